"""The batch resample and drift check on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewright.operators.monitor import bin_counts, psi_from_counts
from tidewright.session import cut_lineage


def resample_stream(
    stream: DataFrame, every: str, late: str, keys: Sequence[str] = (), ts: str = "ts", y: str = "y"
) -> DataFrame:
    """Mean, sum and count per window; state older than the watermark is dropped.
    Watermarks need a zoned timestamp, so local ones pass through UTC."""
    col = F.col(y)
    return (
        stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
        .groupBy(*keys, F.window(ts, every).alias("_w"))
        .agg(F.avg(col).alias("mean"), F.sum(col).alias("sum"), F.count(col).alias("n"))
        .select(*keys, F.col("_w.start").cast("timestamp_ntz").alias(ts), "mean", "sum", "n")
    )


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Everything available now, appended to parquet with exactly-once output."""
    return (
        df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def watch_drift(
    stream: DataFrame, edges: DataFrame, base_counts: DataFrame, keys: Sequence[str], path: str, checkpoint: str, y: str = "y", bins: int = 10
) -> StreamingQuery:
    """PSI of every micro-batch against a stored baseline, appended to ``path``.
    Each batch writes its own folder, so a repeated batch overwrites itself. The
    baseline is materialised once, not once per batch."""
    edges, base_counts = cut_lineage(edges), cut_lineage(base_counts)

    def check(batch: DataFrame, batch_id: int) -> None:
        now = bin_counts(batch, edges, keys, y, bins).withColumnRenamed("counts", "now_counts")
        out = now.join(base_counts.withColumnRenamed("counts", "base_counts"), list(keys))
        out = out.withColumn("psi", psi_from_counts(F.col("base_counts"), F.col("now_counts"))).select(*keys, "psi")
        out.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
