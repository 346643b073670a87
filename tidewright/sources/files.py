"""Delimited files in, forecasts and metrics out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Texts read as missing.
MISSING = ("NA", "")


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str,
    sep: str = ",",
    missing: Sequence[str] = MISSING,
    max_rows: int | None = None,
) -> DataFrame:
    """CSV with a declared schema; compression follows the file name.

    Columns are read as text so that several texts can mean "missing", then
    cast; a value that cannot be cast becomes NULL.
    """
    target = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    text = StructType()
    for f in target.fields:
        text = text.add(f.name, "string")
    raw = spark.read.schema(text).option("header", True).option("sep", sep).csv(path)
    if max_rows is not None:
        raw = raw.limit(max_rows)
    col = lambda f: F.when(~F.col(f.name).isin(*missing), F.col(f.name)).try_cast(f.dataType).alias(f.name)
    return raw.select(*[col(f) for f in target.fields])


def write_forecast(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ("model", "horizon_label")) -> None:
    """Forecast rows, one folder per model and horizon so readers can prune; each
    file is in order of time."""
    by = [c for c in partition_by if c in df.columns]
    writer = df.sortWithinPartitions(*by, *[c for c in ("ts",) if c in df.columns]).write.mode("overwrite").partitionBy(*by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Nested rows as JSON lines."""
    df.write.mode("overwrite").json(path)
