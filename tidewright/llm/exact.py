"""Exact duplicates by a heavy-hitter split.

Misra-Gries sketches (the frequent-items sketch behind ``approx_top_k``) name at
most ``tracked`` digests that may be frequent. Their exact counts and largest
ids are aggregated map-side; this table has at most ``tracked`` rows, so it is
broadcast, and rows of frequent digests are settled where they are read. Every
other digest has at most about ``rows / tracked`` rows and takes the ordinary
shuffle. No digest, however frequent, meets in one task.

Edge cases: a null text counts as empty; a null id is smaller than any other
and equal to a null id; of rows repeated with the same id and text one is kept;
an empty table gives an empty result; extra columns are never touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewright.llm.common import fresh, whole_text
from tidewright.session import cut_lineage

TRACKED = 1024
SKETCH_GROUPS = 64


def text_digest(text: str) -> Column:
    return F.sha2(whole_text(text).cast("binary"), 256)


def frequent_digests(keyed: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """(digest, keep_id, group_size), exact, of the digests that the sketches name
    and that occur more than once: ``tracked`` rows at most."""
    sketches = keyed.groupBy((F.spark_partition_id() % SKETCH_GROUPS).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(digest, {2 * tracked})").alias("sketch")
    )
    # grouped by a constant: an empty partition then sends no empty sketch
    named = sketches.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {2 * tracked})").alias("sketch")).select(
        F.explode(F.transform(F.expr(f"approx_top_k_estimate(sketch, {tracked})"), lambda x: x["item"])).alias("digest")
    )
    return (
        keyed.join(F.broadcast(named), "digest")
        .groupBy("digest")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
    )


def copy_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = TRACKED) -> DataFrame:
    """One row per row of ``docs``: id, keep_id (largest id among equal texts),
    group_size, kept, text_sha256."""
    keyed = cut_lineage(docs.select(F.col(id_col).alias("id"), text_digest(text_col).alias("digest")))
    frequent = cut_lineage(frequent_digests(keyed, tracked))
    settled = keyed.join(F.broadcast(frequent), "digest", "left")
    hot = settled.where(F.col("group_size").isNotNull())
    losers = hot.where(~F.col("id").eqNullSafe(F.col("keep_id"))).withColumn("kept", F.lit(False))
    # rows that repeat the winning id: counted, then written out again, one of them kept
    winners = (
        hot.where(F.col("id").eqNullSafe(F.col("keep_id")))
        .groupBy("digest", "id", "keep_id", "group_size")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
        .withColumn("kept", F.col("copy") == 1)
    )
    each = W.partitionBy("digest")
    rest = (
        settled.where(F.col("group_size").isNull())
        .withColumn("kept", F.row_number().over(each.orderBy(F.desc_nulls_last("id"))) == 1)
        .withColumn("keep_id", F.max("id").over(each))
        .withColumn("group_size", F.count(F.lit(1)).over(each))
    )
    cols = [F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")]
    return losers.select(cols).unionByName(winners.select(cols)).unionByName(rest.select(cols))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = TRACKED) -> DataFrame:
    """``docs`` without later copies: of equal texts the row with the largest id stays."""
    digest, keep, size, rank = fresh(docs, "digest", "keep_id", "group_size", "rank")
    keyed = docs.select(F.col(id_col).alias("id"), text_digest(text_col).alias("digest"))
    frequent = cut_lineage(frequent_digests(keyed, tracked)).toDF(digest, keep, size)
    settled = docs.withColumn(digest, text_digest(text_col)).join(F.broadcast(frequent), digest, "left")
    # of a frequent digest only rows with the winning id go on; one per task leaves the map side
    winners = settled.where(F.col(size).isNotNull() & F.col(id_col).eqNullSafe(F.col(keep))).dropDuplicates([digest])
    rest = (
        settled.where(F.col(size).isNull())
        .withColumn(rank, F.row_number().over(W.partitionBy(digest).orderBy(F.desc_nulls_last(id_col))))
        .where(F.col(rank) == 1)
    )
    return winners.select(docs.columns).unionByName(rest.select(docs.columns))
