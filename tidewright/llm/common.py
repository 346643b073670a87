"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with any column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def whole_text(text: str) -> Column:
    """The text, a null counting as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def per_worker(key, make):
    """Build a read-only table once per Python worker, whatever the number of
    tasks it runs; at most 16 tables are held."""
    held = sys.modules.setdefault("_tidewright_worker_tables", {})
    if key not in held:
        while len(held) >= 16:
            held.pop(next(iter(held)))
        held[key] = make()
    return held[key]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
