"""Registry, the input series every query starts from, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.frequency import floor_to

KEYS = ["series_id"]
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = (fn, sql)
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# ------------------------------------------------------------ base series
# Sums of two-decimal values are rounded back to two decimals so that both
# engines start from identical doubles whatever the order of addition.

def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(F.col("event_type").alias("series_id"), "ts", F.col("value").alias("y"))


def raw_orders(spark: SparkSession, sf: str, by: str | None = "o_orderpriority") -> DataFrame:
    sid = F.col(by) if by else F.lit("all")
    return table(spark, sf, "orders").select(
        sid.alias("series_id"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("y")
    )


def summed(raw: DataFrame, freq: str) -> DataFrame:
    """Total per slot; empty slots stay absent."""
    return raw.groupBy("series_id", floor_to(F.col("ts"), freq).alias("ts")).agg(F.round(F.sum("y"), 2).alias("y"))


def hourly_events(spark, sf):
    return summed(raw_events(spark, sf), "h")


def daily_by_priority(spark, sf):
    return summed(raw_orders(spark, sf), "D")


def daily_all(spark, sf):
    return summed(raw_orders(spark, sf, None), "D")


def monthly_by_priority(spark, sf):
    return summed(raw_orders(spark, sf), "MS")


def _sum_sql(sid: str, ts: str, y: str, unit: str, table_name: str) -> str:
    return (
        f"SELECT {sid} AS series_id, date_trunc('{unit}', {ts})::TIMESTAMP AS ts, round(sum({y}), 2) AS y "
        f"FROM {table_name} GROUP BY {sid}, date_trunc('{unit}', {ts})"
    )


HOURLY_EVENTS = _sum_sql("event_type", "ts", "value", "hour", "events")
DAILY_BY_PRIORITY = _sum_sql("o_orderpriority", "o_orderdate", "o_totalprice", "day", "orders")
DAILY_ALL = (
    "SELECT 'all' AS series_id, date_trunc('day', o_orderdate)::TIMESTAMP AS ts, round(sum(o_totalprice), 2) AS y "
    "FROM orders GROUP BY date_trunc('day', o_orderdate)"
)
MONTHLY_BY_PRIORITY = _sum_sql("o_orderpriority", "o_orderdate", "o_totalprice", "month", "orders")


def with_quiet_hours(hourly: DataFrame) -> DataFrame:
    """Missing readings: the value is unknown at hours 3, 4 and 17."""
    return hourly.withColumn("y", F.when(~F.hour("ts").isin(3, 4, 17), F.col("y")))


def quiet_hours_sql(inner: str) -> str:
    return (
        "SELECT series_id, ts, CASE WHEN hour(ts) NOT IN (3, 4, 17) THEN y END AS y "
        f"FROM ({inner}) AS q"
    )


def with_idle_weekends(daily: DataFrame) -> DataFrame:
    """Intermittent demand: nothing is sold on Saturdays and Sundays."""
    return daily.withColumn("y", F.when(F.weekday("ts") >= 5, F.lit(0.0)).otherwise(F.col("y")))


def idle_weekends_sql(inner: str) -> str:
    return (
        "SELECT series_id, ts, CASE WHEN isodow(ts) >= 6 THEN 0.0::DOUBLE ELSE y END AS y "
        f"FROM ({inner}) AS q"
    )
