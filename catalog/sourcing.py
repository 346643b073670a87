"""Reading, parsing and writing."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import DAILY_ALL, KEYS, MONTHLY_BY_PRIORITY, daily_all, monthly_by_priority, query, raw_events, table
from catalog.evaluating import _SNAIVE
from catalog.profiling import _basic_sql, _round_basic
from tidewright.models import naive
from tidewright.operators import profile, screening
from tidewright.session import scratch_path
from tidewright.sources import files, parse


_ORDERS = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice, o_orderdate,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders"""


@query("csv_roundtrip", _ORDERS)
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "orders")
    d = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "NA").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        "o_orderdate",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    d.write.option("header", True).option("sep", ";").option("compression", "gzip").csv(path)
    schema = "o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    return files.read_csv(spark, path, schema, sep=";")


@query("forecast_roundtrip", f"SELECT series_id, ts, step, forecast, 'snaive' AS model, '24m' AS horizon_label FROM ({_SNAIVE}) AS f")
def forecast_roundtrip(spark, sf):
    path = scratch_path(spark, "forecast")
    f = naive.seasonal_naive(monthly_by_priority(spark, sf), "MS", 24, KEYS)
    files.write_forecast(f.withColumns({"model": F.lit("snaive"), "horizon_label": F.lit("24m")}), path)
    return spark.read.parquet(path).where("model = 'snaive'")


@query("forecast_csv_roundtrip", f"SELECT series_id, ts, step, forecast, 'snaive' AS model, '24m' AS horizon_label FROM ({_SNAIVE}) AS f")
def forecast_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "forecast-csv")
    f = naive.seasonal_naive(monthly_by_priority(spark, sf), "MS", 24, KEYS)
    files.write_forecast(f.withColumns({"model": F.lit("snaive"), "horizon_label": F.lit("24m")}), path, fmt="csv")
    schema = "series_id string, ts timestamp_ntz, step int, forecast double"
    return spark.read.option("header", True).schema(schema + ", model string, horizon_label string").csv(path)


@query("metrics_json_roundtrip", _basic_sql(DAILY_ALL, 3))
def metrics_json_roundtrip(spark, sf):
    path = scratch_path(spark, "metrics")
    stats = profile.basic_stats(daily_all(spark, sf), KEYS)
    nested = stats.select("series_id", F.struct(*[c for c in stats.columns if c != "series_id"]).alias("basic_stats"))
    files.write_metrics(nested, path)
    return _round_basic(spark.read.schema(nested.schema).json(path).select("series_id", "basic_stats.*"), 3)


# ------------------------------------------------------------------- parsing

@query("rename_target", "SELECT o_orderkey, o_orderdate AS ts, o_totalprice AS y FROM orders")
def rename_target(spark, sf):
    d = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("ts"), "o_totalprice")
    return parse.rename_target(d, "o_totalprice")


@query("composite_series_id", """
SELECT o_orderstatus || '_' || o_orderpriority AS series_id, count(*) AS n, round(sum(o_totalprice), 2) AS y FROM orders GROUP BY 1
""")
def composite_series_id(spark, sf):
    d = parse.with_series_id(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])
    return d.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("y"))


@query("first_series", """
WITH h AS (SELECT event_type FROM events ORDER BY ts, event_type LIMIT 1) SELECT event_type AS series_id, ts, value AS y FROM events WHERE event_type = (SELECT event_type FROM h)
""")
def first_series(spark, sf):
    return parse.first_series(raw_events(spark, sf))


def _register_dates(name: str, duck: str, text, expect: str) -> None:
    sql = f"SELECT o_orderkey, {expect} AS ts, strftime(o_orderdate, '{duck}') AS text FROM orders"

    @query(name, sql)
    def run(spark, sf):
        d = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", text).alias("text"))
        return parse.parse_dates(d, "text")


_register_dates("parse_dates_dmy", "%d-%m-%Y", "dd-MM-yyyy", "o_orderdate")
_register_dates("parse_dates_dmy_slash", "%d/%m/%Y", "dd/MM/yyyy", "o_orderdate")
_register_dates("parse_dates_iso", "%Y-%m-%d", "yyyy-MM-dd", "o_orderdate")
_register_dates("parse_dates_mdy", "%m-%d-%Y", "MM-dd-yyyy", "o_orderdate")
_register_dates("parse_dates_mdy_slash", "%m/%d/%Y", "MM/dd/yyyy", "o_orderdate")


@query("parse_dates_month_year", """
SELECT o_orderkey, month(o_orderdate) || '-' || strftime(o_orderdate, '%y') AS text,
  (date_trunc('month', o_orderdate) + to_years((CASE WHEN year(o_orderdate) < 2000 THEN 100 ELSE 0 END)::INTEGER))::TIMESTAMP AS ts FROM orders
""")
def parse_dates_month_year(spark, sf):
    d = table(spark, sf, "orders").select("o_orderkey", F.concat(F.month("o_orderdate").cast("string"), F.lit("-"), F.date_format("o_orderdate", "yy")).alias("text"))
    return parse.parse_dates(d, "text")


@query("combine_date_time", "SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS ts FROM events")
def combine_date_time(spark, sf):
    d = table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("date"), F.date_format("ts", "HH:mm:ss").alias("time"))
    return parse.combine_date_time(d, "date", "time").select("event_id", "ts")


@query("combine_date_parts", "SELECT event_id, date_trunc('hour', ts)::TIMESTAMP AS ts FROM events")
def combine_date_parts(spark, sf):
    d = table(spark, sf, "events").select("event_id", F.year("ts").alias("year"), F.month("ts").alias("month"), F.day("ts").alias("day"), F.hour("ts").alias("hour"))
    return parse.combine_parts(d, "year", "month", "day", "hour").select("event_id", "ts")


@query("date_plus_time_of_day", "SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS ts FROM events")
def date_plus_time_of_day(spark, sf):
    d = table(spark, sf, "events").select("event_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts0"), F.date_format("ts", "H:mm:ss").alias("Time"))
    return parse.add_time_of_day(d.withColumnRenamed("ts0", "ts"))


@query("numeric_varying_columns", """
WITH s AS (SELECT stddev_samp(l_orderkey) AS l_orderkey, stddev_samp(l_partkey) AS l_partkey, stddev_samp(l_suppkey) AS l_suppkey, stddev_samp(l_linenumber) AS l_linenumber,
  stddev_samp(l_quantity) AS l_quantity, stddev_samp(l_extendedprice) AS l_extendedprice, stddev_samp(l_discount) AS l_discount, stddev_samp(l_tax) AS l_tax FROM lineitem),
u AS (UNPIVOT s ON * INTO NAME feature VALUE sd), c AS (SELECT count(*) AS n FROM lineitem)
SELECT feature, n FROM u, c WHERE sd > 0
""")
def numeric_varying_columns(spark, sf):
    d = table(spark, sf, "lineitem").withColumn("always_one", F.lit(1))
    kept = screening.varying_columns(d, screening.numeric_columns(d))
    return d.agg(F.count(F.lit(1)).alias("n")).select(F.explode(F.array(*[F.lit(c) for c in kept])).alias("feature"), "n")


@query("non_negative_clip", "SELECT o_orderkey, CASE WHEN o_totalprice - 200000 < 0 THEN 0.0::DOUBLE ELSE round(o_totalprice - 200000, 2) END AS y FROM orders")
def non_negative_clip(spark, sf):
    from tidewright.functions.expressions import clip_non_negative

    return table(spark, sf, "orders").select("o_orderkey", F.round(clip_non_negative(F.col("o_totalprice") - 200000), 2).alias("y"))


@query("preview_top", f"SELECT * FROM (SELECT series_id, ts, y FROM ({MONTHLY_BY_PRIORITY}) AS m ORDER BY ts, series_id LIMIT 3) AS t")
def preview_top(spark, sf):
    return monthly_by_priority(spark, sf).orderBy("ts", "series_id").limit(3)
