"""Calendar, holiday, lag and rolling features."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    DAILY_BY_PRIORITY, HOURLY_EVENTS, KEYS, daily_by_priority, hourly_events, query, quiet_hours_sql,
    raw_events, rounded, table, with_quiet_hours,
)
from tidewright.operators import features as feat

_CALENDAR = """(isodow(ts) - 1)::INTEGER AS dow, (CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END)::INTEGER AS is_weekend,
  month(ts)::INTEGER AS month, dayofyear(ts)::INTEGER AS dayofyear,
  round(sin(2 * pi() * dayofyear(ts) / 365.25::DOUBLE), 9) AS sin_annual,
  round(cos(2 * pi() * dayofyear(ts) / 365.25::DOUBLE), 9) AS cos_annual"""


@query("calendar_features", f"SELECT series_id, ts, y, {_CALENDAR} FROM ({DAILY_BY_PRIORITY}) AS d")
def calendar_features(spark, sf):
    return rounded(feat.calendar_features(daily_by_priority(spark, sf)), 9, "sin_annual", "cos_annual")


@query("calendar_friday_weekend", """
SELECT event_type AS series_id, (isodow(ts) - 1)::INTEGER AS dow,
  (CASE WHEN isodow(ts) IN (5, 6) THEN 1 ELSE 0 END)::INTEGER AS is_weekend, count(*) AS n, round(sum(value), 2) AS y
FROM events GROUP BY event_type, isodow(ts)
""")
def calendar_friday_weekend(spark, sf):
    d = feat.calendar_features(raw_events(spark, sf), weekend_days=(4, 5))
    return d.groupBy("series_id", "dow", "is_weekend").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("y"), 2).alias("y"))


def holidays(spark, sf):
    """Two fixed holidays in every year the orders cover."""
    years = table(spark, sf, "orders").select(F.year("o_orderdate").alias("yr")).distinct()
    days = F.array(
        F.struct(F.make_date("yr", F.lit(1), F.lit(1)).alias("date"), F.lit("New Year").alias("name")),
        F.struct(F.make_date("yr", F.lit(12), F.lit(25)).alias("date"), F.lit("Christmas").alias("name")),
    )
    return years.select(F.lit("AE").alias("country"), F.explode(days).alias("d")).select("country", "d.*")


@query("holiday_join", f"""
SELECT series_id, ts, y, (CASE WHEN (month(ts) = 1 AND day(ts) = 1) OR (month(ts) = 12 AND day(ts) = 25) THEN 1 ELSE 0 END)::INTEGER AS is_holiday
FROM ({DAILY_BY_PRIORITY}) AS d
""")
def holiday_join(spark, sf):
    return feat.holiday_flags(daily_by_priority(spark, sf), holidays(spark, sf), "AE")


def _lag_sql(shift: int) -> str:
    w = "PARTITION BY series_id ORDER BY ts"
    frame = f"{w} ROWS BETWEEN {6 + shift} PRECEDING AND " + (f"{shift} PRECEDING" if shift else "CURRENT ROW")
    lags = ", ".join(f"lag(y, {n}) OVER ({w}) AS lag_{n}" for n in (1, 7, 14))
    return f"""SELECT series_id, ts, y, {lags},
  round(CASE WHEN count(y) OVER ({frame}) >= 7 THEN avg(y) OVER ({frame}) END, 3) AS roll7_mean,
  round(CASE WHEN count(y) OVER ({frame}) >= 7 THEN stddev_samp(y) OVER ({frame}) END, 3) AS roll7_std
FROM ({DAILY_BY_PRIORITY}) AS d"""


@query("lag_roll_features", _lag_sql(0))
def lag_roll_features(spark, sf):
    return rounded(feat.lag_roll_features(daily_by_priority(spark, sf), KEYS, past_only=False), 3, "roll7_mean", "roll7_std")


@query("lag_roll_past_only", _lag_sql(1))
def lag_roll_past_only(spark, sf):
    return rounded(feat.lag_roll_features(daily_by_priority(spark, sf), KEYS), 3, "roll7_mean", "roll7_std")


@query("lag_roll_blocks", _lag_sql(1))
def lag_roll_blocks(spark, sf):
    d = feat.lag_roll_features(daily_by_priority(spark, sf), KEYS, block_rows=256)
    return rounded(d, 3, "roll7_mean", "roll7_std")


def _rolling_sql(window: int, at_least: int) -> str:
    f = f"PARTITION BY series_id ORDER BY ts ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW"
    return f"""SELECT series_id, ts, y,
  round(CASE WHEN count(y) OVER ({f}) >= {at_least} THEN avg(y) OVER ({f}) END, 6) AS roll_mean,
  round(CASE WHEN count(y) OVER ({f}) >= {max(2, at_least)} THEN stddev_samp(y) OVER ({f}) END, 6) AS roll_std
FROM ({quiet_hours_sql(HOURLY_EVENTS)}) AS d"""


@query("rolling_min_periods", _rolling_sql(30, 1))
def rolling_min_periods(spark, sf):
    return rounded(feat.rolling_stats(with_quiet_hours(hourly_events(spark, sf)), KEYS), 6, "roll_mean", "roll_std")


@query("moving_average_7", _rolling_sql(7, 1))
def moving_average_7(spark, sf):
    d = feat.rolling_stats(with_quiet_hours(hourly_events(spark, sf)), KEYS, window=7)
    return rounded(d, 6, "roll_mean", "roll_std")


@query("feature_join", f"""
WITH d AS ({DAILY_BY_PRIORITY}),
s AS (SELECT date_trunc('day', l_shipdate)::TIMESTAMP AS ts, sum(l_quantity) AS shipped FROM lineitem GROUP BY 1)
SELECT d.series_id, d.ts, d.y, coalesce(s.shipped, 0.0::DOUBLE) AS shipped FROM d LEFT JOIN s ON d.ts = s.ts
""")
def feature_join(spark, sf):
    shipped = (
        table(spark, sf, "lineitem").groupBy(F.date_trunc("day", "l_shipdate").cast("timestamp_ntz").alias("ts"))
        .agg(F.sum("l_quantity").alias("shipped"))
    )
    return feat.align_candidates(daily_by_priority(spark, sf), shipped, ["shipped"])


@query("complete_feature_rows", f"WITH f AS ({_lag_sql(1)}) SELECT * FROM f WHERE lag_14 IS NOT NULL AND roll7_mean IS NOT NULL AND roll7_std IS NOT NULL")
def complete_feature_rows(spark, sf):
    d = feat.complete_rows(feat.lag_roll_features(daily_by_priority(spark, sf), KEYS), ["y", "lag_1", "lag_7", "lag_14", "roll7_mean", "roll7_std"])
    return rounded(d, 3, "roll7_mean", "roll7_std")


@query("last_rows_180", f"""
SELECT series_id, ts, y FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) AS k FROM ({DAILY_BY_PRIORITY}) AS d) AS r WHERE k <= 180
""")
def last_rows_180(spark, sf):
    return feat.last_rows(daily_by_priority(spark, sf), 180, KEYS)


@query("leakage_report", f"""
WITH f AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS rn, y AS lag_0 FROM ({_lag_sql(1)}) AS l),
h AS (SELECT * FROM f WHERE rn <= 40),
c AS (SELECT series_id, count(*) FILTER (lag_0 IS NULL) AS lag_0, count(*) FILTER (lag_1 IS NULL) AS lag_1, count(*) FILTER (lag_7 IS NULL) AS lag_7,
  count(*) FILTER (lag_14 IS NULL) AS lag_14, count(*) FILTER (roll7_mean IS NULL) AS roll7_mean, count(*) FILTER (roll7_std IS NULL) AS roll7_std FROM h GROUP BY series_id),
u AS (UNPIVOT c ON lag_0, lag_1, lag_7, lag_14, roll7_mean, roll7_std INTO NAME feature VALUE early_nulls)
SELECT series_id, feature, early_nulls, early_nulls = 0 AS suspect FROM u
""")
def leakage_report(spark, sf):
    d = feat.lag_roll_features(daily_by_priority(spark, sf), KEYS).withColumn("lag_0", F.col("y"))
    return feat.leakage_report(d, ["lag_0", "lag_1", "lag_7", "lag_14", "roll7_mean", "roll7_std"], KEYS)


@query("leakage_current_row", f"""
WITH f AS (SELECT series_id, ts, y, avg(y) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS now,
  avg(y) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS past,
  row_number() OVER (PARTITION BY series_id ORDER BY ts) AS rn FROM ({DAILY_BY_PRIORITY}) AS d)
SELECT series_id, round(avg((rn > 1 AND abs(now - past) > 1e-9 * greatest(1.0, abs(past)))::INTEGER), 6) AS leak_share FROM f WHERE rn >= 7 GROUP BY series_id
""")
def leakage_current_row(spark, sf):
    d = feat.lag_roll_features(daily_by_priority(spark, sf), KEYS, past_only=False)
    return rounded(feat.current_row_leakage(d, "roll7_mean", 7, KEYS), 6, "leak_share")
