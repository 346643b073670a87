"""Resampling, frequency, gaps, filling, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    DAILY_ALL, DAILY_BY_PRIORITY, HOURLY_EVENTS, KEYS, daily_all, daily_by_priority, hourly_events,
    query, quiet_hours_sql, raw_events, raw_orders, rounded, table, with_quiet_hours,
)
from tidewright.operators import regularize as reg

# ---------------------------------------------------------------- resample

_AGG = {
    "mean": "avg(value)", "max": "max(value)", "min": "min(value)", "median": "quantile_cont(value, 0.5)",
    "first": "first(value ORDER BY ts, value)", "last": "last(value ORDER BY ts, value)",
}


def _register_resample(method: str, expr: str) -> None:
    sql = (
        f"SELECT event_type AS series_id, date_trunc('hour', ts)::TIMESTAMP AS ts, round({expr}, 7) AS y "
        "FROM events GROUP BY event_type, date_trunc('hour', ts)"
    )

    @query(f"resample_hourly_{method}", sql)
    def run(spark, sf):
        return rounded(reg.resample(raw_events(spark, sf), "h", KEYS, method=method), 7, "y")


for _m, _e in _AGG.items():
    _register_resample(_m, _e)


@query("resample_hourly_sum", f"""
WITH h AS ({HOURLY_EVENTS}),
e AS (SELECT series_id, min(ts) AS a, max(ts) AS b FROM h GROUP BY series_id),
s AS (SELECT series_id, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS ts FROM e)
SELECT s.series_id, s.ts::TIMESTAMP AS ts, coalesce(h.y, 0.0::DOUBLE) AS y
FROM s LEFT JOIN h ON s.series_id = h.series_id AND s.ts = h.ts
""")
def resample_hourly_sum(spark, sf):
    return rounded(reg.resample(raw_events(spark, sf), "h", KEYS, method="sum"), 2, "y")


@query("resample_15min", """
SELECT event_type AS series_id, time_bucket(INTERVAL 15 MINUTE, ts)::TIMESTAMP AS ts, round(avg(value), 7) AS y
FROM events GROUP BY event_type, time_bucket(INTERVAL 15 MINUTE, ts)
""")
def resample_15min(spark, sf):
    return rounded(reg.resample(raw_events(spark, sf), "15min", KEYS), 7, "y")


@query("auto_resample", """
WITH q AS (SELECT event_type AS series_id, time_bucket(INTERVAL 15 MINUTE, ts)::TIMESTAMP AS ts,
  round(sum(value), 2) AS y FROM events GROUP BY event_type, time_bucket(INTERVAL 15 MINUTE, ts))
SELECT series_id, date_trunc('hour', ts)::TIMESTAMP AS ts, round(avg(y), 7) AS y, 'h' AS freq
FROM q GROUP BY series_id, date_trunc('hour', ts)
""")
def auto_resample(spark, sf):
    quarter = rounded(reg.resample(raw_events(spark, sf), "15min", KEYS, method="sum"), 2, "y").where("y > 0")
    out, label = reg.auto_resample(quarter, "15min", KEYS)
    return rounded(out, 7, "y").withColumn("freq", F.lit(label))


# --------------------------------------------------------------- frequency

_LADDER = """CASE WHEN g <= 60 THEN 'min' WHEN g <= 300 THEN '5min' WHEN g <= 900 THEN '15min' WHEN g <= 1800 THEN '30min'
WHEN g <= 3600 THEN 'h' WHEN g <= 21600 THEN '6h' WHEN g <= 86400 THEN 'D' WHEN g <= 604800 THEN 'W'
WHEN g <= 2678400 THEN 'MS' WHEN g <= 7948800 THEN 'QS' ELSE 'YS' END"""


@query("infer_freq", f"""
WITH s AS (
  SELECT 'hour/' || series_id AS series_id, ts FROM ({HOURLY_EVENTS}) AS a
  UNION ALL SELECT 'day/' || o_orderpriority, o_orderdate FROM orders
  UNION ALL SELECT 'month/all', date_trunc('month', o_orderdate) FROM orders
  UNION ALL SELECT 'raw/' || event_type, ts FROM events),
d AS (SELECT DISTINCT series_id, ts::TIMESTAMP AS ts FROM s),
g AS (SELECT series_id, date_diff('microsecond', lag(ts) OVER (PARTITION BY series_id ORDER BY ts), ts) / 1e6 AS g FROM d),
c AS (SELECT series_id, g, count(*) AS n FROM g WHERE g > 0 GROUP BY series_id, g),
r AS (SELECT series_id, g, row_number() OVER (PARTITION BY series_id ORDER BY n DESC, g) AS k FROM c)
SELECT series_id, g::DOUBLE AS gap_seconds, {_LADDER} AS freq,
  CASE WHEN g <= 1800 THEN 'h' END AS resample_to FROM r WHERE k = 1
""")
def infer_freq(spark, sf):
    tag = lambda name, df: df.select(F.concat(F.lit(name + "/"), F.col("series_id")).alias("series_id"), "ts")
    months = raw_orders(spark, sf, None).withColumn("ts", F.date_trunc("month", "ts").cast("timestamp_ntz"))
    series = (
        tag("hour", hourly_events(spark, sf)).unionByName(tag("day", raw_orders(spark, sf)))
        .unionByName(tag("month", months)).unionByName(tag("raw", raw_events(spark, sf)))
    )
    return reg.infer_frequency(series, KEYS)


@query("coarse_frequency", f"""
WITH s AS (SELECT 'day/' || series_id AS series_id, ts FROM ({DAILY_BY_PRIORITY}) AS a UNION ALL SELECT 'hour/' || series_id, ts FROM ({HOURLY_EVENTS}) AS b
  UNION ALL SELECT DISTINCT 'month/all', date_trunc('month', o_orderdate)::TIMESTAMP FROM orders),
g AS (SELECT series_id, date_diff('second', lag(ts) OVER (PARTITION BY series_id ORDER BY ts), ts)::DOUBLE AS g FROM s),
m AS (SELECT series_id, quantile_cont(g, 0.5) AS g FROM g GROUP BY series_id)
SELECT series_id, g AS median_gap_seconds, CASE WHEN g <= 3600 THEN 'h' WHEN g <= 86400 THEN 'D' WHEN g <= 604800 THEN 'W' WHEN g <= 2678400 THEN 'MS'
  WHEN g <= 7948800 THEN 'QS' ELSE 'YS' END AS freq FROM m
""")
def coarse_frequency(spark, sf):
    tag = lambda name, df: df.select(F.concat(F.lit(name + "/"), F.col("series_id")).alias("series_id"), "ts")
    months = raw_orders(spark, sf, None).withColumn("ts", F.date_trunc("month", "ts").cast("timestamp_ntz"))
    series = tag("day", raw_orders(spark, sf)).unionByName(tag("hour", hourly_events(spark, sf))).unionByName(tag("month", months))
    return reg.coarse_frequency(series, KEYS)


@query("gap_list", f"""
WITH d AS ({DAILY_BY_PRIORITY}),
g AS (SELECT series_id, ts, lag(ts) OVER (PARTITION BY series_id ORDER BY ts) AS prev_ts FROM d)
SELECT series_id, ts, prev_ts, date_diff('microsecond', prev_ts, ts)::BIGINT AS gap_us FROM g
""")
def gap_list(spark, sf):
    return reg.gaps(raw_orders(spark, sf), KEYS, chunk="month")


# --------------------------------------------------------------------- gaps

_GAP_SQL = """
WITH h AS ({inner}),
b AS (SELECT series_id, count(*) AS n, min(ts) AS a, max(ts) AS z, count(DISTINCT hour(ts)) AS active_hours FROM h GROUP BY series_id),
e AS (SELECT *, date_diff('{unit}', a, z) + 1 AS expected, floor(date_diff('second', a, z) / 86400)::BIGINT + 1 AS days FROM b),
p AS (SELECT *, expected - n AS missing, (expected - n)::DOUBLE / expected AS share,
  ('{unit}' = 'hour' AND expected > n AND active_hours < 24 AND abs(n - days * active_hours) < days * 2) AS partial_day FROM e)
SELECT series_id, n AS n_periods, expected AS expected_periods, missing AS missing_periods, round(share, 9) AS gap_pct,
  active_hours, days AS total_days, partial_day,
  CASE WHEN missing <= 0 THEN 'none' WHEN share < 0.1 THEN 'ffill' WHEN partial_day THEN 'zero' ELSE 'keep' END AS fill_policy FROM p
"""


def office_hours(spark, sf):
    """All event types together, seen only from 8:00 to 19:59."""
    d = hourly_events(spark, sf).groupBy("ts").agg(F.round(F.sum("y"), 2).alias("y"))
    return d.where(F.hour("ts").between(8, 19)).select(F.lit("office").alias("series_id"), "ts", "y")


OFFICE = f"""SELECT 'office' AS series_id, ts, round(sum(y), 2) AS y FROM ({HOURLY_EVENTS}) AS o
WHERE hour(ts) BETWEEN 8 AND 19 GROUP BY ts"""


@query("gap_report_hourly", _GAP_SQL.format(inner=f"{HOURLY_EVENTS} UNION ALL {OFFICE}", unit="hour"))
def gap_report_hourly(spark, sf):
    d = hourly_events(spark, sf).unionByName(office_hours(spark, sf))
    return rounded(reg.gap_report(d, "h", KEYS), 9, "gap_pct").withColumn("active_hours", F.col("active_hours").cast("long"))


@query("gap_report_daily", _GAP_SQL.format(inner=f"{DAILY_BY_PRIORITY} UNION ALL {DAILY_ALL}", unit="day"))
def gap_report_daily(spark, sf):
    d = daily_by_priority(spark, sf).unionByName(daily_all(spark, sf))
    return rounded(reg.gap_report(d, "D", KEYS), 9, "gap_pct").withColumn("active_hours", F.col("active_hours").cast("long"))


_SPINE = """e AS (SELECT series_id, min(ts) AS a, max(ts) AS b FROM h GROUP BY series_id),
s AS (SELECT series_id, unnest(generate_series(a, b, INTERVAL 1 {unit}))::TIMESTAMP AS ts FROM e)"""


@query("missing_periods", f"""
WITH h AS ({DAILY_BY_PRIORITY}), {_SPINE.format(unit='DAY')}
SELECT s.series_id, s.ts FROM s ANTI JOIN h ON s.series_id = h.series_id AND s.ts = h.ts
""")
def missing_periods(spark, sf):
    return reg.missing_periods(daily_by_priority(spark, sf), "D", KEYS)


_ALIGNED = f"""
WITH h AS ({HOURLY_EVENTS}), {_SPINE.format(unit='HOUR')}
SELECT s.series_id, s.ts, h.y, (CASE WHEN h.ts IS NULL THEN 1 ELSE 0 END)::INTEGER AS imputed_flag
FROM s LEFT JOIN h ON s.series_id = h.series_id AND s.ts = h.ts
"""


@query("align_to_spine", _ALIGNED)
def align_to_spine(spark, sf):
    return reg.align_to_spine(hourly_events(spark, sf), "h", KEYS)


@query("densify_grid", _ALIGNED)
def densify_grid(spark, sf):
    return reg.densify(hourly_events(spark, sf), "h", KEYS)


@query("densify_grid_blocks", _ALIGNED)
def densify_grid_blocks(spark, sf):
    return reg.densify(hourly_events(spark, sf), "h", KEYS, block_rows=64)


# --------------------------------------------------------------------- fill

_FILLED = """coalesce(last_value(y IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(y IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query("fill_ffill_bfill", f"""
WITH d AS ({_ALIGNED}) SELECT series_id, ts, imputed_flag, {_FILLED} AS y FROM d
""")
def fill_ffill_bfill(spark, sf):
    return reg.fill_forward_backward(reg.densify(hourly_events(spark, sf), "h", KEYS), KEYS)


@query("carry_forward_chunks", f"""
WITH h AS ({quiet_hours_sql(HOURLY_EVENTS)})
SELECT series_id, ts, y, last_value(y IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM h
""")
def carry_forward_chunks(spark, sf):
    from tidewright.operators.layout import carry

    return carry(with_quiet_hours(hourly_events(spark, sf)), KEYS, "ts", "y", "carried", chunk="day")


def policy_sql(inner: str, unit: str = "hour") -> str:
    return f"""
WITH h AS ({inner}), r AS ({_GAP_SQL.format(inner='SELECT * FROM h', unit=unit)}), {_SPINE.format(unit=unit)},
d AS (SELECT s.series_id, s.ts, h.y, (CASE WHEN h.ts IS NULL THEN 1 ELSE 0 END)::INTEGER AS imputed_flag, r.fill_policy
  FROM s JOIN r ON s.series_id = r.series_id LEFT JOIN h ON s.series_id = h.series_id AND s.ts = h.ts),
f AS (SELECT *, {_FILLED} AS filled FROM d)
SELECT series_id, ts, imputed_flag, fill_policy,
  CASE fill_policy WHEN 'ffill' THEN filled WHEN 'zero' THEN coalesce(y, 0.0::DOUBLE) ELSE y END AS y
FROM f WHERE fill_policy IN ('ffill', 'zero') OR imputed_flag = 0
"""


@query("fill_partial_day_zero", policy_sql(OFFICE))
def fill_partial_day_zero(spark, sf):
    return reg.fill_gaps(office_hours(spark, sf), "h", KEYS)


def mixed_hourly(spark, sf):
    """Series that fall in different branches of the gap policy."""
    late = hourly_events(spark, sf).where("y > 120").withColumn("series_id", F.concat(F.lit("busy/"), "series_id"))
    return hourly_events(spark, sf).unionByName(office_hours(spark, sf)).unionByName(late)


MIXED = f"""{HOURLY_EVENTS} UNION ALL {OFFICE}
UNION ALL SELECT 'busy/' || series_id, ts, y FROM ({HOURLY_EVENTS}) AS m WHERE y > 120"""


@query("fill_policy", policy_sql(MIXED))
def fill_policy(spark, sf):
    return reg.fill_gaps(mixed_hourly(spark, sf), "h", KEYS)


def _lookback_sql(period: int) -> str:
    return f"""
WITH h AS ({quiet_hours_sql(HOURLY_EVENTS)}),
n AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS rn FROM h),
p AS (SELECT series_id, ts, rn, last_value(y IGNORE NULLS) OVER (PARTITION BY series_id, rn % {period} ORDER BY rn
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y FROM n)
SELECT series_id, ts, {_FILLED} AS y FROM p
"""


@query("impute_lookback", _lookback_sql(24))
def impute_lookback(spark, sf):
    return reg.impute_lookback(with_quiet_hours(hourly_events(spark, sf)), "h", KEYS)


@query("impute_lookback_compat", _lookback_sql(1))
def impute_lookback_compat(spark, sf):
    return reg.impute_lookback(with_quiet_hours(hourly_events(spark, sf)), "h", KEYS, compat=True)


@query("fill_policy_blocks", policy_sql(MIXED))
def fill_policy_blocks(spark, sf):
    return reg.fill_gaps(mixed_hourly(spark, sf), "h", KEYS, block_rows=100, chunk="day")


@query("impute_lookback_chunks", _lookback_sql(24))
def impute_lookback_chunks(spark, sf):
    return reg.impute_lookback(with_quiet_hours(hourly_events(spark, sf)), "h", KEYS, chunk="week")


@query("month_start", """
SELECT o_orderpriority AS series_id, date_trunc('month', o_orderdate)::TIMESTAMP AS ts, count(*) AS n
FROM orders GROUP BY o_orderpriority, date_trunc('month', o_orderdate)
""")
def month_start(spark, sf):
    return reg.normalise_months(raw_orders(spark, sf)).groupBy("series_id", "ts").agg(F.count(F.lit(1)).alias("n"))


# Prices in whole cents add up exactly in any order, so nothing needs rounding.
_DEDUPE = {"mean": "avg({})", "sum": "sum({})", "min": "min({})", "max": "max({})", "first": "arg_min({}, o_orderkey)", "last": "arg_max({}, o_orderkey)"}


def _register_dedupe(policy: str, expr: str) -> None:
    sql = (
        f"SELECT o_orderpriority AS series_id, o_orderdate AS ts, {expr.format('round(o_totalprice * 100)')} AS y, count(*) AS n_rows "
        "FROM orders GROUP BY o_orderpriority, o_orderdate"
    )

    @query(f"dedupe_timestamps_{policy}", sql)
    def run(spark, sf):
        d = table(spark, sf, "orders").select(
            F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").alias("ts"),
            F.round(F.col("o_totalprice") * 100).alias("y"), "o_orderkey",
        )
        return reg.dedupe_timestamps(d, KEYS, policy=policy, order="o_orderkey")


for _p, _e in _DEDUPE.items():
    _register_dedupe(_p, _e)


# ----------------------------------------------------------------- validate

OUTLIERS_SQL = """
q AS (SELECT series_id, quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.75) AS q3 FROM d GROUP BY series_id),
f AS (SELECT d.*, coalesce(y < q1 - 1.5 * (q3 - q1) OR y > q3 + 1.5 * (q3 - q1), false) AS is_outlier
  FROM d JOIN q ON d.series_id = q.series_id)
"""


@query("row_outlier_flags", f"WITH d AS ({HOURLY_EVENTS}), {OUTLIERS_SQL} SELECT series_id, ts, y, is_outlier FROM f")
def row_outlier_flags(spark, sf):
    return reg.flag_outliers(hourly_events(spark, sf), KEYS)


@query("iqr_outliers_raw", f"""
WITH d AS (SELECT event_type AS series_id, value AS y FROM events), {OUTLIERS_SQL}
SELECT series_id, count(*) AS n_rows, count(*) FILTER (is_outlier) AS n_outliers,
  round(avg(is_outlier::INTEGER), 9) AS outlier_share FROM f GROUP BY series_id
""")
def iqr_outliers_raw(spark, sf):
    return rounded(reg.outlier_share(raw_events(spark, sf), KEYS, gridded=False), 9, "outlier_share")


@query("validate_series", f"""
WITH d AS ({quiet_hours_sql(HOURLY_EVENTS)} UNION ALL SELECT o_orderstatus, o_orderdate, o_totalprice - 150000 FROM orders
  UNION ALL SELECT 'months', date_trunc('year', o_orderdate)::TIMESTAMP, max(o_totalprice) FROM orders GROUP BY 2), {OUTLIERS_SQL},
s AS (SELECT series_id, count(*) AS n_rows, min(y) AS min_y, avg((y IS NULL)::INTEGER) AS ms, avg(is_outlier::INTEGER) AS os FROM f GROUP BY series_id)
SELECT series_id, n_rows, min_y, round(ms, 9) AS missing_share, round(os, 9) AS outlier_share,
  concat_ws(',', CASE WHEN n_rows < 30 THEN 'too_few_rows' END, CASE WHEN min_y < 0 THEN 'negative_values' END,
    CASE WHEN ms > 0.2 THEN 'too_many_missing' END) AS violations,
  concat_ws(',', CASE WHEN os > 0.1 THEN 'many_outliers' END) AS warnings FROM s
""")
def validate_series(spark, sf):
    orders = table(spark, sf, "orders")
    shifted = orders.select(F.col("o_orderstatus").alias("series_id"), F.col("o_orderdate").alias("ts"), (F.col("o_totalprice") - 150000).alias("y"))
    yearly = orders.groupBy(F.date_trunc("year", "o_orderdate").cast("timestamp_ntz").alias("ts")).agg(F.max("o_totalprice").alias("y"))
    d = (
        with_quiet_hours(hourly_events(spark, sf)).unionByName(shifted)
        .unionByName(yearly.select(F.lit("months").alias("series_id"), "ts", "y"))
    )
    out = rounded(reg.validate_series(d, KEYS, gridded=False), 9, "missing_share", "outlier_share")
    return out.withColumns({c: F.concat_ws(",", c) for c in ("violations", "warnings")})
