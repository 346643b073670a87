"""Descriptive statistics and chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    DAILY_BY_PRIORITY, HOURLY_EVENTS, KEYS, MONTHLY_BY_PRIORITY, daily_by_priority, hourly_events,
    idle_weekends_sql, monthly_by_priority, query, quiet_hours_sql, raw_events, raw_orders, rounded,
    with_idle_weekends, with_quiet_hours,
)
from tidewright.operators import profile, sketches, structure


def _basic_sql(inner: str, d: int) -> str:
    return f"""
WITH s AS (SELECT series_id, count(*) AS count, avg(y) AS mean, stddev_samp(y) AS std, min(y) AS min, max(y) AS max,
  quantile_cont(y, 0.5) AS median, quantile_cont(y, 0.25) AS p25, quantile_cont(y, 0.75) AS p75,
  count(*) FILTER (y = 0) AS zeros_count FROM ({inner}) AS d GROUP BY series_id)
SELECT series_id, count, round(mean, {d}) AS mean, round(std, {d}) AS std, min, max, round(median, {d}) AS median,
  round(p25, {d}) AS p25, round(p75, {d}) AS p75, round(std / greatest(abs(mean), 1e-8::DOUBLE), 7) AS cv,
  zeros_count, round(100.0::DOUBLE * zeros_count / count, 7) AS zeros_pct FROM s"""


def _round_basic(df, d):
    return rounded(rounded(df, d, "mean", "std", "median", "p25", "p75"), 7, "cv", "zeros_pct")


@query("basic_stats", _basic_sql(idle_weekends_sql(DAILY_BY_PRIORITY), 3))
def basic_stats(spark, sf):
    return _round_basic(profile.basic_stats(with_idle_weekends(daily_by_priority(spark, sf)), KEYS), 3)


@query("basic_stats_raw", _basic_sql("SELECT event_type AS series_id, value AS y FROM events", 6))
def basic_stats_raw(spark, sf):
    return _round_basic(profile.basic_stats(raw_events(spark, sf), KEYS, gridded=False), 6)


@query("quality", f"""
SELECT series_id, count(*) FILTER (y IS NULL) AS missing_count, round(100.0::DOUBLE * count(*) FILTER (y IS NULL) / count(*), 7) AS missing_pct,
  count(DISTINCT y) AS unique_count, round(100.0::DOUBLE * count(DISTINCT y) / count(*), 7) AS unique_pct
FROM ({quiet_hours_sql(HOURLY_EVENTS)}) AS d GROUP BY series_id
""")
def quality(spark, sf):
    return rounded(profile.quality(with_quiet_hours(hourly_events(spark, sf)), KEYS), 7, "missing_pct", "unique_pct")


@query("summary_stats", f"""
WITH d AS ({idle_weekends_sql(DAILY_BY_PRIORITY)} UNION ALL {quiet_hours_sql(HOURLY_EVENTS)})
SELECT series_id, count(*) AS n_days, floor(date_diff('second', min(ts), max(ts)) / 86400)::BIGINT + 1 AS span_days,
  count(*) FILTER (y IS NULL) AS missing_days, round(100.0::DOUBLE * count(*) FILTER (y IS NULL) / count(*), 7) AS missing_pct,
  round(count(*) FILTER (y = 0)::DOUBLE / count(*), 9) AS zero_fraction, count(*) FILTER (y = 0)::DOUBLE / count(*) >= 0.4 AS intermittent
FROM d GROUP BY series_id
""")
def summary_stats(spark, sf):
    d = with_idle_weekends(daily_by_priority(spark, sf)).unionByName(with_quiet_hours(hourly_events(spark, sf)))
    return rounded(rounded(profile.summary_stats(d, KEYS), 7, "missing_pct"), 9, "zero_fraction")


_TEMPORAL_CTES = """
wk AS (SELECT series_id, avg(m) AS v FROM (SELECT series_id, avg(y) AS m FROM d GROUP BY series_id, date_trunc('week', ts)) AS a GROUP BY series_id),
mm AS (SELECT series_id, date_trunc('month', ts)::TIMESTAMP AS ts, avg(y) AS m FROM d GROUP BY series_id, date_trunc('month', ts)),
mo AS (SELECT series_id, avg(m) AS v FROM mm GROUP BY series_id),
dw AS (SELECT series_id, isodow(ts) AS k, avg(y) AS m FROM d GROUP BY series_id, isodow(ts)),
dv AS (SELECT series_id, avg(m) FILTER (k <= 5) AS wd, avg(m) FILTER (k > 5) AS we FROM dw GROUP BY series_id),
me AS (SELECT series_id, min(ts) AS a, max(ts) AS b FROM mm GROUP BY series_id),
ms AS (SELECT series_id, unnest(generate_series(a, b, INTERVAL 1 MONTH))::TIMESTAMP AS ts FROM me),
mf AS (SELECT ms.series_id, ms.ts, last_value(mm.m IGNORE NULLS) OVER (PARTITION BY ms.series_id ORDER BY ms.ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m
  FROM ms LEFT JOIN mm ON ms.series_id = mm.series_id AND ms.ts = mm.ts),
mg AS (SELECT series_id, m / lag(m) OVER (PARTITION BY series_id ORDER BY ts) - 1 AS g FROM mf),
gr AS (SELECT series_id, avg(g) * 100 AS ga, stddev_samp(g) * 100 AS gs FROM mg GROUP BY series_id),
al AS (SELECT series_id, floor(date_diff('second', min(ts), max(ts)) / 86400)::BIGINT + 1 AS span_days, avg(y) AS v FROM d GROUP BY series_id)
"""
_TEMPORAL_SELECT = """
SELECT al.series_id, span_days, round(al.v, 3) AS daily_avg, round(wk.v, 3) AS weekly_avg, round(mo.v, 3) AS monthly_avg,
  round(wd, 3) AS weekday_avg, round(we, 3) AS weekend_avg, round(ga, 6) AS mom_growth_avg, round(gs, 6) AS mom_growth_std
FROM al JOIN wk USING (series_id) JOIN mo USING (series_id) JOIN dv USING (series_id) JOIN gr USING (series_id)
"""
_TEMPORAL = "d AS ({inner}), " + _TEMPORAL_CTES + _TEMPORAL_SELECT


def _round_temporal(df):
    d = rounded(df, 3, "daily_avg", "weekly_avg", "monthly_avg", "weekday_avg", "weekend_avg")
    return rounded(d, 6, "mom_growth_avg", "mom_growth_std")


# Quarter-end months only, so that month-over-month growth crosses empty months.
@query("temporal_stats", "WITH " + _TEMPORAL.format(
    inner=f"{DAILY_BY_PRIORITY} UNION ALL SELECT 'quarter/' || series_id, ts, y FROM ({DAILY_BY_PRIORITY}) AS q WHERE month(ts) IN (3, 6, 9, 12)"))
def temporal_stats(spark, sf):
    d = daily_by_priority(spark, sf)
    ends = d.where(F.month("ts").isin(3, 6, 9, 12)).withColumn("series_id", F.concat(F.lit("quarter/"), "series_id"))
    return _round_temporal(profile.temporal_stats(d.unionByName(ends), KEYS))


@query("temporal_stats_raw", "WITH " + _TEMPORAL.format(inner="SELECT o_orderstatus AS series_id, o_orderdate AS ts, o_totalprice AS y FROM orders"))
def temporal_stats_raw(spark, sf):
    return _round_temporal(profile.temporal_stats(raw_orders(spark, sf, "o_orderstatus"), KEYS))


@query("mom_growth", f"""
SELECT * FROM (SELECT series_id, ts, y, round(y / lag(y) OVER (PARTITION BY series_id ORDER BY ts) - 1, 9) AS growth FROM ({MONTHLY_BY_PRIORITY}) AS m) AS g WHERE growth IS NOT NULL
""")
def mom_growth(spark, sf):
    return rounded(profile.month_growth(monthly_by_priority(spark, sf), KEYS), 9, "growth")


_ACF = """
v AS (SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS rn,
  y - avg(y) OVER (PARTITION BY series_id) AS d FROM s WHERE y IS NOT NULL),
z AS (SELECT series_id, sum(d * d) AS v0, count(*) AS n FROM v GROUP BY series_id)
"""


@query("acf_7_365", f"""
WITH s AS ({DAILY_BY_PRIORITY}), {_ACF},
p AS (SELECT a.series_id, b.rn - a.rn AS lag, sum(a.d * b.d) AS c FROM v a JOIN v b ON a.series_id = b.series_id AND b.rn = a.rn + 7 GROUP BY 1, 2
  UNION ALL SELECT a.series_id, b.rn - a.rn, sum(a.d * b.d) FROM v a JOIN v b ON a.series_id = b.series_id AND b.rn = a.rn + 365 GROUP BY 1, 2)
SELECT z.series_id, round(max(c / v0) FILTER (lag = 7), 9) AS acf7, round(max(c / v0) FILTER (lag = 365), 9) AS acf365
FROM z LEFT JOIN p ON z.series_id = p.series_id GROUP BY z.series_id
""")
def acf_7_365(spark, sf):
    return rounded(profile.seasonal_strength(daily_by_priority(spark, sf), KEYS), 9, "acf7", "acf365")


@query("acf_full", f"""
WITH s AS ({quiet_hours_sql(HOURLY_EVENTS)}), {_ACF}
SELECT a.series_id, (b.rn - a.rn)::INTEGER AS lag, round(sum(a.d * b.d) / max(v0), 9) AS acf
FROM v a JOIN v b ON a.series_id = b.series_id AND b.rn BETWEEN a.rn AND a.rn + 365 JOIN z ON z.series_id = a.series_id GROUP BY 1, 2
""")
def acf_full(spark, sf):
    return rounded(profile.acf(with_quiet_hours(hourly_events(spark, sf)), KEYS, block_rows=200), 9, "acf")


_SPECTRUM = f"""s AS ({HOURLY_EVENTS}), {_ACF},
a AS (SELECT a.series_id, (b.rn - a.rn) AS lag, sum(a.d * b.d) / max(v0) AS r
  FROM v a JOIN v b ON a.series_id = b.series_id AND b.rn BETWEEN a.rn AND a.rn + 168 JOIN z ON z.series_id = a.series_id GROUP BY 1, 2),
f AS (SELECT series_id, j AS frequency, sum(CASE WHEN lag = 0 THEN 1 ELSE 2 END * (1 - lag / 168::DOUBLE) * r * cos(pi() * j * lag / 168)) AS power
  FROM a, range(1, 169) AS n(j) GROUP BY series_id, j)"""


@query("spectrum_168", f"WITH {_SPECTRUM} SELECT series_id, frequency::INTEGER AS frequency, round(power, 6) AS power FROM f")
def spectrum_168(spark, sf):
    return rounded(structure.spectrum(profile.acf(hourly_events(spark, sf), KEYS, nlags=168), 168, KEYS), 6, "power")


@query("dominant_period", f"""
WITH {_SPECTRUM}
SELECT series_id, round(336::DOUBLE / arg_max(frequency, power), 6) AS period, round(max(power) / sum(greatest(power, 0)), 6) AS share FROM f WHERE frequency >= 6 GROUP BY series_id
""")
def dominant_period(spark, sf):
    a = profile.acf(hourly_events(spark, sf), KEYS, nlags=168)
    return rounded(structure.dominant_period(a, 168, KEYS), 6, "period", "share")


@query("pacf")
def pacf(spark, sf):
    a = profile.acf(daily_by_priority(spark, sf), KEYS, nlags=40)
    return rounded(profile.pacf(a, KEYS), 6, "pacf")


@query("rolling_cv", f"""
WITH r AS (SELECT series_id, avg(y) OVER w AS m, stddev_samp(y) OVER w AS s FROM ({DAILY_BY_PRIORITY}) AS d
  WINDOW w AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
SELECT series_id, round(stddev_samp(m) / avg(m), 9) AS rolling_mean_cv, round(stddev_samp(s) / avg(s), 9) AS rolling_std_cv FROM r GROUP BY series_id
""")
def rolling_cv(spark, sf):
    return rounded(profile.rolling_cv(daily_by_priority(spark, sf), KEYS), 9, "rolling_mean_cv", "rolling_std_cv")


@query("histogram_50", """
WITH d AS (SELECT event_type AS series_id, value AS y FROM events), e AS (SELECT series_id, min(y) AS a, max(y) AS b FROM d GROUP BY series_id),
c AS (SELECT d.series_id, least(49, floor((y - a) / ((b - a) / 50.0::DOUBLE)))::INTEGER AS bin, count(*) AS n FROM d JOIN e ON d.series_id = e.series_id GROUP BY 1, 2),
f AS (SELECT series_id, a, b, unnest(range(0, 50))::INTEGER AS bin FROM e)
SELECT f.series_id, f.bin, round(a + f.bin * ((b - a) / 50.0::DOUBLE), 7) AS bin_start, coalesce(n, 0) AS n
FROM f LEFT JOIN c ON f.series_id = c.series_id AND f.bin = c.bin
""")
def histogram_50(spark, sf):
    return rounded(profile.histogram(raw_events(spark, sf), KEYS), 7, "bin_start")


def _box_sql(inner: str) -> str:
    return f"""SELECT series_id, month(ts)::INTEGER AS month, count(*) AS n, min(y) AS min, max(y) AS max, round(quantile_cont(y, 0.25), 4) AS p25,
  round(quantile_cont(y, 0.5), 4) AS median, round(quantile_cont(y, 0.75), 4) AS p75 FROM ({inner}) AS d GROUP BY series_id, month(ts)"""


@query("monthly_box", _box_sql(DAILY_BY_PRIORITY))
def monthly_box(spark, sf):
    return rounded(profile.month_box(daily_by_priority(spark, sf), KEYS), 4, "p25", "median", "p75")


@query("monthly_box_raw", _box_sql("SELECT o_orderstatus AS series_id, o_orderdate AS ts, o_totalprice AS y FROM orders"))
def monthly_box_raw(spark, sf):
    return rounded(profile.month_box(raw_orders(spark, sf, "o_orderstatus"), KEYS, gridded=False), 4, "p25", "median", "p75")


def naive_week(spark, sf):
    """Daily series against the value one week of rows earlier."""
    from tidewright.operators.layout import by_series

    d = daily_by_priority(spark, sf)
    return d.withColumn("yhat", F.lag("y", 7).over(by_series(KEYS, "ts"))).where("yhat is not null")


NAIVE_WEEK = f"""SELECT * FROM (SELECT series_id, ts, y, lag(y, 7) OVER (PARTITION BY series_id ORDER BY ts) AS yhat
  FROM ({DAILY_BY_PRIORITY}) AS d) AS n WHERE yhat IS NOT NULL"""


@query("residual_table", f"SELECT *, round(y - yhat, 2) AS residual FROM ({NAIVE_WEEK}) AS r")
def residual_table(spark, sf):
    return rounded(profile.residuals(naive_week(spark, sf)), 2, "residual")


@query("qq_positions", f"""
WITH r AS (SELECT series_id, round(y - yhat, 2) AS residual FROM ({NAIVE_WEEK}) AS r)
SELECT series_id, residual, row_number() OVER w AS rank,
  round((row_number() OVER w - 0.5::DOUBLE) / count(*) OVER (PARTITION BY series_id), 9) AS position
FROM r WINDOW w AS (PARTITION BY series_id ORDER BY residual)
""")
def qq_positions(spark, sf):
    r = rounded(profile.residuals(naive_week(spark, sf)), 2, "residual").select("series_id", "residual")
    d = profile.qq_positions(r, KEYS, with_normal=False)
    return rounded(d, 9, "position").withColumn("rank", F.col("rank").cast("long"))


@query("qq_normal")
def qq_normal(spark, sf):
    return rounded(profile.qq_positions(profile.residuals(naive_week(spark, sf)), KEYS), 6, "normal_quantile")


# Quantiles at 0 and 1 are the exact ends, and counts are exact through every merge.
@query("sketch_months", """
SELECT event_type AS series_id, date_trunc('month', ts)::TIMESTAMP AS slot, count(value) AS n, count(*) - count(value) AS missing, min(value) AS lowest, max(value) AS highest
FROM events GROUP BY event_type, date_trunc('month', ts)
""")
def sketch_months(spark, sf):
    """Months merged from daily sketches."""
    months = sketches.merge_slots(sketches.sketch_slots(raw_events(spark, sf), "D", KEYS), "MS", KEYS)
    return sketches.quantiles(months, [0.0, 1.0]).select("series_id", "slot", "n", "missing", F.col("q")[0].alias("lowest"), F.col("q")[1].alias("highest"))


PROBS = (0.01, 0.25, 0.5, 0.75, 0.99)


@query("sketch_rank_error", f"""
SELECT series_id, prob, n, true AS close FROM (SELECT event_type AS series_id, count(value) AS n FROM events GROUP BY event_type) AS e, (VALUES {", ".join(f"({p}::DOUBLE)" for p in PROBS)}) AS p(prob)
""")
def sketch_rank_error(spark, sf):
    """True ranks, counted over all rows, of quantiles from merged daily sketches."""
    raw = raw_events(spark, sf)
    whole = sketches.quantiles(sketches.merge_slots(sketches.sketch_slots(raw, "D", KEYS), None, KEYS), PROBS)
    ranked = raw.where("y is not null").join(whole, KEYS)
    below = [F.count_if(F.col("y") < F.col("q")[i]) for i in range(len(PROBS))]
    upto = [F.count_if(F.col("y") <= F.col("q")[i]) for i in range(len(PROBS))]
    n = F.count(F.lit(1))
    off = [F.greatest(a / n - p, p - b / n, F.lit(0.0)) for a, b, p in zip(below, upto, PROBS)]
    entries = [F.struct(F.lit(p).alias("prob"), n.alias("n"), (x <= 2 * sketches.rank_error() + 1 / n).alias("close")) for p, x in zip(PROBS, off)]
    return ranked.groupBy(*KEYS).agg(F.array(*entries).alias("e")).select(*KEYS, F.inline("e"))
