"""Splits, naive forecasts, metrics, ladders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.base import (
    DAILY_BY_PRIORITY, HOURLY_EVENTS, KEYS, MONTHLY_BY_PRIORITY, daily_by_priority, hourly_events,
    idle_weekends_sql, monthly_by_priority, query, raw_events, raw_orders, rounded, with_idle_weekends,
)
from catalog.profiling import NAIVE_WEEK, naive_week
from tidewright.functions import expressions as ex
from tidewright.functions import frequency as fq
from tidewright.models import naive
from tidewright.operators import evaluate as ev
from tidewright.operators import intervals as iv

# ------------------------------------------------------------------- splits


def _split_sql(inner: str, cap: int, need: int) -> str:
    return f"""SELECT series_id, ts, y, CASE WHEN back <= CASE WHEN n - h < {need} THEN greatest(1, n - {need}) ELSE h END THEN 'valid' ELSE 'train' END AS split
FROM (SELECT *, CASE WHEN n < {need} + least({cap}, n // 4) THEN greatest(1, n // 5) ELSE least({cap}, n // 4) END AS h FROM (
  SELECT *, count(*) OVER (PARTITION BY series_id) AS n, row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) AS back FROM ({inner}) AS d) AS a) AS b"""


@query("train_valid_split", _split_sql(DAILY_BY_PRIORITY, 90, 180))
def train_valid_split(spark, sf):
    return ev.train_valid_split(daily_by_priority(spark, sf), "D", KEYS)


SPLIT_MONTHLY = _split_sql(MONTHLY_BY_PRIORITY, 6, 12)


@query("train_valid_split_monthly", SPLIT_MONTHLY)
def train_valid_split_monthly(spark, sf):
    return ev.train_valid_split(monthly_by_priority(spark, sf), "MS", KEYS)


_YEARLY = """SELECT o_orderpriority AS series_id, date_trunc('year', o_orderdate)::TIMESTAMP AS ts, round(sum(o_totalprice), 2) AS y
FROM orders GROUP BY o_orderpriority, date_trunc('year', o_orderdate)"""


@query("train_valid_split_short", _split_sql(_YEARLY, 2, 5))
def train_valid_split_short(spark, sf):
    from catalog.base import summed

    return ev.train_valid_split(summed(raw_orders(spark, sf), "YS"), "YS", KEYS)


@query("rolling_origin_folds", f"""
WITH d AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS rn FROM ({DAILY_BY_PRIORITY}) AS q),
f AS (SELECT DISTINCT series_id, n, unnest(range(0, (n - 230) // 30 + 1)) AS fold FROM d),
m AS (SELECT d.series_id, d.ts, d.y, f.fold, CASE WHEN rn <= 200 + fold * 30 THEN 'train' WHEN rn <= 230 + fold * 30 THEN 'valid' END AS split
  FROM d JOIN f ON d.series_id = f.series_id)
SELECT series_id, fold::INTEGER AS fold, split, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, round(sum(y), 2) AS total FROM m WHERE split IS NOT NULL GROUP BY 1, 2, 3
""")
def rolling_origin_folds(spark, sf):
    d = ev.rolling_origin(daily_by_priority(spark, sf), KEYS)
    return d.groupBy("series_id", "fold", "split").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.round(F.sum("y"), 2).alias("total")
    )


@query("fold_table", f"""
WITH n AS (SELECT series_id, count(*) AS n FROM ({DAILY_BY_PRIORITY}) AS q GROUP BY series_id),
f AS (SELECT series_id, unnest(range(0, (n - 230) // 30 + 1)) AS fold FROM n)
SELECT series_id, fold::INTEGER AS fold, 200 + fold * 30 AS train_end_rn, 230 + fold * 30 AS valid_end_rn FROM f
""")
def fold_table(spark, sf):
    return ev.fold_table(daily_by_priority(spark, sf), KEYS)


@query("cv_windows", f"""
WITH e AS (SELECT series_id, count(*) AS n, min(ts) AS a, max(ts) AS b FROM ({DAILY_BY_PRIORITY}) AS q GROUP BY series_id HAVING count(*) > 50),
f AS (SELECT series_id, b, unnest(range(0, (date_diff('day', a, b) - 120) // 7 + 1)) AS fold FROM e WHERE date_diff('day', a, b) >= 120)
SELECT series_id, fold::INTEGER AS fold, (b - to_days(30) - to_days((fold * 7)::INTEGER))::TIMESTAMP AS cutoff, (b - to_days((fold * 7)::INTEGER))::TIMESTAMP AS valid_until FROM f
""")
def cv_windows(spark, sf):
    return ev.cv_windows(daily_by_priority(spark, sf), "D", KEYS)


# ---------------------------------------------------------- future and naive

@query("future_spine", f"""
WITH e AS (SELECT series_id, max(ts) AS b FROM ({DAILY_BY_PRIORITY}) AS d GROUP BY series_id),
m AS (SELECT series_id, max(ts) AS b FROM ({MONTHLY_BY_PRIORITY}) AS d GROUP BY series_id),
h AS (SELECT series_id, max(ts) AS b FROM ({HOURLY_EVENTS}) AS d GROUP BY series_id)
SELECT 'D/' || series_id AS series_id, (b + to_days(step::INTEGER))::TIMESTAMP AS ts, step::INTEGER AS step FROM e, range(1, 31) AS r(step)
UNION ALL SELECT 'MS/' || series_id, (b + to_months(step::INTEGER))::TIMESTAMP, step::INTEGER FROM m, range(1, 13) AS r(step)
UNION ALL SELECT 'h/' || series_id, (b + to_hours(step))::TIMESTAMP, step::INTEGER FROM h, range(1, 721) AS r(step)
""")
def future_spine(spark, sf):
    tag = lambda name, d: d.withColumn("series_id", F.concat(F.lit(name + "/"), "series_id"))
    return (
        tag("D", naive.future_spine(daily_by_priority(spark, sf), "D", 30, KEYS))
        .unionByName(tag("MS", naive.future_spine(monthly_by_priority(spark, sf), "MS", 12, KEYS)))
        .unionByName(tag("h", naive.future_spine(hourly_events(spark, sf), "h", 720, KEYS)))
    )


_MORE = {"W": ("b + to_days(7 * step)", 12), "QS": ("b + to_months(3 * step)", 4), "YS": ("b + to_months(12 * step)", 3), "15min": ("b + to_minutes(15 * step)", 96)}


@query("future_spine_more", f"WITH m AS (SELECT series_id, max(ts) AS b FROM ({MONTHLY_BY_PRIORITY}) AS d GROUP BY series_id)\n" + "\nUNION ALL ".join(
    f"SELECT '{f}/' || series_id AS series_id, ({e})::TIMESTAMP AS ts, step AS step FROM m, (SELECT unnest(generate_series(1, {n}))::INTEGER AS step) AS r" for f, (e, n) in _MORE.items()))
def future_spine_more(spark, sf):
    """The other units, from the monthly series' last rows."""
    d = monthly_by_priority(spark, sf)
    parts = [naive.future_spine(d, f, n, KEYS).withColumn("series_id", F.concat(F.lit(f + "/"), "series_id")) for f, (_, n) in _MORE.items()]
    return reduce(DataFrame.unionByName, parts)


@query("horizon_table", f"""
WITH s AS (SELECT DISTINCT 'D/' || series_id AS series_id, 'D' AS freq FROM ({DAILY_BY_PRIORITY}) AS d
  UNION ALL SELECT DISTINCT 'MS/' || series_id, 'MS' FROM ({MONTHLY_BY_PRIORITY}) AS m UNION ALL SELECT DISTINCT 'h/' || series_id, 'h' FROM ({HOURLY_EVENTS}) AS h),
t AS (SELECT * FROM (VALUES ('D', '30d', 30), ('D', '90d', 90), ('MS', '3m', 3), ('MS', '12m', 12), ('h', '30d', 720), ('h', '90d', 2160)) AS v(freq, horizon_label, horizon))
SELECT s.series_id, s.freq, t.horizon_label, t.horizon::INTEGER AS horizon FROM s JOIN t ON s.freq = t.freq
""")
def horizon_table(spark, sf):
    tag = lambda name, d: d.withColumn("series_id", F.concat(F.lit(name + "/"), "series_id"))
    from tidewright.operators.regularize import infer_frequency

    series = (
        tag("D", daily_by_priority(spark, sf)).unionByName(tag("MS", monthly_by_priority(spark, sf)))
        .unionByName(tag("h", hourly_events(spark, sf)))
    )
    freq = infer_frequency(series, KEYS).select("series_id", "freq")
    return freq.select("series_id", "freq", F.inline(naive.horizon_table(F.col("freq"))))


_SNAIVE = f"""
WITH m AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) AS back FROM ({MONTHLY_BY_PRIORITY}) AS d),
e AS (SELECT series_id, max(ts) AS b FROM m GROUP BY series_id)
SELECT e.series_id, (b + to_months(step::INTEGER))::TIMESTAMP AS ts, step::INTEGER AS step, m.y AS forecast
FROM e JOIN range(1, 25) AS r(step) ON true LEFT JOIN m ON m.series_id = e.series_id AND m.back = 12 - (step - 1) % 12
"""


@query("snaive_forecast", _SNAIVE)
def snaive_forecast(spark, sf):
    return naive.seasonal_naive(monthly_by_priority(spark, sf), "MS", 24, KEYS)


# ------------------------------------------------------------------ metrics

def _metric_sql(y: str, p: str) -> str:
    return f"""avg(CASE WHEN {y} <> 0 THEN abs(({y} - {p}) / {y}) END) * 100 AS mape,
  avg(CASE WHEN abs({y}) + abs({p}) <> 0 THEN abs(abs({y}) - abs({p})) / ((abs({y}) + abs({p})) / 2) END) * 100 AS smape,
  sum(abs({y} - {p}) * abs({y})) / greatest(1e-9::DOUBLE, sum(abs({y}))) * 100 AS wmape,
  sqrt(avg(({y} - {p}) * ({y} - {p}))) AS rmse"""


_NAIVE_ZEROS = f"""SELECT * FROM (SELECT series_id, ts, y, lag(y, 7) OVER (PARTITION BY series_id ORDER BY ts) AS yhat
  FROM ({idle_weekends_sql(DAILY_BY_PRIORITY)}) AS d) AS n WHERE yhat IS NOT NULL"""


def _naive_zeros(spark, sf):
    from tidewright.operators.layout import by_series

    d = with_idle_weekends(daily_by_priority(spark, sf))
    return d.withColumn("yhat", F.lag("y", 7).over(by_series(KEYS, "ts"))).where("yhat is not null")


@query("metrics_all", f"""
SELECT series_id, round(mape, 6) AS mape, round(smape, 6) AS smape, round(wmape, 1) AS wmape, round(rmse, 4) AS rmse
FROM (SELECT series_id, {_metric_sql('y', 'yhat')} FROM ({_NAIVE_ZEROS}) AS n GROUP BY series_id) AS m
""")
def metrics_all(spark, sf):
    s = ev.score(_naive_zeros(spark, sf), KEYS)
    return rounded(rounded(rounded(s, 6, "mape", "smape"), 1, "wmape"), 4, "rmse")


@query("metrics_tidy", f"""
WITH m AS (SELECT series_id, {_metric_sql('y', 'yhat')} FROM ({_NAIVE_ZEROS}) AS n GROUP BY series_id),
r AS (SELECT series_id, round(smape, 4) AS smape, round(rmse, 4) AS rmse FROM m)
UNPIVOT r ON smape, rmse INTO NAME metric VALUE value
""")
def metrics_tidy(spark, sf):
    return rounded(ev.tidy(ev.score(_naive_zeros(spark, sf), KEYS, ["smape", "rmse"]), KEYS, ["smape", "rmse"]), 4, "value")


@query("actual_prediction_join", f"""
WITH d AS ({DAILY_BY_PRIORITY}), p AS (SELECT series_id, ts + INTERVAL 7 DAY AS ts, y AS yhat FROM d)
SELECT d.series_id, d.ts, d.y, p.yhat FROM d JOIN p ON d.series_id = p.series_id AND d.ts = p.ts
""")
def actual_prediction_join(spark, sf):
    d = daily_by_priority(spark, sf)
    p = d.select("series_id", fq.add_steps(F.col("ts"), 7, "D").alias("ts"), F.col("y").alias("yhat"))
    return ev.match_predictions(d, p, KEYS)


def _choose_sql(inner: str) -> str:
    return f"""
WITH d AS (SELECT *, avg(y) OVER (PARTITION BY series_id) AS mean_y FROM ({inner}) AS q),
s AS (SELECT series_id, count(*) FILTER (y = 0)::DOUBLE / count(*) AS z, count(*) FILTER (y < mean_y * 0.1)::DOUBLE / count(*) AS nz,
  CASE WHEN avg(y) > 0 THEN stddev_samp(y) / avg(y) END AS cv, avg(y) AS m, quantile_cont(y, 0.5) AS p50, quantile_cont(y, 0.95) AS p95 FROM d GROUP BY series_id)
SELECT series_id, round(z, 9) AS zero_frac, round(nz, 9) AS near_zero_frac, round(cv, 7) AS cv,
  CASE WHEN z > 0.1 OR nz > 0.2 THEN 'smape' WHEN m <= 0 OR cv > 1.5 OR (p50 <> 0 AND p95 / p50 > 5) OR (p50 = 0 AND p95 > 0) THEN 'rmse' ELSE 'mape' END AS primary_metric FROM s"""


_SKEWED = "SELECT series_id || '/cubed' AS series_id, ts, y * y * y AS y FROM ({}) AS c".format(HOURLY_EVENTS)


@query("metric_selection", _choose_sql(f"{idle_weekends_sql(DAILY_BY_PRIORITY)} UNION ALL SELECT series_id || '/daily', ts, y FROM ({DAILY_BY_PRIORITY}) AS b UNION ALL {_SKEWED}"))
def metric_selection(spark, sf):
    d = daily_by_priority(spark, sf)
    cubed = hourly_events(spark, sf).select(F.concat("series_id", F.lit("/cubed")).alias("series_id"), "ts", (F.col("y") * F.col("y") * F.col("y")).alias("y"))
    mixed = with_idle_weekends(d).unionByName(d.withColumn("series_id", F.concat("series_id", F.lit("/daily")))).unionByName(cubed)
    return rounded(rounded(ev.choose_metric(mixed, KEYS), 9, "zero_frac", "near_zero_frac"), 7, "cv").drop("metrics")


@query("metric_selection_raw", _choose_sql("SELECT event_type AS series_id, value AS y FROM events"))
def metric_selection_raw(spark, sf):
    d = ev.choose_metric(raw_events(spark, sf), KEYS, gridded=False)
    return rounded(rounded(d, 9, "zero_frac", "near_zero_frac"), 7, "cv").drop("metrics")


# ------------------------------------------------------------------- ladder

LADDER = ["naive", "snaive", "moving_average"]

_LADDER_PREDS = f"""
d AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS rn, sum((split = 'train')::INTEGER) OVER (PARTITION BY series_id) AS n FROM ({SPLIT_MONTHLY}) AS s),
preds AS (
  SELECT v.series_id, v.ts, v.y, 'naive' AS model, t.y AS yhat FROM d v JOIN d t ON v.series_id = t.series_id AND t.rn = v.n WHERE v.split = 'valid'
  UNION ALL SELECT v.series_id, v.ts, v.y, 'snaive', t.y FROM d v JOIN d t ON v.series_id = t.series_id AND t.rn = v.n - 12 + 1 + (v.rn - v.n - 1) % 12 WHERE v.split = 'valid'
  UNION ALL SELECT v.series_id, v.ts, v.y, 'moving_average', a.m FROM d v JOIN (SELECT series_id, avg(y) AS m FROM d WHERE split = 'train' AND rn > n - 30 GROUP BY series_id) AS a
    ON v.series_id = a.series_id WHERE v.split = 'valid')
"""


def ladder_preds(spark, sf):
    split = ev.train_valid_split(monthly_by_priority(spark, sf), "MS", KEYS)
    return naive.naive_validation(split, 12, KEYS)


@query("ladder_predictions", f"WITH {_LADDER_PREDS} SELECT series_id, ts, y, model, round(yhat, 4) AS yhat FROM preds")
def ladder_predictions(spark, sf):
    return rounded(ladder_preds(spark, sf), 4, "yhat")


def ladder_scores(spark, sf):
    return ev.score(ladder_preds(spark, sf), [*KEYS, "model"], ["mape"]).withColumnRenamed("mape", "score")


_SCORES = f"{_LADDER_PREDS}, scores AS (SELECT series_id, model, avg(abs((y - yhat) / y)) * 100 AS score FROM preds GROUP BY series_id, model)"


@query("model_ladder_naive", f"""
WITH {_SCORES},
o AS (SELECT *, CASE model WHEN 'naive' THEN 1 WHEN 'snaive' THEN 2 ELSE 3 END AS step FROM scores),
b AS (SELECT *, min(score) OVER (PARTITION BY series_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before,
  row_number() OVER (PARTITION BY series_id ORDER BY score, step) AS place FROM o)
SELECT series_id, model, round(score, 6) AS score, step::INTEGER AS step, round((best_before - score) / best_before * 100, 6) AS improvement_pct,
  coalesce(score < best_before, true) AS new_best, place = 1 AS is_best FROM b
""")
def model_ladder_naive(spark, sf):
    return rounded(ev.rank_models(ladder_scores(spark, sf), LADDER, KEYS), 6, "score", "improvement_pct")


@query("best_model", f"""
WITH {_SCORES} SELECT series_id, arg_min(model, score) AS best_model, round(min(score), 6) AS best_score FROM scores GROUP BY series_id
""")
def best_model(spark, sf):
    return rounded(ev.best_model(ladder_scores(spark, sf), LADDER, KEYS), 6, "best_score")


@query("model_comparison_pivot", f"""
WITH {_SCORES} SELECT series_id, round(max(score) FILTER (model = 'naive'), 6) AS naive, round(max(score) FILTER (model = 'snaive'), 6) AS snaive,
  round(max(score) FILTER (model = 'moving_average'), 6) AS moving_average FROM scores GROUP BY series_id
""")
def model_comparison_pivot(spark, sf):
    return rounded(ev.comparison_table(ladder_scores(spark, sf), LADDER, KEYS), 6, *LADDER)


@query("metric_targets", f"""
WITH {_LADDER_PREDS}, m AS (SELECT series_id, model, {_metric_sql('y', 'yhat')} FROM preds GROUP BY series_id, model),
r AS (SELECT series_id, model, mape, smape FROM m), u AS (UNPIVOT r ON mape, smape INTO NAME metric VALUE value)
SELECT series_id, model, metric, round(value, 6) AS value, (CASE metric WHEN 'mape' THEN 15.0 ELSE 12.0 END)::DOUBLE AS target,
  value <= CASE metric WHEN 'mape' THEN 15.0 ELSE 12.0 END AS passed FROM u
""")
def metric_targets(spark, sf):
    by = [*KEYS, "model"]
    tidy = ev.tidy(ev.score(ladder_preds(spark, sf), by, ["mape", "smape"]), by, ["mape", "smape"])
    return rounded(ev.against_targets(tidy, {"mape": 15.0, "smape": 12.0}), 6, "value")


@query("forecast_summary", f"""
SELECT series_id, 'snaive' AS model, h.horizon_label, count(*) AS n_steps, min(ts) AS first_ts, max(ts) AS last_ts, round(avg(forecast), 4) AS mean_forecast,
  min(forecast) AS min_forecast, max(forecast) AS max_forecast
FROM ({_SNAIVE}) AS f JOIN (VALUES ('3m', 3), ('12m', 12)) AS h(horizon_label, horizon) ON f.step <= h.horizon GROUP BY series_id, h.horizon_label
""")
def forecast_summary(spark, sf):
    f = naive.seasonal_naive(monthly_by_priority(spark, sf), "MS", 12, KEYS)
    labels = naive.horizon_table(F.lit("MS"))
    long = f.select(*f.columns, F.inline(labels)).where(F.col("step") <= F.col("horizon")).withColumn("model", F.lit("snaive"))
    return rounded(ev.forecast_summary(long, [*KEYS, "model", "horizon_label"]), 4, "mean_forecast")


@query("overfit_flags", f"""
WITH r AS (SELECT series_id, sqrt(avg((y - yhat) * (y - yhat)) FILTER (month(ts) <= 6)) AS train, sqrt(avg((y - yhat) * (y - yhat)) FILTER (month(ts) > 6)) AS valid
  FROM ({NAIVE_WEEK}) AS n GROUP BY series_id)
SELECT series_id, round(train, 4) AS train, round(valid, 4) AS valid, coalesce((valid - train) / nullif(train, 0) > 0.01, false) AS overfit,
  round(CASE WHEN train > 0 THEN valid / train ELSE 1.0 END, 9) AS ratio, CASE WHEN train > 0 THEN valid / train ELSE 1.0 END > 1.5 AS ratio_warning FROM r
""")
def overfit_flags(spark, sf):
    half = lambda test: ex.rmse(F.when(test, F.col("y")), F.col("yhat"))
    d = naive_week(spark, sf).groupBy("series_id").agg(half(F.month("ts") <= 6).alias("train"), half(F.month("ts") > 6).alias("valid"))
    t, v = F.col("train"), F.col("valid")
    d = d.withColumns({"overfit": ex.is_overfit(t, v, 0.01), "ratio": ex.overfit_ratio(t, v), "ratio_warning": ex.overfit_ratio(t, v) > 1.5})
    return rounded(rounded(d, 4, "train", "valid"), 9, "ratio")


# ---------------------------------------------------------------- intervals

_CONFORMAL = f"""
WITH {_LADDER_PREDS}, q AS (SELECT series_id, quantile_cont(abs(y - yhat), 0.9) AS w FROM preds WHERE model = 'snaive' GROUP BY series_id)
SELECT f.series_id, f.ts, f.step, f.forecast, round(f.forecast - w, 2) AS lower, round(f.forecast + w, 2) AS upper FROM ({_SNAIVE}) AS f JOIN q ON q.series_id = f.series_id
"""


def snaive_with_bounds(spark, sf):
    valid = ladder_preds(spark, sf).where("model = 'snaive'")
    future = naive.seasonal_naive(monthly_by_priority(spark, sf), "MS", 24, KEYS)
    return iv.conformal(valid, future, KEYS)


@query("conformal", _CONFORMAL.replace(", 2) AS", ", 3) AS"))
def conformal(spark, sf):
    return rounded(snaive_with_bounds(spark, sf), 3, "lower", "upper")


@query("bootstrap")
def bootstrap(spark, sf):
    future = naive.seasonal_naive(monthly_by_priority(spark, sf), "MS", 12, KEYS)
    return rounded(iv.bootstrap(naive_week(spark, sf), future, KEYS), 4, "lower", "upper")


@query("interval_coverage", f"""
WITH n AS ({NAIVE_WEEK}), q AS (SELECT series_id, quantile_cont(abs(y - yhat), 0.9) AS w FROM n GROUP BY series_id)
SELECT n.series_id, round(avg((y BETWEEN yhat - w AND yhat + w)::INTEGER), 9) AS coverage FROM n JOIN q ON n.series_id = q.series_id GROUP BY n.series_id
""")
def interval_coverage(spark, sf):
    n = naive_week(spark, sf)
    bounded = iv.conformal(n, n.withColumn("forecast", F.col("yhat")), KEYS)
    return rounded(ev.interval_coverage(bounded, KEYS), 9, "coverage")


_SCALE = """s AS (SELECT series_id, coalesce(CASE WHEN avg(yhat) > 0 THEN avg(y) / avg(yhat) END, 1.0) AS scale FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) AS k FROM n) AS r WHERE k <= 12 GROUP BY series_id)"""


@query("level_calibration", f"WITH n AS ({NAIVE_WEEK}), {_SCALE} SELECT series_id, round(scale, 9) AS scale FROM s")
def level_calibration(spark, sf):
    return rounded(iv.level_scale(naive_week(spark, sf), KEYS), 9, "scale")


_MONTH_FIT = f"""SELECT * FROM (SELECT series_id, ts, y, avg(y) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS yhat FROM ({MONTHLY_BY_PRIORITY}) AS m) AS w WHERE yhat IS NOT NULL"""


@query("blend", f"""
WITH n AS ({_MONTH_FIT}), {_SCALE}, e AS (SELECT series_id, avg(y) AS level, max(ts) AS b FROM n GROUP BY series_id)
SELECT f.series_id, f.ts, f.step, round(greatest(0.2 * level * scale + 0.8 * f.forecast, 0), 3) AS forecast,
  round(greatest(0.2 * level * 0.9 * scale + 0.8 * f.forecast, 0), 3) AS lower, round(greatest(0.2 * level * 1.1 * scale + 0.8 * f.forecast, 0), 3) AS upper
FROM ({_SNAIVE}) AS f JOIN e ON e.series_id = f.series_id JOIN s ON s.series_id = f.series_id
""")
def blend(spark, sf):
    from tidewright.operators.layout import by_series

    m = monthly_by_priority(spark, sf)
    n = m.withColumn("yhat", F.avg("y").over(by_series(KEYS, "ts").rowsBetween(-3, -1))).where("yhat is not null")
    level = n.groupBy(*KEYS).agg(F.avg("y").alias("forecast"))
    future = naive.future_spine(m, "MS", 24, KEYS).join(level, KEYS)
    future = future.withColumns({"lower": F.col("forecast") * 0.9, "upper": F.col("forecast") * 1.1})
    future = iv.calibrate_level(future, iv.level_scale(n, KEYS), KEYS)
    mixed = iv.blend(naive.with_seasonal_naive(future, m, 12, KEYS)).drop("snaive")
    return rounded(iv.clip_forecast(mixed), 3, "forecast", "lower", "upper")


@query("union_history_forecast", f"""
SELECT series_id, ts, y, 'history' AS kind FROM ({MONTHLY_BY_PRIORITY}) AS m UNION ALL SELECT series_id, ts, forecast, 'forecast' FROM ({_SNAIVE}) AS f
""")
def union_history_forecast(spark, sf):
    m = monthly_by_priority(spark, sf)
    f = naive.seasonal_naive(m, "MS", 24, KEYS)
    return m.withColumn("kind", F.lit("history")).unionByName(
        f.select("series_id", "ts", F.col("forecast").alias("y"), F.lit("forecast").alias("kind"))
    )
