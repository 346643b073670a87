"""Fitted models: unit root, seasonal AR, trend and season, boosted trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    DAILY_BY_PRIORITY, HOURLY_EVENTS, KEYS, MONTHLY_BY_PRIORITY, daily_by_priority, hourly_events, monthly_by_priority, query, rounded,
)
from catalog.feature_building import holidays
from catalog.profiling import _ACF, _TEMPORAL_CTES, _TEMPORAL_SELECT, _basic_sql
from tidewright.functions import frequency as fq
from tidewright.models import boosted, leaves, linear, seasonal_ar, trend_season, unit_root
from tidewright.models.naive import future_spine
from tidewright.operators import evaluate as ev
from tidewright.operators import features as feat
from tidewright.operators import profile
from tidewright.operators.regularize import densify, fill_forward_backward
from tidewright.session import cut_lineage


def filled_daily(spark, sf):
    """Daily totals without gaps, as the seasonal models need."""
    d = densify(daily_by_priority(spark, sf), "D", KEYS)
    return fill_forward_backward(d, KEYS).select("series_id", "ts", "y")


# --------------------------------------------------------------- unit root

@query("df_tstat", f"""
WITH d AS (SELECT series_id, y, lag(y) OVER (PARTITION BY series_id ORDER BY ts) AS p FROM ({DAILY_BY_PRIORITY}) AS q),
r AS (SELECT series_id, regr_slope(y - p, p) AS b, regr_sxx(y - p, p) AS sxx, regr_syy(y - p, p) AS syy, regr_count(y - p, p) AS n FROM d WHERE p IS NOT NULL GROUP BY series_id)
SELECT series_id, round(b / sqrt((syy - b * b * sxx) / (n - 2) / sxx), 6) AS adf_statistic, 0::INTEGER AS used_lags FROM r
""")
def df_tstat(spark, sf):
    d = unit_root.adf_test(daily_by_priority(spark, sf), KEYS, lags=0)
    return rounded(d, 6, "adf_statistic").drop("adf_pvalue")


@query("adf_test")
def adf_test(spark, sf):
    d = daily_by_priority(spark, sf).unionByName(
        monthly_by_priority(spark, sf).withColumn("series_id", F.concat(F.lit("monthly/"), "series_id"))
    )
    return rounded(unit_root.adf_test(d, KEYS), 6, "adf_statistic", "adf_pvalue")


@query("full_summary")
def full_summary(spark, sf):
    d = profile.full_summary(daily_by_priority(spark, sf), KEYS)
    return d.select("series_id", *[F.to_json(c).alias(c) for c in d.columns if c != "series_id"])


# -------------------------------------------------------------- seasonal AR

@query("ar1_fit", f"""
WITH d AS (SELECT series_id, ts, y, lag(y) OVER (PARTITION BY series_id ORDER BY ts) AS p FROM ({MONTHLY_BY_PRIORITY}) AS q)
SELECT series_id, round(regr_slope(y, p), 7) AS phi, round(regr_intercept(y, p), 1) AS const, arg_max(y, ts) AS last_y, max(ts) AS last_ts FROM d GROUP BY series_id
""")
def ar1_fit(spark, sf):
    return rounded(rounded(seasonal_ar.ar1_fit(monthly_by_priority(spark, sf), KEYS), 7, "phi"), 1, "const")


@query("ar1_recursive", f"""
WITH RECURSIVE d AS (SELECT series_id, ts, y, lag(y) OVER (PARTITION BY series_id ORDER BY ts) AS p FROM ({MONTHLY_BY_PRIORITY}) AS q),
m AS (SELECT series_id, regr_slope(y, p) AS phi, regr_intercept(y, p) AS c, arg_max(y, ts) AS y0, max(ts) AS t0 FROM d GROUP BY series_id),
r AS (SELECT series_id, 0 AS step, y0 AS v FROM m UNION ALL SELECT r.series_id, r.step + 1, m.c + m.phi * r.v FROM r JOIN m ON r.series_id = m.series_id WHERE r.step < 12)
SELECT r.series_id, step::INTEGER AS step, (t0 + to_months(step::INTEGER))::TIMESTAMP AS ts, round(v, 2) AS forecast FROM r JOIN m ON r.series_id = m.series_id WHERE step > 0
""")
def ar1_recursive(spark, sf):
    return rounded(seasonal_ar.ar1_forecast(monthly_by_priority(spark, sf), "MS", 12, KEYS), 2, "forecast")


@query("seasonal_ar_fit")
def seasonal_ar_fit(spark, sf):
    coef, _ = seasonal_ar.fit(filled_daily(spark, sf), KEYS, season=7)
    return coef.select("series_id", F.posexplode("beta").alias("term", "coef"), F.round("var", 6).alias("var")).withColumn("coef", F.round("coef", 6))


@query("seasonal_ar_forecast")
def seasonal_ar_forecast(spark, sf):
    return rounded(seasonal_ar.forecast(filled_daily(spark, sf), "D", 30, KEYS), 2, "forecast", "lower", "upper")


@query("seasonal_ar_x_forecast")
def seasonal_ar_x_forecast(spark, sf):
    d = filled_daily(spark, sf)
    exog = ["is_weekend", "sin_annual", "cos_annual"]
    future = feat.calendar_features(future_spine(d, "D", 30, KEYS))
    out = seasonal_ar.forecast(feat.calendar_features(d), "D", 30, KEYS, exog=exog, exog_future=future)
    return rounded(out, 2, "forecast", "lower", "upper")


@query("order_grid")
def order_grid(spark, sf):
    return rounded(seasonal_ar.order_grid(filled_daily(spark, sf), KEYS), 3, "aic")


@query("best_order")
def best_order(spark, sf):
    return rounded(seasonal_ar.best_order(seasonal_ar.order_grid(filled_daily(spark, sf), KEYS), KEYS), 3, "aic")


# --------------------------------------------------------- trend and season

@query("trend_season_forecast")
def trend_season_forecast(spark, sf):
    return rounded(trend_season.forecast(daily_by_priority(spark, sf), "D", 90, KEYS), 2, "forecast", "lower", "upper")


@query("trend_season_holidays")
def trend_season_holidays(spark, sf):
    h = holidays(spark, sf)
    # the calendar continues past the data: repeat last year's days one year on
    ahead = h.withColumn("date", F.add_months("date", 12))
    cal = h.unionByName(ahead).dropDuplicates(["country", "date"])
    design = trend_season.Design.for_frequency("D", holiday="is_holiday")
    d = feat.holiday_flags(daily_by_priority(spark, sf), cal, "AE")
    model = trend_season.fit(d, design, KEYS)
    future = feat.holiday_flags(future_spine(d, "D", 90, KEYS), cal, "AE")
    return rounded(trend_season.predict(future, model, design, KEYS), 2, "forecast", "lower", "upper")


@query("trend_season_fitted")
def trend_season_fitted(spark, sf):
    d = monthly_by_priority(spark, sf)
    design = trend_season.Design.for_frequency("MS")
    return rounded(trend_season.fitted(d, trend_season.fit(d, design, KEYS), design, KEYS), 2, "yhat")


@query("prior_grid_cv")
def prior_grid_cv(spark, sf):
    return rounded(trend_season.prior_scores(monthly_by_priority(spark, sf), "MS", KEYS), 6, "cv_mape")


@query("prior_grid_daily")
def prior_grid_daily(spark, sf):
    """Weekly, yearly and daily patterns over some hundred folds per series."""
    return rounded(trend_season.prior_scores(filled_daily(spark, sf), "D", KEYS), 6, "cv_mape")


@query("prior_choice")
def prior_choice(spark, sf):
    return rounded(trend_season.choose_prior(trend_season.prior_scores(monthly_by_priority(spark, sf), "MS", KEYS), KEYS), 6, "cv_mape")


# ------------------------------------------------------------------ boosted

def _boosted(spark, sf):
    split = ev.train_valid_split(filled_daily(spark, sf), "D", KEYS)
    table = cut_lineage(boosted.training_table(split, KEYS))
    return split, table, boosted.train(table)


@query("gbt_validation")
def gbt_validation(spark, sf):
    _, table, model = _boosted(spark, sf)
    valid = boosted.predict(table.where("split = 'valid'"), model)
    return rounded(ev.score(valid, KEYS, ["mape", "smape", "rmse"]), 4, "mape", "smape", "rmse")


@query("gbt_forecast")
def gbt_forecast(spark, sf):
    split, table, model = _boosted(spark, sf)
    steps = max(h for _, h in fq.frequency("D").horizons)
    return rounded(boosted.forecast(split, table, model, "D", steps, KEYS), 2, "forecast")


@query("learning_curve")
def learning_curve(spark, sf):
    _, table, model = _boosted(spark, sf)
    return rounded(boosted.learning_curve(table, model), 6, "train_rmse", "valid_rmse")


@query("best_iteration")
def best_iteration(spark, sf):
    _, table, model = _boosted(spark, sf)
    curve = boosted.learning_curve(table, model).withColumn("rmse", F.col("valid_rmse"))
    return rounded(ev.best_iteration(curve), 6, "best_loss")


@query("feature_importance")
def feature_importance(spark, sf):
    _, _, model = _boosted(spark, sf)
    return rounded(boosted.importance(spark, model), 6, "importance")


# ------------------------------------------- special cases SQL can also compute

@query("pacf_two_lags", f"""
WITH s AS ({DAILY_BY_PRIORITY}), {_ACF},
r AS (SELECT a.series_id, sum(a.d * b.d) FILTER (b.rn = a.rn + 1) / max(v0) AS r1, sum(a.d * b.d) FILTER (b.rn = a.rn + 2) / max(v0) AS r2
  FROM v a JOIN v b ON a.series_id = b.series_id AND b.rn BETWEEN a.rn + 1 AND a.rn + 2 JOIN z ON z.series_id = a.series_id GROUP BY a.series_id)
SELECT series_id, 1::INTEGER AS lag, round(r1, 8) AS pacf FROM r UNION ALL SELECT series_id, 2::INTEGER, round((r2 - r1 * r1) / (1 - r1 * r1), 8) FROM r
""")
def pacf_two_lags(spark, sf):
    return rounded(profile.pacf(profile.acf(daily_by_priority(spark, sf), KEYS, nlags=2), KEYS), 8, "pacf")


@query("pacf_three_lags", f"""
WITH s AS ({DAILY_BY_PRIORITY}), {_ACF},
r AS (SELECT a.series_id, {", ".join(f"sum(a.d * b.d) FILTER (b.rn = a.rn + {k}) / max(v0) AS r{k}" for k in (1, 2, 3))}
  FROM v a JOIN v b ON a.series_id = b.series_id AND b.rn BETWEEN a.rn + 1 AND a.rn + 3 JOIN z ON z.series_id = a.series_id GROUP BY a.series_id),
q AS (SELECT *, (r2 - r1 * r1) / (1 - r1 * r1) AS p22 FROM r), t AS (SELECT *, r1 - p22 * r1 AS p21 FROM q)
SELECT series_id, 1::INTEGER AS lag, round(r1, 8) AS pacf FROM t UNION ALL SELECT series_id, 2::INTEGER, round(p22, 8) FROM t
UNION ALL SELECT series_id, 3::INTEGER, round((r3 - p21 * r2 - p22 * r1) / (1 - p21 * r1 - p22 * r2), 8) FROM t
""")
def pacf_three_lags(spark, sf):
    return rounded(profile.pacf(profile.acf(daily_by_priority(spark, sf), KEYS, nlags=3), KEYS), 8, "pacf")


_FILLED_DAILY = f"""SELECT s.series_id, s.ts, last_value(h.y IGNORE NULLS) OVER (PARTITION BY s.series_id ORDER BY s.ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y
  FROM (SELECT series_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY))::TIMESTAMP AS ts FROM ({DAILY_BY_PRIORITY}) AS e GROUP BY series_id) AS s
  LEFT JOIN ({DAILY_BY_PRIORITY}) AS h ON s.series_id = h.series_id AND s.ts = h.ts"""


@query("order_grid_small", f"""
WITH f AS ({_FILLED_DAILY}), sd AS (SELECT series_id, stddev_samp(y) AS sd FROM f GROUP BY series_id),
w AS (SELECT series_id, ts, (y - lag(y, 1) OVER w - lag(y, 7) OVER w + lag(y, 8) OVER w) AS w FROM f WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
p AS (SELECT w.series_id, w / sd AS w, lag(w) OVER (PARTITION BY w.series_id ORDER BY ts) / sd AS p FROM w JOIN sd ON w.series_id = sd.series_id),
r AS (SELECT series_id, regr_count(w, p) AS n, regr_syy(w, p) AS syy, regr_sxx(w, p) AS sxx, regr_sxy(w, p) AS sxy FROM p GROUP BY series_id)
SELECT series_id, 0::INTEGER AS p, 0::INTEGER AS seasonal_p, round(n * ln(syy / n) + 2, 4) AS aic FROM r
UNION ALL SELECT series_id, 1::INTEGER, 0::INTEGER, round(n * ln((syy - sxy * sxy / sxx) / n) + 4, 4) FROM r
""")
def order_grid_small(spark, sf):
    return rounded(seasonal_ar.order_grid(filled_daily(spark, sf), KEYS, max_p=1, max_seasonal=0), 4, "aic")


LINE = trend_season.Design(changepoints=0, yearly=0, weekly=0, multiplicative=False)


@query("trend_season_line", f"""
WITH d AS ({DAILY_BY_PRIORITY}), e AS (SELECT series_id, min(ts) AS a, max(ts) AS b FROM d GROUP BY series_id),
t AS (SELECT d.series_id, y, date_diff('second', a, ts)::DOUBLE / date_diff('second', a, b) AS t FROM d JOIN e ON d.series_id = e.series_id),
r AS (SELECT series_id, regr_slope(y, t) AS k, regr_intercept(y, t) AS c, sqrt((regr_syy(y, t) - regr_slope(y, t) * regr_sxy(y, t)) / (count(*) - 2)) AS s FROM t GROUP BY series_id),
f AS (SELECT e.series_id, (b + to_days(step::INTEGER))::TIMESTAMP AS ts, step::INTEGER AS step, c + k * (date_diff('second', a, b + to_days(step::INTEGER))::DOUBLE / date_diff('second', a, b)) AS f, s
  FROM e JOIN r ON e.series_id = r.series_id, range(1, 31) AS n(step))
SELECT series_id, ts, step, round(f, 1) AS forecast, round(f - 1.959963984540054::DOUBLE * s, 1) AS lower, round(f + 1.959963984540054::DOUBLE * s, 1) AS upper FROM f
""")
def trend_season_line(spark, sf):
    return rounded(trend_season.forecast(daily_by_priority(spark, sf), "D", 30, KEYS, design=LINE), 1, "forecast", "lower", "upper")


BENT = trend_season.Design(changepoints=1, yearly=0, weekly=0, sparse=True)


# One bend of a line in the logarithm: what is left of the hinge beside level and slope
# decides alone, and its pull is cut by the weight of the prior.
@query("sparse_changepoint", f"""
WITH d AS ({DAILY_BY_PRIORITY}), e AS (SELECT series_id, min(ts) AS a, max(ts) AS b FROM d GROUP BY series_id),
t AS (SELECT d.series_id, ln(1 + greatest(y, 0)) AS z, date_diff('second', a, ts)::DOUBLE / date_diff('second', a, b) AS t FROM d JOIN e ON d.series_id = e.series_id),
h AS (SELECT *, greatest(0, t - {BENT.history_share / 2}::DOUBLE) AS h FROM t),
s AS (SELECT series_id, count(*) AS n, avg(t) AS mt, avg(h) AS mh, avg(z) AS mz, var_pop(t) AS vt, var_pop(h) AS vh, covar_pop(h, t) AS ht, covar_pop(h, z) AS hz, covar_pop(t, z) AS tz FROM h GROUP BY series_id),
g AS (SELECT s.*, p.prior, n * (hz - ht / vt * tz) AS pull, n * (vh - ht / vt * ht) AS own, {trend_season.NOISE}::DOUBLE / p.prior AS weight
  FROM s, (VALUES (0.001::DOUBLE), (0.01), (0.05), (0.5)) AS p(prior)),
b AS (SELECT *, CASE WHEN abs(pull) <= weight THEN 0.0 ELSE (pull - sign(pull) * weight) / own END AS bend FROM g)
SELECT series_id, prior, round(mz - bend * mh - (tz - bend * ht) / vt * mt, 5) AS level, round((tz - bend * ht) / vt, 5) AS slope, round(bend, 5) AS bend FROM b
""")
def sparse_changepoint(spark, sf):
    d = daily_by_priority(spark, sf)
    out = None
    for p in trend_season.PRIORS:
        chosen = d.select("series_id").distinct().withColumn("prior", F.lit(p))
        beta = trend_season.fit(d, BENT, KEYS, priors=chosen)
        part = beta.select("series_id", "prior", *[F.col("beta")[i].alias(c) for i, c in enumerate(("level", "slope", "bend"))])
        out = part if out is None else out.unionByName(part)
    return rounded(out, 5, "level", "slope", "bend")


@query("prior_grid_line", f"""
WITH d AS ({MONTHLY_BY_PRIORITY}), e AS (SELECT series_id, min(ts) AS a, max(ts) AS b, date_diff('day', min(ts), max(ts)) AS span FROM d GROUP BY series_id HAVING count(*) > 50),
c AS (SELECT series_id, a, b, k, b - to_days(365) - to_days((k * 180)::INTEGER) AS cut FROM e, range(0, 40) AS r(k) WHERE k <= (span - 365 - 730) // 180),
t AS (SELECT c.series_id, k, cut, ts, y, date_diff('second', a, ts)::DOUBLE / date_diff('second', a, b) AS t FROM c JOIN d ON c.series_id = d.series_id),
m AS (SELECT series_id, k, regr_slope(y, t) AS s, regr_intercept(y, t) AS i FROM t WHERE ts <= cut GROUP BY series_id, k),
v AS (SELECT t.series_id, t.k, avg(abs((y - (i + s * t)) / y)) * 100 AS e FROM t JOIN m ON t.series_id = m.series_id AND t.k = m.k WHERE ts > cut AND ts <= cut + to_days(365) GROUP BY 1, 2),
g AS (SELECT series_id, avg(e) AS cv_mape, count(*) AS n_folds FROM v GROUP BY series_id)
SELECT series_id, prior::DOUBLE AS prior, round(cv_mape, 4) AS cv_mape, n_folds FROM g, (VALUES (0.001), (0.01), (0.05), (0.5)) AS p(prior)
""")
def prior_grid_line(spark, sf):
    return rounded(trend_season.prior_scores(monthly_by_priority(spark, sf), "MS", KEYS, design=LINE), 4, "cv_mape")


@query("recursive_linear", f"""
WITH RECURSIVE d AS ({DAILY_BY_PRIORITY}),
h AS (SELECT series_id, list(y ORDER BY ts) AS h, max(ts) AS b FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) AS k FROM d) AS q WHERE k <= 14 GROUP BY series_id),
r AS (SELECT series_id, b, h, 0 AS step FROM h
  UNION ALL SELECT series_id, b, list_append(h, 0.5::DOUBLE * h[-1] + 0.3::DOUBLE * h[-7] + 0.2::DOUBLE * list_avg(h[-7:])), step + 1 FROM r WHERE step < 10)
SELECT series_id, step::INTEGER AS step, (b + to_days(step::INTEGER))::TIMESTAMP AS ts, round(h[-1], 3) AS forecast FROM r WHERE step > 0
""")
def recursive_linear(spark, sf):
    d = daily_by_priority(spark, sf).withColumn("level", F.lit(1.0))
    score = lambda f: f.withColumn("_pred", F.col("lag_1") * 0.5 + F.col("lag_7") * 0.3 + F.col("roll7_mean") * 0.2)
    return rounded(boosted.recursive_forecast(d, "D", 10, KEYS, score), 3, "forecast")


LONG = linear.Linear({"lag_1": 0.3, "lag_7": 0.4, "lag_14": 0.1, "roll7_mean": 0.15, "is_weekend": 2.5}, 1.25)


@query("recursive_linear_long", f"""
WITH RECURSIVE d AS ({HOURLY_EVENTS}),
h AS (SELECT series_id, list(y ORDER BY ts) AS h, max(ts) AS b FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts DESC) AS k FROM d) AS q WHERE k <= 14 GROUP BY series_id),
r AS (SELECT series_id, b, h, 0 AS step FROM h
  UNION ALL SELECT series_id, b, list_append(h[2:], 1.25::DOUBLE + 0.3::DOUBLE * h[-1] + 0.4::DOUBLE * h[-7] + 0.1::DOUBLE * h[-14] + 0.15::DOUBLE * list_avg(h[-7:])
    + CASE WHEN isodow(b + to_hours((step + 1)::INTEGER)) >= 6 THEN 2.5::DOUBLE ELSE 0 END), step + 1 FROM r WHERE step < 2160)
SELECT series_id, step::INTEGER AS step, (b + to_hours(step::INTEGER))::TIMESTAMP AS ts, round(h[-1], 6) AS forecast FROM r WHERE step > 0
""")
def recursive_linear_long(spark, sf):
    """Ninety days by the hour, in one job."""
    return rounded(linear.forecast(hourly_events(spark, sf), LONG, "h", 2160, KEYS), 6, "forecast")


@query("linear_pooled_forecast")
def linear_pooled_forecast(spark, sf):
    split = ev.train_valid_split(filled_daily(spark, sf), "D", KEYS)
    table = cut_lineage(boosted.training_table(split, KEYS))
    leveled = split.join(table.select("series_id", "level").distinct(), KEYS)
    return rounded(linear.forecast(leveled, linear.train(table), "D", 365, KEYS, level="level"), 2, "forecast")


#: (absolute, squared, merging) penalties of a leaf
PENALTIES = [(0.0, 0.0, 0.0), (0.0, 50.0, 0.0), (40.0, 10.0, 0.0), (25.0, 1.0, 1e9)]
_CUT = "1996-07-01"


# One split at the weekend, on which half is sold: leaves and merging in closed form.
@query("penalised_leaves", f"""
WITH d AS (SELECT series_id, ts, (isodow(ts) >= 6)::INTEGER AS is_weekend, CASE WHEN isodow(ts) >= 6 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END * y AS y FROM ({DAILY_BY_PRIORITY}) AS q WHERE ts < TIMESTAMP '{_CUT}'),
v AS (SELECT *, y / avg(abs(y)) OVER (PARTITION BY series_id) AS v FROM d),
s AS (SELECT is_weekend, sum(v) AS g, count(*) AS h FROM v GROUP BY is_weekend),
p AS (SELECT * FROM (VALUES {", ".join(f"({a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE)" for a, b, c in PENALTIES)}) AS t(l1, l2, gamma)),
n AS (SELECT p.*, is_weekend, sign(g) * greatest(abs(g) - l1, 0) AS pull, h + l2 AS own, sum(g) OVER w AS tg, sum(h) OVER w + l2 AS town FROM s, p WINDOW w AS (PARTITION BY l1, l2, gamma)),
m AS (SELECT *, sign(tg) * greatest(abs(tg) - l1, 0) AS tpull, sum(pull * pull / own) OVER (PARTITION BY l1, l2, gamma) AS apart FROM n)
SELECT l1, l2, gamma, is_weekend, round(CASE WHEN apart - tpull * tpull / town < gamma THEN tpull / town ELSE pull / own END, 9) AS value FROM m
""")
def penalised_leaves(spark, sf):
    d = feat.calendar_features(daily_by_priority(spark, sf).where(F.col("ts") < F.lit(_CUT).cast("timestamp_ntz")))
    d = d.withColumn("y", F.when(F.col("is_weekend") == 1, F.col("y") * 0.5).otherwise(F.col("y")))
    level = d.groupBy(*KEYS).agg(F.avg(F.abs("y")).alias("level"))
    table = cut_lineage(d.join(level, KEYS).select("is_weekend", (F.col("y") / F.col("level")).alias("_scaled"), F.lit("train").alias("split")))
    model = boosted.train(table, ["is_weekend"], patience=None, maxIter=1, maxDepth=1, subsamplingRate=1.0, featureSubsetStrategy="all")
    out = None
    for l1, l2, gamma in PENALTIES:
        trees = leaves.penalised(table, model, ["is_weekend"], l1, l2, gamma, patience=None)
        half = 2 ** (trees.depth - 1)  # the left half of the lowest nodes is the week
        part = leaves.leaf_values(spark, trees).where(F.col("leaf").isin(0, half)).select(
            F.lit(l1).alias("l1"), F.lit(l2).alias("l2"), F.lit(gamma).alias("gamma"), (F.col("leaf") / half).cast("int").alias("is_weekend"), "value")
        out = part if out is None else out.unionByName(part)
    return rounded(out, 9, "value")


@query("gbt_penalised_validation")
def gbt_penalised_validation(spark, sf):
    split = ev.train_valid_split(filled_daily(spark, sf), "D", KEYS)
    table = cut_lineage(boosted.training_table(split, KEYS))
    model = boosted.train(table, patience=None, maxIter=40, stepSize=0.2)
    trees = leaves.penalised(table, model, l1=0.1, l2=1.0, gamma=0.01)
    valid = boosted.predict(table.where("split = 'valid'"), trees)
    return rounded(ev.score(valid, KEYS, ["mape", "smape", "rmse"]), 4, "mape", "smape", "rmse")


@query("full_summary_fields", f"""
WITH d AS ({DAILY_BY_PRIORITY}), b AS ({_basic_sql(DAILY_BY_PRIORITY, 3)}), {_TEMPORAL_CTES},
q AS (SELECT series_id, count(DISTINCT y) AS unique_count FROM d GROUP BY series_id),
l AS (SELECT series_id, y, lag(y) OVER (PARTITION BY series_id ORDER BY ts) AS p FROM d),
g AS (SELECT series_id, regr_slope(y - p, p) AS s, regr_sxx(y - p, p) AS sxx, regr_syy(y - p, p) AS syy, regr_count(y - p, p) AS n FROM l WHERE p IS NOT NULL GROUP BY series_id)
SELECT b.series_id, b.mean, b.median, b.cv, t.weekly_avg, t.weekend_avg, t.mom_growth_avg, q.unique_count, round(g.s / sqrt((g.syy - g.s * g.s * g.sxx) / (g.n - 2) / g.sxx), 6) AS adf_statistic
FROM b JOIN ({_TEMPORAL_SELECT}) AS t ON b.series_id = t.series_id JOIN q ON b.series_id = q.series_id JOIN g ON b.series_id = g.series_id
""")
def full_summary_fields(spark, sf):
    d = profile.full_summary(daily_by_priority(spark, sf), KEYS, adf_lags=0)
    d = d.select(
        "series_id", "basic_stats.mean", "basic_stats.median", "basic_stats.cv", "temporal_stats.weekly_avg", "temporal_stats.weekend_avg",
        "temporal_stats.mom_growth_avg", "quality.unique_count", "stationarity.adf_statistic",
    )
    return rounded(rounded(rounded(d, 3, "mean", "median", "weekly_avg", "weekend_avg"), 7, "cv"), 6, "mom_growth_avg", "adf_statistic")
