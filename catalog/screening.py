"""Correlation, variance inflation, uplift and gates; structure of a series."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    DAILY_BY_PRIORITY, HOURLY_EVENTS, KEYS, MONTHLY_BY_PRIORITY, REGISTRY, daily_by_priority, hourly_events, idle_weekends_sql,
    monthly_by_priority, query, rounded, table, with_idle_weekends,
)
from catalog.profiling import _ACF
from tidewright.functions.expressions import safe_divide
from tidewright.operators import features as feat
from tidewright.operators import profile, screening, structure

NUMERICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr(a: str, b: str) -> str:
    return f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0)"


@query("corr_pairs", "SELECT l_returnflag AS series_id, u.* FROM (SELECT l_returnflag, [" + ", ".join(
    f"{{'a': '{a}', 'b': '{b}', 'corr': round({_corr(a, b)}, 9)}}" for i, a in enumerate(NUMERICS) for b in NUMERICS[i + 1:]
) + "] AS p FROM lineitem GROUP BY l_returnflag) AS g, unnest(p) AS t(u)")
def corr_pairs(spark, sf):
    d = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "series_id")
    return rounded(screening.corr_pairs(d, NUMERICS, KEYS), 9, "corr")


@query("corr_high_pairs", f"""
WITH d AS (SELECT *, l_quantity * 2 + l_tax AS mixed FROM lineitem), c AS (SELECT {_corr('l_quantity', 'l_extendedprice')} AS a, {_corr('l_quantity', 'mixed')} AS b,
  {_corr('l_extendedprice', 'mixed')} AS c FROM d),
u AS (SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, a AS corr FROM c UNION ALL SELECT 'l_quantity', 'mixed', b FROM c UNION ALL SELECT 'l_extendedprice', 'mixed', c FROM c)
SELECT a, b, round(corr, 9) AS corr FROM u WHERE abs(corr) > 0.8
""")
def corr_high_pairs(spark, sf):
    d = table(spark, sf, "lineitem").withColumn("mixed", F.col("l_quantity") * 2 + F.col("l_tax"))
    return rounded(screening.high_pairs(d, ["l_quantity", "l_extendedprice", "mixed"]), 9, "corr")


_LAGGED = ["dow", "month", "lag_1", "lag_7", "roll7_mean"]


def lagged_features(spark, sf):
    d = feat.calendar_features(daily_by_priority(spark, sf))
    return feat.lag_roll_features(d, KEYS)


_LAGGED_SQL = f"""SELECT *, (isodow(ts) - 1)::DOUBLE AS dow, month(ts)::DOUBLE AS month FROM (
  SELECT series_id, ts, y, lag(y, 1) OVER w AS lag_1, lag(y, 7) OVER w AS lag_7,
    CASE WHEN count(y) OVER f >= 7 THEN avg(y) OVER f END AS roll7_mean FROM ({DAILY_BY_PRIORITY}) AS d
  WINDOW w AS (PARTITION BY series_id ORDER BY ts), f AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) AS l"""


@query("corr_all", f"WITH d AS ({_LAGGED_SQL}), c AS (SELECT series_id, " + ", ".join(
    f"round({_corr(f'coalesce({c}, 0)', 'coalesce(y, 0)')}, 9) AS {c}" for c in _LAGGED
) + f" FROM d GROUP BY series_id) UNPIVOT c ON {', '.join(_LAGGED)} INTO NAME feature VALUE corr")
def corr_all(spark, sf):
    return rounded(screening.correlations(lagged_features(spark, sf), _LAGGED, KEYS), 9, "corr")


@query("corr_screen", f"WITH d AS ({idle_weekends_sql(DAILY_BY_PRIORITY)}), e AS (SELECT *, (isodow(ts) - 1)::DOUBLE AS dow, (isodow(ts) >= 6)::INTEGER::DOUBLE AS is_weekend, "
       "month(ts)::DOUBLE AS month, 5.0::DOUBLE AS fixed FROM d), c AS (SELECT series_id, " + ", ".join(
    f"round({_corr(c, 'y')}, 9) AS {c}" for c in ("dow", "is_weekend", "month", "fixed")
) + " FROM e GROUP BY series_id), u AS (UNPIVOT c ON dow, is_weekend, month, fixed INTO NAME feature VALUE corr) SELECT * FROM u WHERE abs(corr) >= 0.1")
def corr_screen(spark, sf):
    d = feat.calendar_features(with_idle_weekends(daily_by_priority(spark, sf))).withColumn("fixed", F.lit(5.0))
    return rounded(screening.corr_screen(d, ["dow", "is_weekend", "month", "fixed"], KEYS), 9, "corr")


@query("corr_pairs_tiled", REGISTRY["corr_pairs"][1])
def corr_pairs_tiled(spark, sf):
    """The same pairs from tiles of three columns."""
    d = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "series_id")
    return rounded(screening.corr_pairs(d, NUMERICS, KEYS, tile=3), 9, "corr")


LAGS = range(1, 61)


def lag_columns(spark, sf):
    return feat.lag_roll_features(daily_by_priority(spark, sf), KEYS, lags=list(LAGS), rolls=[])


@query("corr_pairs_wide", f"""
WITH d AS (SELECT series_id, y, row_number() OVER (PARTITION BY series_id ORDER BY ts) AS rn FROM ({DAILY_BY_PRIORITY}) AS x),
l AS (SELECT d.series_id, d.rn, k, e.y FROM d, range({LAGS.start}, {LAGS.stop}) AS r(k) JOIN d AS e ON e.series_id = d.series_id AND e.rn = d.rn - k)
SELECT a.series_id, 'lag_' || a.k AS a, 'lag_' || b.k AS b, round(covar_pop(a.y, b.y) / nullif(stddev_pop(a.y) * stddev_pop(b.y), 0), 8) AS corr
FROM l AS a JOIN l AS b ON a.series_id = b.series_id AND a.rn = b.rn AND a.k < b.k GROUP BY a.series_id, a.k, b.k
""")
def corr_pairs_wide(spark, sf):
    """Sixty lags: 1,770 pairs a series, each over the rows that have both."""
    return rounded(screening.corr_pairs(lag_columns(spark, sf), [f"lag_{k}" for k in LAGS], KEYS), 8, "corr")


@query("vif_select_wide")
def vif_select_wide(spark, sf):
    """Sixty lags and ten sums of neighbours, which go."""
    d = lag_columns(spark, sf)
    d = d.withColumns({f"sum_{k}": F.col(f"lag_{k}") + F.col(f"lag_{k + 1}") for k in range(1, 11)})
    return screening.select_by_vif(d, [*[f"sum_{k}" for k in range(1, 11)], *[f"lag_{k}" for k in LAGS]], KEYS)


@query("vif_two", f"""
SELECT l_returnflag AS series_id, round(1 / (1 - r * r), 9) AS vif FROM (SELECT l_returnflag, {_corr('l_quantity', 'l_extendedprice')} AS r FROM lineitem GROUP BY l_returnflag) AS c
""")
def vif_two(spark, sf):
    d = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "series_id")
    return rounded(screening.vif_pair(d, "l_quantity", "l_extendedprice", KEYS), 9, "vif")


_P3 = ["l_quantity", "l_extendedprice", "l_tax"]


# Three predictors: R^2 of one on the other two has a closed form.
@query("vif_three", f"""
WITH c AS (SELECT l_returnflag AS series_id, {_corr('l_quantity', 'l_extendedprice')} AS a, {_corr('l_quantity', 'l_tax')} AS b, {_corr('l_extendedprice', 'l_tax')} AS c FROM lineitem GROUP BY l_returnflag),
u AS (SELECT series_id, 'l_quantity' AS feature, (a * a + b * b - 2 * a * b * c) / (1 - c * c) AS r2 FROM c
  UNION ALL SELECT series_id, 'l_extendedprice', (a * a + c * c - 2 * a * b * c) / (1 - b * b) FROM c
  UNION ALL SELECT series_id, 'l_tax', (b * b + c * c - 2 * a * b * c) / (1 - a * a) FROM c)
SELECT series_id, feature, round(1 / (1 - r2), 8) AS vif, CASE WHEN 1 / (1 - r2) > 5 THEN 'high_vif' ELSE '' END AS flag FROM u
""")
def vif_three(spark, sf):
    d = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "series_id")
    return rounded(screening.vif_table(d, _P3, KEYS), 8, "vif")


@query("vif_three_tiled", REGISTRY["vif_three"][1])
def vif_three_tiled(spark, sf):
    """The same factors from tiles of two columns."""
    d = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "series_id")
    return rounded(screening.vif_table(d, _P3, KEYS, tile=2), 8, "vif")


_MIXED3 = ["l_quantity", "mixed", "l_tax"]


# Round one drops the worst of three when its VIF exceeds 5, round two the
# earlier of the two left when theirs does.
@query("vif_select_three", f"""
WITH d AS (SELECT *, l_quantity * 2 + l_discount * 100 AS mixed FROM lineitem),
c AS (SELECT l_returnflag AS series_id, {_corr('l_quantity', 'mixed')} AS a, {_corr('l_quantity', 'l_tax')} AS b, {_corr('mixed', 'l_tax')} AS c FROM d GROUP BY l_returnflag),
u AS (SELECT series_id, 0 AS k, 'l_quantity' AS feature, 1 / (1 - (a * a + b * b - 2 * a * b * c) / (1 - c * c)) AS vif, c AS others FROM c
  UNION ALL SELECT series_id, 1, 'mixed', 1 / (1 - (a * a + c * c - 2 * a * b * c) / (1 - b * b)), b FROM c
  UNION ALL SELECT series_id, 2, 'l_tax', 1 / (1 - (b * b + c * c - 2 * a * b * c) / (1 - a * a)), a FROM c),
w AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY vif DESC) AS place, max(vif) OVER (PARTITION BY series_id) AS top FROM u),
k AS (SELECT series_id, feature, row_number() OVER (PARTITION BY series_id ORDER BY k) AS pos,
  1 / (1 - (max(CASE WHEN place = 1 THEN others END) OVER (PARTITION BY series_id)) ** 2) AS pair_vif, top, place FROM w)
SELECT series_id, feature FROM k WHERE top <= 5 OR (place > 1 AND (pair_vif <= 5 OR pos = (SELECT max(pos) FROM k AS m WHERE m.series_id = k.series_id AND m.place > 1)))
""")
def vif_select_three(spark, sf):
    d = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "series_id")
    return screening.select_by_vif(d.withColumn("mixed", F.col("l_quantity") * 2 + F.col("l_discount") * 100), _MIXED3, KEYS)


@query("vif_n")
def vif_n(spark, sf):
    return rounded(screening.vif_table(lagged_features(spark, sf), [*_LAGGED, "lag_14", "dayofyear"], KEYS), 6, "vif")


@query("vif_select")
def vif_select(spark, sf):
    return screening.select_by_vif(lagged_features(spark, sf), [*_LAGGED, "lag_14", "dayofyear"], KEYS)


@query("evaluate_features")
def evaluate_features(spark, sf):
    d = screening.evaluate_features(lagged_features(spark, sf), [*_LAGGED, "dayofyear"], KEYS, min_abs=0.01)
    return rounded(d, 6, "max_vif").withColumn("features_kept", F.concat_ws(",", "features_kept"))


# Candidate arm: last week's value; base arm: yesterday's. Folds are months.
@query("uplift_decision", f"""
WITH d AS (SELECT * FROM ({_LAGGED_SQL}) AS l WHERE lag_7 IS NOT NULL),
f AS (SELECT series_id, date_trunc('month', ts) AS fold, avg(abs((y - lag_1) / y)) * 100 AS base, avg(abs((y - lag_7) / y)) * 100 AS plus FROM d GROUP BY 1, 2),
m AS (SELECT series_id, quantile_cont(base, 0.5) AS mb, quantile_cont(plus, 0.5) AS mp FROM f GROUP BY series_id)
SELECT series_id, round(mb, 6) AS median_base, round(mp, 6) AS median_plus, round(mb - mp, 6) AS uplift, mb - mp >= 1.0 AS accepted FROM m
""")
def uplift_decision(spark, sf):
    d = lagged_features(spark, sf).where("lag_7 is not null").withColumn("fold", F.date_trunc("month", "ts"))
    error = lambda c: F.avg(F.abs(safe_divide(F.col("y") - F.col(c), F.col("y")))) * 100
    folds = d.groupBy("series_id", "fold").agg(error("lag_1").alias("base"), error("lag_7").alias("plus"))
    long = folds.unpivot(["series_id", "fold"], ["base", "plus"], "arm", "score")
    return rounded(screening.uplift_decision(long, KEYS), 6, "median_base", "median_plus", "uplift")


@query("gates", f"""
WITH s AS ({idle_weekends_sql(DAILY_BY_PRIORITY)}), {_ACF},
p AS (SELECT a.series_id, b.rn - a.rn AS lag, sum(a.d * b.d) AS c FROM v a JOIN v b ON a.series_id = b.series_id AND b.rn = a.rn + 7 GROUP BY 1, 2
  UNION ALL SELECT a.series_id, b.rn - a.rn, sum(a.d * b.d) FROM v a JOIN v b ON a.series_id = b.series_id AND b.rn = a.rn + 365 GROUP BY 1, 2),
g AS (SELECT z.series_id, max(c / v0) FILTER (lag = 7) AS a7, max(c / v0) FILTER (lag = 365) AS a365 FROM z LEFT JOIN p ON z.series_id = p.series_id GROUP BY z.series_id),
k AS (SELECT series_id, greatest(abs({_corr('isodow(ts) - 1', 'y')}), abs({_corr('(isodow(ts) >= 6)::INTEGER', 'y')}), abs({_corr('month(ts)', 'y')})) >= 0.1 AS keep,
  count(*) FILTER (y = 0)::DOUBLE / count(*) AS zf FROM s GROUP BY series_id)
SELECT g.series_id, keep AS try_holidays, coalesce(a7 > 0.3, false) AS try_lags, coalesce(a7 < 0.3 AND a365 < 0.3, false) AS low_seasonality, zf > 0.4 AS intermittent_warning
FROM g JOIN k ON g.series_id = k.series_id
""")
def gates(spark, sf):
    d = with_idle_weekends(daily_by_priority(spark, sf))
    kept = screening.correlations(feat.calendar_features(d), ["dow", "is_weekend", "month"], KEYS)
    kept = kept.groupBy(*KEYS).agg((F.max(F.abs("corr")) >= 0.1).alias("kept"))
    all_ = profile.seasonal_strength(d, KEYS).join(profile.summary_stats(d, KEYS), KEYS).join(kept, KEYS)
    cols = screening.gate_columns(F.col("acf7"), F.col("acf365"), F.col("kept"), F.col("zero_fraction"))
    return all_.select(*KEYS, *[c.alias(n) for n, c in cols.items()])


# ---------------------------------------------------------------- structure

def _decompose_sql(inner: str, m: int, multiplicative: bool) -> str:
    h = m // 2
    trend = (
        f"CASE WHEN count(y) OVER (w ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) = {m} THEN avg(y) OVER (w ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) END"
        if m % 2 else
        f"CASE WHEN count(y) OVER (w ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) = {m + 1} THEN (sum(y) OVER (w ROWS BETWEEN {h - 1} PRECEDING AND {h - 1} FOLLOWING) "
        f"+ 0.5 * lag(y, {h}) OVER w + 0.5 * lead(y, {h}) OVER w) / {m} END"
    )
    op, inv = ("/", "*") if multiplicative else ("-", "+")
    # half-weight averages of two-decimal values end in 5 beyond the point
    digits, s_digits = (0, 7) if multiplicative else (2, 2)
    return f"""
WITH t AS (SELECT *, row_number() OVER w - 1 AS rn, {trend} AS trend FROM ({inner}) AS d WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
f AS (SELECT series_id, rn % {m} AS phase, avg(y {op} trend) AS fig FROM t GROUP BY series_id, rn % {m}),
c AS (SELECT series_id, avg(fig) AS centre FROM f GROUP BY series_id)
SELECT t.series_id, t.ts, t.y, round(trend, {digits}) AS trend, round(fig {op} centre, {s_digits}) AS seasonal, round(y {op} (trend {inv} (fig {op} centre)), {s_digits}) AS resid
FROM t JOIN f ON t.series_id = f.series_id AND t.rn % {m} = f.phase JOIN c ON c.series_id = t.series_id
"""


@query("decompose_additive", _decompose_sql(DAILY_BY_PRIORITY, 7, False))
def decompose_additive(spark, sf):
    return rounded(structure.decompose(daily_by_priority(spark, sf), 7, KEYS), 2, "trend", "seasonal", "resid")


@query("decompose_multiplicative", _decompose_sql(MONTHLY_BY_PRIORITY, 12, True))
def decompose_multiplicative(spark, sf):
    d = structure.decompose(monthly_by_priority(spark, sf), 12, KEYS, model="multiplicative")
    return rounded(rounded(d, 0, "trend"), 7, "seasonal", "resid")


@query("trend_line", f"""
WITH d AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts)::DOUBLE AS rn FROM ({DAILY_BY_PRIORITY}) AS q)
SELECT series_id, round(regr_slope(y, rn), 5) AS slope, round(regr_intercept(y, rn), 2) AS intercept, round(regr_r2(y, rn), 9) AS r2 FROM d GROUP BY series_id
""")
def trend_line(spark, sf):
    d = structure.trend_line(daily_by_priority(spark, sf), KEYS)
    return rounded(rounded(rounded(d, 5, "slope"), 2, "intercept"), 9, "r2")


@query("season_period", f"""
WITH s AS ({HOURLY_EVENTS}), {_ACF},
a AS (SELECT a.series_id, b.rn - a.rn AS lag, round(sum(a.d * b.d) / max(v0), 9) AS acf FROM v a JOIN v b ON a.series_id = b.series_id AND b.rn IN (a.rn + 6, a.rn + 12, a.rn + 24, a.rn + 168)
  JOIN z ON z.series_id = a.series_id GROUP BY 1, 2)
SELECT series_id, arg_max(lag, acf)::INTEGER AS period, max(acf) AS strength FROM a GROUP BY series_id
""")
def season_period(spark, sf):
    a = rounded(profile.acf(hourly_events(spark, sf), KEYS, nlags=168), 9, "acf")
    return structure.seasonal_period(a, [6, 12, 24, 168], KEYS)
