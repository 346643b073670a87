"""Augmented Dickey-Fuller test (constant, no trend) for every series."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, erf, sqrt

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.models.gram import gram, least_squares, solve
from tidewright.operators.layout import by_series, whole_series

# MacKinnon's published response surface for the constant-only
# case: polynomial coefficients in the statistic, and where it applies.
TAU_STAR, TAU_MIN, TAU_MAX = -1.61, -18.83, 2.74
SMALL_P = (2.1659, 1.4412, 0.038269)
LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)


def mackinnon_p(tau: float) -> float:
    if tau > TAU_MAX:
        return 1.0
    if tau < TAU_MIN:
        return 0.0
    coef = SMALL_P if tau <= TAU_STAR else LARGE_P
    z = sum(c * tau**i for i, c in enumerate(coef))
    return 0.5 * (1.0 + erf(z / sqrt(2.0)))


def adf_test(df: DataFrame, keys: Sequence[str], ts: str = "ts", y: str = "y", lags: int | str = "aic", max_lag: int | None = None) -> DataFrame:
    """Statistic, p-value and lags used; NULL where the regression fails.

    With ``lags="aic"`` the lag count minimises AIC over the nested regressions
    that live inside one cross-product matrix; the winner is then refitted on
    all the rows it can use. A series of n rows tries up to 12 (n / 100)^(1/4)
    lags (rounded up, and at most n / 2 - 2) unless ``max_lag`` says otherwise;
    lags beyond a series' own limit are 0 in its matrix.
    """
    w = by_series(keys, ts)
    series = whole_series(keys)
    d = df.where(F.col(y).isNotNull())
    # the statistic does not depend on location and scale; unit scale keeps the
    # cross-products well conditioned
    d = d.withColumn("_u", (F.col(y) - F.avg(y).over(series)) / F.nullif(F.stddev_samp(y).over(series), F.lit(0.0)))
    d = d.withColumns({"_one": F.lit(1.0), "_prev": F.lag("_u").over(w)}).withColumn("_dy", F.col("_u") - F.col("_prev"))
    longest = None
    if lags == "aic" and max_lag is None:
        n = F.count(F.lit(1)).over(series)
        d = d.withColumn("_top", F.greatest(F.lit(0), F.least(F.ceil(12 * F.pow(n / 100, F.lit(0.25))), F.floor(n / 2) - 2)).cast("int"))
        # one number: the limit of the longest series
        longest = df.where(F.col(y).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        max_lag = ceil(12 * (longest / 100) ** 0.25)
    top = max_lag if lags == "aic" else int(lags)
    names = [f"_d{i}" for i in range(1, top + 1)]
    d = d.withColumns({name: F.lag("_dy", i).over(w) for i, name in enumerate(names, 1)}) if names else d
    if longest is not None:
        d = d.withColumns({name: F.when(F.col("_top") >= i, F.col(name)).otherwise(F.lit(0.0)) for i, name in enumerate(names, 1)})
    columns = ["_one", "_prev", *names, "_dy"]
    schema = "adf_statistic double, adf_pvalue double, used_lags int"

    def test(g: np.ndarray, n: int, k: int):
        fit = least_squares(g, n, range(2 + k), g.shape[0] - 1)
        if fit is None or fit["se"][1] == 0:
            return []
        tau = float(fit["beta"][1] / fit["se"][1])
        return [[tau, mackinnon_p(tau), k]]

    if lags != "aic":
        return _all_series(df, keys, solve(gram(d, keys, columns), keys, len(columns), lambda g, n: test(g, n, top), schema))

    def choose(g: np.ndarray, n: int):
        own = int(np.count_nonzero(np.diag(g)[2:-1]))
        fits = {k: least_squares(g, n, range(2 + k), g.shape[0] - 1) for k in range(own + 1)}
        scored = {k: f["aic"] for k, f in fits.items() if f is not None}
        return [[min(scored, key=scored.get)]] if scored else []

    picked = solve(gram(d, keys, columns), keys, len(columns), choose, "_k int")
    refit = d.join(picked, list(keys))
    # unused lags become 0, so only the rows the chosen lags need are dropped
    refit = refit.withColumns({n: F.when(F.col("_k") >= i, F.col(n)).otherwise(F.lit(0.0)) for i, n in enumerate(names, 1)})
    out = solve(gram(refit, [*keys, "_k"], columns), keys, len(columns), lambda g, n: test(g, n, int(np.count_nonzero(np.diag(g)[2:-1]))), schema)
    return _all_series(df, keys, out)


def _all_series(df: DataFrame, keys: Sequence[str], out: DataFrame) -> DataFrame:
    return df.select(*keys).distinct().join(out, list(keys), "left")
