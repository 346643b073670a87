"""Seasonal ARMA on differenced series, fitted by two-stage least squares.

Stage one regresses on a long autoregression to estimate the shocks; stage two
regresses on lagged values and lagged shocks (Hannan and Rissanen). Both stages
are cross-product aggregations. Orders are one ordinary and one seasonal term of
each kind after one ordinary and one seasonal difference, optionally with
outside features, differenced the same way.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions import frequency as fq
from tidewright.models.gram import gram, key_schema, least_squares, solve
from tidewright.models.naive import future_spine
from tidewright.operators.layout import by_series, whole_series

Z95 = 1.959963984540054
_FIT = "beta array<double>, var double"


def _differenced(c: Column, w, season: int) -> Column:
    back = lambda k: F.lag(c, k).over(w)
    if season == 1:
        return c - back(1)
    return c - back(1) - back(season) + back(season + 1)


def _fit_rows(g: np.ndarray, n: int) -> list[list]:
    p = g.shape[0]
    fit = least_squares(g, n, range(p - 1), p - 1)
    return [] if fit is None else [[[float(b) for b in fit["beta"]], float(fit["var"])]]


def _stationary(df: DataFrame, keys, ts, y, season, exog) -> DataFrame:
    w, series = by_series(keys, ts), whole_series(keys)
    d = df.withColumns({"_mu": F.avg(y).over(series), "_sd": F.nullif(F.stddev_samp(y).over(series), F.lit(0.0))})
    d = d.withColumn("_u", (F.col(y) - F.col("_mu")) / F.col("_sd"))
    d = d.withColumns({"_w": _differenced(F.col("_u"), w, season)})
    if exog:
        d = d.withColumns({f"_x_{c}": _differenced(F.col(c).cast("double"), w, season) for c in exog})
    return d


def _shocks(d: DataFrame, keys, ts, season) -> DataFrame:
    """Stage one: residuals ``_e`` of a long autoregression."""
    w = by_series(keys, ts)
    reach = sorted({1, 2, 3, season, season + 1})
    names = [f"_w{k}" for k in reach]
    d = d.withColumns({n: F.lag("_w", k).over(w) for n, k in zip(names, reach)})
    fit = solve(gram(d, keys, [*names, "_w"]), keys, len(names) + 1, _fit_rows, "_long array<double>, _v double").drop("_v")
    fitted = sum((F.col("_long")[i] * F.col(n) for i, n in enumerate(names)), F.lit(0.0))
    return d.join(fit, list(keys), "left").withColumn("_e", F.col("_w") - fitted).drop("_long", *names)


def _terms(season: int) -> list[tuple[str, str, int]]:
    terms = [("_w", "_aw1", 1), ("_e", "_ae1", 1)]
    return terms if season == 1 else [*terms, ("_w", "_aws", season), ("_e", "_aes", season)]


def fit(
    df: DataFrame, keys: Sequence[str], ts: str = "ts", y: str = "y", season: int = 7, exog: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(coefficients per series, rows with differences and shocks). Series that
    cannot be fitted have no coefficients."""
    d = _shocks(_stationary(df, keys, ts, y, season, exog), keys, ts, season)
    w = by_series(keys, ts)
    d = d.withColumns({name: F.lag(src, k).over(w) for src, name, k in _terms(season)})
    columns = [name for _, name, _ in _terms(season)] + [f"_x_{c}" for c in exog]
    coef = solve(gram(d, keys, [*columns, "_w"]), keys, len(columns) + 1, _fit_rows, _FIT)
    return coef, d


def forecast(
    df: DataFrame,
    freq: str,
    horizon: int,
    keys: Sequence[str],
    ts: str = "ts",
    y: str = "y",
    season: int | None = None,
    exog: Sequence[str] = (),
    exog_future: DataFrame | None = None,
    future: DataFrame | None = None,
) -> DataFrame:
    """Mean forecast with 95 % bounds for ``horizon`` steps after each series.

    Steps count rows, as the differences do. ``future`` may name the rows to
    forecast (keys, ts, step); otherwise they follow on the calendar.

    ``exog_future`` carries real future values of the features on the future
    grid. The recursion sees one row per series: a season of recent values and
    shocks, whatever the length of the history.
    """
    season = season or fq.frequency(freq).season
    keys, exog = list(keys), list(exog)
    coef, d = fit(df, keys, ts, y, season, exog)
    keep = season + 1
    back = F.row_number().over(by_series(keys, F.col(ts).desc()))
    recent = d.withColumn("_back", back).where(F.col("_back") <= keep)
    ordered = lambda c: F.transform(
        F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("o"), F.coalesce(F.col(c), F.lit(0.0)).alias("v")))), lambda s: s["v"]
    )
    state = recent.groupBy(*keys).agg(
        ordered("_u").alias("_u"), ordered("_w").alias("_w"), ordered("_e").alias("_e"),
        F.max("_mu").alias("_mu"), F.max("_sd").alias("_sd"),
    ).join(coef, keys)
    if future is None:
        future = future_spine(df, freq, horizon, keys, ts)
    if exog:
        state = state.join(_future_exog(df, future, exog_future, keys, ts, season, exog), keys)
    else:
        state = state.withColumn("_fx", F.array().cast("array<array<double>>"))
    n_ar = len(_terms(season))

    def roll(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            # a shorter history than one season cannot be continued
            pdf = pdf[pdf["_u"].map(len) == keep]
            if pdf.empty:
                continue
            beta = np.stack(pdf["beta"].to_numpy())
            u, w, e = (np.stack(pdf[c].to_numpy()).astype(float) for c in ("_u", "_w", "_e"))
            add = np.zeros((len(pdf), horizon))
            if exog:
                # a series may have fewer future rows than the horizon
                for i, steps in enumerate(pdf["_fx"]):
                    fx = np.array([np.asarray(step, dtype=float) for step in steps])
                    add[i, : len(fx)] = fx @ beta[i, n_ar:]
            mean = _continue(beta, u, w, e, add, season)
            sd = np.sqrt(pdf["var"].to_numpy()[:, None] * np.cumsum(_psi(beta, horizon, season) ** 2, axis=1))
            mu, scale = pdf["_mu"].to_numpy()[:, None], pdf["_sd"].to_numpy()[:, None]
            out = pdf[keys].loc[pdf.index.repeat(horizon)].reset_index(drop=True)
            out["step"] = np.tile(np.arange(1, horizon + 1), len(pdf))
            out["forecast"] = (mu + scale * mean).ravel()
            out["lower"] = (mu + scale * (mean - Z95 * sd)).ravel()
            out["upper"] = (mu + scale * (mean + Z95 * sd)).ravel()
            yield out

    paths = state.mapInPandas(roll, key_schema(df, keys) + "step int, forecast double, lower double, upper double")
    return future.join(paths, [*keys, "step"])


def _future_exog(df, future, exog_future, keys, ts, season, exog) -> DataFrame:
    """Differenced features on the future grid, one array of steps per series."""
    if exog_future is None:
        raise ValueError("exog_future is needed when the model uses features")
    back = F.row_number().over(by_series(keys, F.col(ts).desc()))
    tail = df.select(*keys, ts, *exog).withColumn("_back", back).where(F.col("_back") <= season + 1).drop("_back")
    rows = tail.withColumn("step", F.lit(0)).unionByName(
        future.join(exog_future.select(*keys, ts, *exog), [*keys, ts]).select(*keys, ts, *exog, "step")
    )
    w = by_series(keys, ts)
    rows = rows.withColumns({f"_x_{c}": _differenced(F.col(c).cast("double"), w, season) for c in exog}).where("step > 0")
    values = F.array(*[F.coalesce(F.col(f"_x_{c}"), F.lit(0.0)) for c in exog])
    return rows.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("step", values.alias("v")))), lambda s: s["v"]).alias("_fx")
    )


def _continue(beta, u, w, e, add, season) -> np.ndarray:
    """Continue all series of a batch together, one step at a time."""
    held, horizon = u.shape[1], add.shape[1]
    room = np.zeros((len(u), horizon))
    u, w, e = (np.concatenate([x, room], axis=1) for x in (u, w, e))
    for h in range(horizon):
        at = held + h
        nxt = beta[:, 0] * w[:, at - 1] + beta[:, 1] * e[:, at - 1] + add[:, h]
        if season > 1:
            nxt = nxt + beta[:, 2] * w[:, at - season] + beta[:, 3] * e[:, at - season]
            u[:, at] = nxt + u[:, at - 1] + u[:, at - season] - u[:, at - season - 1]
        else:
            u[:, at] = nxt + u[:, at - 1]
        w[:, at] = nxt
    return u[:, held:]


def _psi(beta: np.ndarray, horizon: int, season: int) -> np.ndarray:
    """Weights of past shocks in the forecast error, by polynomial division."""
    size = 2 * season + 3
    ar = np.zeros((len(beta), size))
    ar[:, 0] = 1.0
    ar[:, 1] -= beta[:, 0]
    ma = np.zeros((len(beta), size))
    ma[:, 0] = 1.0
    ma[:, 1] += beta[:, 1]
    if season > 1:
        ar[:, season] -= beta[:, 2]
        ma[:, season] += beta[:, 3]

    def times_difference(poly: np.ndarray, lag: int) -> np.ndarray:
        out = np.zeros((len(poly), poly.shape[1] + lag))
        out[:, : poly.shape[1]] += poly
        out[:, lag:] -= poly
        return out

    ar = times_difference(ar, 1)
    if season > 1:
        ar = times_difference(ar, season)
    # a handful of lags whatever the season: 1, s and what differencing makes of them
    used = [i for i in range(1, ar.shape[1]) if ar[:, i].any()]
    psi = np.zeros((len(beta), horizon))
    psi[:, 0] = 1.0
    for j in range(1, horizon):
        value = ma[:, j].copy() if j < ma.shape[1] else np.zeros(len(beta))
        for i in used:
            if i > j:
                break
            value -= ar[:, i] * psi[:, j - i]
        psi[:, j] = value
    return psi


# ------------------------------------------------------------- simple AR forms

def ar1_fit(df: DataFrame, keys: Sequence[str], ts: str = "ts", y: str = "y") -> DataFrame:
    """Slope and intercept of y on its previous value, and the last value."""
    d = df.withColumn("_prev", F.lag(y).over(by_series(keys, ts)))
    return d.groupBy(*keys).agg(
        F.regr_slope(y, "_prev").alias("phi"), F.regr_intercept(y, "_prev").alias("const"),
        F.max_by(y, ts).alias("last_y"), F.max(ts).alias("last_ts"),
    )


def ar1_forecast(df: DataFrame, freq: str, horizon: int, keys: Sequence[str], ts: str = "ts", y: str = "y") -> DataFrame:
    """Recursive forecast folded inside the plan, one row per series."""
    path = F.aggregate(
        F.sequence(F.lit(1), F.lit(horizon)),
        F.array(F.col("last_y")),
        lambda acc, _: F.concat(acc, F.array(F.col("const") + F.col("phi") * F.element_at(acc, -1))),
    )
    d = ar1_fit(df, keys, ts, y).withColumn("_path", F.slice(path, 2, horizon))
    d = d.select(*keys, "last_ts", F.posexplode_outer("_path").alias("_i", "forecast"))
    step = (F.col("_i") + 1).cast("int")
    return d.select(*keys, step.alias("step"), fq.add_steps(F.col("last_ts"), step, freq).alias(ts), "forecast")


def order_grid(
    df: DataFrame, keys: Sequence[str], ts: str = "ts", y: str = "y", season: int = 7, max_p: int = 3, max_seasonal: int = 2
) -> DataFrame:
    """AIC of every (p, P) autoregression on the differenced series. All of them
    are sub-blocks of one cross-product matrix, so the data is read once."""
    d = _stationary(df, keys, ts, y, season, ())
    w = by_series(keys, ts)
    plain = [f"_p{i}" for i in range(1, max_p + 1)]
    seasonal = [f"_s{i}" for i in range(1, max_seasonal + 1)]
    d = d.withColumns({n: F.lag("_w", i).over(w) for i, n in enumerate(plain, 1)})
    d = d.withColumns({n: F.lag("_w", i * season).over(w) for i, n in enumerate(seasonal, 1)})
    columns = ["_one", *plain, *seasonal, "_w"]
    d = d.withColumn("_one", F.lit(1.0))

    def grid(g: np.ndarray, n: int) -> list[list]:
        rows = []
        for p in range(max_p + 1):
            for s in range(max_seasonal + 1):
                x = [0, *range(1, 1 + p), *range(1 + max_p, 1 + max_p + s)]
                found = least_squares(g, n, x, g.shape[0] - 1)
                if found is not None:
                    rows.append([p, s, float(found["aic"])])
        return rows

    return solve(gram(d, keys, columns), keys, len(columns), grid, "p int, seasonal_p int, aic double")


def best_order(grid: DataFrame, keys: Sequence[str]) -> DataFrame:
    best = F.min(F.struct("aic", "p", "seasonal_p"))
    return grid.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.p", "_b.seasonal_p", "_b.aic")
