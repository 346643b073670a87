"""Feature screening: correlation, variance inflation, uplift, gates."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.expressions import pearson
from tidewright.operators import tiles

# Screening thresholds.
MIN_ABS_CORR = 0.10
HIGH_PAIR_CORR = 0.8
MAX_VIF = 5.0
MIN_ACF7_FOR_LAGS = 0.3
LOW_SEASONALITY = 0.3
UPLIFT_POINTS = 1.0
PLANNED_COLUMNS = 24  # beyond so many, pairs are summed in tiles, not planned one by one


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    kinds = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in exclude]


def varying_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns whose values are not all the same: one aggregated row decides."""
    row = df.agg(*[F.stddev_samp(c).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] is not None and row[c] > 0]


# -------------------------------------------------------------- correlation

def correlations(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), y: str = "y") -> DataFrame:
    """Correlation of every candidate with the target, missing read as 0; all
    candidates in one aggregation. Constant candidates have none."""
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    wide = df.groupBy(*keys).agg(*[pearson(zero(c), zero(y)).alias(c) for c in columns])
    return wide.unpivot(list(keys), list(columns), "feature", "corr")


def corr_screen(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), y: str = "y", min_abs: float = MIN_ABS_CORR
) -> DataFrame:
    return correlations(df, columns, keys, y).where(F.abs("corr") >= min_abs)


def corr_pairs(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), threshold: float | None = None, tile: int | None = None
) -> DataFrame:
    """Correlation of each pair of columns, optionally only above a threshold. Many
    columns, or a given ``tile`` size, go by tiles of cross-products."""
    if tile or len(columns) > PLANNED_COLUMNS:
        out = tiles.pair_rows(df, columns, keys, tile or tiles.TILE)
        return out if threshold is None else out.where(F.abs("corr") > threshold)
    pairs = list(combinations(columns, 2))
    value = lambda a, b: pearson(F.col(a).cast("double"), F.col(b).cast("double"))
    entries = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), value(a, b).alias("corr")) for a, b in pairs]
    out = df.groupBy(*keys).agg(F.array(*entries).alias("_p")).select(*keys, F.inline("_p"))
    return out if threshold is None else out.where(F.abs("corr") > threshold)


def high_pairs(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), threshold: float = HIGH_PAIR_CORR) -> DataFrame:
    """Report form: highly correlated pairs, strongest first."""
    return corr_pairs(df, columns, keys, threshold).orderBy(*keys, F.abs("corr").desc(), "a", "b")


# ---------------------------------------------------------------------- VIF

def _corr_rows(df: DataFrame, columns: Sequence[str], keys: Sequence[str], complete: bool = True, tile: int | None = None) -> DataFrame:
    """One row per series: row count and upper-triangle correlations, of rows
    that are complete in all columns unless the caller has chosen the rows."""
    d = df.na.drop(subset=list(columns)) if complete else df
    if tile or len(columns) > PLANNED_COLUMNS:
        return tiles.matrix_rows(d, columns, keys, tile or tiles.TILE)
    value = lambda a, b: pearson(F.col(a).cast("double"), F.col(b).cast("double"))
    spread = [F.stddev_samp(F.col(c).cast("double")) for c in columns]
    return d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.array(*spread).alias("_sd"),
        F.array(*[value(a, b) for a, b in combinations(columns, 2)]).alias("_r"),
    )


def _unpack(n_cols: int, sd, r) -> tuple[np.ndarray, list[int]]:
    """Correlation matrix of the columns that vary, and their positions."""
    full = np.eye(n_cols)
    full[np.triu_indices(n_cols, 1)] = [np.nan if v is None else v for v in r]
    full = np.triu(full) + np.triu(full, 1).T
    live = [i for i in range(n_cols) if sd[i] is not None and sd[i] > 0]
    return full[np.ix_(live, live)], live


def _vifs(corr: np.ndarray) -> np.ndarray:
    """Variance inflation factors: the diagonal of the inverse correlation. Columns that
    take part in an exact relation have an infinite one."""
    if not len(corr):
        return np.zeros(0)
    values, vectors = np.linalg.eigh(corr)
    null = values < 1e-10
    if null.any():
        share = (vectors[:, null] ** 2).sum(1)
        rest = (vectors[:, ~null] ** 2 / values[~null]).sum(1)
        return np.where(share > 1e-9, np.inf, rest)
    return np.diag(np.linalg.inv(corr))


def _prune(corr: np.ndarray, n: int, threshold: float) -> list[int]:
    """Columns left after dropping the worst again and again. The inverse without a
    column follows from the inverse with it; the end is checked afresh."""
    left = list(range(len(corr)))
    while left and n > len(left) + 1:
        v = _vifs(corr[np.ix_(left, left)])
        if v.max() <= threshold:
            break
        if np.isinf(v).any():
            left.pop(int(np.argmax(v)))
            continue
        inverse = np.linalg.inv(corr[np.ix_(left, left)])
        while left and n > len(left) + 1 and (v := np.diag(inverse)).max() > threshold:
            k = int(np.argmax(v))
            inverse = inverse - np.outer(inverse[:, k], inverse[k]) / inverse[k, k]
            inverse = np.delete(np.delete(inverse, k, 0), k, 1)
            left.pop(k)
    return left


def vif_table(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), threshold: float = MAX_VIF, tile: int | None = None
) -> DataFrame:
    """VIF per column and a flag above the threshold.

    Rows are reduced to one correlation vector per series by ordinary
    aggregation; only that p-by-p matrix is inverted in Python. Constant columns
    are left out; a series with no more than p + 1 rows yields nothing.
    """
    columns, keys = list(columns), list(keys)

    def invert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for rec in pdf.to_dict("records"):
                corr, live = _unpack(len(columns), rec["_sd"], rec["_r"])
                if rec["_n"] <= len(live) + 1:
                    continue
                for pos, v in zip(live, _vifs(corr)):
                    rows.append([*(rec[k] for k in keys), columns[pos], float(v), "high_vif" if v > threshold else ""])
            yield pd.DataFrame(rows, columns=[*keys, "feature", "vif", "flag"])

    stats = _corr_rows(df, columns, keys, tile=tile)
    return stats.mapInPandas(invert, _key_schema(df, keys) + "feature string, vif double, flag string")


def _key_schema(df: DataFrame, keys: Sequence[str]) -> str:
    return "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)


def vif_pair(df: DataFrame, a: str, b: str, keys: Sequence[str] = ()) -> DataFrame:
    """Two predictors share one VIF, 1 / (1 - r^2): no matrix needed."""
    r = pearson(F.col(a).cast("double"), F.col(b).cast("double"))
    return df.na.drop(subset=[a, b]).groupBy(*keys).agg((1.0 / F.nullif(1.0 - r * r, F.lit(0.0))).alias("vif"))


def select_by_vif(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), threshold: float = MAX_VIF, tile: int | None = None
) -> DataFrame:
    """Columns left after dropping the worst VIF again and again.

    The data is scanned once; every round works on a sub-matrix of the same
    correlations.
    """
    columns, keys = list(columns), list(keys)

    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for rec in pdf.to_dict("records"):
                corr, live = _unpack(len(columns), rec["_sd"], rec["_r"])
                left = _prune(corr, rec["_n"], threshold)
                constant = [i for i in range(len(columns)) if i not in live]
                for i in sorted([live[i] for i in left] + constant):
                    rows.append([*(rec[k] for k in keys), columns[i]])
            yield pd.DataFrame(rows, columns=[*keys, "feature"])

    return _corr_rows(df, columns, keys, tile=tile).mapInPandas(prune, _key_schema(df, keys) + "feature string")


def evaluate_features(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], y: str = "y",
    min_abs: float = MIN_ABS_CORR, threshold: float = MAX_VIF,
) -> DataFrame:
    """Correlation screen, then drop every survivor whose VIF is too high, all
    at once. One row per series: counts, largest VIF, kept features. Rows count
    for the VIF when a series' survivors are known in them; a screened-out column
    takes no row away."""
    columns, keys = list(columns), list(keys)
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    target = df.groupBy(*keys).agg(F.array(*[pearson(zero(c), zero(y)) for c in columns]).alias("_t"))

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for rec in pdf.to_dict("records"):
                t = [np.nan if v is None else v for v in rec["_t"]]
                screened = [i for i, v in enumerate(t) if abs(v) >= min_abs]
                vifs = {}
                if rec["_r"] is not None:
                    corr, live = _unpack(len(columns), rec["_sd"], rec["_r"])
                    both = [i for i in screened if i in live]
                    at = [live.index(i) for i in both]
                    if rec["_n"] > len(both) + 1:
                        vifs = dict(zip(both, _vifs(corr[np.ix_(at, at)])))
                kept = [columns[i] for i in screened if not vifs.get(i, 0.0) > threshold]
                rows.append([*(rec[k] for k in keys), len(screened), len(kept), float(max(vifs.values(), default=0.0)), kept])
            yield pd.DataFrame(rows, columns=[*keys, "n_features_post_corr", "n_features_final", "max_vif", "features_kept"])

    schema = _key_schema(df, keys) + "n_features_post_corr int, n_features_final int, max_vif double, features_kept array<string>"
    survives = target.select(*keys, F.transform("_t", lambda r: F.coalesce(F.abs(r) >= min_abs, F.lit(False))).alias("_in"))
    known = [~F.col("_in")[i] | F.col(c).isNotNull() for i, c in enumerate(columns)]
    rows = df.join(survives, keys).where(reduce(lambda a, b: a & b, known)) if keys else df
    return target.join(_corr_rows(rows, columns, keys, complete=not keys), keys, "left").mapInPandas(decide, schema)


# ------------------------------------------------------------- uplift, gates

def uplift_decision(
    fold_scores: DataFrame, keys: Sequence[str] = (), arm: str = "arm", value: str = "score", points: float = UPLIFT_POINTS
) -> DataFrame:
    """Accept candidates when the median fold error falls by enough points.

    ``fold_scores`` holds one row per (series, arm, fold), arms ``base`` and
    ``plus``. A missing arm counts as an infinite error.
    """
    median = lambda name: F.percentile(F.when(F.col(arm) == name, F.col(value)), F.lit(0.5))
    inf = F.lit(float("inf"))
    d = fold_scores.groupBy(*keys).agg(median("base").alias("median_base"), median("plus").alias("median_plus"))
    base, plus = F.coalesce("median_base", inf), F.coalesce("median_plus", inf)
    uplift = F.when((base == inf) & (plus == inf), F.lit(None)).otherwise(base - plus)
    return d.withColumn("uplift", uplift).withColumn("accepted", F.coalesce(F.col("uplift") >= points, F.lit(False)))


def select_external_features(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    backtest: Callable[[DataFrame, Sequence[str]], DataFrame] | None = None,
    base: Sequence[str] = (),
    y: str = "y",
    points: float = UPLIFT_POINTS,
    min_abs: float = MIN_ABS_CORR,
) -> DataFrame:
    """Screen candidates, then keep them where a caller's back-test improves.

    ``backtest(df, columns)`` returns ``keys + [score]`` rows, one per fold. It
    sees NULL in the candidates that a series' screen has dropped, so only the
    survivors are tried. A series without survivors stays on its base set.
    """
    kept = corr_screen(df, columns, keys, y, min_abs).groupBy(*keys).agg(F.array_sort(F.collect_list("feature")).alias("screened"))
    every = df.select(*keys).distinct().join(kept, list(keys), "left")
    every = every.withColumn("screened", F.coalesce("screened", F.array().cast("array<string>")))
    if backtest is None:
        return every.withColumn("accepted", F.size("screened") > 0)
    tried = df.join(every.withColumnRenamed("screened", "_screened"), list(keys))
    tried = tried.withColumns({c: F.when(F.array_contains("_screened", c), F.col(c)) for c in columns}).drop("_screened")
    arms = backtest(df, list(base)).withColumn("arm", F.lit("base")).unionByName(
        backtest(tried, [*base, *columns]).withColumn("arm", F.lit("plus"))
    )
    out = every.join(uplift_decision(arms, keys, points=points), list(keys), "left")
    return out.withColumn("accepted", F.coalesce("accepted", F.lit(False)) & (F.size("screened") > 0))


def gate_columns(acf7: Column, acf365: Column, calendar_kept: Column, zero_fraction: Column) -> dict[str, Column]:
    """Which feature families to try, and warnings, per series."""
    return {
        "try_holidays": calendar_kept,
        "try_lags": F.coalesce(acf7 > MIN_ACF7_FOR_LAGS, F.lit(False)),
        "low_seasonality": F.coalesce((acf7 < LOW_SEASONALITY) & (acf365 < LOW_SEASONALITY), F.lit(False)),
        "intermittent_warning": zero_fraction > 0.4,
    }
