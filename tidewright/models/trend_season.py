"""Trend with change points plus Fourier seasons, for every series at once.

The model is linear in a design vector per row: level, slope, hinges at change
points, sine and cosine pairs, holiday flag. Multiplicative seasonality is
fitted on the logarithm. The prior of the change points is a double exponential when
the design is ``sparse`` (an absolute penalty: most change points are exactly zero), else
a normal one (a squared penalty). Either way every candidate prior solves the same
cross-product matrix; sparse ones follow a path, each starting from the one before.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions import frequency as fq
from tidewright.models.gram import gram_of_vectors, key_schema, least_squares, solve, sparse_path, unpack
from tidewright.models.naive import future_spine
from tidewright.operators.evaluate import cv_windows
from tidewright.operators.intervals import clip_forecast
from tidewright.operators.layout import by_series

# Prior grid and default, season prior, interval half-width.
PRIORS = (0.001, 0.01, 0.05, 0.5)
DEFAULT_PRIOR = 0.05
SEASON_PRIOR = 10.0
Z95 = 1.959963984540054
NOISE = 0.01  # noise variance that turns a prior scale into a ridge weight


@dataclass(frozen=True)
class Design:
    """Which columns a row's design vector holds."""

    changepoints: int = 10
    history_share: float = 0.8  # change points lie in this part of the history
    yearly: int = 6
    weekly: int = 3
    daily: int = 0
    multiplicative: bool = True
    holiday: str | None = None  # name of a 0/1 column
    sparse: bool = False  # absolute penalty on the change points

    @staticmethod
    def for_frequency(freq: str, **over) -> "Design":
        f = fq.frequency(freq)
        weekly = 3 if f.unit == "minute" and f.every <= 1440 else 0
        daily = 4 if f.unit == "minute" and f.every < 1440 else 0
        # monthly grids cannot tell more than five pairs apart
        yearly = {"MS": 5, "QS": 1, "YS": 0}.get(f.label, 6)
        return Design(**{"yearly": yearly, "weekly": weekly, "daily": daily, "sparse": True, **over})

    @property
    def width(self) -> int:
        return 2 + self.changepoints + 2 * (self.yearly + self.weekly + self.daily) + (1 if self.holiday else 0)

    def ridge(self, prior: float) -> np.ndarray:
        hinge = np.full(self.changepoints, NOISE / prior**2)
        rest = np.full(self.width - 2 - self.changepoints, NOISE / SEASON_PRIOR**2)
        return np.concatenate([[1e-9, 1e-9], hinge, rest])

    def solutions(self, g: np.ndarray, n: int, priors: Sequence[float]) -> list[dict | None]:
        """Coefficients under each prior from one cross-product matrix."""
        x, y = range(self.width), self.width
        if not (self.sparse and self.changepoints):
            return [least_squares(g, n, x, y, self.ridge(prior)) for prior in priors]
        ridge, hinges = self.ridge(1.0), slice(2, 2 + self.changepoints)
        ridge[hinges] = 0.0
        weights = np.zeros((len(priors), self.width))
        weights[:, hinges] = NOISE / np.asarray(priors)[:, None]
        return sparse_path(g, n, x, y, ridge, weights) or [None] * len(priors)

    def vector(self, ts: Column, start: Column, end: Column) -> Column:
        t = fq.seconds_between(start, ts) / F.greatest(F.lit(1.0), fq.seconds_between(start, end).cast("double"))
        days = fq.seconds_between(F.lit("1970-01-01").cast("timestamp_ntz"), ts) / F.lit(86400.0)
        hinges = [
            F.greatest(F.lit(0.0), t - F.lit(self.history_share * j / (self.changepoints + 1)))
            for j in range(1, self.changepoints + 1)
        ]
        waves = []
        for period, pairs in ((365.25, self.yearly), (7.0, self.weekly), (1.0, self.daily)):
            for k in range(1, pairs + 1):
                angle = days * F.lit(2.0 * np.pi * k / period)
                waves += [F.sin(angle), F.cos(angle)]
        extra = [F.col(self.holiday).cast("double")] if self.holiday else []
        return F.array(F.lit(1.0), t, *hinges, *waves, *extra)

    def to_fit(self, y: Column) -> Column:
        return F.log1p(F.greatest(y, F.lit(0.0))) if self.multiplicative else y

    def from_fit(self, v: Column) -> Column:
        return F.expm1(v) if self.multiplicative else v


def _spans(df: DataFrame, keys, ts, y) -> DataFrame:
    return df.where(F.col(y).isNotNull()).groupBy(*keys).agg(F.min(ts).alias("_start"), F.max(ts).alias("_end"))


def _with_vectors(df: DataFrame, spans: DataFrame, design: Design, keys, ts) -> DataFrame:
    return df.join(spans, list(keys)).withColumn("_x", design.vector(F.col(ts), F.col("_start"), F.col("_end")))


def _dot(x: str, beta: str) -> Column:
    return F.aggregate(F.zip_with(x, beta, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def fit(
    df: DataFrame, design: Design, keys: Sequence[str], ts: str = "ts", y: str = "y", priors: DataFrame | None = None
) -> DataFrame:
    """One row per series: span, coefficients, residual variance. ``priors`` may
    hold a chosen ``prior`` per series; otherwise the default is used."""
    keys = list(keys)
    spans = _spans(df, keys, ts, y)
    rows = _with_vectors(df.where(F.col(y).isNotNull()), spans, design, keys, ts)
    z = rows.select(*keys, F.concat("_x", F.array(design.to_fit(F.col(y)))).alias("_z"))
    grams = gram_of_vectors(z, keys, "_z")
    if priors is None:
        grams = grams.withColumn("prior", F.lit(DEFAULT_PRIOR))
    else:
        grams = grams.join(priors.select(*keys, "prior"), keys, "left")
        grams = grams.withColumn("prior", F.coalesce("prior", F.lit(DEFAULT_PRIOR)))
    p = design.width

    # one solve per distinct prior value; each series matches exactly one
    def one(g: np.ndarray, n: int) -> list[list]:
        rows = []
        for prior, found in zip(PRIORS, design.solutions(g, n, PRIORS)):
            if found is not None:
                rows.append([[float(b) for b in found["beta"]], float(found["var"]), prior])
        return rows

    solved = solve(grams, keys, p + 1, one, "beta array<double>, var double, solved_prior double", extra=["prior"])
    chosen = solved.where(F.col("solved_prior") == F.col("prior")).drop("solved_prior")
    return chosen.join(spans, keys)


def predict(rows: DataFrame, model: DataFrame, design: Design, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Adds ``forecast`` and 95 % bounds, none below zero when multiplicative."""
    d = rows.join(model, list(keys)).withColumn("_x", design.vector(F.col(ts), F.col("_start"), F.col("_end")))
    mid, half = _dot("_x", "beta"), F.sqrt("var") * Z95
    out = d.withColumn("_mid", mid).withColumns({
        "forecast": design.from_fit(F.col("_mid")),
        "lower": design.from_fit(F.col("_mid") - half), "upper": design.from_fit(F.col("_mid") + half),
    })
    out = out.select(*rows.columns, "forecast", "lower", "upper")
    return clip_forecast(out) if design.multiplicative else out


def forecast(
    df: DataFrame, freq: str, horizon: int, keys: Sequence[str], ts: str = "ts", y: str = "y",
    design: Design | None = None, priors: DataFrame | None = None,
) -> DataFrame:
    design = design or Design.for_frequency(freq)
    model = fit(df, design, keys, ts, y, priors)
    return predict(future_spine(df, freq, horizon, keys, ts), model, design, keys, ts)


def fitted(df: DataFrame, model: DataFrame, design: Design, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """In-sample values, as ``yhat``."""
    return predict(df, model, design, keys, ts).withColumnRenamed("forecast", "yhat").drop("lower", "upper")


def prior_scores(
    df: DataFrame, freq: str, keys: Sequence[str], ts: str = "ts", y: str = "y", design: Design | None = None
) -> DataFrame:
    """Mean cross-validated MAPE of every prior, per series.

    Folds nest: each trains on everything up to its cut-off. Rows are therefore
    summed once per segment between cut-offs and the matrices accumulated, so no
    row is copied into every later fold.
    """
    keys = list(keys)
    design = design or Design.for_frequency(freq)
    p = design.width
    _, period, horizon = fq.frequency(freq).cv_days
    cuts = cv_windows(df, freq, keys, ts).withColumn(
        "_fold", F.row_number().over(by_series(keys, "cutoff")) - 1
    )
    per_series = cuts.groupBy(*keys).agg(F.min("cutoff").alias("_first"), F.count(F.lit(1)).alias("_folds"))
    spans = _spans(df, keys, ts, y)
    rows = _with_vectors(df.where(F.col(y).isNotNull()), spans, design, keys, ts).join(per_series, keys)
    # cut-offs are evenly spaced, so the number of them before a row is arithmetic
    passed = F.ceil(fq.seconds_between(F.col("_first"), F.col(ts)) / F.lit(period * 86400))
    rows = rows.withColumn("_segment", F.greatest(F.lit(0), F.least(F.col("_folds"), passed)).cast("int"))

    z = F.concat("_x", F.array(design.to_fit(F.col(y))))
    train = rows.where(F.col("_segment") < F.col("_folds")).select(*keys, "_segment", z.alias("_z"))
    cells = gram_of_vectors(train, [*keys, "_segment"], "_z")
    # a series' segment matrices are bounded by its number of folds; they are summed up
    # fold by fold where they are solved, and a fold with an empty segment adds nothing
    held = cells.groupBy(*keys).agg(F.collect_list(F.struct("_segment", "n", "gram")).alias("_cells"))
    held = per_series.select(*keys, "_folds").join(held, keys)

    def grid(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for rec in pdf.to_dict("records"):
                at = {c["_segment"]: c for c in rec["_cells"]}
                total, n = np.zeros((p + 1) * (p + 2) // 2), 0
                for fold in range(int(rec["_folds"])):
                    if fold in at:
                        total, n = total + np.asarray(at[fold]["gram"], float), n + int(at[fold]["n"])
                    g = unpack(total, p + 1)
                    for prior, found in zip(PRIORS, design.solutions(g, n, PRIORS)):
                        if found is not None:
                            out.append([*(rec[k] for k in keys), fold, [float(b) for b in found["beta"]], prior])
            yield pd.DataFrame(out, columns=[*keys, "_fold", "beta", "prior"])

    models = held.mapInPandas(grid, key_schema(df, keys) + "_fold int, beta array<double>, prior double")
    # a validation row belongs to the last few folds that ended before it
    back = -(-horizon // period)
    ended = F.sequence(F.greatest(F.lit(0), F.col("_segment") - back - 1), F.col("_segment") - 1)
    cutoff_of = lambda i: F.col("_first") + F.make_dt_interval(i * period)
    reaches = lambda i: F.col(ts) <= cutoff_of(i) + F.make_dt_interval(F.lit(horizon))
    valid = rows.where(F.col("_segment") > 0).select(
        *keys, F.col(y).alias("_y"), "_x", F.explode(F.filter(ended, reaches)).alias("_fold")
    )
    scored = valid.join(models, [*keys, "_fold"])
    error = F.abs((F.col("_y") - design.from_fit(_dot("_x", "beta"))) / F.nullif(F.col("_y"), F.lit(0.0)))
    by_fold = scored.groupBy(*keys, "prior", "_fold").agg((F.avg(error) * 100).alias("_mape"))
    return by_fold.groupBy(*keys, "prior").agg(F.avg("_mape").alias("cv_mape"), F.count("_mape").alias("n_folds"))


def choose_prior(scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    return scores.groupBy(*keys).agg(F.min_by("prior", F.struct("cv_mape", "prior")).alias("prior"), F.min("cv_mape").alias("cv_mape"))
