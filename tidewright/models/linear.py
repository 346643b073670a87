"""Linear scorers over lags, rolling mean and calendar, and their recursion over long horizons.

A linear scorer that feeds on its own forecasts is an affine map of the last ``MEMORY``
values. Its powers are the same for all series, so a block of steps is one product of
the states of many series with a matrix, and a horizon of thousands of steps is a few
dozen products inside one task, in one job.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.expressions import calendar_columns
from tidewright.models.boosted import CALENDAR, MEMORY, _assembled, _history
from tidewright.models.gram import key_schema
from tidewright.models.naive import future_spine
from tidewright.operators.layout import by_series

LAGS = {"lag_1": 1, "lag_7": 7, "lag_14": 14}
WEEK = 7
#: what a linear scorer may read of its own past; a deviation is not linear
PAST = [*LAGS, "roll7_mean"]
FEATURES = [*CALENDAR, *PAST]
STEPS_AT_ONCE = 64


@dataclass
class Linear:
    """``intercept`` plus ``weights`` times features, on values divided by the level."""

    weights: Mapping[str, float] = field(default_factory=dict)
    intercept: float = 0.0

    def __post_init__(self):
        unknown = set(self.weights) - set(FEATURES)
        if unknown:
            raise ValueError(f"no linear features: {sorted(unknown)}")

    def step_weights(self) -> np.ndarray:
        """Weight of each of the last ``MEMORY`` values, oldest first."""
        w = np.zeros(MEMORY)
        for name, lag in LAGS.items():
            w[-lag] += self.weights.get(name, 0.0)
        w[-WEEK:] += self.weights.get("roll7_mean", 0.0) / WEEK
        return w

    def blocks(self, steps: int) -> tuple[np.ndarray, np.ndarray]:
        """(from state, from offsets): matrices that give ``steps`` forecasts at once."""
        w = self.step_weights()
        state = np.concatenate([np.eye(MEMORY), np.zeros((steps, MEMORY))])
        offset = np.zeros((MEMORY + steps, steps))
        for i in range(steps):
            state[MEMORY + i] = w @ state[i : MEMORY + i]
            offset[MEMORY + i] = w @ offset[i : MEMORY + i]
            offset[MEMORY + i, i] += 1.0
        return state[MEMORY:], offset[MEMORY:]


def train(table: DataFrame, features: Sequence[str] = FEATURES, ridge: float = 1e-6) -> Linear:
    """Least squares on the training rows of ``boosted.training_table``, all series pooled:
    one pass that sums cross-products."""
    fit = LinearRegression(featuresCol="features", labelCol="_scaled", solver="normal", regParam=ridge)
    model = fit.fit(_assembled(table.where("split = 'train'"), features).select("features", "_scaled"))
    return Linear(dict(zip(features, map(float, model.coefficients))), float(model.intercept))


def _paths(model: Linear, hist: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Forecasts of series with equally long histories (rows) for each column of offsets."""
    horizon = offsets.shape[1]
    out = np.empty(offsets.shape)
    past = np.array([model.weights.get(f, 0.0) for f in PAST])
    at = 0
    # shorter than a week the mean runs over fewer values, so these steps go one by one
    while hist.shape[1] < WEEK and at < horizon:
        out[:, at] = _history(hist)[:, : len(PAST)] @ past + offsets[:, at]
        hist = np.concatenate([hist, out[:, at : at + 1]], axis=1)
        at += 1
    if at == horizon:
        return out
    # a lag before the first value reads the first value
    short = max(0, MEMORY - hist.shape[1])
    hist = np.concatenate([np.repeat(hist[:, :1], short, axis=1), hist], axis=1)[:, -MEMORY:]
    from_state, from_offsets = model.blocks(min(STEPS_AT_ONCE, horizon - at))
    while at < horizon:
        n = min(len(from_state), horizon - at)
        out[:, at : at + n] = hist @ from_state[:n].T + offsets[:, at : at + n] @ from_offsets[:n, :n].T
        hist = np.concatenate([hist, out[:, at : at + n]], axis=1)[:, -MEMORY:]
        at += n
    return out


def forecast(
    df: DataFrame, model: Linear, freq: str, horizon: int, keys: Sequence[str], ts: str = "ts", y: str = "y", level: str | None = None,
    weekend_days: Sequence[int] = (5, 6),
) -> DataFrame:
    """keys, ``step``, ``ts``, ``forecast``: each step feeds the next.

    A series is one row with its last values and the offsets of its future rows, so what
    a task holds is bounded by the horizon. ``level`` names the column values are divided
    by. A series without a known value has no forecast.
    """
    keys = list(keys)
    scaled = F.col(y).cast("double") / (F.col(level) if level else F.lit(1.0))
    known = df.withColumn("_v", scaled).where(F.col("_v").isNotNull())
    recent = known.withColumn("_back", F.row_number().over(by_series(keys, F.col(ts).desc()))).where(F.col("_back") <= MEMORY)
    in_order = F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("o"), F.col("_v").alias("v"))))
    state = recent.groupBy(*keys).agg(
        F.transform(in_order, lambda s: s["v"]).alias("_hist"), (F.max_by(level, ts) if level else F.lit(1.0)).cast("double").alias("_level"))
    future = future_spine(known, freq, horizon, keys, ts)
    calendar = calendar_columns(F.col(ts), weekend_days)
    offset = F.lit(float(model.intercept))
    for name in CALENDAR:
        if model.weights.get(name):
            offset = offset + calendar[name] * F.lit(float(model.weights[name]))
    steps = F.array_sort(F.collect_list(F.struct("step", offset.cast("double").alias("v"))))
    ahead = future.groupBy(*keys).agg(F.transform(steps, lambda s: s["v"]).alias("_ahead"))

    def roll(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, same in pdf.groupby(pdf["_hist"].map(len)):
                for i in range(0, len(same), 256):
                    some = same.iloc[i : i + 256]
                    path = _paths(model, np.stack(some["_hist"].to_numpy()).astype(float), np.stack(some["_ahead"].to_numpy()).astype(float))
                    out = some[keys].loc[some.index.repeat(horizon)].reset_index(drop=True)
                    out["step"] = np.tile(np.arange(1, horizon + 1), len(some))
                    out["forecast"] = (path * some["_level"].to_numpy()[:, None]).ravel()
                    yield out

    paths = state.join(ahead, keys).mapInPandas(roll, key_schema(df, keys) + "step int, forecast double")
    return future.join(paths, [*keys, "step"]).select(*keys, "step", ts, "forecast")
