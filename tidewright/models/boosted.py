"""Gradient-boosted trees pooled over all series, and recursive forecasting."""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions import frequency as fq
from tidewright.functions.expressions import calendar_columns
from tidewright.models.gram import key_schema
from tidewright.models.naive import future_spine
from tidewright.operators.features import calendar_features, complete_rows, lag_roll_features
from tidewright.operators.layout import by_series
from tidewright.session import cut_lineage

CALENDAR = ["dow", "is_weekend", "month", "dayofyear", "sin_annual", "cos_annual"]
HISTORY = ["lag_1", "lag_7", "lag_14", "roll7_mean", "roll7_std"]
FEATURES = [*CALENDAR, *HISTORY]
MEMORY = 14  # rows of history the features look back on

# Tree depth, learning rate, sampling, leaf size, rounds, seed.
SETTINGS = {
    "maxDepth": 3, "stepSize": 0.05, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8",
    "minInstancesPerNode": 3, "maxIter": 500, "seed": 42,
}
PATIENCE = 20


def training_table(df: DataFrame, keys: Sequence[str], ts: str = "ts", y: str = "y", weekend_days: Sequence[int] = (5, 6)) -> DataFrame:
    """Rows with every feature known. ``df`` carries ``split``; values are divided
    by each series' training level so that one model serves all series."""
    level = df.where("split = 'train'").groupBy(*keys).agg(F.nullif(F.avg(F.abs(F.col(y))), F.lit(0.0)).alias("level"))
    d = df.join(level, list(keys)).withColumn("_scaled", F.col(y) / F.col("level"))
    d = lag_roll_features(calendar_features(d, ts, weekend_days), keys, ts, "_scaled")
    return complete_rows(d, [*FEATURES, "_scaled"])


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


class Trees:
    """A fitted ensemble as arrays, read from the model's own listing once: each tree is a
    full binary tree of the model's depth, short branches repeated down to it."""

    def __init__(self, model: GBTRegressionModel):
        depth = SETTINGS["maxDepth"]
        found: list[list] = []
        for line in model.toDebugString.splitlines():
            text = line.strip()
            if text.startswith("Tree "):
                found.append([])
            elif text.startswith(("If ", "Predict")):
                found[-1].append(text)
        depth = max([depth, *(max(_depths(t)) for t in found)])
        n, size = len(found), 2 ** (depth + 1) - 1
        self.depth = depth
        self.weight = np.array(model.treeWeights, float)
        self.feature = np.zeros((n, size), np.int64)
        self.limit = np.full((n, size), np.inf)
        self.value = np.zeros((n, size))
        for t, lines in enumerate(found):
            self._place(t, iter(lines), 0)

    def _place(self, t: int, lines: Iterator[str], node: int) -> None:
        text = next(lines)
        if text.startswith("Predict"):
            self._leaf(t, node, float(text.split(":")[1]))
            return
        # "If (feature 3 <= 0.5)"
        _, feature, _, limit = text[text.index("(") + 1 : text.rindex(")")].split(" ")
        self.feature[t, node], self.limit[t, node] = int(feature), float(limit)
        self._place(t, lines, 2 * node + 1)
        self._place(t, lines, 2 * node + 2)

    def _leaf(self, t: int, node: int, value: float) -> None:
        self.value[t, node] = value
        if 2 * node + 2 < self.value.shape[1]:
            self._leaf(t, 2 * node + 1, value)
            self._leaf(t, 2 * node + 2, value)

    def nodes(self, x: np.ndarray, trees: int | None = None) -> np.ndarray:
        """Lowest node that every row of ``x`` reaches in each of the first trees."""
        tree = np.arange(len(self.weight) if trees is None else trees)
        node = np.zeros((len(x), len(tree)), np.int64)
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            right = x[row, self.feature[tree, node]] > self.limit[tree, node]
            node = 2 * node + 1 + right
        return node

    def each(self, x: np.ndarray) -> np.ndarray:
        """Weighted value of every tree for every row of ``x``."""
        return self.value[np.arange(len(self.weight)), self.nodes(x)] * self.weight

    def first(self, n: int) -> Trees:
        """The ensemble of the first ``n`` trees."""
        out = copy.copy(self)
        for name in ("weight", "feature", "limit", "value"):
            setattr(out, name, getattr(self, name)[:n])
        return out


def _depths(lines: list[str]) -> list[int]:
    """Depth of each leaf, from the order of branches and leaves."""
    out, todo = [], [0]
    for text in lines:
        d = todo.pop()
        if text.startswith("Predict"):
            out.append(d)
        else:
            todo += [d + 1, d + 1]
    return out


def as_trees(model: GBTRegressionModel | Trees) -> Trees:
    return model if isinstance(model, Trees) else Trees(model)


def losses(rows: DataFrame, model: GBTRegressionModel | Trees, features: Sequence[str] = FEATURES) -> list[float]:
    """Mean squared error after each round, all rounds in one pass over the rows."""
    trees = as_trees(model)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(len(trees.weight)), 0
        for pdf in batches:
            for i in range(0, len(pdf), 1024):
                some = pdf.iloc[i : i + 1024]
                error = some["_scaled"].to_numpy()[:, None] - np.cumsum(trees.each(some[list(features)].to_numpy(float)), axis=1)
                total, n = total + (error**2).sum(0), n + len(some)
        yield pd.DataFrame({"round": np.arange(len(total)), "total": total, "n": n})

    parts = rows.select(*features, "_scaled").mapInPandas(sums, "round int, total double, n long")
    out = parts.groupBy("round").agg((F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).alias("mse")).orderBy("round").collect()
    return [r["mse"] if r["mse"] is not None else 0.0 for r in out]


def _fit(table: DataFrame, features: Sequence[str], rounds: int, settings: dict) -> GBTRegressionModel:
    gbt = GBTRegressor(
        featuresCol="features", labelCol="_scaled", predictionCol="_pred", **{**SETTINGS, **settings, "maxIter": rounds}
    )
    return gbt.fit(_assembled(table, features).select("features", "_scaled"))


def train(
    table: DataFrame, features: Sequence[str] = FEATURES, patience: int | None = PATIENCE, **settings
) -> GBTRegressionModel:
    """Boosting on the training rows, stopped where the validation loss has not
    improved for ``patience`` rounds.

    Rounds are fitted in doubling steps (the same seed gives the same leading
    trees), so a run that stops early never pays for all rounds; the losses of
    all rounds of a fit come from one pass over the validation rows. Leaf penalties
    and pruning follow in ``leaves.penalised``.
    """
    limit = settings.pop("maxIter", SETTINGS["maxIter"])
    d = table.cache()
    try:
        learn, check = d.where("split = 'train'"), d.where("split = 'valid'")
        if patience is None:
            return _fit(learn, features, limit, settings)
        rounds = min(limit, 2 * patience)
        while True:
            model = _fit(learn, features, rounds, settings)
            loss = losses(check, model, features)
            best = min(range(len(loss)), key=loss.__getitem__) + 1
            if rounds >= limit or best + patience <= rounds:
                return model if best == rounds else _fit(learn, features, best, settings)
            rounds = min(limit, rounds * 2)
    finally:
        d.unpersist()


def predict(table: DataFrame, model: GBTRegressionModel | Trees, features: Sequence[str] = FEATURES) -> DataFrame:
    if isinstance(model, Trees):
        @F.pandas_udf("double")
        def value(x: pd.DataFrame) -> pd.Series:
            x = x.to_numpy(float)
            return pd.Series(np.concatenate([model.each(x[i : i + 4096]).sum(1) for i in range(0, len(x), 4096)]))

        cols = F.struct(*[F.col(c).cast("double").alias(c) for c in features])
        return table.withColumn("yhat", value(cols) * F.col("level"))
    d = model.transform(_assembled(table, features))
    return d.withColumn("yhat", F.col("_pred") * F.col("level")).drop("features", "_pred")


def learning_curve(table: DataFrame, model: GBTRegressionModel | Trees, features: Sequence[str] = FEATURES) -> DataFrame:
    """Loss after each round on the training and validation rows: one number per
    round, computed by MLlib in one pass over each split."""
    curves = {x: losses(table.where(F.col("split") == x), model, features) for x in ("train", "valid")}
    spark: SparkSession = table.sparkSession
    rows = [(i + 1, float(a) ** 0.5, float(b) ** 0.5) for i, (a, b) in enumerate(zip(curves["train"], curves["valid"]))]
    return spark.createDataFrame(rows, "iteration int, train_rmse double, valid_rmse double")


def importance(spark: SparkSession, model: GBTRegressionModel, features: Sequence[str] = FEATURES) -> DataFrame:
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double")


# ------------------------------------------------------------------ recursion

def recursive_forecast(
    df: DataFrame,
    freq: str,
    horizon: int,
    keys: Sequence[str],
    score: Callable[[DataFrame], DataFrame],
    ts: str = "ts",
    y: str = "y",
    checkpoint_every: int = 6,
    step_features: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Forecast step by step, each step feeding the next.

    The loop runs over steps, not series: every step scores all series in one
    transform. A series is one row holding its last values, so state is bounded;
    lineage is cut every few steps by a reliable checkpoint.

    ``score`` adds ``_pred`` to a frame holding the features; ``step_features``
    may add more columns for the step's date.
    """
    keys = list(keys)
    back = F.row_number().over(by_series(keys, F.col(ts).desc()))
    recent = df.where(F.col(y).isNotNull()).withColumn("_back", back).where(F.col("_back") <= MEMORY)
    state = recent.groupBy(*keys).agg(
        F.max(ts).alias("_end"),
        F.transform(F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("o"), F.col(y).alias("v")))), lambda s: s["v"]).alias("_hist"),
        F.first("level").alias("level"),
    ).withColumn("_path", F.array().cast("array<double>"))
    for step in range(1, horizon + 1):
        d = state.withColumn(ts, fq.add_steps(F.col("_end"), step, freq))
        d = d.withColumns(calendar_columns(F.col(ts))).withColumns(_history_features())
        if step_features is not None:
            d = step_features(d)
        d = score(d).withColumn("_value", F.col("_pred").cast("double"))
        state = d.select(
            *keys, "_end", "level",
            _shift("_hist", "_value").alias("_hist"),
            F.concat("_path", F.array("_value")).alias("_path"),
        )
        if step % checkpoint_every == 0 and step < horizon:
            state = cut_lineage(state)
    # the outer form adds no "array is not empty" filter, which the optimizer
    # would push down through every step
    out = state.select(*keys, "_end", "level", F.posexplode_outer("_path").alias("_i", "_v"))
    n = (F.col("_i") + 1).cast("int")
    return out.select(*keys, n.alias("step"), fq.add_steps(F.col("_end"), n, freq).alias(ts), (F.col("_v") * F.col("level")).alias("forecast"))


def _shift(hist: str, value: str):
    grown = F.concat(F.col(hist), F.array(F.col(value)))
    return F.slice(grown, F.greatest(F.lit(1), F.size(grown) - MEMORY + 1), F.lit(MEMORY))


def _history_features() -> dict:
    """Lags and a rolling week from the state array; short histories fall back to
    the oldest value, the overall mean and a zero deviation."""
    h, n = F.col("_hist"), F.size("_hist")
    nth = lambda k: F.when(n >= k, F.element_at(h, -k)).otherwise(F.element_at(h, 1))
    week = F.slice(h, F.greatest(F.lit(1), n - 6), F.lit(7))
    mean = F.aggregate(week, F.lit(0.0), lambda s, v: s + v) / F.size(week)
    spread = F.aggregate(week, F.lit(0.0), lambda s, v: s + (v - mean) * (v - mean))
    return {
        "lag_1": F.element_at(h, -1), "lag_7": nth(7), "lag_14": nth(14), "roll7_mean": mean,
        "roll7_std": F.when(n >= 7, F.sqrt(spread / 6.0)).otherwise(F.lit(0.0)),
    }


def forecast(
    df: DataFrame, table: DataFrame, model: GBTRegressionModel | Trees, freq: str, horizon: int, keys: Sequence[str],
    ts: str = "ts", y: str = "y",
) -> DataFrame:
    """Recursive boosted forecast on the original scale.

    All steps of a series run inside one task on its last values; the calendar of
    its future rows comes along as one array, so no step costs a job.
    """
    keys = list(keys)
    level = table.select(*keys, "level").distinct()
    scaled = df.join(level, keys).withColumn("_scaled", F.col(y) / F.col("level"))
    back = F.row_number().over(by_series(keys, F.col(ts).desc()))
    recent = scaled.where(F.col("_scaled").isNotNull()).withColumn("_back", back).where(F.col("_back") <= MEMORY)
    in_order = F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("o"), F.col("_scaled").alias("v"))))
    state = recent.groupBy(*keys).agg(F.transform(in_order, lambda s: s["v"]).alias("_hist"), F.first("level").alias("level"))
    future = future_spine(df.where(F.col(y).isNotNull()), freq, horizon, keys, ts)
    dates = future.withColumns(calendar_columns(F.col(ts))).groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("step", F.array(*[F.col(c).cast("double") for c in CALENDAR]).alias("v")))), lambda s: s["v"]).alias("_dates"))
    trees = as_trees(model)

    def roll(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, some in pdf.groupby(pdf["_hist"].map(len)):
                hist = np.stack(some["_hist"].to_numpy()).astype(float)
                dates = np.array([np.stack(x) for x in some["_dates"]])
                path = []
                for step in range(horizon):
                    x = np.concatenate([dates[:, step], _history(hist)], axis=1)
                    path.append(trees.each(x).sum(1))
                    hist = np.concatenate([hist, path[-1][:, None]], axis=1)[:, -MEMORY:]
                out = some[keys].loc[some.index.repeat(horizon)].reset_index(drop=True)
                out["step"] = np.tile(np.arange(1, horizon + 1), len(some))
                out["forecast"] = (np.stack(path, axis=1) * some["level"].to_numpy()[:, None]).ravel()
                yield out

    paths = state.join(dates, keys).mapInPandas(roll, key_schema(df, keys) + "step int, forecast double")
    return future.join(paths, [*keys, "step"])


def _history(h: np.ndarray) -> np.ndarray:
    """The columns of HISTORY, as ``_history_features`` has them."""
    n = h.shape[1]
    nth = lambda k: h[:, -k] if n >= k else h[:, 0]
    week = h[:, -7:]
    spread = week.std(1, ddof=1) if n >= 7 else np.zeros(len(h))
    return np.stack([h[:, -1], nth(7), nth(14), week.mean(1), spread], axis=1)
