"""Leaf values of boosted trees under an absolute and a squared penalty, and pruning.

MLlib grows the trees; their leaves are valued again. A leaf of tree ``t`` sums the
residuals of its rows, which depend on the values of all trees before it, but only
through how many rows share a leaf of each. So one pass over the training rows counts
shared rows for a run of trees (a matrix of bounded size) and sums their targets, and
all values of the run follow from it, tree by tree. Rows are never written back.

For a leaf with residual sum ``g`` over ``h`` rows the value is the soft-thresholded
``g`` (by ``l1``) over ``h + l2``, and its score that threshold's square over
``h + l2``. Two sibling leaves whose scores exceed their parent's by less than
``gamma`` are merged, from the bottom up.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.models.boosted import FEATURES, PATIENCE, Trees, losses

#: trees whose shared rows are counted in one pass
TREES_AT_ONCE = 32
ROWS_AT_ONCE = 4096


def _values(g: np.ndarray, h: np.ndarray, l1: float, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """(value, score) of nodes with residual sums ``g`` over ``h`` rows."""
    pull = np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)
    weight = np.where(h + l2 > 0, h + l2, 1.0)
    return pull / weight, pull**2 / weight


def _settle(g: np.ndarray, h: np.ndarray, split: np.ndarray, l1: float, l2: float, gamma: float) -> np.ndarray:
    """Values of the lowest nodes of one tree after merging, from their residual sums.
    ``split`` says which nodes above them divide their rows at all."""
    value, score = _values(g, h, l1, l2)
    width = len(g)
    #: True where everything below the node is one leaf by now
    whole = np.ones(width, bool)
    at = 1  # lowest nodes below each node of this level
    while len(g) > 1:
        first, last = slice(0, None, 2), slice(1, None, 2)
        total, rows = g[first] + g[last], h[first] + h[last]
        own, own_score = _values(total, rows, l1, l2)
        level = split[len(total) - 1 : 2 * len(total) - 1]
        small = score[first] + score[last] - own_score < gamma
        merge = whole[first] & whole[last] & (small | ~level)
        at *= 2
        for node in np.flatnonzero(merge):
            value[node * at : (node + 1) * at] = own[node]
        score = np.where(merge, own_score, score[first] + score[last])
        g, h, whole = total, rows, merge
    return value


def _shared_rows(rows: DataFrame, trees: Trees, first: int, last: int, features: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows that each two leaves of trees ``first`` to ``last`` share, and per leaf the sum
    of what the trees before ``first`` leave of the target."""
    count, leaves = last - first, 2**trees.depth
    size = count * leaves

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shared, target = np.zeros((size, size)), np.zeros(size)
        for pdf in batches:
            x, y = pdf[list(features)].to_numpy(float), pdf["_scaled"].to_numpy(float)
            for i in range(0, len(y), ROWS_AT_ONCE):
                node = trees.nodes(x[i : i + ROWS_AT_ONCE], last)
                before = trees.value[np.arange(first), node[:, :first]] @ trees.weight[:first]
                slot = node[:, first:] - (leaves - 1) + leaves * np.arange(count)
                one = np.zeros((len(slot), size))
                one[np.arange(len(slot))[:, None], slot] = 1.0
                shared += one.T @ one
                target += one.T @ (y[i : i + ROWS_AT_ONCE] - before)
        a, b = np.nonzero(np.triu(shared))
        yield pd.DataFrame({"a": a, "b": b, "n": shared[a, b], "y": np.where(a == b, target[a], 0.0)})

    parts = rows.select(*features, "_scaled").mapInPandas(sums, "a int, b int, n double, y double")
    # at most (TREES_AT_ONCE * leaves)^2 cells, however many rows there are
    cells = parts.groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("y").alias("y")).toPandas()
    shared, target = np.zeros((size, size)), np.zeros(size)
    a, b = cells["a"].to_numpy(), cells["b"].to_numpy()
    shared[a, b] = cells["n"]
    shared[b, a] = cells["n"]
    target[a[a == b]] = cells["y"].to_numpy()[a == b]
    return shared, target


def penalised(
    table: DataFrame, model: GBTRegressionModel | Trees, features: Sequence[str] = FEATURES, l1: float = 0.0, l2: float = 1.0,
    gamma: float = 0.0, patience: int | None = PATIENCE,
) -> Trees:
    """The trees of ``model`` with leaves valued again on the rows of split ``train``.

    All training rows count for a leaf, also those that its tree was grown without. With
    ``patience`` the trees after the best round on the ``valid`` rows are cut off.
    No rows in a leaf give it the value 0; ``l1 = l2 = gamma = 0`` gives plain means.
    """
    if min(l1, l2, gamma) < 0:
        raise ValueError("penalties are not negative")
    trees = copy.deepcopy(model) if isinstance(model, Trees) else Trees(model)
    learn = table.where("split = 'train'")
    lowest = 2**trees.depth
    n = len(trees.weight)
    for first in range(0, n, TREES_AT_ONCE):
        last = min(n, first + TREES_AT_ONCE)
        shared, target = _shared_rows(learn, trees, first, last, features)
        for t in range(first, last):
            at = slice((t - first) * lowest, (t - first + 1) * lowest)
            earlier = slice(0, at.start)
            settled = (trees.value[first:t, lowest - 1 :] * trees.weight[first:t, None]).ravel()
            g = target[at] - shared[at, earlier] @ settled
            h = shared[at, at].diagonal()
            trees.value[t, lowest - 1 :] = _settle(g, h, np.isfinite(trees.limit[t]), l1, l2, gamma)
    if patience is not None:
        loss = losses(table.where("split = 'valid'"), trees, features)
        if loss:
            trees = trees.first(min(range(len(loss)), key=loss.__getitem__) + 1)
    return trees


def leaf_values(spark: SparkSession, trees: Trees) -> DataFrame:
    """(tree, leaf, value, weight): lowest nodes from left to right."""
    lowest = 2**trees.depth
    rows = [(t + 1, i, float(v), float(w)) for t, w in enumerate(trees.weight) for i, v in enumerate(trees.value[t, lowest - 1 :])]
    return spark.createDataFrame(rows, "tree int, leaf int, value double, weight double")
