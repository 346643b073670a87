"""Least squares for every series at once.

A regression needs only the cross-product matrix of its columns. That matrix is
an ordinary sum, so it is built by partial aggregation whatever the length of a
series; the solver then sees one small matrix per series and never a raw row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JVM_COLUMNS = 12  # up to here one codegen'd aggregation holds all the sums


def key_schema(df: DataFrame, keys: Sequence[str]) -> str:
    return "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)


def gram(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Row count ``n`` and ``gram``: the upper triangle of Z'Z, row by row, over
    the rows where every column is known."""
    d = df.na.drop(subset=list(columns)).select(*keys, *columns)
    if len(columns) > JVM_COLUMNS:
        return gram_of_vectors(d.select(*keys, F.array(*[F.col(c).cast("double") for c in columns]).alias("_z")), keys, "_z")
    sums = [F.sum(F.col(a).cast("double") * F.col(b).cast("double")) for a, b in combinations_with_replacement(columns, 2)]
    return d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("gram"))


def gram_of_vectors(df: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """The same for wide designs held as one array column: every Arrow batch is
    reduced to a matrix per series before anything is shuffled."""
    keys = list(keys)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            rows = []
            for key, part in pdf.groupby(keys, sort=False):
                z = np.stack(part[vector].to_numpy()).astype(float)
                upper = (z.T @ z)[np.triu_indices(z.shape[1])]
                rows.append([*key, len(z), upper])
            yield pd.DataFrame(rows, columns=[*keys, "n", "gram"])

    parts = df.select(*keys, vector).mapInPandas(partial, key_schema(df, keys) + "n long, gram array<double>")
    # whole triangles are added up, map-side first; they are never taken apart
    total = Summarizer.sum(array_to_vector("gram"))
    return parts.groupBy(*keys).agg(F.sum("n").alias("n"), vector_to_array(total).alias("gram"))


def unpack(upper: Sequence[float], p: int) -> np.ndarray:
    m = np.zeros((p, p))
    m[np.triu_indices(p)] = upper
    return m + np.triu(m, 1).T


def least_squares(g: np.ndarray, n: int, x: Sequence[int], y: int, ridge: np.ndarray | None = None) -> dict | None:
    """Coefficients, standard errors and squared error from a cross-product
    matrix, or None when the system cannot be solved. Columns that are 0
    throughout get a coefficient of 0."""
    every = list(x)
    if n <= len(every) or not np.isfinite(g).all():
        return None
    live = [i for i, c in enumerate(every) if g[c, c] > 0]
    if not live:
        return None
    x = [every[i] for i in live]
    ridge = None if ridge is None else np.asarray(ridge)[live]
    a, b, yy = g[np.ix_(x, x)], g[x, y], g[y, y]
    scale = np.sqrt(np.clip(np.diag(a), 1e-300, None))
    normal = a / np.outer(scale, scale)
    if ridge is not None:
        normal = normal + np.diag(ridge / scale**2)
    try:
        if ridge is None and np.linalg.cond(normal) > 1e13:
            return None
        inv = np.linalg.inv(normal)
    except np.linalg.LinAlgError:
        return None
    beta = (inv @ (b / scale)) / scale
    sse = max(float(yy - 2 * beta @ b + beta @ a @ beta), 0.0)
    var = sse / max(n - len(x), 1)
    se = np.sqrt(np.clip(np.diag(inv) * var, 0, None)) / scale
    spread = np.zeros((2, len(every)))
    spread[:, live] = beta, se
    beta, se = spread
    return {"beta": beta, "se": se, "sse": sse, "var": var, "aic": n * np.log(max(sse / n, 1e-300)) + 2 * len(x)}


def _sparse(a: np.ndarray, b: np.ndarray, weight: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Minimum of x'ax/2 - b'x + sum(weight |x|), searched from ``start``.

    Coordinates without a weight follow from the others and are eliminated. For the rest
    signs are searched: with signs given the minimum is the solution of linear equations;
    the way there is cut where it pays at a change of sign; the coordinate at zero that
    pulls hardest beyond its weight comes in when those inside are settled. Every step
    lowers the sum, so no set of signs comes twice and the result is exact.
    """
    free = weight <= 0
    out = np.zeros(len(b))
    if free.all():
        return np.linalg.solve(a, b)
    held = ~free
    if free.any():
        follow = np.linalg.solve(a[np.ix_(free, free)], np.column_stack([a[np.ix_(free, held)], b[free]]))
        inner = a[np.ix_(held, held)] - a[np.ix_(held, free)] @ follow[:, :-1]
        pull = b[held] - a[np.ix_(held, free)] @ follow[:, -1]
    else:
        inner, pull = a, b
    out[held] = _signs_searched(inner, pull, weight[held], start[held])
    if free.any():
        out[free] = follow[:, -1] - follow[:, :-1] @ out[held]
    return out


def _signs_searched(a: np.ndarray, b: np.ndarray, weight: np.ndarray, x: np.ndarray) -> np.ndarray:
    x = x.copy()
    cost = lambda v: v @ a @ v / 2 - b @ v + weight @ np.abs(v)
    close = 1e-11 * max(1.0, float(np.abs(b).max(initial=0.0)))
    signs = np.sign(x)
    for _ in range(50 * (len(b) + 2)):
        # settle those inside
        on = np.flatnonzero(signs)
        if len(on):
            goal = np.zeros(len(b))
            goal[on] = np.linalg.lstsq(a[np.ix_(on, on)], b[on] - weight[on] * signs[on], rcond=None)[0]
            stops = [1.0]
            for j in on:
                if x[j] != 0 and goal[j] * x[j] < 0:
                    stops.append(x[j] / (x[j] - goal[j]))
            ways = []
            for share in sorted(stops):
                way = x + share * (goal - x)
                way[np.abs(way) < 1e-14 * max(1.0, float(np.abs(goal).max()))] = 0.0
                ways.append(way)
            best = min(ways, key=cost)
            whole = best is ways[-1] and (np.sign(goal[on]) == signs[on]).all()
            x = best
            signs = np.sign(x)
            if not whole:
                continue
        slope = b - a @ x
        beyond = np.where(x == 0, np.abs(slope) - weight, -np.inf)
        j = int(np.argmax(beyond))
        if beyond[j] <= close:
            break
        signs[j] = np.sign(slope[j])
    return x


def sparse_path(
    g: np.ndarray, n: int, x: Sequence[int], y: int, ridge: np.ndarray, weights: Sequence[np.ndarray]
) -> list[dict] | None:
    """Least squares with squared and absolute penalties (half the squared error plus
    ridge/2 b² plus weight |b|) for every set of absolute ``weights``, from the same
    cross-products. The heaviest come first and each starts from the one before; the results
    are in the order given. None when the system cannot be solved."""
    every = list(x)
    if n <= len(every) or not np.isfinite(g).all():
        return None
    live = [i for i, c in enumerate(every) if g[c, c] > 0]
    if not live:
        return None
    at = [every[i] for i in live]
    a, b, yy = g[np.ix_(at, at)], g[at, y], g[y, y]
    scale = np.sqrt(np.diag(a))
    normal, pull = a / np.outer(scale, scale) + np.diag(np.asarray(ridge)[live] / scale**2), b / scale
    out: list[dict | None] = [None] * len(weights)
    beta = np.zeros(len(live))
    for k in sorted(range(len(weights)), key=lambda k: -float(np.sum(weights[k]))):
        beta = _sparse(normal, pull, np.asarray(weights[k])[live] / scale, beta)
        found = beta / scale
        sse = max(float(yy - 2 * found @ b + found @ a @ found), 0.0)
        whole = np.zeros(len(every))
        whole[live] = found
        out[k] = {"beta": whole, "sse": sse, "var": sse / max(n - int((found != 0).sum()), 1)}
    return out


def solve(
    grams: DataFrame, keys: Sequence[str], p: int, fn: Callable[[np.ndarray, int], list[list]], schema: str, extra: Sequence[str] = ()
) -> DataFrame:
    """Apply ``fn(matrix, n) -> rows`` to each series' matrix."""
    keys = [*keys, *extra]
    names = [part.strip().split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, n, upper in zip(pdf[keys].itertuples(index=False), pdf["n"], pdf["gram"]):
                if upper is None or any(v is None for v in upper):
                    continue
                for row in fn(unpack(upper, p), int(n)):
                    rows.append([*key, *row])
            yield pd.DataFrame(rows, columns=[*keys, *names])

    return grams.select(*keys, "n", "gram").mapInPandas(run, key_schema(grams, keys) + schema)
