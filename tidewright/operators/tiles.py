"""Cross-products of many columns, tile by tile.

One aggregate with an expression for every pair of columns cannot be planned for hundreds
of columns. Here the columns of a row are one array; each Arrow batch becomes, per series,
the products of its column blocks, and the products are added up by (series, tile, tile).
What is shuffled is tiles, not rows, and no task holds more of a series' matrix than it has
summed up so far (``HELD_BYTES``, then it passes on what it has).

Sums are taken of values less the series' column means (found in a pass of their own), so
that they do not cancel. Where values are missing, every pair of columns is taken over the
rows that have both, as the pairwise aggregates take it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.operators.layout import spread_join

TILE = 128  # columns of a block
HELD_BYTES = 64_000_000


def _matrix(column: pa.ChunkedArray | pa.Array, p: int) -> np.ndarray:
    """Rows of p doubles; a missing one is NaN."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(-1, p)


def _by_key(batch: pa.RecordBatch, keys: Sequence[str]) -> Iterator[tuple[tuple, np.ndarray]]:
    """Each key of the batch with the numbers of its rows."""
    if not keys:
        yield (), np.arange(batch.num_rows)
        return
    found: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(*[batch.column(k).to_pylist() for k in keys])):
        found.setdefault(key, []).append(i)
    for key, rows in found.items():
        yield key, np.array(rows)


class _Held:
    """Sums of arrays by key, given out when they weigh too much and at the end."""

    def __init__(self, schema: T.StructType, keys: int):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.schema, self.keys = to_arrow_schema(schema), keys
        self.sums: dict[tuple, np.ndarray] = {}
        self.bytes = 0

    def add(self, key: tuple, values: np.ndarray) -> None:
        if key in self.sums:
            self.sums[key] += values
        else:
            self.sums[key] = values
            self.bytes += values.nbytes

    def drain(self) -> Iterator[pa.RecordBatch]:
        for key, values in self.sums.items():
            columns = [pa.array([v], self.schema.field(i).type) for i, v in enumerate([*key, values])]
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)
        self.sums, self.bytes = {}, 0


def _summed(d: DataFrame, keys: Sequence[str], marks: Sequence[str], each: Callable) -> DataFrame:
    """Sum of the arrays that ``each(batch, key, rows)`` gives per key and mark."""
    fields = [d.schema[k] for k in keys]
    schema = T.StructType([*fields, *[T.StructField(m, T.IntegerType()) for m in marks], T.StructField("_v", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(schema, len(keys))
        for batch in batches:
            for key, rows in _by_key(batch, keys):
                for mark, values in each(batch, rows):
                    held.add((*key, *mark), values)
            if held.bytes > HELD_BYTES:
                yield from held.drain()
        yield from held.drain()

    total = vector_to_array(Summarizer.sum(array_to_vector("_v")))
    # a constant key, so that no rows give no sum
    by = [*keys, *marks] or [F.lit(1).alias("_one")]
    return d.mapInArrow(run, schema).groupBy(*by).agg(total.alias("_v")).drop("_one")


def tile_sums(df: DataFrame, columns: Sequence[str], keys: Sequence[str], tile: int = TILE) -> DataFrame:
    """keys, tile_a <= tile_b, ``_v``: the number of rows, then six tables of tile_a's
    columns by tile_b's, over rows that have both: their number, the sums of x, y, x², y²
    and xy."""
    keys, p = list(keys), len(columns)
    d = df.select(*keys, F.array(*[F.col(c).cast("double") for c in columns]).alias("_x"))

    def for_means(batch: pa.RecordBatch, rows: np.ndarray):
        x = _matrix(batch.column("_x"), p)[rows]
        known = ~np.isnan(x)
        yield (), np.concatenate([known.sum(0), np.where(known, x, 0.0).sum(0)])

    halves = _summed(d, keys, [], for_means)
    count, total = F.slice("_v", 1, p), F.slice("_v", p + 1, p)
    means = halves.select(*keys, F.zip_with(total, count, lambda s, n: F.when(n > 0, s / n).otherwise(0.0)).alias("_m"))
    fixed = np.zeros(p)
    if keys:
        d = spread_join(d, means, keys)
    else:  # a number per column
        fixed = np.array((means.first() or {"_m": None})["_m"] or fixed, float)
    starts = range(0, p, tile)

    def products(batch: pa.RecordBatch, rows: np.ndarray):
        x = _matrix(batch.column("_x"), p)[rows]
        x = x - (_matrix(batch.column("_m").slice(rows[0], 1), p)[0] if keys else fixed)
        known = ~np.isnan(x)
        x, m = np.where(known, x, 0.0), known.astype(float)
        square = x * x
        for a, i in enumerate(starts):
            for b, j in enumerate(starts):
                if a <= b:
                    left, right = slice(i, i + tile), slice(j, j + tile)
                    parts = (m[:, left].T @ m[:, right], x[:, left].T @ m[:, right], m[:, left].T @ x[:, right],
                             square[:, left].T @ m[:, right], m[:, left].T @ square[:, right], x[:, left].T @ x[:, right])
                    yield (a, b), np.concatenate([[len(rows)], *[q.ravel() for q in parts]])

    return _summed(d, keys, ["tile_a", "tile_b"], products)


def _correlations(values: np.ndarray, wide: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(correlations, deviations of the first columns' values) of a tile; NaN where a
    column does not vary."""
    n, x, y, xx, yy, xy = values[1:].reshape(6, wide, high)
    with np.errstate(invalid="ignore", divide="ignore"):
        vx, vy = xx - x * x / n, yy - y * y / n
        # what is left of equal values is rounding
        vx, vy = (np.where(v > 1e-14 * np.abs(s), v, 0.0) for v, s in ((vx, xx), (vy, yy)))
        r = (xy - x * y / n) / np.sqrt(vx * vy)
        return np.where((vx > 0) & (vy > 0), r, np.nan), np.sqrt(vx / (n - 1))


def _sizes(p: int, tile: int) -> list[int]:
    return [min(tile, p - i) for i in range(0, p, tile)]


def pair_rows(df: DataFrame, columns: Sequence[str], keys: Sequence[str], tile: int = TILE) -> DataFrame:
    """keys, a, b, corr of every two columns."""
    keys, columns = list(keys), list(columns)
    sizes = _sizes(len(columns), tile)
    sums = tile_sums(df, columns, keys, tile)
    schema = T.StructType([*[sums.schema[k] for k in keys], *[T.StructField(c, T.StringType()) for c in "ab"], T.StructField("corr", T.DoubleType())])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                at = {c: batch.column(c)[r] for c in batch.schema.names}
                a, b = at["tile_a"].as_py(), at["tile_b"].as_py()
                corr, _ = _correlations(at["_v"].values.to_numpy(), sizes[a], sizes[b])
                i, j = np.triu_indices(sizes[a], 1) if a == b else (g.ravel() for g in np.indices(corr.shape))
                found = corr[i, j]
                names = [pa.array([columns[k] for k in side], pa.string()) for side in (a * tile + i, b * tile + j)]
                key = [pa.array([at[k].as_py()] * len(found), batch.schema.field(k).type) for k in keys]
                yield pa.RecordBatch.from_arrays([*key, *names, pa.array(found, pa.float64(), mask=np.isnan(found))], names=[*keys, "a", "b", "corr"])

    return sums.mapInArrow(pairs, schema)


def matrix_rows(df: DataFrame, columns: Sequence[str], keys: Sequence[str], tile: int = TILE) -> DataFrame:
    """One row per series: number of rows ``_n``, deviations ``_sd``, and the upper triangle
    of the correlations ``_r``. Its size is that of the matrix, whatever the rows."""
    keys, p = list(keys), len(columns)
    sizes = _sizes(p, tile)
    sums = tile_sums(df, columns, keys, tile)
    schema = T.StructType([*[sums.schema[k] for k in keys], T.StructField("_n", T.LongType()), *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("_sd", "_r")]])

    def whole(table: pa.Table) -> pa.Table:
        r, sd, n = np.full((p, p), np.nan), np.full(p, np.nan), 0
        for a, b, v in zip(table.column("tile_a").to_pylist(), table.column("tile_b").to_pylist(), table.column("_v")):
            values = v.values.to_numpy()
            corr, spread = _correlations(values, sizes[a], sizes[b])
            left, right = slice(a * tile, a * tile + sizes[a]), slice(b * tile, b * tile + sizes[b])
            r[left, right], n = corr, int(round(values[0]))
            if a == b:
                sd[left] = np.diag(spread)
        upper = r[np.triu_indices(p, 1)]
        nulls = lambda x: pa.array([pa.array(x, mask=np.isnan(x)).to_pylist()], pa.list_(pa.float64()))
        return pa.table({**{k: table.column(k).slice(0, 1) for k in keys}, "_n": pa.array([n]), "_sd": nulls(sd), "_r": nulls(upper)})

    return sums.groupBy(*keys).applyInArrow(whole, schema)
