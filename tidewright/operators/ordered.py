"""Order statistics of a sliding window, and the change-point score built on them.

A window is held twice: in the order its values came, and sorted. A new value is put at
its rank and the oldest taken out at its own, both found by bisection, so a row costs the
logarithm of the window (and a move within one small array), not the window.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.operators.layout import dealt_blocks

# Fixed value: the factor that makes a median absolute deviation comparable to a deviation.
MAD_TO_STD = 1.4826


class SortedWindow:
    """The last ``size`` values; missing ones take a place but no rank."""

    def __init__(self, size: int, values: Sequence[float | None] = ()):
        self.size = size
        self.order: deque[float | None] = deque(values)
        self.ranked = sorted(v for v in values if v is not None)

    def push(self, value: float | None) -> None:
        if len(self.order) == self.size:
            oldest = self.order.popleft()
            if oldest is not None:
                del self.ranked[bisect_left(self.ranked, oldest)]
        self.order.append(value)
        if value is not None:
            insort(self.ranked, value)

    def median(self, at_least: int) -> float | None:
        n = len(self.ranked)
        if n < max(at_least, 1):
            return None
        middle = n // 2
        return self.ranked[middle] if n % 2 else 0.5 * self.ranked[middle - 1] + 0.5 * self.ranked[middle]


class RobustScore:
    """Distance of each value from the rolling median, in rolling median deviations."""

    def __init__(self, window: int, values: Sequence[float | None] = (), deviations: Sequence[float | None] = ()):
        self.at_least = max(5, window // 2)
        self.values, self.deviations = SortedWindow(window, values), SortedWindow(window, deviations)

    def push(self, value: float | None) -> float | None:
        if value is not None and value != value:
            value = None
        self.values.push(value)
        middle = self.values.median(self.at_least)
        known = value is not None and middle is not None
        self.deviations.push(abs(value - middle) if known else None)
        spread = self.deviations.median(self.at_least)
        return (value - middle) / (spread * MAD_TO_STD) if known and spread else None


def scan_rows(
    df: DataFrame, keys: Sequence[str], ts: str, y: str, make: Callable[[], Callable[[float | None], float | None]], out: str,
    before: int, block_rows: int | None = None,
) -> DataFrame:
    """Adds ``out``: what a fresh ``make()`` per series answers to each value in time order.

    Rows stream through sorted partitions, so no series is held. With ``block_rows`` a
    series is split into blocks that start ``before`` rows early.
    """
    keys = list(keys)
    if block_rows is None:
        part, order, d = keys, ts, df
    else:
        part, order, d = [*keys, "_block"], "_pos", dealt_blocks(df, keys, ts, before, 0, block_rows)
    d = (d.repartition(*part) if part else d.repartition(1)).sortWithinPartitions(*part, order)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, answer = None, None
        for batch in batches:
            series = zip(*[batch.column(k).to_pylist() for k in part]) if part else [()] * batch.num_rows
            found = []
            for key, value in zip(series, batch.column(y).cast(pa.float64()).to_pylist()):
                if key != last or answer is None:
                    last, answer = key, make()
                found.append(answer(value))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, out])

    done = d.mapInArrow(scan, T.StructType([*d.schema.fields, T.StructField(out, T.DoubleType())]))
    return done if block_rows is None else done.where(F.col("_block") == F.col("_home")).drop("_pos", "_home", "_block")
