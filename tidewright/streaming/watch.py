"""Drift and change points of a stream, row by row, as the batch operators have them.

Each series keeps its last rows in the state store: a ring of values and one of deviations
for the robust score, a ring of two spans for the drift. New rows wait in sorted runs of
small pages until the watermark has passed them, when a timer takes them out in time order,
merging the runs page by page, so no series is held at once. What a row gets
therefore depends on the rows before it alone, not on how the stream was cut into batches,
in which order rows of a batch came, or how often the query was restarted.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewright.operators.monitor import PSI_GUARD, PSI_MIN_ROWS
from tidewright.operators.ordered import RobustScore
from tidewright.streaming.runs import SortedRuns, ranks, values

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
OUT_ROWS = 1 << 13  # of a frame of results


def quantile(ranked: Sequence[float], p: float) -> float:
    """Linear interpolation, as the builtin ``percentile`` does it."""
    at = p * (len(ranked) - 1)
    low, high = math.floor(at), math.ceil(at)
    if low == high or ranked[low] == ranked[high]:
        return ranked[low]
    return (high - at) * ranked[low] + (at - low) * ranked[high]


def drift_of(base: Sequence[float | None], now: Sequence[float | None], bins: int) -> float | None:
    """Population stability index of two samples; None where one is too small."""
    base, now = (sorted(v for v in side if v is not None) for side in (base, now))
    if min(len(base), len(now)) < PSI_MIN_ROWS:
        return None
    edges = [quantile(base, i / bins) for i in range(1, bins)]
    counts = []
    for side in (base, now):
        found = [0] * bins
        for v in side:
            found[bisect_right(edges, v)] += 1
        counts.append([c / len(side) for c in found])
    return sum((q - p) * math.log((q + PSI_GUARD) / (p + PSI_GUARD)) for p, q in zip(*counts))


class SeriesWatch(StatefulProcessor):
    """Scores the rows of each series as the watermark passes them."""

    def __init__(self, keys: Sequence[str], ts: str, y: str, window: int, threshold: float, span: int, every: int, bins: int):
        self.keys, self.ts, self.y = list(keys), ts, y
        self.window, self.threshold, self.span, self.every, self.bins = window, threshold, span, every, bins

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "run long, page long", "rows binary")
        self.runs = handle.getValueState("runs", "runs array<long>")
        self.past = handle.getValueState("past", "rows long, recent array<double>, recent_deviations array<double>, drift array<double>")

    def _waiting(self) -> SortedRuns:
        stored = self.runs.get()
        return SortedRuns(self.waiting, stored[0] if stored else ())

    def _block(self, pdf: pd.DataFrame) -> np.ndarray:
        # pandas may hold timestamps in another unit than nanoseconds
        micros = pdf[self.ts].astype("datetime64[us, UTC]" if pdf[self.ts].dt.tz is not None else "datetime64[us]").astype("int64")
        return np.stack([micros.to_numpy(), ranks(pdf[self.y].to_numpy(np.float64))])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        runs = self._waiting()
        before = runs.first()
        runs.add(map(self._block, rows))
        self.runs.update((runs.stored(),))
        if runs.first() != before:
            self._wake_at(runs.first())
        return iter(())

    def _wake_at(self, micros: int) -> None:
        self.handle.registerTimer(-(-micros // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        runs = self._waiting()
        if not runs.runs or runs.first() > passed:
            return
        number, recent, deviations, ring = self.past.get() if self.past.exists() else (0, [], [], [])
        score, ring = RobustScore(self.window, list(recent), list(deviations)), list(ring)
        for block in runs.take(passed):
            for i in range(0, block.shape[1], OUT_ROWS):
                part, out = block[:, i : i + OUT_ROWS], []
                for micros, value in zip(part[0].tolist(), values(part[1]).tolist()):
                    value = None if value != value else value
                    z = score.push(value)
                    number += 1
                    ring.append(value)
                    place = number % self.every == 0 and number >= 2 * self.span
                    if len(ring) > 2 * self.span + 1024 or place:
                        del ring[: -2 * self.span]
                    psi = drift_of(ring[: self.span], ring[self.span :], self.bins) if place else None
                    out.append((micros, value, z, z is not None and abs(z) > self.threshold, number, psi))
                yield self._scored(key, out)
        self.past.update((number, list(score.values.order), list(score.deviations.order), ring[-2 * self.span :]))
        if runs.runs:
            self.runs.update((runs.stored(),))
            self._wake_at(runs.first())
        else:
            self.runs.clear()

    def _scored(self, key, out: list[tuple]) -> pd.DataFrame:
        pdf = pd.DataFrame(out, columns=[self.ts, self.y, "z", "is_change", "rn", "psi"])
        pdf[self.ts] = pd.to_datetime(pdf[self.ts], unit="us", utc=True)
        for c in (self.y, "z", "psi"):
            pdf[c] = pdf[c].astype(float)
        for k, v in zip(self.keys, key):
            pdf[k] = v
        return pdf[[*self.keys, self.ts, self.y, "z", "is_change", "rn", "psi"]]

    def close(self) -> None:
        pass


def watch_series(
    stream: DataFrame, late: str, keys: Sequence[str], ts: str = "ts", y: str = "y",
    window: int = 30, threshold: float = 4.0, span: int = 90, every: int = 30, bins: int = 10,
) -> DataFrame:
    """Every row once the watermark (``late`` behind the newest) has passed it, with ``z``
    and ``is_change`` as ``mad_change_points`` has them, its number ``rn`` in the series
    and, at every ``every``-th row, ``psi`` as ``rolling_drift`` has it. Rows without a time
    are left out, rows later than the watermark too; rows of equal time go by value. State
    per series: ``window`` and ``2 span`` values and the rows not yet passed, of which some
    pages at a time are in memory.

    The state store must be the one with timers (RocksDB); it is set for the session."""
    spark, keys = stream.sparkSession, list(keys)
    if spark.conf.get(PROVIDER, None) != ROCKS:
        spark.conf.set(PROVIDER, ROCKS)
    d = stream.where(F.col(ts).isNotNull()).select(*keys, F.col(ts).cast("timestamp").alias(ts), F.col(y).cast("double").alias(y))
    schema = "".join(f"`{k}` {d.schema[k].dataType.simpleString()}, " for k in keys)
    schema += f"`{ts}` timestamp, `{y}` double, z double, is_change boolean, rn long, psi double"
    scored = d.withWatermark(ts, late).groupBy(*keys).transformWithStateInPandas(
        SeriesWatch(keys, ts, y, window, threshold, span, every, bins), schema, "Append", "EventTime")
    numbers = {c: F.nullif(F.col(c), F.lit(float("nan"))) for c in (y, "z", "psi")}
    return scored.withColumns(numbers | {ts: F.col(ts).cast("timestamp_ntz")})
