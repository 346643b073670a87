"""Order-statistic windows; drift and change points of a stream however it is cut."""

import pickle
import time
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from conftest import SCHEMA
from pyspark.sql import functions as F

from tidewright.operators import monitor
from tidewright.operators.ordered import RobustScore, SortedWindow
from tidewright.session import scratch_path
from tidewright.streaming import live, runs, watch

KEYS = ["series_id"]


def test_sorted_window_against_sorting():
    rng = np.random.default_rng(2)
    values = [None if rng.random() < 0.2 else float(rng.integers(0, 9)) for _ in range(500)]
    for size in (1, 2, 7, 50):
        w = SortedWindow(size)
        for i, v in enumerate(values):
            w.push(v)
            known = [x for x in values[max(0, i - size + 1) : i + 1] if x is not None]
            assert w.ranked == sorted(known)
            assert w.median(1) == (np.median(known) if known else None)
            assert w.median(len(known) + 1) is None
        again = SortedWindow(size, list(w.order))
        assert again.ranked == w.ranked


def test_cost_hardly_grows_with_the_window():
    values = np.random.default_rng(3).normal(size=60_000).tolist()

    def seconds(window):
        best = float("inf")
        for _ in range(3):
            score, start = RobustScore(window), time.perf_counter()
            for v in values:
                score.push(v)
            best = min(best, time.perf_counter() - start)
        return best

    assert seconds(1000) < 2 * seconds(30)


def test_no_value_and_constant_series(spark):
    rows = [("none", i, None) for i in range(40)] + [("flat", i, 5.0) for i in range(40)] + [("nan", i, float("nan")) for i in range(40)]
    d = spark.createDataFrame(rows, "series_id string, i int, y double").withColumn("ts", F.timestamp_add("DAY", "i", F.lit("2024-01-01").cast("timestamp_ntz"))).drop("i")
    got = monitor.mad_change_points(d, KEYS)
    assert got.count() == 120 and got.where("z is not null or is_change").count() == 0
    assert monitor.mad_change_points(d.where("series_id = 'x'"), KEYS).count() == 0


def test_rolling_drift_against_recent_drift(spark, daily, daily_pdf):
    """At a series' last row it is the drift of its last rows."""
    got = {(r.series_id, r.rn): r.psi for r in monitor.rolling_drift(daily, KEYS, every=100).collect()}
    assert set(got) == {(f"s{i}", n) for i, size in enumerate((400, 300, 500)) for n in range(200, size + 1, 100)}
    for r in monitor.recent_drift(daily, KEYS).collect():
        size = {"s0": 400, "s1": 300, "s2": 500}[r.series_id]
        assert got[r.series_id, size] == pytest.approx(r.psi, abs=1e-12)


@pytest.fixture(scope="module")
def rows_pdf():
    rng = np.random.default_rng(5)
    frames = []
    for name, n in (("a", 700), ("b", 260), ("few", 12)):
        y = rng.normal(10, 2, n)
        y[n // 2 :] += 3
        y[rng.random(n) < 0.05] = 60.0
        y[rng.random(n) < 0.1] = np.nan
        frames.append(pd.DataFrame({"series_id": name, "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n) * 37, unit="min"), "y": y}))
    return pd.concat(frames, ignore_index=True)


def write_pieces(spark, pdf, path, names):
    """Files that the stream reads one per batch, in the order of their times."""
    for k, part in enumerate(names):
        d = spark.createDataFrame(part, SCHEMA).withColumn("y", F.nanvl("y", F.lit(None).cast("double")))
        d.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)


def run(spark, folder, out, ckpt):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    scored = watch.watch_series(stream, "2 days", KEYS, window=20, span=60, every=25)
    live.write_stream(scored, out, ckpt).awaitTermination()


def batch(spark, pdf):
    d = spark.createDataFrame(pdf, SCHEMA).withColumn("y", F.nanvl("y", F.lit(None).cast("double")))
    d = d.where(F.col("ts") <= F.lit(pdf.ts.max() - pd.Timedelta(days=2)))
    z = monitor.mad_change_points(d, KEYS, window=20)
    psi = monitor.rolling_drift(d, KEYS, span=60, every=25)
    return sorted(z.join(psi.drop("rn"), ["series_id", "ts"], "left").select("series_id", "ts", "y", F.round("z", 9).alias("z"), "is_change", F.round("psi", 9).alias("psi")).collect(), key=str)


def got_from(spark, out):
    return sorted(spark.read.parquet(out).select("series_id", "ts", "y", F.round("z", 9).alias("z"), "is_change", F.round("psi", 9).alias("psi")).collect(), key=str)


def test_a_stream_cut_anyhow_and_restarted(spark, rows_pdf):
    want = batch(spark, rows_pdf)
    assert sum(r.is_change for r in want) > 10 and sum(r.psi is not None for r in want) > 10
    # at once
    folder, out, ckpt = (scratch_path(spark, x) for x in ("watch-in", "watch-out", "watch-ck"))
    write_pieces(spark, rows_pdf, folder, [rows_pdf.sample(frac=1, random_state=1)])
    run(spark, folder, out, ckpt)
    assert got_from(spark, out) == want
    # in four pieces whose rows are up to a day out of order, restarted in the middle
    rng = np.random.default_rng(9)
    arrival = rows_pdf.ts + pd.to_timedelta(rng.integers(0, 86400, len(rows_pdf)), unit="s")
    pieces = [rows_pdf[group.to_numpy()].sample(frac=1, random_state=2) for _, group in pd.get_dummies(pd.qcut(arrival, 4, labels=False)).astype(bool).items()]
    folder, out, ckpt = (scratch_path(spark, x) for x in ("watch-in", "watch-out", "watch-ck"))
    write_pieces(spark, rows_pdf, folder, pieces[:2])
    run(spark, folder, out, ckpt)
    half = got_from(spark, out)
    assert 0 < len(half) < len(want) and set(half) <= set(want)
    write_pieces(spark, rows_pdf, folder, pieces[2:])
    run(spark, folder, out, ckpt)
    assert got_from(spark, out) == want


class Variable(dict):
    """A state variable of any kind, for one series; notes the most bytes put or got at once."""

    largest = 0

    def _seen(self, value):
        self.largest = max(self.largest, len(pickle.dumps(value)))
        return value

    def updateValue(self, key, value):
        self[key] = self._seen(value)

    def getValue(self, key):
        return self._seen(self[key])

    def removeKey(self, key):
        del self[key]

    def update(self, value):
        self[0] = self._seen(value)

    put = update

    def appendList(self, value):
        self[0] = [*self.get(), *self._seen(value)] if self else self._seen(value)

    def get(self):
        return self._seen(super().get(0))

    def exists(self):
        return bool(self)


@pytest.mark.parametrize("sizes", [(64, 8, 4), (10, 16, 3), (1000, 7, 2), (1 << 18, 1 << 12, 64)])
def test_sorted_runs_against_sorting(monkeypatch, sizes):
    for name, size in zip(("RUN_ROWS", "PAGE_ROWS", "MOST_RUNS"), sizes):
        monkeypatch.setattr(runs, name, size)
    rng, some = np.random.default_rng(1), np.array([np.nan, -np.inf, np.inf, -1.5, 0.0, 2.0, 1e-300])
    assert np.array_equal(runs.values(runs.ranks(some)), some, equal_nan=True)
    for _ in range(10):
        pages, stored, left, passed = Variable(), [], [], 0
        for _ in range(20):
            blocks = []
            for n in rng.integers(1, 150, rng.integers(0, 4)):
                blocks.append(np.stack([passed + 1 + rng.integers(0, 200, n), runs.ranks(rng.choice(some, n))]))
                left += zip(*blocks[-1].tolist())
            waiting = runs.SortedRuns(pages, stored)
            waiting.add(iter(blocks))
            assert waiting.first() == min(left, default=(None,))[0] and len(waiting.runs) <= sizes[2]
            passed += int(rng.integers(0, 150))
            waiting = runs.SortedRuns(pages, waiting.stored())
            got = [tuple(row) for block in waiting.take(passed) for row in block.T.tolist()]
            assert got == sorted(row for row in left if row[0] <= passed)
            left, stored = [row for row in left if row[0] > passed], waiting.stored()
        assert sum(1 for block in runs.SortedRuns(pages, stored).take(10**9) for _ in block.T) == len(left) and not pages
        assert pages.largest < 16 * sizes[1] + 1000


def test_a_long_series_is_never_held_at_once():
    rng, n = np.random.default_rng(4), 300_000
    micros, y = rng.permutation(n // 3).repeat(3) * 1000, rng.normal(size=n)
    y[rng.random(n) < 0.01] = np.nan
    frames = [pd.DataFrame({"ts": pd.to_datetime(micros[i : i + 10_000], unit="us"), "y": y[i : i + 10_000]}) for i in range(0, n, 10_000)]
    variables, timers = {}, []
    kept = lambda name, *_: variables.setdefault(name, Variable())
    series = watch.SeriesWatch(["series_id"], "ts", "y", 30, 4.0, 90, 30_000, 10)
    series.init(SimpleNamespace(getListState=kept, getMapState=kept, getValueState=kept, registerTimer=timers.append))
    assert not list(series.handleInputRows(("a",), iter(frames), None)) and timers == [0]
    out, half = [], n // 6
    for passed in (half, n):
        out += series.handleExpiredTimer(("a",), SimpleNamespace(getCurrentWatermarkInMs=lambda: passed), None)  # noqa: B023
    assert timers == [0, half + 1] and max(map(len, out)) <= 10_000
    assert max(v.largest for v in variables.values()) < 100_000
    got, order = pd.concat(out), np.lexsort((np.where(np.isnan(y), -np.inf, y), micros))
    assert np.array_equal(got.rn, np.arange(1, n + 1)) and np.array_equal(got.y, y[order], equal_nan=True)
    assert np.array_equal(got.ts.dt.tz_localize(None).astype("datetime64[us]").astype("int64"), micros[order])
    score = RobustScore(30)
    assert got.z.tolist()[:5000] == pytest.approx([np.nan if (z := score.push(v)) is None else z for v in y[order][:5000].tolist()], nan_ok=True)
    assert got.psi.count() == n // 30_000
