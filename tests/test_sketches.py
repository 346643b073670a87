"""Quantile sketches: ranks, merges, nulls, the approximate option."""

import numpy as np
import pandas as pd
import pytest
from conftest import SCHEMA
from pyspark.sql import functions as F

from tidewright.operators import profile, sketches

KEYS = ["series_id"]
PROBS = [0.01, 0.1, 0.5, 0.9, 0.99]


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(11)
    n = 60_000
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 40 * 86_400, n), "s")
    # the hot series holds two thirds of the rows and moves with time
    hot = rng.random(n) < 0.67
    y = rng.lognormal(3, 1, n) + (ts - ts.min()).days * hot
    return pd.DataFrame({"series_id": np.where(hot, "hot", "cold"), "ts": ts, "y": np.round(y, 1)})


def off(sorted_y, q, p):
    a, b = np.searchsorted(sorted_y, q, "left") / len(sorted_y), np.searchsorted(sorted_y, q, "right") / len(sorted_y)
    return max(a - p, p - b, 0.0)


def test_merged_sketches_keep_the_rank_bound(spark, values):
    d = spark.createDataFrame(values, SCHEMA).repartition(7)
    days = sketches.sketch_slots(d, "D", KEYS)
    bound = 2 * sketches.rank_error()
    for keys, groups in ((KEYS, values.groupby("series_id")), ([], [("all", values)])):
        merged = sketches.quantiles(sketches.merge_slots(days, None, keys), PROBS).toPandas()
        want = {k: np.sort(g["y"].to_numpy()) for k, g in groups}
        for r in merged.itertuples():
            y = want[getattr(r, "series_id", "all")]
            assert r.n == len(y)
            assert max(off(y, q, p) for q, p in zip(r.q, PROBS)) <= bound
    direct = sketches.quantiles(sketches.merge_slots(sketches.sketch_slots(d, "MS", KEYS), None, KEYS), PROBS).toPandas()
    assert direct.n.sum() == len(values)


def test_sketches_are_bounded(spark, values):
    d = spark.createDataFrame(values, SCHEMA)
    size = sketches.merge_slots(sketches.sketch_slots(d, "D", KEYS)).select(F.length("sketch")).first()[0]
    assert size < 40 * sketches.K


def test_missing_values_and_empty_tables(spark):
    rows = [("a", None, 1.0), ("a", None, None), ("b", None, None), ("c", None, float("nan")), ("c", None, 2.0)]
    d = spark.createDataFrame(rows, SCHEMA)
    got = {r.series_id: r for r in sketches.quantiles(sketches.sketch_slots(d, "D", KEYS), [0.5]).collect()}
    assert (got["a"].n, got["a"].missing, got["a"].q, got["a"].slot) == (1, 1, [1.0], None)
    assert (got["b"].n, got["b"].missing, got["b"].q) == (0, 1, None)
    assert (got["c"].n, got["c"].missing, got["c"].q) == (1, 1, [2.0])
    assert sketches.merge_slots(sketches.sketch_slots(d.limit(0), "D", KEYS), "MS", KEYS).count() == 0
    merged = {r.series_id: r for r in sketches.quantiles(sketches.merge_slots(sketches.sketch_slots(d, "D", KEYS), "MS", KEYS), [0.0, 1.0]).collect()}
    assert merged["b"].q is None and merged["a"].q == [1.0, 1.0]


def test_approximate_statistics(spark, values):
    d = spark.createDataFrame(values, SCHEMA)
    near, exact = (profile.basic_stats(d, KEYS, **o).toPandas().set_index("series_id") for o in ({"approx": True}, {"gridded": False}))
    assert list(near.columns) == list(exact.columns)
    for k, g in values.groupby("series_id"):
        y = np.sort(g["y"].to_numpy())
        assert max(off(y, near.loc[k, c], p) for c, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75))) <= 2 * sketches.rank_error()
        assert near.loc[k, "max"] == exact.loc[k, "max"] and near.loc[k, "count"] == exact.loc[k, "count"]
