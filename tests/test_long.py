"""Long horizons, long lags, penalised leaves."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import SCHEMA, series_of
from pyspark.sql import functions as F

from tidewright.models import boosted, leaves, linear
from tidewright.operators import evaluate as ev
from tidewright.operators import profile, structure

KEYS = ["series_id"]


# ------------------------------------------------------------------ linear recursion

def plain(h, dates, weights, intercept):
    h = list(h)
    for date in dates:
        week = np.array(h[-7:])
        far = lambda k: h[-k] if len(h) >= k else h[0]
        h.append(
            intercept + weights["lag_1"] * h[-1] + weights["lag_7"] * far(7) + weights["lag_14"] * far(14)
            + weights["roll7_mean"] * week.mean() + weights["is_weekend"] * (date.dayofweek >= 5))
    return h[-len(dates):]


WEIGHTS = {"lag_1": 0.3, "lag_7": 0.4, "lag_14": 0.1, "roll7_mean": 0.15, "is_weekend": 2.5}


def test_linear_recursion_over_a_long_horizon(daily, daily_pdf):
    model = linear.Linear(WEIGHTS, 1.25)
    got = linear.forecast(daily, model, "D", 1000, KEYS).toPandas()
    for name, s in series_of(daily_pdf).items():
        g = got[got.series_id == name].sort_values("step")
        dates = pd.date_range(s.index[-1] + pd.Timedelta(days=1), periods=1000)
        assert (g.ts.to_numpy() == dates.to_numpy()).all()
        np.testing.assert_allclose(g.forecast, plain(s.tolist(), dates, WEIGHTS, 1.25), rtol=1e-9)


@pytest.mark.parametrize("horizon", [1, 3, 64, 70])
def test_linear_recursion_of_short_series(spark, horizon):
    rows = [(f"n{n}", datetime(2024, 1, 1) + timedelta(days=i), 5.0 + i * i % 7) for n in (1, 2, 6, 7, 9, 13, 14, 15) for i in range(n)]
    rows += [("none", datetime(2024, 1, 1), None), ("n9", datetime(2024, 1, 10), None)]
    d = spark.createDataFrame(rows, SCHEMA)
    got = linear.forecast(d, linear.Linear(WEIGHTS, 0.5), "D", horizon, KEYS).toPandas()
    assert "none" not in set(got.series_id)
    for n in (1, 2, 6, 7, 9, 13, 14, 15):
        dates = pd.date_range(pd.Timestamp("2024-01-01") + pd.Timedelta(days=n), periods=horizon)
        g = got[got.series_id == f"n{n}"].sort_values("step")
        np.testing.assert_allclose(g.forecast, plain([5.0 + i * i % 7 for i in range(n)], dates, WEIGHTS, 0.5), rtol=1e-9)


def test_linear_model_learns_and_refuses(daily):
    table = boosted.training_table(ev.train_valid_split(daily, "D", KEYS), KEYS).cache()
    model = linear.train(table)
    scaled = daily.join(table.select("series_id", "level").distinct(), KEYS)
    out = linear.forecast(scaled, model, "D", 30, KEYS, level="level")
    spread = out.join(daily.groupBy("series_id").agg(F.avg("y").alias("m")), KEYS).agg(F.max(F.abs(F.col("forecast") / F.col("m") - 1))).first()[0]
    assert spread < 0.5
    with pytest.raises(ValueError):
        linear.Linear({"roll7_std": 1.0})


# ------------------------------------------------------------------ penalised leaves

def two_leaves(spark):
    rows = [("train", float(i % 2), float(v)) for i, v in enumerate([1, 5, 2, 7, 3, 6, 2, 6, 1, 5, 3, 7])]
    rows += [("valid", 0.0, 2.0), ("valid", 1.0, 6.0)]
    return spark.createDataFrame(rows, "split string, x double, _scaled double").withColumn("level", F.lit(1.0))


def one_tree(spark, **penalty):
    d = two_leaves(spark)
    model = boosted.train(d, ["x"], patience=None, maxIter=1, maxDepth=1, subsamplingRate=1.0, featureSubsetStrategy="all")
    trees = leaves.penalised(d, model, ["x"], patience=None, **penalty)
    rows = boosted.predict(d, trees, ["x"]).where("split = 'valid'").toPandas()
    return dict(zip(rows.x, rows.yhat))


@pytest.mark.parametrize("l1, l2", [(0.0, 0.0), (0.0, 1.0), (2.0, 1.0), (7.0, 3.0), (13.0, 0.0)])
def test_penalties_of_one_tree(spark, l1, l2):
    got = one_tree(spark, l1=l1, l2=l2)
    left, right = max(0.0, 12.0 - l1), max(0.0, 36.0 - l1)
    if left**2 / (6 + l2) + right**2 / (6 + l2) < (48.0 - l1) ** 2 / (12 + l2):  # worse than no split at all
        left = right = (48.0 - l1) * (6 + l2) / (12 + l2)
    assert (got[0.0], got[1.0]) == pytest.approx((left / (6 + l2), right / (6 + l2)))


def test_gamma_merges_leaves(spark):
    gain = 12**2 / 7 + 36**2 / 7 - 48**2 / 13
    apart, merged = one_tree(spark, l2=1.0, gamma=gain - 1e-6), one_tree(spark, l2=1.0, gamma=gain + 1e-6)
    assert apart[0.0] != apart[1.0]
    assert merged[0.0] == merged[1.0] == pytest.approx(48 / 13)


def slow_leaves(trees, x, y, l1, l2, gamma):
    """Leaf by leaf from the residuals of all rows."""
    left = y.copy()
    lowest = 2**trees.depth
    for t in range(len(trees.weight)):
        node = trees.nodes(x, t + 1)[:, t]

        def settle(i):
            below = [i]
            while below[0] < lowest - 1:
                below = [c for b in below for c in (2 * b + 1, 2 * b + 2)]
            rows = np.isin(node, below)
            g, h = left[rows].sum(), rows.sum()
            pull = np.sign(g) * max(0.0, abs(g) - l1)
            own, score = (pull / (h + l2), pull**2 / (h + l2)) if h + l2 else (0.0, 0.0)
            if i >= lowest - 1:
                trees.value[t, i] = own
                return True, score
            (a, sa), (b, sb) = settle(2 * i + 1), settle(2 * i + 2)
            if a and b and (sa + sb - score < gamma or np.isinf(trees.limit[t, i])):
                for c in below:
                    trees.value[t, c] = own
                return True, score
            return False, sa + sb

        settle(0)
        left = left - trees.weight[t] * trees.value[t, node]
    return trees.value[:, lowest - 1 :]


@pytest.mark.parametrize("l1, l2, gamma", [(0.0, 1.0, 0.0), (0.5, 2.0, 0.02)])
def test_many_trees_equal_the_row_by_row_way(daily, monkeypatch, l1, l2, gamma):
    table = boosted.training_table(ev.train_valid_split(daily, "D", KEYS), KEYS).cache()
    model = boosted.train(table, patience=None, maxIter=11, stepSize=0.3)
    monkeypatch.setattr(leaves, "TREES_AT_ONCE", 4)
    trees = leaves.penalised(table, model, l1=l1, l2=l2, gamma=gamma, patience=None)
    p = table.where("split = 'train'").toPandas()
    want = slow_leaves(boosted.Trees(model), p[boosted.FEATURES].to_numpy(float), p["_scaled"].to_numpy(float), l1, l2, gamma)
    np.testing.assert_allclose(trees.value[:, 2**trees.depth - 1 :], want, rtol=1e-7, atol=1e-9)
    cut = leaves.penalised(table, model, l1=l1, l2=l2, gamma=gamma, patience=3)
    loss = boosted.losses(table.where("split = 'valid'"), trees)
    assert len(cut.weight) == int(np.argmin(loss)) + 1
    out = boosted.forecast(daily, table, cut, "D", 5, KEYS)
    assert out.where("forecast is null or isnan(forecast)").count() == 0 and out.count() == 15


def test_penalties_are_not_negative(daily):
    with pytest.raises(ValueError):
        leaves.penalised(daily, None, l2=-1.0)


# ------------------------------------------------------------------ long lags

def test_autocorrelation_at_ten_thousand_lags(spark):
    rng = np.random.default_rng(5)
    n, lags = 30_000, 10_000
    y = 1e3 + np.cumsum(rng.normal(0, 1, n)) * 0.1 + 5 * np.sin(2 * np.pi * np.arange(n) / 168)
    p = pd.DataFrame({"series_id": "a", "ts": pd.date_range("2020-01-01", periods=n, freq="h"), "y": y})
    d = spark.createDataFrame(p, SCHEMA)
    x = y - y.mean()
    size = 1 << 17
    f = np.fft.rfft(x, size)
    whole = np.fft.irfft(f * np.conj(f), size)[: lags + 1]
    some = [0, 1, 63, 64, 168, 8192, 9999, 10_000]
    want = [x[k:] @ x[: n - k] / (x @ x) for k in some]
    for block in (None, 4096):
        got = profile.acf(d, KEYS, nlags=lags, block_rows=block).toPandas().sort_values("lag")["acf"].to_numpy()
        assert len(got) == lags + 1
        np.testing.assert_allclose(got[some], want, atol=1e-9)
        np.testing.assert_allclose(got, whole / whole[0], atol=1e-9)


def test_dominant_period(spark, daily):
    a = profile.acf(daily, KEYS, nlags=84)
    got = structure.dominant_period(a, 84, KEYS).toPandas()
    assert got.period.tolist() == [7.0] * 3 and (got.share > 0.3).all()
    s = structure.spectrum(a, 84, KEYS).where("series_id = 's0'").toPandas().sort_values("frequency")
    r = a.where("series_id = 's0'").toPandas().sort_values("lag")["acf"].to_numpy()
    taper = 1 - np.arange(85) / 84
    want = [1 + 2 * sum(taper[k] * r[k] * np.cos(np.pi * j * k / 84) for k in range(1, 84)) for j in range(1, 85)]
    np.testing.assert_allclose(s.power, want, atol=1e-9)
    short = spark.createDataFrame([("a", datetime(2024, 1, 1) + timedelta(days=i), float(i % 2)) for i in range(12)], SCHEMA)
    assert structure.dominant_period(profile.acf(short, KEYS, nlags=40), 40, KEYS).first()["period"] == pytest.approx(2.0, rel=0.1)
