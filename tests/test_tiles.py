"""Tiled cross-products against NumPy and pandas, for many columns and missing values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewright.operators import screening, tiles

KEYS = ["series_id"]


def table(spark, pdf):
    d = spark.createDataFrame(pdf)
    return d.select(*[F.nanvl(c, F.lit(None).cast("double")).alias(c) if c != "series_id" else F.col(c) for c in d.columns]).repartition(5)


@pytest.fixture(scope="module")
def wide_pdf():
    rng = np.random.default_rng(6)
    frames = []
    for name, level, n in (("a", 1e7, 300), ("b", 0.0, 200)):
        x = rng.normal(level, 3.0, (n, 40)) + rng.normal(0, 2.0, (n, 1))
        x[:, 7] = 5.0
        x[:, 9] = x[:, 3] + x[:, 4]
        x[rng.random(x.shape) < 0.03] = np.nan
        frames.append(pd.DataFrame(x, columns=[f"c{i}" for i in range(40)]).assign(series_id=name))
    return pd.concat(frames, ignore_index=True)


@pytest.mark.parametrize("tile", [1, 7, 128])
def test_pairs_over_rows_that_have_both(spark, wide_pdf, tile):
    columns = [f"c{i}" for i in range(12 if tile == 1 else 40)]
    got = {(r.series_id, r.a, r.b): r["corr"] for r in screening.corr_pairs(table(spark, wide_pdf), columns, KEYS, tile=tile).collect()}
    assert len(got) == 2 * len(columns) * (len(columns) - 1) // 2
    for name, g in wide_pdf.groupby("series_id"):
        want = g[columns].corr()
        for i, a in enumerate(columns):
            for b in columns[i + 1 :]:
                w = want.loc[a, b]
                assert got[name, a, b] is None if "c7" in (a, b) else got[name, a, b] == pytest.approx(w, abs=1e-8)


def test_no_keys_threshold_and_few_rows(spark, wide_pdf):
    columns = [f"c{i}" for i in range(40)]
    d = table(spark, wide_pdf[wide_pdf.series_id == "b"]).drop("series_id")
    want = wide_pdf[wide_pdf.series_id == "b"][columns].corr()
    high = {(r.a, r.b) for r in screening.corr_pairs(d, columns, threshold=0.4).collect()}
    assert high == {(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :] if abs(want.loc[a, b]) > 0.4}
    assert screening.corr_pairs(d.limit(0), columns).where("corr is not null").count() == 0
    assert screening.corr_pairs(d.limit(1), columns).where("corr is not null").count() == 0
    assert screening.vif_table(d.limit(0), columns).count() == 0


def test_both_ways_agree(spark, wide_pdf):
    columns = [f"c{i}" for i in (0, 1, 2, 3, 4, 7, 9)]
    d = table(spark, wide_pdf)
    plain = {(r.series_id, r.feature): (r.vif, r.flag) for r in screening.vif_table(d, columns, KEYS).collect()}
    tiled = {(r.series_id, r.feature): (r.vif, r.flag) for r in screening.vif_table(d, columns, KEYS, tile=3).collect()}
    assert set(plain) == set(tiled) and len(plain) == 12
    for k, (v, flag) in plain.items():
        assert tiled[k][1] == flag and (tiled[k][0] == pytest.approx(v, rel=1e-6) or min(v, tiled[k][0]) > 1e6)
    kept = lambda **o: sorted(map(tuple, screening.select_by_vif(d, columns, KEYS, **o).collect()))
    assert kept() == kept(tile=2)


def test_five_hundred_columns(spark):
    rng = np.random.default_rng(1)
    p, n = 500, 1500
    x = rng.normal(50, 1, (n, p)) + 0.3 * rng.normal(0, 1, (n, 1))
    x[:, 499] = x[:, 0] + x[:, 1] + 0.01 * x[:, 2]
    x[:, 250] = x[:, 10] + 0.1 * rng.normal(size=n)
    columns = [f"c{i}" for i in range(p)]
    d = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").select(*[F.col("v")[i].alias(c) for i, c in enumerate(columns)]).repartition(4)
    want = np.corrcoef(x.T)
    pairs = screening.corr_pairs(d, columns)
    got = pairs.toPandas()
    assert len(got) == p * (p - 1) // 2
    i, j = got.a.str[1:].astype(int).to_numpy(), got.b.str[1:].astype(int).to_numpy()
    np.testing.assert_allclose(got["corr"].to_numpy(), want[i, j], atol=1e-9)
    kept = {r.feature for r in screening.select_by_vif(d, columns).collect()}
    left, dropped = list(range(p)), []
    while True:
        sub = want[np.ix_(left, left)]
        v = np.full(len(left), np.inf) if np.linalg.eigvalsh(sub)[0] < 1e-10 else np.diag(np.linalg.inv(sub))
        if np.isinf(v[0]):
            values, vectors = np.linalg.eigh(sub)
            v = np.where((vectors[:, values < 1e-10] ** 2).sum(1) > 1e-9, np.inf, 1.0)
        if v.max() <= 5:
            break
        dropped.append(left.pop(int(np.argmax(v))))
    assert kept == {columns[k] for k in left} and len(dropped) >= 2


def test_factors_of_exact_relations():
    """The rule for columns outside an exact relation, against regressions."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 8))
    x[:, 5] = x[:, 0] - 2 * x[:, 1]
    x[:, 6] += x[:, 2]
    v = screening._vifs(np.corrcoef(x.T))
    for k in range(8):
        others = np.column_stack([np.ones(400), np.delete(x, k, 1)])
        rest = x[:, k] - others @ np.linalg.lstsq(others, x[:, k], rcond=None)[0]
        r2 = 1 - rest @ rest / ((x[:, k] - x[:, k].mean()) ** 2).sum()
        assert np.isinf(v[k]) if k in (0, 1, 5) else v[k] == pytest.approx(1 / (1 - r2), rel=1e-8)
