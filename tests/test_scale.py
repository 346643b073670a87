"""Hot keys, forced shuffles and block edges give the same answers."""

import numpy as np
import pandas as pd
import pytest
from conftest import SCHEMA
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewright.operators import monitor, profile
from tidewright.operators import regularize as reg
from tidewright.operators.layout import carry, number_rows, spread_join
from tidewright.operators.quantiles import exact_quantiles
from tidewright.session import ensure_checkpoint_dir

KEYS = ["series_id"]


@pytest.fixture(scope="module")
def skewed_pdf():
    """One key holds over a third of the rows, one value most of another key."""
    rng = np.random.default_rng(11)
    sizes = {"hot": 6000, "flat": 3000, "b": 2500, "c": 2500, "one": 1, "two": 2}
    frames = []
    for k, n in sizes.items():
        y = rng.lognormal(3, 1, n)
        if k == "flat":
            y = np.where(rng.random(n) < 0.9, 5.0, y)
        ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 20 * 86400 * 1000, n), unit="ms")
        frames.append(pd.DataFrame({"series_id": k, "ts": ts, "y": y}))
    return pd.concat(frames, ignore_index=True)


@pytest.fixture(scope="module")
def skewed(spark, skewed_pdf):
    return spark.createDataFrame(skewed_pdf, SCHEMA).repartition(9)


@pytest.fixture(params=["broadcast", "shuffle"])
def join_mode(spark, request):
    if request.param == "shuffle":
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.set(name, "-1")
    yield request.param
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(name)


@pytest.mark.parametrize("accuracy", [100, 1000, 10_000])
def test_exact_quantiles(skewed, skewed_pdf, join_mode, accuracy):
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = {r["series_id"]: r for r in exact_quantiles(skewed, KEYS, "y", probs, accuracy=accuracy, carry={"m": F.avg("y")}).collect()}
    for k, g in skewed_pdf.groupby("series_id"):
        np.testing.assert_allclose(got[k]["q"], np.quantile(g.y, probs), rtol=1e-12)
        assert got[k]["m"] == pytest.approx(g.y.mean())


def test_quantiles_of_missing_values_and_no_keys(spark, skewed, skewed_pdf):
    d = skewed.withColumn("y", F.when(F.col("series_id") != "c", F.col("y")))
    got = {r["series_id"]: r["q"] for r in exact_quantiles(d, KEYS, "y", [0.5]).collect()}
    assert got["c"] is None and got["one"] is not None
    every = exact_quantiles(skewed, [], "y", [0.1, 0.5], accuracy=200).first()["q"]
    np.testing.assert_allclose(every, np.quantile(skewed_pdf.y, [0.1, 0.5]), rtol=1e-12)


def test_spread_join_keeps_every_row_once(spark, skewed, join_mode):
    per_key = skewed.where("series_id <> 'one'").groupBy(*KEYS).agg(F.max("y").alias("top"))
    inner, left = spread_join(skewed, per_key, KEYS), spread_join(skewed, per_key, KEYS, "left")
    assert inner.count() == skewed.where("series_id <> 'one'").count()
    assert left.count() == skewed.count() and left.where("top is null").count() == 1
    assert spread_join(skewed, per_key, KEYS, "left_semi").count() == inner.count()


def test_spread_join_splits_a_hot_key(spark, skewed, join_mode):
    per_key = skewed.groupBy(*KEYS).agg(F.max("y").alias("top"))
    if join_mode == "broadcast":
        pytest.skip("no shuffle to look at")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = spread_join(skewed, per_key, KEYS).where("series_id = 'hot'").groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert parts > 1


@pytest.mark.parametrize("chunk", ["hour", "day", "month"])
def test_row_numbers_and_carry_across_chunks(skewed, chunk):
    d = skewed.dropDuplicates(["series_id", "ts"]).withColumn("y", F.when(F.col("y") > 25, F.col("y")))
    w = Window.partitionBy("series_id").orderBy("ts")
    want = d.withColumns({"rn": F.row_number().over(w).cast("long"), "c": F.last("y", True).over(w.rowsBetween(Window.unboundedPreceding, 0))})
    got = number_rows(d, KEYS, "ts", chunk=chunk).join(carry(d, KEYS, "ts", "y", "c", chunk).select("series_id", "ts", "c"), ["series_id", "ts"])
    assert got.select("series_id", "ts", "rn", "c").exceptAll(want.select("series_id", "ts", "rn", "c")).count() == 0
    assert got.count() == want.count()


def test_chunked_filling_equals_the_plain_one(holes):
    for plain, cut in (
        (reg.fill_forward_backward(holes, KEYS), reg.fill_forward_backward(holes, KEYS, chunk="month")),
        (reg.impute_lookback(holes, "D", KEYS), reg.impute_lookback(holes, "D", KEYS, chunk="month")),
        (reg.fill_gaps(holes.where("y is not null"), "D", KEYS), reg.fill_gaps(holes.where("y is not null"), "D", KEYS, block_rows=50, chunk="week")),
    ):
        cols = sorted(plain.columns)
        assert plain.select(cols).exceptAll(cut.select(cols)).count() == 0 and plain.count() == cut.count()


def test_gaps_do_not_depend_on_the_chunk(skewed):
    a, b = reg.gaps(skewed, KEYS, chunk="hour"), reg.gaps(skewed, KEYS, chunk="month")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_raw_and_gridded_statistics_agree(skewed, join_mode):
    a = profile.basic_stats(skewed, KEYS, gridded=False).toPandas().sort_values("series_id").reset_index(drop=True)
    b = profile.basic_stats(skewed, KEYS, gridded=True).toPandas().sort_values("series_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, rtol=1e-10)
    cut = F.lit("2024-01-10").cast("timestamp_ntz")
    base, now = skewed.where(F.col("ts") < cut), skewed.where(F.col("ts") >= cut)
    x = {r["series_id"]: r["psi"] for r in monitor.psi(base, now, KEYS).collect()}
    y = {r["series_id"]: r["psi"] for r in monitor.psi(base, now, KEYS, gridded=True).collect()}
    assert x["hot"] == pytest.approx(y["hot"]) and x["flat"] == pytest.approx(y["flat"])


def test_filters_and_columns_reach_the_scan(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    d = d.select(F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("y"), "o_custkey")
    plan = reg.resample(d.where("y > 1000"), "D", KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in plan
    assert "o_custkey" not in plan


def test_windows_share_one_shuffle(daily):
    from tidewright.operators.structure import decompose

    d = daily.groupBy("series_id", "ts").agg(F.max("y").alias("y"))
    for df in (reg.impute_lookback(d, "D", KEYS), reg.fill_gaps(d, "D", KEYS, policy="ffill"), decompose(d, 7, KEYS)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2  # the aggregation's and the series'


def test_checkpoint_folder_comes_from_the_session(spark, tmp_path):
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir()
