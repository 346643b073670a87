import os
import sys

import numpy as np
import pandas as pd
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__  # noqa: E402,F401  (ships the package to the workers)
from pyspark.sql import functions as F  # noqa: E402

from tidewright.functions.expressions import as_null  # noqa: E402
from tidewright.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SCHEMA = "series_id string, ts timestamp_ntz, y double"


@pytest.fixture(scope="session")
def daily_pdf():
    """Three gridded daily series with trend, weekly and yearly waves."""
    rng = np.random.default_rng(7)
    frames = []
    for i, n in enumerate((400, 300, 500)):
        t = np.arange(n)
        y = 100 + 20 * i + 0.05 * t + 10 * np.sin(2 * np.pi * t / 7) + 5 * np.cos(2 * np.pi * t / 365.25) + rng.normal(0, 2, n)
        frames.append(pd.DataFrame({"series_id": f"s{i}", "ts": pd.date_range("2020-01-01", periods=n), "y": y}))
    return pd.concat(frames, ignore_index=True)


@pytest.fixture(scope="session")
def daily(spark, daily_pdf):
    return spark.createDataFrame(daily_pdf, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def holes_pdf(daily_pdf):
    rng = np.random.default_rng(3)
    p = daily_pdf.copy()
    p.loc[rng.random(len(p)) < 0.1, "y"] = np.nan
    return p


@pytest.fixture(scope="session")
def holes(spark, holes_pdf):
    d = spark.createDataFrame(holes_pdf, SCHEMA).repartition(5)
    return d.withColumn("y", as_null(F.col("y")))


def series_of(pdf):
    return {k: g.sort_values("ts").set_index("ts")["y"] for k, g in pdf.groupby("series_id")}
