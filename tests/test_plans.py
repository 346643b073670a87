"""Loading and the full back-test."""

from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import SCHEMA
from pyspark.sql import functions as F

from tidewright.plans import forecasting as plan
from tidewright.plans.load import LoadOptions, load_series
from tidewright.sources import files, parse

KEYS = ["series_id"]


def test_load_from_csv_text(spark, tmp_path):
    start = datetime(2023, 1, 1)
    lines = ["store;item;when;sold"]
    for store in ("n", "s"):
        for i in range(60):
            if i not in (5, 6):
                lines.append(f"{store};7;{start + timedelta(days=i):%d/%m/%Y};{'NA' if i == 20 else i + 1}")
    path = tmp_path / "sales.csv"
    path.write_text("\n".join(lines))
    raw = files.read_csv(spark, str(path), "store string, item int, when string, sold double", sep=";")
    out = load_series(raw, LoadOptions(target="sold", date="when", id_cols=("store", "item"))).toPandas()
    assert set(out.series_id) == {"n_7", "s_7"} and set(out.freq) == {"D"}
    one = out[out.series_id == "n_7"].sort_values("ts").set_index("ts")
    assert len(one) == 60 and one.y.notna().all()
    assert one.imputed_flag.sum() == 2 and one.y.iloc[5] == 5.0 and one.y.iloc[20] == 20.0


def test_mixed_frequencies_take_their_own_branch(spark):
    rows = [("minute", datetime(2024, 1, 1) + timedelta(minutes=15 * i), float(i)) for i in range(96)]
    rows += [("month", datetime(2020 + i // 12, 1 + i % 12, 15), float(i)) for i in range(24)]
    d = spark.createDataFrame(rows, "name string, at timestamp_ntz, value double")
    out = load_series(d, LoadOptions(date="at", id_cols=("name",))).toPandas()
    assert out.groupby("series_id").freq.first().to_dict() == {"minute": "h", "month": "MS"}
    assert (out.series_id == "minute").sum() == 24
    assert out[out.series_id == "month"].ts.dt.day.eq(1).all()


def test_load_validates(spark):
    rows = [("long", 2024, 1 + i // 28, 1 + i % 28, float(i)) for i in range(56)] + [("short", 2024, 1, 1 + i, -1.0) for i in range(5)]
    d = spark.createDataFrame(rows, "name string, year int, month int, day int, value double")
    o = LoadOptions(date_parts=("year", "month", "day"), id_cols=("name",), freq="D", validate="report")
    found = {r["series_id"]: r["violations"] for r in load_series(d, o).select("series_id", "violations").distinct().collect()}
    assert found == {"long": [], "short": ["too_few_rows", "negative_values"]}
    with pytest.raises(Exception, match="failed validation"):
        load_series(d, replace(o, validate="strict")).collect()
    assert load_series(d.where("name = 'long'"), replace(o, validate="strict")).count() == 59  # three days without rows
    with pytest.raises(ValueError, match="unknown validation"):
        load_series(d, replace(o, validate="yes"))


def test_only_first_series(spark):
    d = spark.createDataFrame([("b", datetime(2024, 1, 1), 1.0), ("a", datetime(2024, 1, 2), 2.0), ("b", datetime(2024, 1, 3), 3.0)], SCHEMA)
    assert {r["series_id"] for r in parse.first_series(d).collect()} == {"b"}


@pytest.mark.parametrize("texts, fmt", [
    (["31-12-2023", "01-02-2024"], "d-M-yyyy"), (["31/12/2023"], "d/M/yyyy"), (["2023-12-31"], "yyyy-M-d"),
    (["12-31-2023", "01-02-2024"], "M-d-yyyy"), (["12/31/2023"], "M/d/yyyy"), (["3-01", "12-99"], "M-yy"),
])
def test_first_format_that_reads_the_whole_column(spark, texts, fmt):
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    assert parse.choose_date_format(d, "t") == fmt
    assert parse.parse_dates(d, "t").where("ts is null").count() == 0


def test_unreadable_dates_and_times(spark):
    d = spark.createDataFrame([("31-12-2023", "x"), ("soon", "7:30")], "t string, Time string")
    with pytest.raises(ValueError):
        parse.choose_date_format(d, "t")
    dated = d.select(F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), "Time")
    assert "Time" in parse.add_time_of_day(dated).columns  # dates stand alone
    rowwise = parse.add_time_of_day(dated, all_or_nothing=False)
    assert sorted(str(r["ts"]) for r in rowwise.collect()) == ["2024-01-01 00:00:00", "2024-01-01 07:30:00"]


def test_missing_target_names_the_columns(spark):
    with pytest.raises(ValueError, match="available"):
        parse.rename_target(spark.range(1), "sales")


def test_row_cap(spark, tmp_path):
    (tmp_path / "t.csv").write_text("v\n1\n2\n3\n")
    assert files.read_csv(spark, str(tmp_path / "t.csv"), "v int", max_rows=2).count() == 2


def test_backtest_picks_the_lowest_score_and_forecasts_every_horizon(daily):
    run = plan.backtest(daily, "D", KEYS, plan.LADDER, boosting={"maxIter": 5, "patience": None})
    ranked = run.ranked.toPandas()
    assert set(ranked.model) == set(plan.LADDER)
    best = {r["series_id"]: r for r in run.best.collect()}
    for k, g in ranked.groupby("series_id"):
        assert best[k]["best_score"] == g.score.min()
        assert best[k]["best_model"] == g.sort_values(["score", "step"]).model.iloc[0]
    assert ranked.score.min() < 5  # the waves are learned
    out = plan.forecast("D", KEYS, run).toPandas()
    sizes = out.groupby(["series_id", "horizon_label"]).size().to_dict()
    assert sizes == {(s, h): n for s in ("s0", "s1", "s2") for h, n in (("30d", 30), ("90d", 90))}
    assert (out.lower <= out.upper).all()
    rep = plan.report(KEYS, run).toPandas()
    assert len(rep) == 3 and rep.models_tried.map(len).eq(4).all()
    assert isinstance(rep, pd.DataFrame)


def test_gapped_and_short_series_keep_every_row_and_step(spark, daily_pdf):
    gapped = daily_pdf[(daily_pdf.series_id != "s0") | (daily_pdf.ts.dt.dayofweek < 5)]
    short = daily_pdf[daily_pdf.series_id == "s1"].head(4).assign(series_id="short")
    d = spark.createDataFrame(pd.concat([gapped, short]), SCHEMA)
    ladder = ("seasonal_ar", "seasonal_ar_x", "trend_season", "naive", "snaive", "moving_average")
    run = plan.backtest(d, "D", KEYS, ladder)
    counts = run.predictions.toPandas().groupby(["series_id", "model"]).size().unstack()
    for k in ("s0", "s1", "s2"):
        assert counts.loc[k, list(ladder)].nunique() == 1
    out = plan.forecast("D", KEYS, run, "30d").toPandas()
    assert out.groupby("series_id").size().to_dict() == {k: 30 for k in ("s0", "s1", "s2", "short")}
    assert out.forecast.notna().all()


@pytest.mark.parametrize("name, value", [("naive", lambda y: y.iloc[-1]), ("moving_average", lambda y: y.tail(30).mean())])
def test_a_baseline_that_wins_makes_its_own_forecast(daily, daily_pdf, name, value):
    run = plan.backtest(daily, "D", KEYS, (name,))
    out = plan.forecast("D", KEYS, run, "30d").toPandas()
    for k, g in daily_pdf.groupby("series_id"):
        assert abs(out[out.series_id == k].forecast - value(g.sort_values("ts").y)).max() < 1e-9
    assert set(out.model) == {name} and not out.fallback.any()


def test_run_report_tries_all_models(spark):
    import json

    from catalog import whole_runs
    from tidewright.plans import forecasting

    rows = whole_runs.run_report(spark, "/root/testdata/sf0.001").collect()
    assert rows
    for r in rows:
        assert {x["model"] for x in json.loads(r.models_tried)} == {*forecasting.BASELINES, *forecasting.LADDER}


def test_holidays_in_the_run(spark):
    """Days off cost half the value; a run that knows the country sees them coming."""
    from dateutil.easter import easter

    days = pd.date_range("2018-01-01", "2021-12-20")
    off = {pd.Timestamp(easter(y)) + pd.Timedelta(days=k) for y in range(2018, 2023) for k in (-2, 1, 39, 50)}
    off |= {pd.Timestamp(y, m, d) for y in range(2018, 2023) for m, d in ((1, 1), (5, 1), (10, 3), (12, 25), (12, 26))}
    rng = np.random.default_rng(2)
    y = (100 + 10 * np.sin(2 * np.pi * np.arange(len(days)) / 7) + rng.normal(0, 0.5, len(days))) * np.where(days.isin(list(off)), 0.5, 1.0)
    series = spark.createDataFrame(pd.DataFrame({"series_id": "a", "ts": days, "y": y}), SCHEMA)
    error = {}
    for country in (None, "DE"):
        run = plan.backtest(series, "D", ["series_id"], ladder=["trend_season"], country=country)
        p = plan.forecast("D", ["series_id"], run).where("horizon_label = '30d'").toPandas().set_index("ts")["forecast"]
        error[country] = abs(p[pd.Timestamp("2021-12-25")] - 50)
        assert abs(p[pd.Timestamp("2022-01-12")] - 100) < 15
    assert error["DE"] < 15 < error[None]
