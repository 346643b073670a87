"""Back-test a ladder of models, pick the best per series, forecast, monitor."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions import frequency as fq
from tidewright.functions import holidays
from tidewright.models import boosted, naive, seasonal_ar, trend_season
from tidewright.operators import evaluate as ev
from tidewright.operators import intervals as iv
from tidewright.operators import monitor
from tidewright.operators.features import calendar_features
from tidewright.operators.layout import by_series
from tidewright.session import cut_lineage

LADDER = ("seasonal_ar", "seasonal_ar_x", "trend_season", "boosted")
EXOG = ("is_weekend", "sin_annual", "cos_annual")


BASELINES = ("naive", "snaive", "moving_average")
AVERAGED = 30  # rows of the moving average


@dataclass
class Run:
    """Results of one back-test; all later steps read the series stored here."""

    series: DataFrame  # keys, ts, y
    predictions: DataFrame  # keys, ts, y, model, yhat: models that predicted every validation row
    scores: DataFrame  # keys, model, metric, value
    ranked: DataFrame  # keys, model, score, improvement, is_best
    best: DataFrame  # keys, best_model, best_score, fallback: one row for every series
    metric: DataFrame  # keys, primary_metric
    boosted_model: object = None
    priors: DataFrame | None = None  # keys, prior
    country: str | None = None  # whose holidays the trend knows


def _season(freq: str) -> int:
    # one week for daily data, else the frequency's own cycle
    return fq.frequency(freq).season


def _design(freq: str, country: str | None) -> trend_season.Design:
    return trend_season.Design.for_frequency(freq, holiday="is_holiday") if country else trend_season.Design.for_frequency(freq)


def _with_holidays(df: DataFrame, country: str | None) -> DataFrame:
    if country is None:
        return df
    return holidays.flag(df.withColumn("_country", F.lit(country)), [country], "_country").drop("_country")


def _ar(df: DataFrame, freq: str, steps: int, keys: Sequence[str], features: bool, future: DataFrame | None = None) -> DataFrame:
    if not features:
        return seasonal_ar.forecast(df, freq, steps, keys, season=_season(freq), future=future)
    known = future.select(*keys, "ts") if future is not None else naive.future_spine(df, freq, steps, keys)
    return seasonal_ar.forecast(
        calendar_features(df), freq, steps, keys, season=_season(freq), exog=list(EXOG), exog_future=calendar_features(known), future=future
    )


def backtest(
    series: DataFrame, freq: str, keys: Sequence[str], ladder: Sequence[str] = LADDER, boosting: dict | None = None,
    tune_prior: bool = False, country: str | None = None,
) -> Run:
    """Score every model of the ladder on each series' validation rows.

    ``country`` gives the trend-and-season model that country's public holidays.

    ``tune_prior`` chooses the trend's flexibility per series by cross-validation
    on its training rows; series too short for a fold keep the default.

    All models are scored on the same rows: each predicts every validation row, by
    position where it counts steps. A model that leaves one out has failed for
    that series. A series where every model fails falls back on the seasonal
    naive, or on the last value if it is shorter than a season.
    """
    keys = list(keys)
    # every model reads the regular series, which is small beside the raw rows
    series = cut_lineage(series.select(*keys, "ts", "y"))
    split = ev.train_valid_split(series, freq, keys)
    train = split.where("split = 'train'").drop("split")
    valid = split.where("split = 'valid'").drop("split").withColumn("step", F.row_number().over(by_series(keys, "ts")))
    steps = fq.frequency(freq).valid_cap
    run_model = priors = None
    parts = []
    for name in ladder:
        if name in ("seasonal_ar", "seasonal_ar_x"):
            p = _ar(train, freq, steps, keys, name.endswith("_x"), valid.select(*keys, "ts", "step"))
            p = p.select(*keys, "ts", F.col("forecast").alias("yhat"))
        elif name == "trend_season":
            design = _design(freq, country)
            known = _with_holidays(train, country)
            if tune_prior:
                priors = cut_lineage(trend_season.choose_prior(trend_season.prior_scores(known, freq, keys, design=design), keys))
            p = trend_season.predict(_with_holidays(valid.drop("step"), country), trend_season.fit(known, design, keys, priors=priors), design, keys)
            p = p.select(*keys, "ts", F.col("forecast").alias("yhat"))
        elif name == "boosted":
            table = cut_lineage(boosted.training_table(split, keys))
            run_model = boosted.train(table, **(boosting or {}))
            p = boosted.predict(table.where("split = 'valid'"), run_model).select(*keys, "ts", "yhat")
        elif name in BASELINES:
            p = naive.naive_validation(split, _season(freq), keys, window=AVERAGED).where(F.col("model") == name).select(*keys, "ts", "yhat")
        else:
            raise ValueError(f"unknown model {name!r}")
        parts.append(valid.drop("step").join(p, [*keys, "ts"], "left").withColumn("model", F.lit(name)))
    # scored, ranked and used for intervals: fitted once
    predictions = cut_lineage(reduce(DataFrame.unionByName, parts))
    by = [*keys, "model"]
    failed = predictions.where("yhat is null or isnan(yhat)").select(*by).distinct()
    predictions = predictions.join(failed, by, "left_anti").select(*keys, "ts", "y", "model", "yhat")
    scores = ev.tidy(ev.score(predictions, by), by)
    metric = ev.choose_metric(series, keys).select(*keys, "primary_metric")
    primary = scores.join(metric, keys).where("metric = primary_metric").select(*by, F.col("value").alias("score"))
    ranked = ev.rank_models(primary, ladder, keys)
    won = ev.best_model(primary, ladder, keys)
    fallback = F.when(F.col("_n") >= _season(freq), "snaive").otherwise("naive")
    best = series.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).join(won, keys, "left").select(
        *keys, F.coalesce("best_model", fallback).alias("best_model"), "best_score", F.col("best_model").isNull().alias("fallback"))
    return Run(series, predictions, scores, ranked, cut_lineage(best), metric, run_model, priors, country)


def forecast(freq: str, keys: Sequence[str], run: Run, horizon_label: str | None = None) -> DataFrame:
    """Refit each series' best model on its whole history and forecast.

    Monthly trend-season forecasts are levelled and blended with the seasonal
    naive; baselines and boosted forecasts get conformal bounds from their own
    validation rows. Every series has every step: what a refitted model cannot
    give is the last value, marked as fallback.
    """
    keys = list(keys)
    f = fq.frequency(freq)
    horizons = [h for h in f.horizons if horizon_label in (None, h[0])]
    steps = max(h for _, h in horizons)
    winners = sorted(r["best_model"] for r in run.best.select("best_model").distinct().collect())  # at most the ladder and the baselines
    future = naive.future_spine(run.series, freq, steps, keys)
    parts = []
    for name in winners:
        mine = run.series.join(run.best.where(F.col("best_model") == name).select(*keys), keys, "left_semi")
        out = _refitted(name, mine, freq, steps, keys, run)
        parts.append(out.select(*keys, "step", "forecast", "lower", "upper").withColumn("model", F.lit(name)))
    last = run.series.where("y is not null").groupBy(*keys).agg(F.max_by("y", "ts").alias("_last"))
    known = future.join(run.best.select(*keys, "fallback"), keys).join(last, keys, "left")
    if parts:
        known = known.join(reduce(DataFrame.unionByName, parts), [*keys, "step"], "left")
    missing = F.col("forecast").isNull() | F.isnan("forecast")
    value = F.when(missing, F.col("_last")).otherwise(F.col("forecast"))
    every = known.select(
        *keys, "ts", "step", value.alias("forecast"),
        F.when(missing, value * iv.FALLBACK[0]).otherwise(F.coalesce("lower", value * iv.FALLBACK[0])).alias("lower"),
        F.when(missing, value * iv.FALLBACK[1]).otherwise(F.coalesce("upper", value * iv.FALLBACK[1])).alias("upper"),
        F.when(missing, "naive").otherwise(F.col("model")).alias("model"), (F.col("fallback") | missing).alias("fallback"))
    labels = F.array(*[F.struct(F.lit(n).alias("horizon_label"), F.lit(h).alias("_h")) for n, h in horizons])
    return every.select(*every.columns, F.inline(labels)).where(F.col("step") <= F.col("_h")).drop("_h")


def _refitted(name: str, mine: DataFrame, freq: str, steps: int, keys: list[str], run: Run) -> DataFrame:
    """Forecast of one model for the series that it won."""
    if name in ("seasonal_ar", "seasonal_ar_x"):
        return _ar(mine, freq, steps, keys, name.endswith("_x"))
    if name == "trend_season":
        return _trend(mine, freq, steps, keys, run.priors, run.country)
    if name == "boosted":
        # as many rounds as validation chose, on all rows
        table = cut_lineage(boosted.training_table(run.series.withColumn("split", F.lit("train")), keys))
        model = boosted.train(table, patience=None, maxIter=run.boosted_model.getNumTrees)
        out = boosted.forecast(mine, table, model, freq, steps, keys)
    elif name == "snaive":
        out = naive.seasonal_naive(mine, freq, steps, keys, season=_season(freq))
    elif name == "naive":
        out = naive.level_forecast(mine, freq, steps, keys)
    elif name == "moving_average":
        out = naive.level_forecast(mine, freq, steps, keys, window=AVERAGED)
    else:
        raise ValueError(f"unknown model {name!r}")
    return iv.conformal(run.predictions.where(F.col("model") == name), out, keys)


def _trend(
    df: DataFrame, freq: str, steps: int, keys: Sequence[str], priors: DataFrame | None = None, country: str | None = None
) -> DataFrame:
    design = _design(freq, country)
    df = _with_holidays(df, country)
    model = trend_season.fit(df, design, keys, priors=priors)
    out = trend_season.predict(_with_holidays(naive.future_spine(df, freq, steps, keys), country), model, design, keys)
    if fq.frequency(freq).label != "MS":
        return out
    scale = iv.level_scale(trend_season.fitted(df, model, design, keys), keys)
    out = iv.calibrate_level(out, scale, keys)
    # a series shorter than a year has no season to blend with
    long = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n >= 12").select(*keys)
    return iv.blend(naive.with_seasonal_naive(out, df.join(long, list(keys), "left_semi"), 12, keys)).drop("snaive")


def report(keys: Sequence[str], run: Run) -> DataFrame:
    """One nested row per series: winner, ladder, metrics of all models, drift of the recent rows."""
    keys = list(keys)
    entry = F.struct("step", "model", "score", "is_best")
    ladder = run.ranked.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("models_tried"))
    metrics = run.scores.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("model", "metric", "value"))).alias("metrics"))
    drift = monitor.recent_drift(run.series, keys).select(*keys, F.col("psi").alias("drift_psi"))
    best = run.best.join(run.priors.select(*keys, "prior"), keys, "left") if run.priors is not None else run.best
    return best.join(run.metric, keys, "left").join(ladder, keys, "left").join(metrics, keys, "left").join(drift, keys, "left")
