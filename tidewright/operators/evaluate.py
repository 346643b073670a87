"""Splits, folds, error metrics, model choice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions import frequency as fq
from tidewright.functions.expressions import METRICS
from tidewright.operators.layout import by_series, spread_join, whole_series
from tidewright.operators.quantiles import exact_quantiles, percentile
from tidewright.operators.profile import join_per_key


# ------------------------------------------------------------------- splits

def valid_size(n: Column, cap: Column | int, min_train: Column | int) -> Column:
    """Rows held out from ``n``: a quarter up to the cap, a fifth when that
    leaves too little, and never so many that training falls short."""
    cap = cap if isinstance(cap, Column) else F.lit(cap)
    need = min_train if isinstance(min_train, Column) else F.lit(min_train)
    quarter = F.least(cap, F.floor(n / 4))
    held = F.when(n < need + quarter, F.greatest(F.lit(1), F.floor(n / 5))).otherwise(quarter)
    return F.when(n - held < need, F.greatest(F.lit(1), n - need)).otherwise(held).cast("long")


def train_valid_split(df: DataFrame, freq: str, keys: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """Adds ``split``; the most recent rows of each series validate."""
    f = fq.frequency(freq)
    n = F.count(F.lit(1)).over(whole_series(keys))
    back = F.row_number().over(by_series(keys, F.col(ts).desc()))
    held = valid_size(n, f.valid_cap, f.min_train)
    return df.withColumn("split", F.when(back <= held, "valid").otherwise("train"))


def fold_table(
    df: DataFrame, keys: Sequence[str] = (), initial: int = 200, horizon: int = 30, stride: int = 30, min_train: int = 100
) -> DataFrame:
    """Rolling-origin folds of each series: training rows 1..train_end_rn,
    validation up to valid_end_rn."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    last = F.floor((F.col("_n") - horizon - initial) / stride)
    folds = F.when(last >= 0, F.sequence(F.lit(0), last.cast("int"))).otherwise(F.array().cast("array<int>"))
    out = sizes.select(*keys, F.explode(folds).alias("fold"))
    if initial < min_train:
        out = out.where(F.lit(False))
    start = (F.lit(initial) + F.col("fold") * stride).cast("long")
    return out.withColumns({"train_end_rn": start, "valid_end_rn": start + horizon})


def rolling_origin(
    df: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "ts",
    initial: int = 200,
    horizon: int = 30,
    stride: int = 30,
    min_train: int = 100,
    splits: Sequence[str] = ("train", "valid"),
) -> DataFrame:
    """Fold membership of every row: ``fold`` and ``split``.

    The folds a row belongs to follow from its number, so rows are expanded in
    place; there is no range join against a fold table.
    """
    n, rn = F.col("_n"), F.col("_rn")
    d = df.withColumns({
        "_n": F.count(F.lit(1)).over(whole_series(keys)),
        "_rn": F.row_number().over(by_series(keys, ts)),
    })
    last = F.floor((n - horizon - initial) / stride)
    if initial < min_train:
        last = F.lit(-1)
    # fold k trains on rn <= initial + k*stride
    first_train = F.greatest(F.lit(0), F.ceil((rn - initial) / stride))
    first_valid = F.greatest(F.lit(0), F.ceil((rn - horizon - initial) / stride))
    last_valid = F.least(last, F.ceil((rn - initial) / stride) - 1)
    none = F.array().cast("array<struct<fold:int,split:string>>")

    def members(a: Column, b: Column, split: str) -> Column:
        if split not in splits:
            return none
        as_fold = lambda k: F.struct(k.alias("fold"), F.lit(split).alias("split"))
        return F.when(a <= b, F.transform(F.sequence(a.cast("int"), b.cast("int")), as_fold)).otherwise(none)

    both = F.concat(members(first_train, last, "train"), members(first_valid, last_valid, "valid"))
    out = d.withColumn("_m", F.explode(both))
    return out.select(*df.columns, F.col("_m.fold").alias("fold"), F.col("_m.split").alias("split"))


def cv_windows(df: DataFrame, freq: str, keys: Sequence[str] = (), ts: str = "ts", min_rows: int = 50) -> DataFrame:
    """Time-based cross-validation cut-offs: back from the last horizon, one
    period at a time, while the initial span still fits.

    A series needs more than ``min_rows`` rows and, up to weekly frequency, a
    span of initial + horizon days.
    """
    f = fq.frequency(freq)
    initial, period, horizon = f.cv_days
    ends = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_a"), F.max(ts).alias("_b"))
    day = lambda k: F.make_dt_interval(F.lit(k) if isinstance(k, int) else k.cast("int"))
    span = F.floor(fq.seconds_between(F.col("_a"), F.col("_b")) / 86400)
    ok = F.col("_n") > min_rows
    if f.unit != "month":
        ok = ok & (fq.seconds_between(F.col("_a"), F.col("_b")) >= (initial + horizon) * 86400)
    last = F.floor((span - horizon - initial) / period)
    steps = F.when(ok & (last >= 0), F.sequence(F.lit(0), last.cast("int"))).otherwise(F.array().cast("array<int>"))
    out = ends.select(*keys, "_b", F.explode(steps).alias("fold"))
    cutoff = (F.col("_b") - day(horizon) - day(F.col("fold") * period)).cast("timestamp_ntz")
    out = out.withColumn("cutoff", cutoff)
    return out.select(*keys, "fold", "cutoff", (F.col("cutoff") + day(horizon)).cast("timestamp_ntz").alias("valid_until"))


# ------------------------------------------------------------------ metrics

def score(
    preds: DataFrame, by: Sequence[str], metrics: Sequence[str] = tuple(METRICS), y: str = "y", yhat: str = "yhat"
) -> DataFrame:
    """One row per group, one column per metric, in a single aggregation."""
    return preds.groupBy(*by).agg(*[METRICS[m](F.col(y), F.col(yhat)).alias(m) for m in metrics])


def tidy(scores: DataFrame, by: Sequence[str], metrics: Sequence[str] = tuple(METRICS)) -> DataFrame:
    return scores.unpivot(list(by), list(metrics), "metric", "value")


def match_predictions(actual: DataFrame, preds: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Actuals joined to predictions on series and time."""
    return actual.join(preds, [*keys, ts])


def choose_metric(df: DataFrame, keys: Sequence[str] = (), y: str = "y", gridded: bool = True) -> DataFrame:
    """Primary error metric per series from its zeros, spread and tail.

    Many zeros or near-zero values: smape. Wide spread or a heavy tail: rmse.
    Otherwise mape. wmape always comes along.
    """
    col = F.col(y)
    if gridded:
        d = df.withColumn("_mean", F.avg(col).over(whole_series(keys)))
        moments = d.groupBy(*keys).agg(*_metric_moments(col), percentile(y, [0.5, 0.95]).alias("_q"))
    else:
        mean = df.groupBy(*keys).agg(F.avg(col).alias("_mean"))
        d = spread_join(df, mean, keys) if keys else df.withColumn("_mean", F.lit(mean.first()["_mean"]))
        moments = join_per_key(
            d.groupBy(*keys).agg(*_metric_moments(col)), exact_quantiles(df, keys, y, [0.5, 0.95], out="_q"), keys
        )
    p50, p95 = F.col("_q")[0], F.col("_q")[1]
    cv = F.when(F.col("_m") > 0, F.col("_sd") / F.nullif(F.col("_m"), F.lit(0.0)))
    heavy_tail = F.when(p50 != 0, p95 / F.nullif(p50, F.lit(0.0)) > 5).otherwise(p95 > 0)
    wide = F.when(F.col("_m") > 0, cv > 1.5).otherwise(F.lit(True))
    primary = (
        F.when((F.col("zero_frac") > 0.1) | (F.col("near_zero_frac") > 0.2), "smape")
        .when(wide | heavy_tail, "rmse").otherwise("mape")
    )
    return moments.select(
        *keys, "zero_frac", "near_zero_frac", cv.alias("cv"), primary.alias("primary_metric"),
        F.array(primary, F.lit("wmape")).alias("metrics"),
    )


def _metric_moments(col: Column) -> list[Column]:
    n = F.count(F.lit(1))
    return [
        (F.count_if(col == 0) / n).alias("zero_frac"),
        (F.count_if(col < F.col("_mean") * 0.1) / n).alias("near_zero_frac"),
        F.avg(col).alias("_m"), F.stddev_samp(col).alias("_sd"),
    ]


def against_targets(scores: DataFrame, targets: Mapping[str, float]) -> DataFrame:
    """Tidy scores with their target and whether it is met."""
    limit = None
    for metric, value in targets.items():
        test = F.col("metric") == metric
        limit = F.when(test, float(value)) if limit is None else limit.when(test, float(value))
    return scores.withColumn("target", limit).where("target is not null").withColumn("passed", F.col("value") <= F.col("target"))


def interval_coverage(df: DataFrame, by: Sequence[str], y: str = "y", lower: str = "lower", upper: str = "upper") -> DataFrame:
    inside = F.col(y).between(F.col(lower), F.col(upper))
    return df.groupBy(*by).agg(F.avg(inside.cast("int")).alias("coverage"))


# -------------------------------------------------------------------- choice

def rank_models(scores: DataFrame, ladder: Sequence[str], keys: Sequence[str] = (), value: str = "score") -> DataFrame:
    """Walk the ladder in order: which step improved on the best so far, by how
    much, and which model wins (earlier step on ties)."""
    step = F.array_position(F.array(*[F.lit(m) for m in ladder]), F.col("model")).cast("int")
    d = scores.withColumn("step", step)
    so_far = by_series(keys, "step").rowsBetween(Window.unboundedPreceding, -1)
    best_before = F.min(value).over(so_far)
    gain = (best_before - F.col(value)) / F.nullif(best_before, F.lit(0.0)) * 100
    place = F.row_number().over(by_series(keys, F.col(value).asc_nulls_last(), "step"))
    return d.withColumns({
        "improvement_pct": gain,
        "new_best": F.coalesce(F.col(value) < best_before, F.col(value).isNotNull()),
        "is_best": (place == 1) & F.col(value).isNotNull(),
    })


def best_model(scores: DataFrame, ladder: Sequence[str], keys: Sequence[str] = (), value: str = "score") -> DataFrame:
    ranked = rank_models(scores, ladder, keys, value)
    return ranked.where("is_best").select(*keys, F.col("model").alias("best_model"), F.col(value).alias("best_score"))


def comparison_table(scores: DataFrame, ladder: Sequence[str], keys: Sequence[str] = (), value: str = "score") -> DataFrame:
    """One column per model."""
    return scores.groupBy(*keys).pivot("model", list(ladder)).agg(F.first(value))


def best_iteration(curve: DataFrame, iteration: str = "iteration", loss: str = "rmse", keys: Sequence[str] = ()) -> DataFrame:
    """Iteration with the lowest validation loss (the earliest on ties)."""
    return curve.groupBy(*keys).agg(
        F.min_by(iteration, F.struct(loss, iteration)).alias("best_iteration"), F.min(loss).alias("best_loss")
    )


def forecast_summary(forecasts: DataFrame, by: Sequence[str], ts: str = "ts", value: str = "forecast") -> DataFrame:
    return forecasts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_steps"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        F.avg(value).alias("mean_forecast"), F.min(value).alias("min_forecast"), F.max(value).alias("max_forecast"),
    )
