"""Forecasts that need no fitting: future grid, naive, seasonal-naive, average."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions import frequency as fq
from tidewright.operators.layout import by_series, whole_series


def horizon_table(freq: Column) -> Column:
    """Array of (horizon_label, horizon) for a frequency label column."""
    entry = lambda f: F.array(*[F.struct(F.lit(n).alias("horizon_label"), F.lit(k).alias("horizon")) for n, k in f.horizons])
    return fq.by_label(freq, entry)


def future_spine(df: DataFrame, freq: str, horizon: int | Column, keys: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """The ``horizon`` grid slots after each series' last row, with ``step``."""
    ends = df.groupBy(*keys).agg(F.max(ts).alias("_end"))
    h = horizon if isinstance(horizon, Column) else F.lit(horizon)
    steps = ends.select(*keys, "_end", F.explode_outer(F.sequence(F.lit(1), h)).alias("step"))
    return steps.select(*keys, fq.add_steps(F.col("_end"), F.col("step"), freq).alias(ts), "step")


def seasonal_tail(df: DataFrame, season: int, keys: Sequence[str] = (), ts: str = "ts", y: str = "y") -> DataFrame:
    """The last season of each series: ``slot`` 0 is the oldest of its rows."""
    back = F.row_number().over(by_series(keys, F.col(ts).desc()))
    d = df.withColumn("_back", back).where(F.col("_back") <= season)
    return d.select(*keys, (F.lit(season) - F.col("_back")).alias("slot"), F.col(y).alias("snaive"))


def with_seasonal_naive(
    future: DataFrame, df: DataFrame, season: int, keys: Sequence[str] = (), ts: str = "ts", y: str = "y"
) -> DataFrame:
    """Each future step takes the value at the same place of the last season."""
    slot = F.pmod(F.col("step") - 1, F.lit(season)).cast("int")
    return future.withColumn("slot", slot).join(seasonal_tail(df, season, keys, ts, y), [*keys, "slot"], "left").drop("slot")


def seasonal_naive(df: DataFrame, freq: str, horizon: int, keys: Sequence[str] = (), ts: str = "ts", y: str = "y", season: int | None = None) -> DataFrame:
    season = season or fq.frequency(freq).season
    future = future_spine(df, freq, horizon, keys, ts)
    return with_seasonal_naive(future, df, season, keys, ts, y).withColumnRenamed("snaive", "forecast")


def level_forecast(
    df: DataFrame, freq: str, horizon: int, keys: Sequence[str] = (), ts: str = "ts", y: str = "y", window: int = 1
) -> DataFrame:
    """Every step takes the mean of the last ``window`` rows (1: the last value)."""
    back = F.row_number().over(by_series(keys, F.col(ts).desc()))
    recent = df.withColumn("_back", back).where(F.col("_back") <= window)
    level = recent.groupBy(*keys).agg(F.avg(y).alias("forecast"))
    future = future_spine(df, freq, horizon, keys, ts)
    return future.join(level, list(keys)) if keys else future.withColumn("forecast", F.lit(level.first()["forecast"]))


def naive_validation(df: DataFrame, season: int, keys: Sequence[str] = (), ts: str = "ts", y: str = "y", window: int = 30) -> DataFrame:
    """Validation predictions of three baselines, from a frame with ``split``.

    naive: last training value; snaive: last training season repeated;
    moving_average: mean of the last training rows. All from one shuffle by
    series; the tail kept per row is a season or a window long.
    """
    w = by_series(keys, ts)
    series = whole_series(keys)
    in_train = F.col("split") == "train"
    keep = max(season, window)
    d = df.withColumns({"_n": F.sum(in_train.cast("int")).over(series), "_rn": F.row_number().over(w)})
    # the last rows of training, at most ``keep`` of them, oldest first
    recent = F.when(in_train & (F.col("_rn") > F.col("_n") - keep), F.struct(F.col("_rn"), F.col(y).alias("v")))
    tail = F.transform(F.array_sort(F.collect_list(recent).over(series)), lambda s: s["v"])
    d = d.withColumn("_tail", tail).where(~in_train)
    size = F.size("_tail")
    slot = F.pmod(F.col("_rn") - F.col("_n") - 1, F.lit(season))
    last = F.slice("_tail", F.greatest(F.lit(1), size - window + 1), F.lit(window))
    mean = F.aggregate(last, F.lit(0.0), lambda s, x: s + x) / F.nullif(F.size(last), F.lit(0))
    models = {
        "naive": F.get("_tail", size - 1),
        "snaive": F.when(size >= season, F.get("_tail", (size - season + slot).cast("int"))),
        "moving_average": mean,
    }
    long = F.array(*[F.struct(F.lit(m).alias("model"), v.alias("yhat")) for m, v in models.items()])
    return d.select(*keys, ts, y, F.explode(long).alias("_m")).select(*keys, ts, y, "_m.model", "_m.yhat")
