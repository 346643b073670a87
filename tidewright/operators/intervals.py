"""Uncertainty around forecasts, and adjustments to their level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.expressions import clip_non_negative
from tidewright.operators.layout import by_series
from tidewright.operators.quantiles import exact_quantiles, percentile

# Calibration rows, blend weight of the model, fallback bounds.
CALIBRATION_ROWS = 12
MODEL_WEIGHT = 0.2
FALLBACK = (0.9, 1.1)
BOOTSTRAP_MIN = 20


def conformal(
    valid: DataFrame,
    future: DataFrame,
    keys: Sequence[str],
    alpha: float = 0.1,
    y: str = "y",
    yhat: str = "yhat",
    forecast: str = "forecast",
    gridded: bool = True,
) -> DataFrame:
    """Forecast plus and minus the (1 - alpha) quantile of absolute validation
    residuals. Series without residuals get proportional bounds."""
    r = valid.select(*keys, F.abs(F.col(y) - F.col(yhat)).alias("_r"))
    if gridded:
        q = r.groupBy(*keys).agg(percentile("_r", 1 - alpha).alias("_w"))
    else:
        q = exact_quantiles(r, keys, "_r", [1 - alpha], out="_w").withColumn("_w", F.col("_w")[0])
    d = future.join(q, list(keys), "left")
    return d.withColumns({
        "lower": F.coalesce(F.col(forecast) - F.col("_w"), F.col(forecast) * FALLBACK[0]),
        "upper": F.coalesce(F.col(forecast) + F.col("_w"), F.col(forecast) * FALLBACK[1]),
    }).drop("_w")


def bootstrap(
    valid: DataFrame,
    future: DataFrame,
    keys: Sequence[str],
    ts: str = "ts",
    draws: int = 500,
    alpha: float = 0.05,
    seed: int = 42,
    y: str = "y",
    yhat: str = "yhat",
    forecast: str = "forecast",
    step: str = "step",
) -> DataFrame:
    """Percentile bounds from residuals drawn with replacement.

    The draw for (step, i) is a hash of step, i and seed, so the result does not
    depend on partitioning or retries. A series' validation residuals (at most
    its validation rows) travel once as an array and each forecast row simulates
    in place: no draws-by-steps table is ever shuffled.
    """
    pool = valid.where(F.col(y).isNotNull() & F.col(yhat).isNotNull()).groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(ts, (F.col(y) - F.col(yhat)).alias("r")))), lambda s: s["r"]).alias("_pool")
    )
    d = future.join(pool, list(keys), "left")
    n = F.size("_pool")
    pick = lambda i: F.pmod(F.xxhash64(F.col(step).cast("long"), i.cast("long"), F.lit(seed).cast("long")), n).cast("int")
    sims = F.array_sort(F.transform(F.sequence(F.lit(1), F.lit(draws)), lambda i: F.get("_pool", pick(i))))
    d = d.withColumn("_sims", F.when(n >= BOOTSTRAP_MIN, sims))
    return d.withColumns({
        "lower": F.col(forecast) + _sorted_quantile(F.col("_sims"), alpha / 2, draws),
        "upper": F.col(forecast) + _sorted_quantile(F.col("_sims"), 1 - alpha / 2, draws),
    }).drop("_pool", "_sims")


def _sorted_quantile(values: Column, p: float, n: int) -> Column:
    rank = (n - 1) * p
    lo = int(rank)
    hi = min(lo + 1, n - 1)
    return F.get(values, F.lit(lo)) + (F.get(values, F.lit(hi)) - F.get(values, F.lit(lo))) * (rank - lo)


def level_scale(
    fitted: DataFrame, keys: Sequence[str], ts: str = "ts", y: str = "y", yhat: str = "yhat", last: int = CALIBRATION_ROWS
) -> DataFrame:
    """Recent actual level over recent fitted level, 1 where the latter is not positive."""
    back = F.row_number().over(by_series(keys, F.col(ts).desc()))
    recent = fitted.withColumn("_back", back).where(F.col("_back") <= last)
    a, f = F.avg(y), F.avg(yhat)
    return recent.groupBy(*keys).agg(F.coalesce(F.when(f > 0, a / F.nullif(f, F.lit(0.0))), F.lit(1.0)).alias("scale"))


def calibrate_level(
    future: DataFrame, scale: DataFrame, keys: Sequence[str], columns: Sequence[str] = ("forecast", "lower", "upper")
) -> DataFrame:
    d = future.join(scale, list(keys), "left").withColumn("scale", F.coalesce("scale", F.lit(1.0)))
    return d.withColumns({c: F.col(c) * F.col("scale") for c in columns}).drop("scale")


def blend(
    future: DataFrame,
    seasonal: str = "snaive",
    columns: Sequence[str] = ("forecast", "lower", "upper"),
    weight: float = MODEL_WEIGHT,
) -> DataFrame:
    """Weighted mean of the model and the seasonal-naive column."""
    mix = lambda c: F.when(F.col(seasonal).isNull(), F.col(c)).otherwise(F.col(c) * weight + F.col(seasonal) * (1 - weight))
    return future.withColumns({c: mix(c) for c in columns})


def clip_forecast(df: DataFrame, columns: Sequence[str] = ("forecast", "lower", "upper")) -> DataFrame:
    return df.withColumns({c: clip_non_negative(F.col(c)) for c in columns})
