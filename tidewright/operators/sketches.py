"""Quantile sketches kept as a table and merged: one small row per series and slot.

Raw rows are read once, when their slot is sketched. Any longer span, any set of series
and any quantile is answered from the stored sketches, whose size is bounded by ``k``
whatever the number of rows. ``quantiles.exact_quantiles`` stays for exact answers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.frequency import floor_to

K = 800


def rank_error(k: int = K) -> float:
    """Distance between true and estimated rank, as a share of all rows, that one estimate
    in a hundred exceeds (fixed values: the published fit for this kind of sketch)."""
    return 2.296 / k**0.9723


def sketch_of(y: Column, k: int = K) -> Column:
    """Aggregate: sketch of the known values."""
    return F.kll_sketch_agg_double(y.cast("double"), F.lit(k))


def quantiles_of(sketch: Column, n: Column, probs: Sequence[float]) -> Column:
    """Array of quantiles: smallest values whose estimated rank reaches each share. NULL without values."""
    return F.when(n > 0, F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(p)) for p in probs])))


def sketch_slots(df: DataFrame, freq: str, keys: Sequence[str] = (), ts: str = "ts", y: str = "y", k: int = K) -> DataFrame:
    """keys, slot, ``n`` (known values), ``missing``, ``sketch`` for every slot of ``freq``
    that has rows. Rows without a time have the slot NULL."""
    col = F.col(y).cast("double")
    value = F.when(~F.isnan(col), col)
    return df.groupBy(*keys, floor_to(F.col(ts), freq).alias("slot")).agg(
        F.count(value).alias("n"), (F.count(F.lit(1)) - F.count(value)).alias("missing"), sketch_of(value, k).alias("sketch"))


def merge_slots(sketches: DataFrame, freq: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Sketches of longer slots, or of all time without ``freq``, from those of shorter
    ones; fewer ``keys`` merge series too."""
    by = [*keys, *([floor_to(F.col("slot"), freq).alias("slot")] if freq else [])]
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("missing").alias("missing"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(sketches: DataFrame, probs: Sequence[float], out: str = "q") -> DataFrame:
    """Array ``out`` of quantiles in place of each sketch."""
    return sketches.withColumn(out, quantiles_of(F.col("sketch"), F.col("n"), probs)).drop("sketch")
