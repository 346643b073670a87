"""Exact quantiles that do not gather a group in one task.

The builtin ``percentile`` keeps every distinct value of a group in one
aggregation buffer. That is fine for gridded series; for raw observations a
single hot key would not fit. ``exact_quantiles`` instead brackets each target
rank with a mergeable sketch, counts the rows below the bracket, and sorts only
the few rows inside it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators.layout import spread_join


def percentile(y: Column | str, probs: float | Sequence[float]) -> Column:
    """Linear-interpolation quantile aggregate (for bounded groups)."""
    col = F.col(y) if isinstance(y, str) else y
    if isinstance(probs, (int, float)):
        return F.percentile(col, F.lit(float(probs)))
    return F.percentile(col, F.array(*[F.lit(float(p)) for p in probs]))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    y: str,
    probs: Sequence[float],
    out: str = "q",
    accuracy: int = 10_000,
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per key: array ``out`` of linear-interpolation quantiles (NULL for
    a key without values), and the ``carry`` aggregates taken in the first pass.

    Two passes over the column, one small shuffle each: the raw rows are not
    shuffled unless the per-key sketches are too many to broadcast, and then a
    hot key is spread over many tasks.
    """
    probs, carry = [float(p) for p in probs], dict(carry or {})
    margin = 4.0 / accuracy
    edges = [max(0.0, p - margin) for p in probs] + [min(1.0, p + margin) for p in probs]
    k = len(probs)
    rows = df.withColumn("_y", F.col(y).cast("double"))
    if not keys:
        rows = rows.withColumn("_all", F.lit(1))
    group = list(keys) or ["_all"]

    sketch = rows.groupBy(*group).agg(
        F.count("_y").alias("_n"),
        F.percentile_approx("_y", edges, accuracy).alias("_e"),
        F.struct(F.lit(True).alias("_"), *[c.alias(name) for name, c in carry.items()]).alias("_carry"),
    )
    # One entry per target the row matters to: its value inside the bracket,
    # NULL when it only counts as "below". Groups no larger than the sketch keep
    # all their rows as candidates: the bracket is only sure to hold the rank
    # when it spans several rows. Missing values only keep their key alive.
    small = F.col("_n") <= accuracy
    entries = [F.when(F.col("_y").isNull(), F.struct(F.lit(-1).alias("i"), F.lit(None).cast("double").alias("v")))]
    for i in range(k):
        low = F.lit(True) if edges[i] <= 0.0 else small | (F.col("_y") >= F.col("_e")[i])
        high = F.lit(True) if edges[k + i] >= 1.0 else small | (F.col("_y") <= F.col("_e")[k + i])
        known = F.col("_y").isNotNull() & high
        entries.append(F.when(known, F.struct(F.lit(i).alias("i"), F.when(low, F.col("_y")).alias("v"))))
    counted = (
        spread_join(rows, sketch, group)
        .select(*group, "_n", "_carry", F.explode(F.array(*entries)).alias("_s"))
        .where("_s is not null")
        .groupBy(*group, F.col("_s.i").alias("_i"), F.col("_s.v").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"), F.first("_n").alias("_n"), F.first("_carry").alias("_carry"))
    )
    upto = Window.partitionBy(*group, "_i").orderBy(F.col("_v").asc_nulls_first())
    real = F.col("_i") >= 0
    prob = F.element_at(F.array(*[F.lit(p) for p in probs]), F.greatest(F.lit(1), F.col("_i") + 1))
    rank = (F.col("_n") - 1) * prob
    lo, hi = F.floor(rank), F.ceil(rank)
    seen = F.col("_seen")
    holds = lambda r: F.col("_v").isNotNull() & (seen - F.col("_c") <= r) & (r < seen)
    # a bracket that misses its rank must fail loudly, never answer wrongly
    missed = F.raise_error(F.lit("quantile bracket missed its rank")).cast("double")
    sure = lambda c: F.when(real, F.coalesce(F.col(c), missed))
    value = sure("_lo") + (sure("_hi") - sure("_lo")) * F.col("_frac")
    picked = (
        counted.withColumn("_seen", F.sum("_c").over(upto))
        .groupBy(*group, "_i")
        .agg(
            F.max(F.when(holds(lo), F.col("_v"))).alias("_lo"),
            F.max(F.when(holds(hi), F.col("_v"))).alias("_hi"),
            F.first(rank - lo).alias("_frac"),
            F.first("_carry").alias("_carry"),
        )
    )
    packed = picked.groupBy(*group).agg(
        F.array_sort(F.collect_list(F.when(real, F.struct(F.col("_i"), value.alias("v"))))).alias("_p"),
        F.first("_carry").alias("_carry"),
    )
    values = F.when(F.size("_p") > 0, F.transform("_p", lambda s: s["v"]))
    return packed.select(*keys, values.alias(out), *[F.col(f"_carry.{name}").alias(name) for name in carry])
