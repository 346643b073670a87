"""Drift between two samples and change points inside a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators.layout import by_series, spread_join
from tidewright.operators.ordered import RobustScore, scan_rows
from tidewright.operators.quantiles import exact_quantiles, percentile

# Guard inside the logarithm, sample size below which PSI is undefined.
PSI_GUARD = 1e-9
PSI_MIN_ROWS = 10


def bin_edges(baseline: DataFrame, keys: Sequence[str], y: str = "y", bins: int = 10, gridded: bool = False) -> DataFrame:
    """Inner quantile edges of the baseline, one row per series."""
    probs = [i / bins for i in range(1, bins)]
    if gridded:
        return baseline.groupBy(*keys).agg(percentile(y, probs).alias("edges"))
    return exact_quantiles(baseline, keys, y, probs, out="edges")


def _bin_index(y: str, bins: int) -> Column:
    """Number of edges at or below the value; equal edges leave empty bins."""
    return sum(((F.col("edges")[i] <= F.col(y)).cast("int") for i in range(bins - 1)), F.lit(0))


def bin_counts(sample: DataFrame, edges: DataFrame, keys: Sequence[str], y: str = "y", bins: int = 10) -> DataFrame:
    """Rows per bin as one array per series; empty bins count 0."""
    d = spread_join(sample.where(F.col(y).isNotNull()), edges, keys).withColumn("_bin", _bin_index(y, bins))
    return d.groupBy(*keys).agg(F.array(*[F.count_if(F.col("_bin") == i) for i in range(bins)]).alias("counts"))


def psi_from_counts(base: Column, now: Column) -> Column:
    """Population stability index of two count arrays."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + x)
    share = lambda a: F.transform(a, lambda x: x / F.greatest(F.lit(1), total(a)))
    terms = F.zip_with(share(base), share(now), lambda p, q: (q - p) * F.ln((q + PSI_GUARD) / (p + PSI_GUARD)))
    enough = (total(base) >= PSI_MIN_ROWS) & (total(now) >= PSI_MIN_ROWS)
    return F.when(enough, F.aggregate(terms, F.lit(0.0), lambda s, x: s + x))


def psi(
    baseline: DataFrame, current: DataFrame, keys: Sequence[str], y: str = "y", bins: int = 10, gridded: bool = False
) -> DataFrame:
    """Drift of ``current`` against ``baseline`` per series.

    Both samples are binned in one aggregation, so only bin counts are shuffled.
    """
    edges = bin_edges(baseline, keys, y, bins, gridded)
    both = baseline.withColumn("_base", F.lit(True)).unionByName(
        current.withColumn("_base", F.lit(False)), allowMissingColumns=True
    )
    d = spread_join(both.where(F.col(y).isNotNull()), edges, keys).withColumn("_bin", _bin_index(y, bins))
    counts = lambda side: F.array(*[F.count_if(side & (F.col("_bin") == i)) for i in range(bins)])
    out = d.groupBy(*keys).agg(counts(F.col("_base")).alias("base_counts"), counts(~F.col("_base")).alias("now_counts"))
    return out.withColumn("psi", psi_from_counts(F.col("base_counts"), F.col("now_counts")))


def recent_drift(
    df: DataFrame, keys: Sequence[str], ts: str = "ts", y: str = "y", span: int = 90, bins: int = 10
) -> DataFrame:
    """PSI of the last ``span`` rows against the ``span`` rows before them."""
    back = F.row_number().over(by_series(keys, F.col(ts).desc()))
    d = df.withColumn("_back", back).where(F.col("_back") <= 2 * span)
    before, now = d.where(F.col("_back") > span), d.where(F.col("_back") <= span)
    return psi(before, now, keys, y, bins, gridded=True)


def rolling_drift(
    df: DataFrame, keys: Sequence[str], ts: str = "ts", y: str = "y", span: int = 90, every: int = 30, bins: int = 10
) -> DataFrame:
    """PSI of the last ``span`` rows against the ``span`` before them, at every
    ``every``-th row of a series that has so many. A row is copied to the places whose
    spans hold it; only bin counts are shuffled after that."""
    keys = list(keys)
    d = df.withColumn("_rn", F.row_number().over(by_series(keys, ts)).cast("long"))
    first = F.greatest(F.ceil(F.col("_rn") / every), F.ceil(F.lit(2 * span) / every)).cast("long")
    last = F.floor((F.col("_rn") + 2 * span - 1) / every).cast("long")
    places = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    at = d.select(*keys, "_rn", y, F.explode(F.transform(places, lambda k: k * every)).alias("_at"))
    ends = d.where(F.col("_rn") % every == 0).select(*keys, F.col("_rn").alias("_at"), ts)
    before, now = at.where(F.col("_rn") <= F.col("_at") - span), at.where(F.col("_rn") > F.col("_at") - span)
    scored = psi(before, now, [*keys, "_at"], y, bins, gridded=True)
    return ends.where(F.col("_at") >= 2 * span).join(scored, [*keys, "_at"], "left").select(*keys, ts, F.col("_at").alias("rn"), "psi")


def mad_change_points(
    df: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "ts",
    y: str = "y",
    window: int = 30,
    threshold: float = 4.0,
    block_rows: int | None = None,
) -> DataFrame:
    """Robust rolling z-score and flag: distance from the rolling median in units of the
    rolling median absolute deviation, both over the last ``window`` rows. The cost of a row
    hardly grows with the window (see ``ordered``)."""
    done = scan_rows(df, keys, ts, y, lambda: RobustScore(window).push, "z", 2 * (window - 1), block_rows)
    return done.withColumn("is_change", F.coalesce(F.abs("z") > threshold, F.lit(False)))
