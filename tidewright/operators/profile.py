"""Descriptive statistics of each series, and the data behind its charts."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators.features import rolling_stats
from tidewright.operators.layout import by_series, number_rows, spread_join, whole_series
from tidewright.operators.quantiles import exact_quantiles, percentile
from tidewright.operators.sketches import quantiles_of, sketch_of

INTERMITTENT_SHARE = 0.4
QUARTILES = (0.25, 0.5, 0.75)


def join_per_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join of two one-row-per-series frames (or one-row frames without keys)."""
    if keys:
        return left.join(right, list(keys))
    one = F.lit(1)
    return left.withColumn("_one", one).join(right.withColumn("_one", one), "_one").drop("_one")


def basic_stats(df: DataFrame, keys: Sequence[str] = (), y: str = "y", gridded: bool = True, approx: bool = False) -> DataFrame:
    """Count (missing included), moments, quartiles, variation, zeros. ``approx`` takes the
    quartiles from a sketch within the same pass (``sketches.rank_error``)."""
    col = F.col(y)
    aggs = {
        "count": F.count(F.lit(1)), "mean": F.avg(col), "std": F.stddev_samp(col),
        "min": F.min(col), "max": F.max(col), "zeros_count": F.count_if(col == 0),
    }
    if approx:
        d = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()], F.count(col).alias("_n"), sketch_of(col).alias("_s"))
        d = d.withColumn("_q", quantiles_of(F.col("_s"), F.col("_n"), QUARTILES))
    elif gridded:
        d = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()], percentile(y, QUARTILES).alias("_q"))
    else:
        d = exact_quantiles(df, keys, y, QUARTILES, out="_q", carry=aggs)
    return d.select(
        *keys, "count", "mean", "std", "min", "max",
        F.col("_q")[1].alias("median"), F.col("_q")[0].alias("p25"), F.col("_q")[2].alias("p75"),
        (F.col("std") / F.greatest(F.abs("mean"), F.lit(1e-8))).alias("cv"),
        "zeros_count", (F.col("zeros_count") * 100.0 / F.col("count")).alias("zeros_pct"),
    )


def quality(df: DataFrame, keys: Sequence[str] = (), y: str = "y") -> DataFrame:
    n = F.count(F.lit(1))
    return df.groupBy(*keys).agg(
        F.count_if(F.col(y).isNull()).alias("missing_count"),
        (F.count_if(F.col(y).isNull()) * 100.0 / n).alias("missing_pct"),
        F.count_distinct(F.col(y)).alias("unique_count"),
        (F.count_distinct(F.col(y)) * 100.0 / n).alias("unique_pct"),
    )


def _span_days(ts: str) -> Column:
    return (F.floor(F.timestamp_diff("SECOND", F.min(ts), F.max(ts)) / F.lit(86400)) + 1).cast("long")


def summary_stats(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", y: str = "y") -> DataFrame:
    """Pre-flight diagnostics: length, span, missing, zeros, intermittency."""
    n = F.count(F.lit(1))
    zero = F.count_if(F.col(y) == 0) / n
    return df.groupBy(*keys).agg(
        n.alias("n_days"), _span_days(ts).alias("span_days"),
        F.count_if(F.col(y).isNull()).alias("missing_days"),
        (F.count_if(F.col(y).isNull()) * 100.0 / n).alias("missing_pct"),
        zero.alias("zero_fraction"), (zero >= INTERMITTENT_SHARE).alias("intermittent"),
    )


def temporal_stats(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", y: str = "y") -> DataFrame:
    """Averages by week, month and kind of day, and month-over-month growth.

    Raw rows are first reduced to days (sum and count, combined map-side); every
    calendar roll-up is then taken from that small table in one pass.
    """
    day = F.date_trunc("day", F.col(ts)).cast("timestamp_ntz")
    days = df.groupBy(*keys, day.alias("_day")).agg(
        F.sum(y).alias("_s"), F.count(F.col(y)).alias("_c"), F.min(ts).alias("_a"), F.max(ts).alias("_b")
    )
    bucket = lambda kind, b: F.struct(F.lit(kind).alias("kind"), b.cast("timestamp_ntz").alias("at"))
    monday = F.lit("2000-01-03").cast("timestamp_ntz")
    kinds = F.array(
        bucket("all", monday),
        bucket("week", F.date_trunc("week", "_day")),
        bucket("month", F.date_trunc("month", "_day")),
        F.when(F.weekday("_day") < 5, bucket("weekday", monday + F.make_dt_interval(F.weekday("_day"))))
        .otherwise(bucket("weekend", monday + F.make_dt_interval(F.weekday("_day")))),
    )
    cells = (
        days.select(*keys, "_s", "_c", "_a", "_b", F.explode(kinds).alias("_k"))
        .groupBy(*keys, F.col("_k.kind").alias("_kind"), F.col("_k.at").alias("_at"))
        .agg((F.sum("_s") / F.nullif(F.sum("_c"), F.lit(0))).alias("_m"), F.min("_a").alias("_a"), F.max("_b").alias("_b"))
    )
    # Growth against the last known month; an empty month in between repeats
    # that month, i.e. adds a growth of 0.
    known = F.when((F.col("_kind") == "month") & F.col("_m").isNotNull(), F.struct("_m", "_at"))
    w = by_series([*keys, "_kind"], "_at").rowsBetween(Window.unboundedPreceding, -1)
    prev = F.last(known, ignorenulls=True).over(w)
    apart = (F.year("_at") - F.year(prev["_at"])) * 12 + F.month("_at") - F.month(prev["_at"])
    cells = cells.withColumn("_prev", prev).withColumns({
        "_steps": F.when(known.isNotNull(), apart),
        "_g": F.when(known.isNotNull(), F.col("_m") / F.nullif(prev["_m"], F.lit(0)) - 1),
    })
    of = lambda kind: F.avg(F.when(F.col("_kind") == kind, F.col("_m")))
    n, s, ss = F.sum("_steps"), F.sum("_g"), F.sum(F.col("_g") * F.col("_g"))
    return cells.groupBy(*keys).agg(
        (F.floor(F.timestamp_diff("SECOND", F.min("_a"), F.max("_b")) / F.lit(86400)) + 1).cast("long").alias("span_days"),
        of("all").alias("daily_avg"), of("week").alias("weekly_avg"), of("month").alias("monthly_avg"),
        of("weekday").alias("weekday_avg"), of("weekend").alias("weekend_avg"),
        (s / n * 100).alias("mom_growth_avg"),
        (F.sqrt(F.greatest(F.lit(0.0), (ss - s * s / n)) / F.nullif(n - 1, F.lit(0))) * 100).alias("mom_growth_std"),
    )


def month_growth(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", y: str = "y") -> DataFrame:
    """Relative change on the row before; the first row of a series has none."""
    prev = F.lag(y).over(by_series(keys, ts))
    return df.withColumn("growth", F.col(y) / F.nullif(prev, F.lit(0)) - 1).where(F.col("growth").isNotNull())


# ---------------------------------------------------------- autocorrelation

def seasonal_strength(
    df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", y: str = "y", lags: Sequence[int] = (7, 365)
) -> DataFrame:
    """Autocorrelation at a few lags, NULL for series shorter than 14 rows."""
    d = df.where(F.col(y).isNotNull()).withColumn("_d", F.col(y) - F.avg(y).over(whole_series(keys)))
    w = by_series(keys, ts)
    d = d.withColumns({f"_p{k}": F.col("_d") * F.lag("_d", k).over(w) for k in lags})
    n, var = F.count(F.lit(1)), F.nullif(F.sum(F.col("_d") * F.col("_d")), F.lit(0.0))
    return d.groupBy(*keys).agg(
        *[F.when((n >= 14) & (n > k), F.sum(f"_p{k}") / var).alias(f"acf{k}") for k in lags]
    )


FEW_LAGS = 64  # below, products are cheaper than transforms


def acf(
    df: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "ts",
    y: str = "y",
    nlags: int = 365,
    block_rows: int | None = None,
) -> DataFrame:
    """Autocorrelation at every lag up to ``nlags``.

    Each (series, block) becomes one array with the ``nlags`` rows after the
    block as context; a fast Fourier transform of block and context turns it into
    ``nlags + 1`` partial sums (few lags are multiplied out), and only those are
    added up per series. No row is paired with every lag, and as a block is no shorter
    than ``nlags`` rows, none is context of more than one block. ``block_rows`` sets
    another length.
    """
    block_rows = block_rows or max(8192, nlags)
    group = list(keys) or ["_all"]
    d = df.where(F.col(y).isNotNull())
    if not keys:
        d = d.withColumn("_all", F.lit(1))
    d = d.select(*group, F.col(ts).alias("_ts"), F.col(y).cast("double").alias("_y"))
    means = d.groupBy(*group).agg(F.avg("_y").alias("_mean"), F.count(F.lit(1)).alias("_n"))
    d = spread_join(number_rows(d, group, "_ts", out="_rn"), means, group)
    block = F.floor((F.col("_rn") - 1) / F.lit(block_rows))
    # a row also serves as context for the blocks up to nlags rows before it
    first = F.floor(F.greatest(F.lit(0), F.col("_rn") - 1 - nlags) / F.lit(block_rows))
    d = d.select(
        *group, "_rn", "_n", (F.col("_y") - F.col("_mean")).alias("_d"), F.explode_outer(F.sequence(first, block)).alias("_block")
    )
    packed = d.groupBy(*group, "_block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rn", "_d"))), lambda s: s["_d"]).alias("_x"),
        F.first("_n").alias("_n"),
    )

    @F.pandas_udf("array<double>")
    def lag_sums(xs: pd.Series) -> pd.Series:
        def one(x):
            x = np.asarray(x, dtype=float)
            head = x[:block_rows]
            if not len(head):
                return np.zeros(nlags + 1)
            padded = np.zeros(len(head) + nlags)
            padded[: len(x)] = x[: len(padded)]
            if nlags < FEW_LAGS:
                return np.correlate(padded, head, "valid")
            # long enough that no sum wraps around
            size = 1 << (len(padded) - 1).bit_length()
            both = np.conj(np.fft.rfft(head, size)) * np.fft.rfft(padded, size)
            return np.fft.irfft(both, size)[: nlags + 1]

        return xs.map(one)

    sums = packed.select(*group, "_n", F.posexplode(lag_sums("_x")).alias("lag", "_s"))
    total = sums.groupBy(*group, "lag").agg(F.sum("_s").alias("_s"), F.first("_n").alias("_n"))
    zero_lag = F.max(F.when(F.col("lag") == 0, F.col("_s"))).over(whole_series(group))
    out = total.withColumn("acf", F.col("_s") / F.nullif(zero_lag, F.lit(0.0))).where(F.col("lag") < F.col("_n"))
    return out.select(*keys, "lag", "acf")


def pacf(acf_df: DataFrame, keys: Sequence[str] = (), nlags: int = 40) -> DataFrame:
    """Partial autocorrelations from the (lag, acf) table by Durbin-Levinson."""
    rows = acf_df.where((F.col("lag") >= 1) & (F.col("lag") <= nlags)).groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda s: s["acf"]).alias("_r")
    )

    @F.pandas_udf("array<double>")
    def levinson(rs: pd.Series) -> pd.Series:
        def one(r):
            r = np.asarray(r, dtype=float)
            phi, out, left = np.zeros(0), [], 1.0
            for k in range(len(r)):
                last = (r[k] - phi @ r[:k][::-1]) / left if left > 1e-12 else 0.0
                phi = np.append(phi - last * phi[::-1], last)
                left *= 1.0 - last * last
                out.append(last)
            return out

        return rs.map(one)

    return rows.select(*keys, F.posexplode(levinson("_r")).alias("_k", "pacf")).select(
        *keys, (F.col("_k") + 1).alias("lag"), "pacf"
    )


# --------------------------------------------------------------- stationarity

def rolling_cv(
    df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", y: str = "y", window: int = 30, block_rows: int | None = None
) -> DataFrame:
    """Variation of the rolling mean and of the rolling deviation."""
    d = rolling_stats(df, keys, ts, y, window, 1, block_rows)
    cv = lambda c: F.stddev_samp(c) / F.nullif(F.avg(c), F.lit(0.0))
    return d.groupBy(*keys).agg(cv("roll_mean").alias("rolling_mean_cv"), cv("roll_std").alias("rolling_std_cv"))


def full_summary(df: DataFrame, keys: Sequence[str], ts: str = "ts", y: str = "y", adf_lags: int | str = "aic") -> DataFrame:
    """One nested row per series: basic, temporal, stationarity, quality."""
    from tidewright.models.unit_root import adf_test

    parts = {
        "basic_stats": basic_stats(df, keys, y),
        "temporal_stats": temporal_stats(df, keys, ts, y),
        "stationarity": rolling_cv(df, keys, ts, y).join(
            adf_test(df, keys, ts, y, lags=adf_lags).select(*keys, "adf_statistic", "adf_pvalue"), list(keys), "left"
        ),
        "quality": quality(df, keys, y),
    }
    out = None
    for name, part in parts.items():
        fields = [c for c in part.columns if c not in keys]
        nested = part.select(*keys, F.struct(*fields).alias(name))
        out = nested if out is None else out.join(nested, list(keys))
    return out


# ---------------------------------------------------------------- chart data

def histogram(
    df: DataFrame, keys: Sequence[str] = (), y: str = "y", bins: int = 50
) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed; empty bins
    are listed. Two partial aggregations, whatever the size of a series."""
    group = list(keys) or ["_all"]
    d = df.where(F.col(y).isNotNull())
    if not keys:
        d = d.withColumn("_all", F.lit(1))
    ends = d.groupBy(*group).agg(F.min(y).alias("_a"), F.max(y).alias("_b"))
    flat = F.col("_a") == F.col("_b")
    ends = ends.select(
        *group,
        F.when(flat, F.col("_a") - 0.5).otherwise(F.col("_a")).alias("_a"),
        F.when(flat, F.col("_b") + 0.5).otherwise(F.col("_b")).alias("_b"),
    )
    width = (F.col("_b") - F.col("_a")) / F.lit(float(bins))
    bin_of = F.least(F.lit(bins - 1), F.floor((F.col(y) - F.col("_a")) / width)).cast("int")
    counts = spread_join(d, ends, group).groupBy(*group, bin_of.alias("bin")).agg(
        F.count(F.lit(1)).alias("_c"), F.first("_a").alias("_a"), F.first("_b").alias("_b")
    )
    # at most ``bins`` rows per series meet here
    filled = counts.groupBy(*group).agg(
        F.first("_a").alias("_a"), F.first("_b").alias("_b"),
        F.map_from_entries(F.collect_list(F.struct("bin", "_c"))).alias("_m"),
    )
    every = filled.select(*group, "_a", width.alias("_w"), "_m", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.select(
        *keys, "bin",
        (F.col("_a") + F.col("bin") * F.col("_w")).alias("bin_start"),
        F.coalesce(F.try_element_at("_m", F.col("bin")), F.lit(0)).alias("n"),
    )


def month_box(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", y: str = "y", gridded: bool = True) -> DataFrame:
    """Five-number summary by calendar month."""
    group = [*keys, "month"]
    d = df.withColumn("month", F.month(ts)).where(F.col(y).isNotNull())
    ends = {"min": F.min(y), "max": F.max(y), "n": F.count(F.lit(1))}
    if gridded:
        box = d.groupBy(*group).agg(*[c.alias(n) for n, c in ends.items()], percentile(y, QUARTILES).alias("_q"))
    else:
        box = exact_quantiles(d, group, y, QUARTILES, out="_q", carry=ends)
    return box.select(
        *group, "n", "min", "max",
        F.col("_q")[0].alias("p25"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("p75"),
    )


def residuals(df: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    return df.withColumn("residual", F.col(y) - F.col(yhat))


# Wichura's algorithm AS 241, numerators and denominators of the
# centre and of two tails, highest power first.
AS241 = (
    (
        (2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4,
         1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080),
        (5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4,
         5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0),
    ),
    (
        (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258,
         3.64784832476320460504, 5.76949722146069140550, 4.63033784615654529590, 1.42343711074968357734),
        (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
         6.89767334985100004550e-1, 1.67638483018380384940, 2.05319162663775882187, 1.0),
    ),
    (
        (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
         2.96560571828504891230e-1, 1.78482653991729133580, 5.46378491116411436990, 6.65790464350110377720),
        (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
         1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0),
    ),
)


def _normal_quantile(p: pd.Series) -> pd.Series:
    """Inverse standard normal of a whole column."""
    p = p.to_numpy(float)
    ratio = lambda part, r: np.polyval(part[0], r) / np.polyval(part[1], r)
    q = p - 0.5
    tail = np.sqrt(-np.log(np.clip(np.minimum(p, 1 - p), 1e-300, 0.5)))
    far = np.where(tail <= 5, ratio(AS241[1], tail - 1.6), ratio(AS241[2], tail - 5))
    return pd.Series(np.where(np.abs(q) <= 0.425, q * ratio(AS241[0], 0.180625 - q * q), np.sign(q) * far))


def qq_positions(df: DataFrame, keys: Sequence[str] = (), value: str = "residual", with_normal: bool = True) -> DataFrame:
    """Ordered residuals with plotting position (i - 0.5) / n."""
    d = df.where(F.col(value).isNotNull())
    n = F.count(F.lit(1)).over(whole_series(keys))
    rank = F.row_number().over(by_series(keys, value))
    d = d.withColumns({"rank": rank, "position": (rank - 0.5) / n})
    if not with_normal:
        return d
    return d.withColumn("normal_quantile", F.pandas_udf(_normal_quantile, "double")("position"))
