"""Decomposition, trend and seasonal period."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators.features import gated
from tidewright.operators.layout import by_series, whole_series


def decompose(
    df: DataFrame, period: int, keys: Sequence[str] = (), ts: str = "ts", y: str = "y", model: str = "additive"
) -> DataFrame:
    """Classical decomposition: centred moving average, mean seasonal figure,
    remainder. The three steps share one shuffle by series."""
    multiplicative = {"additive": False, "multiplicative": True}[model]
    w, half = by_series(keys, ts), period // 2
    col = F.col(y)
    if period % 2:
        frame = w.rowsBetween(-half, half)
        trend = gated(F.avg(y).over(frame), col, frame, period)
    else:
        frame = w.rowsBetween(-half + 1, half - 1)
        inner = gated(F.sum(y).over(frame), col, frame, period - 1)
        trend = (inner + (F.lag(y, half).over(w) + F.lead(y, half).over(w)) * 0.5) / period
    d = df.withColumns({"trend": trend, "_phase": F.pmod(F.row_number().over(w) - 1, F.lit(period))})
    detrended = F.col(y) / F.nullif(F.col("trend"), F.lit(0.0)) if multiplicative else F.col(y) - F.col("trend")
    d = d.withColumn("_detrended", detrended)
    phase = whole_series([*keys, "_phase"])
    d = d.withColumns({"_figure": F.avg("_detrended").over(phase), "_rows": F.count(F.lit(1)).over(phase)})
    # mean of the figures, each phase counted once
    centre = F.sum(F.col("_figure") / F.col("_rows")).over(whole_series(keys)) / period
    seasonal = F.col("_figure") / centre if multiplicative else F.col("_figure") - centre
    d = d.withColumn("seasonal", seasonal)
    rest = (
        F.col(y) / F.nullif(F.col("trend") * F.col("seasonal"), F.lit(0.0))
        if multiplicative else F.col(y) - F.col("trend") - F.col("seasonal")
    )
    return d.withColumn("resid", rest).drop("_phase", "_detrended", "_figure", "_rows")


def trend_line(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", y: str = "y") -> DataFrame:
    """Least-squares line over the row number."""
    d = df.withColumn("_rn", F.row_number().over(by_series(keys, ts)).cast("double"))
    return d.groupBy(*keys).agg(
        F.regr_slope(y, "_rn").alias("slope"), F.regr_intercept(y, "_rn").alias("intercept"), F.regr_r2(y, "_rn").alias("r2")
    )


def seasonal_period(acf_df: DataFrame, candidates: Sequence[int], keys: Sequence[str] = ()) -> DataFrame:
    """Candidate lag with the largest autocorrelation (the shorter on ties)."""
    d = acf_df.where(F.col("lag").isin(*candidates))
    return d.groupBy(*keys).agg(
        F.max_by("lag", F.struct(F.col("acf"), -F.col("lag"))).alias("period"), F.max("acf").alias("strength")
    )


def spectrum(acf_df: DataFrame, nlags: int, keys: Sequence[str] = ()) -> DataFrame:
    """(frequency, power): smoothed periodogram from the (lag, acf) table.

    The autocorrelations up to ``nlags``, tapered linearly, are the Fourier transform of
    the spectrum, so a series of any length costs one transform of ``2 * nlags`` numbers.
    ``frequency`` counts cycles in ``2 * nlags`` rows, from 1 to ``nlags``. Lags beyond
    the series' length count as 0.
    """
    kept = acf_df.where((F.col("lag") >= 0) & (F.col("lag") <= nlags))
    rows = kept.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col("lag").cast("int"), F.coalesce("acf", F.lit(0.0))))).alias("_r"))

    @F.pandas_udf("array<double>")
    def transform(rs: pd.Series) -> pd.Series:
        def one(r):
            r = dict(r)
            x = np.zeros(2 * nlags)
            at = np.array(sorted(r))
            x[at] = np.array([r[k] for k in at.tolist()]) * (1 - at / nlags)
            x[nlags + 1 :] = x[1:nlags][::-1]
            return np.fft.rfft(x).real[1:]

        return rs.map(one)

    out = rows.select(*keys, F.posexplode(transform("_r")).alias("_i", "power"))
    return out.select(*keys, (F.col("_i") + 1).alias("frequency"), "power")


def dominant_period(
    acf_df: DataFrame, nlags: int, keys: Sequence[str] = (), cycles: int = 3
) -> DataFrame:
    """Period of the strongest frequency that completes ``cycles`` or more cycles within the
    lags, and its share of their power; the longer period on ties."""
    s = spectrum(acf_df, nlags, keys).where(F.col("frequency") >= 2 * cycles)
    best = F.max_by("frequency", F.struct("power", -F.col("frequency")))
    return s.groupBy(*keys).agg(
        (F.lit(2.0 * nlags) / best).alias("period"), (F.max("power") / F.nullif(F.sum(F.greatest("power", F.lit(0.0))), F.lit(0.0))).alias("share"))
