"""Calendar, holiday, lag and rolling features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidewright.functions.expressions import calendar_columns
from tidewright.operators.layout import by_series, in_blocks

LAGS = (1, 7, 14)
ROLLS = (7,)


def calendar_features(df: DataFrame, ts: str = "ts", weekend_days: Sequence[int] = (5, 6)) -> DataFrame:
    return df.withColumns(calendar_columns(F.col(ts), weekend_days))


def holiday_flags(df: DataFrame, holidays: DataFrame, country: str, ts: str = "ts") -> DataFrame:
    """``is_holiday`` from a (country, date, name) dimension.

    The dimension is one country's calendar; Spark broadcasts it when its
    measured size allows and hash-joins on the date otherwise.
    """
    days = (
        holidays.where(F.col("country") == country)
        .select(F.col("date").cast("date").alias("_day"), F.lit(1).alias("_h"))
        .dropDuplicates(["_day"])
    )
    return (
        df.withColumn("_day", F.col(ts).cast("date"))
        .join(days, "_day", "left")
        .withColumn("is_holiday", F.coalesce("_h", F.lit(0)))
        .drop("_day", "_h")
    )


def gated(value: Column, y: Column, frame: WindowSpec, at_least: int) -> Column:
    """``value`` only where the frame holds enough known observations."""
    return F.when(F.count(y).over(frame) >= at_least, value)


def lag_roll_features(
    df: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "ts",
    y: str = "y",
    lags: Sequence[int] = LAGS,
    rolls: Sequence[int] = ROLLS,
    past_only: bool = True,
    block_rows: int | None = None,
) -> DataFrame:
    """``lag_L`` and ``rollW_mean`` / ``rollW_std``.

    A rolling value needs a full window of known observations. ``past_only``
    leaves the current row out of the window, as a forecasting model needs;
    turn it off to include the current row.
    """
    shift = 1 if past_only else 0
    reach = max([*lags, *(w - 1 + shift for w in rolls)], default=0)

    def body(d: DataFrame, w: WindowSpec) -> DataFrame:
        new = {f"lag_{n}": F.lag(y, n).over(w) for n in lags}
        for n in rolls:
            frame = w.rowsBetween(-(n - 1) - shift, -shift)
            new[f"roll{n}_mean"] = gated(F.avg(y).over(frame), F.col(y), frame, n)
            new[f"roll{n}_std"] = gated(F.stddev_samp(y).over(frame), F.col(y), frame, n)
        return d.withColumns(new)

    return in_blocks(df, keys, ts, body, before=reach, block_rows=block_rows)


def rolling_stats(
    df: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "ts",
    y: str = "y",
    window: int = 30,
    min_periods: int = 1,
    block_rows: int | None = None,
) -> DataFrame:
    """Rolling mean and standard deviation with a minimum count (the deviation
    needs two values whatever the minimum)."""

    def body(d: DataFrame, w: WindowSpec) -> DataFrame:
        frame = w.rowsBetween(-(window - 1), 0)
        return d.withColumns({
            "roll_mean": gated(F.avg(y).over(frame), F.col(y), frame, min_periods),
            "roll_std": gated(F.stddev_samp(y).over(frame), F.col(y), frame, max(2, min_periods)),
        })

    return in_blocks(df, keys, ts, body, before=window - 1, block_rows=block_rows)


def join_features(df: DataFrame, features: DataFrame, keys: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """Left join of an external feature table on series and time."""
    return df.join(features, [*keys, ts], "left")


def align_candidates(
    df: DataFrame, candidates: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), ts: str = "ts"
) -> DataFrame:
    """Candidate columns on the target's rows, 0 where they have no value."""
    joined = join_features(df, candidates.select(*keys, ts, *columns), keys, ts)
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in columns})


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where every listed column is known."""
    return df.na.drop(subset=list(columns))


def last_rows(df: DataFrame, n: int, keys: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """The most recent ``n`` rows of each series."""
    recent = F.row_number().over(by_series(keys, F.col(ts).desc()))
    return df.withColumn("_back", recent).where(F.col("_back") <= n).drop("_back")


def leakage_report(
    df: DataFrame, features: Sequence[str], keys: Sequence[str] = (), ts: str = "ts", lookback: int = 40
) -> DataFrame:
    """Lag and rolling columns with no missing value in the first rows of a
    series cannot be looking back, so they are suspect."""
    named = [c for c in features if c.startswith("lag_") or "roll" in c]
    d = df.withColumn("_rn", F.row_number().over(by_series(keys, ts))).where(F.col("_rn") <= lookback)
    nulls = d.groupBy(*keys).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in named])
    return nulls.unpivot(list(keys), named, "feature", "early_nulls").withColumn("suspect", F.col("early_nulls") == 0)


def current_row_leakage(
    df: DataFrame, feature: str, window: int, keys: Sequence[str] = (), ts: str = "ts", y: str = "y"
) -> DataFrame:
    """Stronger check for a rolling mean: share of rows where it equals the mean
    over a window that includes the row's own target but not the past-only one."""
    with_now = by_series(keys, ts).rowsBetween(-(window - 1), 0)
    past = by_series(keys, ts).rowsBetween(-window, -1)
    close = lambda a, b: F.abs(a - b) <= F.lit(1e-9) * F.greatest(F.lit(1.0), F.abs(b))
    d = df.withColumns({"_now": F.avg(y).over(with_now), "_past": F.avg(y).over(past)})
    hit = close(F.col(feature), F.col("_now")) & ~close(F.col(feature), F.col("_past"))
    return d.where(F.col(feature).isNotNull()).groupBy(*keys).agg(F.avg(hit.cast("int")).alias("leak_share"))
