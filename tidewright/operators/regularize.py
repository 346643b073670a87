"""From raw observations to a regular grid: resample, find gaps, fill, check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions import frequency as fq
from tidewright.operators.layout import by_series, carry, in_blocks, number_rows, spread_join, whole_series
from tidewright.operators.quantiles import exact_quantiles, percentile

RESAMPLE_METHODS = ("mean", "sum", "max", "min", "median", "first", "last")

# Gap share below which gaps are filled, validation limits.
SMALL_GAP_SHARE = 0.1
MIN_ROWS = 30
MAX_MISSING_SHARE = 0.2
MAX_OUTLIER_SHARE = 0.1
IQR_REACH = 1.5


# ---------------------------------------------------------------- resample

def resample(
    df: DataFrame,
    freq: str,
    keys: Sequence[str] = (),
    ts: str = "ts",
    y: str = "y",
    method: str = "mean",
    others: Sequence[str] = (),
) -> DataFrame:
    """One row per (series, grid slot); slots without data are dropped, except
    under ``sum``, where an empty slot inside the series is 0.

    Map-side combining shrinks raw rows to slots before the shuffle, so a hot
    key costs no more than its slots. ``median`` uses the bracketed quantile.
    An unknown method falls back to the mean.
    """
    cols = [y, *others]
    d = df.withColumn("_slot", fq.floor_to(F.col(ts), freq))
    group = [*keys, "_slot"]
    if method == "median":
        out = None
        for name in cols:
            q = exact_quantiles(d, group, name, [0.5], out="_q").select(*group, F.col("_q")[0].alias(name))
            out = q if out is None else out.join(q, group)
    else:
        out = d.groupBy(*group).agg(*[_slot_value(F.col(c), F.col(ts), method).alias(c) for c in cols])
    out = out.withColumnRenamed("_slot", ts)
    if method == "sum":
        out = densify(out, freq, keys, ts).drop("imputed_flag")
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in cols})
    return out.dropna(subset=cols).select(*keys, ts, *cols)


def _slot_value(col: Column, ts: Column, method: str) -> Column:
    when_known = F.when(col.isNotNull(), F.struct(ts, col))
    return {
        "sum": F.sum(col),
        "max": F.max(col),
        "min": F.min(col),
        "first": F.min_by(col, when_known),
        "last": F.max_by(col, when_known),
    }.get(method, F.avg(col))


def auto_resample(
    df: DataFrame,
    label: str,
    keys: Sequence[str] = (),
    ts: str = "ts",
    y: str = "y",
    method: str = "mean",
    target: str | None = None,
    enabled: bool = True,
) -> tuple[DataFrame, str]:
    """Explicit target first; otherwise sub-hourly series go to hours."""
    label = fq.frequency(label).label
    if target is None and enabled and label in fq.SUB_HOURLY:
        target = "h"
    if target is None or target == label:
        return df, label
    return resample(df, target, keys, ts, y, method), target


# --------------------------------------------------------------- frequency

def gaps(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", chunk: str = "hour") -> DataFrame:
    """Microseconds from each distinct timestamp to the one before it.

    Raw series may be long, so gaps are taken inside (series, calendar chunk)
    and between neighbouring chunks from one summary row per chunk. A series
    keeps one row with a NULL gap: its first timestamp.
    """
    d = df.select(*keys, F.col(ts).alias("ts")).where("ts is not null").distinct()
    d = d.withColumn("_chunk", F.date_trunc(chunk, "ts"))
    part = [*keys, "_chunk"]
    inner = (
        d.withColumn("prev_ts", F.lag("ts").over(by_series(part, "ts")))
        .where("prev_ts is not null")
        .select(*keys, "ts", "prev_ts")
    )
    ends = d.groupBy(*part).agg(F.min("ts").alias("ts"), F.max("ts").alias("_last"))
    outer = ends.select(*keys, "ts", F.lag("_last").over(by_series(keys, "_chunk")).alias("prev_ts"))
    return inner.unionByName(outer).withColumn("gap_us", F.timestamp_diff("MICROSECOND", F.col("prev_ts"), F.col("ts")))


def infer_frequency(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", chunk: str = "hour") -> DataFrame:
    """Most common positive gap per series (ties: the shorter), read off the
    gap ladder. Series with fewer than two timestamps count as daily."""
    counts = gaps(df, keys, ts, chunk).groupBy(*keys, "gap_us").agg(F.count(F.lit(1)).alias("_n"))
    rank = F.when(F.col("gap_us") > 0, F.struct(F.col("_n"), -F.col("gap_us")))
    top = counts.groupBy(*keys).agg(F.max_by("gap_us", rank).alias("_us"))
    seconds = F.coalesce(F.col("_us") / F.lit(1e6), F.lit(86400.0))
    return top.select(
        *keys,
        seconds.alias("gap_seconds"),
        fq.label_for_gap(seconds).alias("freq"),
        fq.resample_target(fq.label_for_gap(seconds)).alias("resample_to"),
    )


def coarse_frequency(df: DataFrame, keys: Sequence[str], ts: str = "ts", chunk: str = "hour") -> DataFrame:
    """Six-label frequency from the median gap, as cross-validation uses it; a
    series without two timestamps counts as daily."""
    seconds = gaps(df, keys, ts, chunk).withColumn("_s", F.col("gap_us") / F.lit(1e6))
    q = exact_quantiles(seconds, keys, "_s", [0.5], out="_q")
    median = F.coalesce(F.col("_q")[0], F.lit(86400.0))
    return q.select(*keys, median.alias("median_gap_seconds"), fq.coarse_label_for_gap(median).alias("freq"))


# --------------------------------------------------------------------- gaps

def spine(df: DataFrame, freq: str, keys: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """Every grid slot from the first to the last timestamp of each series."""
    ends = df.groupBy(*keys).agg(F.min(ts).alias("_a"), F.max(ts).alias("_b"))
    return ends.select(*keys, F.explode_outer(F.sequence("_a", "_b", fq.step_interval(freq))).alias(ts))


def align_to_spine(df: DataFrame, freq: str, keys: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """Left join onto the spine, with ``imputed_flag`` 1 on added rows."""
    on = [*keys, ts]
    marked = df.withColumn("_there", F.lit(1))
    joined = spine(df, freq, keys, ts).join(marked, on, "left")
    return joined.withColumn("imputed_flag", F.when(F.col("_there").isNull(), 1).otherwise(0)).drop("_there")


def missing_periods(df: DataFrame, freq: str, keys: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """Spine slots with no observation."""
    return spine(df, freq, keys, ts).join(df.select(*keys, ts), [*keys, ts], "left_anti")


def densify(
    df: DataFrame,
    freq: str,
    keys: Sequence[str] = (),
    ts: str = "ts",
    only_if: Column | None = None,
    block_rows: int | None = None,
    repeat: Sequence[str] = (),
) -> DataFrame:
    """The same rows as ``align_to_spine`` without a join: every row emits the
    empty slots up to the next one. One shuffle, shared with later windows.
    Columns in ``repeat`` keep their value on the added rows."""
    cols = [c for c in df.columns if c not in (*keys, ts)]
    step = fq.step_interval(freq)

    def body(d, w):
        nxt = F.lead(ts).over(w)
        last = F.greatest(F.col(ts), (nxt - step).cast("timestamp_ntz"))
        slots = F.sequence(F.col(ts), F.coalesce(last, F.col(ts)), step)
        if only_if is not None:
            slots = F.when(only_if, slots).otherwise(F.array(F.col(ts)))
        return d.withColumn("_slots", slots)

    d = in_blocks(df, keys, ts, body, after=1, block_rows=block_rows)
    # never empty: the outer form spares a second evaluation in a size filter
    d = d.select(*df.columns, F.explode_outer("_slots").alias("_slot"))
    real = F.col("_slot") == F.col(ts)
    return d.select(
        *keys,
        F.col("_slot").alias(ts),
        *[F.col(c) if c in repeat else F.when(real, F.col(c)).alias(c) for c in cols],
        F.when(real, 0).otherwise(1).alias("imputed_flag"),
    )


def _gap_columns(n, first, last, hours, freq: str) -> dict[str, Column]:
    expected = fq.steps_between(first, last, freq) + 1
    missing = expected - n
    days = F.floor(fq.seconds_between(first, last) / F.lit(86400)) + 1
    if fq.frequency(freq).label == "h":
        partial = (missing > 0) & (hours < 24) & (F.abs(n - days * hours) < days * 2)
    else:
        partial = F.lit(False)
    share = missing / expected
    policy = (
        F.when(missing <= 0, "none").when(share < SMALL_GAP_SHARE, "ffill").when(partial, "zero").otherwise("keep")
    )
    return {
        "n_periods": n, "expected_periods": expected, "missing_periods": missing, "gap_pct": share,
        "active_hours": hours, "total_days": days, "partial_day": partial, "fill_policy": policy,
    }


def gap_report(df: DataFrame, freq: str, keys: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """Expected against present slots, hour coverage, and the fill policy."""
    base = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min(ts).alias("_a"), F.max(ts).alias("_b"),
        F.size(F.collect_set(F.hour(ts))).alias("_h"),  # at most 24 entries
    )
    cols = _gap_columns(F.col("_n"), F.col("_a"), F.col("_b"), F.col("_h"), freq)
    return base.select(*keys, *[c.alias(name) for name, c in cols.items()])


# --------------------------------------------------------------------- fill

def fill_forward_backward(
    df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", y: str = "y", chunk: str | None = None
) -> DataFrame:
    """Last known value, else the next known one. With ``chunk`` (a calendar
    unit) a long series is filled chunk by chunk."""
    if chunk is None:
        return df.withColumn(y, _ffill_bfill(F.col(y), keys, ts))
    d = carry(df, keys, ts, y, "_back", chunk)
    d = carry(d, keys, ts, y, "_ahead", chunk, ahead=True)
    return d.withColumn(y, F.coalesce("_back", "_ahead")).drop("_back", "_ahead")


def _ffill_bfill(col: Column, keys: Sequence[str], order: str) -> Column:
    w = by_series(keys, order)
    back = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return F.coalesce(F.last(col, ignorenulls=True).over(back), F.first(col, ignorenulls=True).over(ahead))


def fill_gaps(
    df: DataFrame,
    freq: str,
    keys: Sequence[str] = (),
    ts: str = "ts",
    y: str = "y",
    others: Sequence[str] = (),
    policy: str = "auto",
    block_rows: int | None = None,
    chunk: str | None = None,
) -> DataFrame:
    """Per-series gap policy in one plan: few gaps are filled forward then
    backward, inactive hours become 0, anything else is kept as it is.

    All steps window on ``keys``, so the series is shuffled once. For long
    series give ``block_rows`` and ``chunk``: the policy then comes from an
    aggregation and every window is cut into blocks.
    """
    d = df.select(*keys, ts, y, *others)
    if policy != "auto":
        d = d.withColumn("_policy", F.lit(policy))
    elif block_rows:
        chosen = gap_report(d, freq, keys, ts).select(*keys, F.col("fill_policy").alias("_policy"))
        d = spread_join(d, chosen, keys)
    else:
        w = whole_series(keys)
        d = d.withColumns({
            "_n": F.count(F.lit(1)).over(w), "_a": F.min(ts).over(w), "_b": F.max(ts).over(w),
            "_h": F.size(F.collect_set(F.hour(ts)).over(w)),
        })
        chosen = _gap_columns(F.col("_n"), F.col("_a"), F.col("_b"), F.col("_h"), freq)["fill_policy"]
        d = d.withColumn("_policy", chosen).drop("_n", "_a", "_b", "_h")
    dense = densify(d, freq, keys, ts, only_if=F.col("_policy").isin("ffill", "zero"), block_rows=block_rows, repeat=["_policy"])
    if chunk is None:
        near = _ffill_bfill(F.col(y), keys, ts)
    else:
        dense = fill_forward_backward(dense.withColumn("_near", F.col(y)), keys, ts, "_near", chunk)
        near = F.col("_near")
    zero = F.col("_policy") == "zero"
    filled = {y: F.when(F.col("_policy") == "ffill", near).when(zero, F.coalesce(F.col(y), F.lit(0.0))).otherwise(F.col(y))}
    for c in others:
        filled[c] = F.when(zero, F.coalesce(F.col(c), F.lit(0.0))).otherwise(F.col(c))
    return dense.withColumns(filled).withColumnRenamed("_policy", "fill_policy").drop("_near")


def impute_lookback(
    df: DataFrame,
    freq: str,
    keys: Sequence[str] = (),
    ts: str = "ts",
    y: str = "y",
    compat: bool = False,
    chunk: str | None = None,
) -> DataFrame:
    """Missing values take the value one season back, which may itself have been
    filled; what is left is filled forward then backward.

    Looking back recursively by L equals the last known value among rows whose
    number has the same remainder mod L, so no loop is needed. ``chunk`` works
    as in ``fill_forward_backward``.
    """
    f = fq.frequency(freq)
    lookback = fq.COMPAT_LOOKBACK.get(f.label, 1) if compat else f.lookback
    if chunk:
        d = number_rows(df, keys, ts, out="_rn", chunk=chunk).withColumn("_phase", F.col("_rn") % lookback)
        d = carry(d, [*keys, "_phase"], ts, y, "_season", chunk).drop("_rn", "_phase", y)
        return fill_forward_backward(d.withColumnRenamed("_season", y), keys, ts, y, chunk).select(*df.columns)
    d = df.withColumn("_rn", F.row_number().over(by_series(keys, ts)))
    d = d.withColumn("_phase", F.col("_rn") % lookback)
    same_phase = by_series([*keys, "_phase"], "_rn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn(y, F.last(y, ignorenulls=True).over(same_phase))
    return d.withColumn(y, _ffill_bfill(F.col(y), keys, "_rn")).drop("_rn", "_phase")


def normalise_months(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Month-like timestamps move to the first of the month."""
    return df.withColumn(ts, fq.floor_to(F.col(ts), "MS"))


def dedupe_timestamps(
    df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", y: str = "y", policy: str = "mean", order: str | None = None
) -> DataFrame:
    """One row per (series, timestamp) by ``mean``, ``sum``, ``min``, ``max`` or,
    with an ordering column, ``first`` / ``last``; also the number merged."""
    if policy in ("first", "last"):
        if order is None:
            raise ValueError("first/last need an ordering column")
        value = (F.min_by if policy == "first" else F.max_by)(y, order)
    else:
        value = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max}[policy](y)
    return df.groupBy(*keys, ts).agg(value.alias(y), F.count(F.lit(1)).alias("n_rows"))


# ----------------------------------------------------------------- validate

def with_quantiles(
    df: DataFrame, keys: Sequence[str], y: str, probs: Sequence[float], out: str = "_q", gridded: bool = True
) -> DataFrame:
    """Attach each series' quantile array to its rows."""
    if gridded:
        return df.withColumn(out, percentile(y, probs).over(whole_series(keys)))
    q = exact_quantiles(df, keys, y, probs, out=out)
    if keys:
        return spread_join(df, q, keys, "left")
    one = F.lit(1).alias("_one")
    return spread_join(df.select("*", one), q.select("*", one), ["_one"], "left").drop("_one")


def _outside_iqr(y: Column, q: Column) -> Column:
    reach = (q[1] - q[0]) * IQR_REACH
    return F.coalesce((y < q[0] - reach) | (y > q[1] + reach), F.lit(False))


def flag_outliers(df: DataFrame, keys: Sequence[str] = (), y: str = "y", gridded: bool = True) -> DataFrame:
    """Row flag: outside 1.5 inter-quartile ranges."""
    d = with_quantiles(df, keys, y, [0.25, 0.75], gridded=gridded)
    return d.withColumn("is_outlier", _outside_iqr(F.col(y), F.col("_q"))).drop("_q")


def outlier_share(df: DataFrame, keys: Sequence[str] = (), y: str = "y", gridded: bool = True) -> DataFrame:
    flagged = flag_outliers(df, keys, y, gridded)
    return flagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("is_outlier").cast("long")).alias("n_outliers"),
        F.avg(F.col("is_outlier").cast("int")).alias("outlier_share"),
    )


def check_schema(df: DataFrame, ts: str = "ts", y: str = "y") -> None:
    """The table must carry a timestamp column and the target."""
    types = dict(df.dtypes)
    if types.get(ts) not in ("timestamp", "timestamp_ntz", "date"):
        raise ValueError(f"{ts!r} must be a timestamp column, found {types.get(ts)}")
    if y not in types:
        raise ValueError(f"target {y!r} not found; available: {df.columns}")


def validate_series(
    df: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "ts",
    y: str = "y",
    min_rows: int = MIN_ROWS,
    allow_negative: bool = False,
    max_missing: float = MAX_MISSING_SHARE,
    max_outliers: float = MAX_OUTLIER_SHARE,
    check_outliers: bool = True,
    gridded: bool = True,
    strict: bool = False,
) -> DataFrame:
    """Per-series violations (errors) and warnings. ``strict`` makes a series
    with violations fail the query."""
    check_schema(df, ts, y)
    d = flag_outliers(df, keys, y, gridded) if check_outliers else df.withColumn("is_outlier", F.lit(False))
    stats = d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(y).alias("min_y"),
        F.avg(F.col(y).isNull().cast("int")).alias("missing_share"),
        F.avg(F.col("is_outlier").cast("int")).alias("outlier_share"),
    )
    rules = [F.when(F.col("n_rows") < min_rows, "too_few_rows")]
    if not allow_negative:
        rules.append(F.when(F.col("min_y") < 0, "negative_values"))
    rules.append(F.when(F.col("missing_share") > max_missing, "too_many_missing"))
    out = stats.withColumn("violations", F.array_compact(F.array(*rules))).withColumn(
        "warnings", F.array_compact(F.array(F.when(F.col("outlier_share") > max_outliers, "many_outliers")))
    )
    if strict:
        broken = F.size("violations") > 0
        message = F.concat(F.lit("series failed validation: "), F.concat_ws(",", "violations"))
        out = out.withColumn("violations", F.when(broken, F.raise_error(message).cast("array<string>")).otherwise(F.col("violations")))
    return out
