"""Raw table to regular, validated series: the whole load as one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions import frequency as fq
from tidewright.operators import regularize as reg
from tidewright.operators.layout import spread_join
from tidewright.sources import parse

KEYS = ["series_id"]
BLOCK_ROWS, CHUNK = 50_000, "month"


@dataclass(frozen=True)
class LoadOptions:
    target: str = "value"
    date: str = "date"
    date_format: str | None = None  # None: first format that reads the column
    date_parts: Sequence[str] = ()  # columns of year, month, day, hour (the last ones may be left out) in place of a date
    time: str | None = None
    id_cols: Sequence[str] = ()
    only_first: bool = False
    freq: str | None = None  # None: inferred per series
    resample_freq: str | None = None
    resample_method: str = "mean"
    auto_resample: bool = True
    duplicates: str = "mean"
    compat_lookback: bool = False
    long_series: bool = False  # very fine grids: cut every window into blocks
    validate: str = "off"  # "report": each series' violations and warnings on its rows; "strict": violations fail the load
    allow_negative: bool = False


def shape(raw: DataFrame, o: LoadOptions) -> DataFrame:
    """Names, ids, dates: (series_id, ts, y)."""
    d = parse.rename_target(raw, o.target)
    d = parse.with_series_id(d, o.id_cols) if o.id_cols else d.withColumn("series_id", F.lit("all"))
    d = parse.combine_parts(d, *o.date_parts) if o.date_parts else parse.parse_dates(d, o.date, "ts", o.date_format)
    if o.time and o.time in d.columns:
        d = parse.add_time_of_day(d, "ts", o.time)
    y = F.col("y").cast("double")
    d = d.select("series_id", "ts", F.when(~F.isnan(y), y).alias("y")).where("ts is not null")
    return parse.first_series(d) if o.only_first else d


def regular(d: DataFrame, label: str, o: LoadOptions) -> DataFrame:
    """Series of one frequency: resample, align, fill, impute."""
    if o.resample_freq or (o.auto_resample and label in fq.SUB_HOURLY):
        d, label = reg.auto_resample(d, label, KEYS, method=o.resample_method, target=o.resample_freq, enabled=o.auto_resample)
    else:
        d = reg.dedupe_timestamps(d.withColumn("ts", fq.floor_to(F.col("ts"), label)), KEYS, policy=o.duplicates).drop("n_rows")
    block_rows, chunk = (BLOCK_ROWS, CHUNK) if o.long_series else (None, None)
    d = reg.fill_gaps(d, label, KEYS, block_rows=block_rows, chunk=chunk)
    d = reg.impute_lookback(d, label, KEYS, compat=o.compat_lookback, chunk=chunk)
    return d.withColumn("freq", F.lit(label))


def checked(d: DataFrame, o: LoadOptions) -> DataFrame:
    """The regular series with what validation says of each, if it is asked for."""
    if o.validate == "off":
        return d
    if o.validate not in ("report", "strict"):
        raise ValueError(f"unknown validation {o.validate!r}")
    found = reg.validate_series(d, KEYS, allow_negative=o.allow_negative, strict=o.validate == "strict")
    return spread_join(d, found.select(*KEYS, "violations", "warnings"), KEYS)


def load_series(raw: DataFrame, options: LoadOptions = LoadOptions()) -> DataFrame:
    """(series_id, ts, y, imputed_flag, fill_policy, freq) for every series, and
    (violations, warnings) where ``options.validate`` asks for them.

    With inferred frequencies the plan has one branch per way of regularising;
    all sub-hourly series share one when they are resampled. Only that list of
    at most eleven labels reaches the driver.
    """
    d = shape(raw, options)
    if options.freq:
        return checked(regular(d, fq.frequency(options.freq).label, options), options)
    label = F.col("freq")
    if options.auto_resample and options.resample_freq is None:
        label = F.when(label.isin(*fq.SUB_HOURLY), F.lit(fq.SUB_HOURLY[-1])).otherwise(label)
    inferred = reg.infer_frequency(d, KEYS).select(*KEYS, label.alias("freq"))
    labels = sorted(r["freq"] for r in inferred.select("freq").distinct().collect())
    out = None
    for name in labels:
        mine = d if len(labels) == 1 else spread_join(d, inferred.where(F.col("freq") == name), KEYS, "left_semi")
        part = regular(mine, name, options)
        out = part if out is None else out.unionByName(part)
    return out if out is None else checked(out, options)
