"""From raw columns to (series_id, ts, y): names, ids, dates, times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators.layout import whole_series

# Date formats tried in this order. The first two are the
# day-first readings; M-yy is a month with a two-digit year counted from 2000.
DATE_FORMATS = ("d-M-yyyy", "d/M/yyyy", "yyyy-M-d", "M-d-yyyy", "M/d/yyyy")
MONTH_YEAR = "M-yy"

# Looks of the formats above. Testing the look first spares the parser (and the
# exceptions it raises inside) on text that cannot match.
LOOKS = {
    "d-M-yyyy": r"^\d{1,2}-\d{1,2}-\d{4}$", "d/M/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$", "yyyy-M-d": r"^\d{4}-\d{1,2}-\d{1,2}$",
    "M-d-yyyy": r"^\d{1,2}-\d{1,2}-\d{4}$", "M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
}


def rename_target(df: DataFrame, target: str = "value", y: str = "y") -> DataFrame:
    if target in df.columns:
        return df if target == y else df.withColumnRenamed(target, y)
    if y not in df.columns:
        raise ValueError(f"target column {target!r} not found; available: {df.columns}")
    return df


def with_series_id(df: DataFrame, id_cols: Sequence[str], out: str = "series_id") -> DataFrame:
    if not id_cols:
        raise ValueError("id_cols must name at least one column")
    return df.withColumn(out, F.concat_ws("_", *[F.col(c).cast("string") for c in id_cols]))


def first_series(df: DataFrame, key: str = "series_id", ts: str = "ts") -> DataFrame:
    """Only the series that starts earliest (ties: the smaller id). Series are
    kept whole by default everywhere; this is for single-series use."""
    head = df.agg(F.min(F.struct(ts, key)).alias("_h")).select(F.col(f"_h.{key}").alias(key))
    return df.join(head, key, "left_semi")


# -------------------------------------------------------------------- dates

def _month_year(col: Column) -> Column:
    parts = F.split(col, "-")
    month, year = F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))
    two = (F.size(parts) == 2) & (F.length(month) <= 2) & (F.length(year) == 2)
    text = F.concat(F.lit("20"), year, F.lit("-"), F.lpad(month, 2, "0"), F.lit("-01"))
    return F.when(two, F.try_to_timestamp(text, F.lit("yyyy-MM-dd")))


def _reading(col: Column, fmt: str) -> Column:
    if fmt == MONTH_YEAR:
        return _month_year(col).cast("timestamp_ntz")
    parsed = F.try_to_timestamp(col, F.lit(fmt))
    if fmt in LOOKS:
        parsed = F.when(col.rlike(LOOKS[fmt]), parsed)
    return parsed.cast("timestamp_ntz")


def choose_date_format(df: DataFrame, column: str, formats: Sequence[str] = (*DATE_FORMATS[:2], MONTH_YEAR, *DATE_FORMATS[2:])) -> str:
    """The first format that reads the whole column: one aggregation counts the
    failures of all of them. Only those counts reach the driver."""
    col = F.col(column)
    row = df.agg(
        *[F.count_if(col.isNotNull() & _reading(col, f).isNull()).alias(f"f{i}") for i, f in enumerate(formats)]
    ).first()
    for i, f in enumerate(formats):
        if row[f"f{i}"] == 0:
            return f
    raise ValueError(f"could not parse date column {column!r} with any of {list(formats)}")


def parse_dates(df: DataFrame, column: str, out: str = "ts", fmt: str | None = None) -> DataFrame:
    """Text to timestamps, whole column by one format."""
    if dict(df.dtypes)[column] in ("timestamp", "timestamp_ntz", "date"):
        return df.withColumn(out, F.col(column).cast("timestamp_ntz"))
    return df.withColumn(out, _reading(F.col(column), fmt or choose_date_format(df, column)))


def combine_date_time(df: DataFrame, date: str, time: str, out: str = "ts", fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Two text columns read together as one timestamp."""
    text = F.concat_ws(" ", F.col(date), F.col(time))
    return df.withColumn(out, F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz"))


def combine_parts(df: DataFrame, year: str, month: str | None = None, day: str | None = None, hour: str | None = None, out: str = "ts") -> DataFrame:
    part = lambda c, default: F.col(c).cast("int") if c else F.lit(default)
    stamp = F.make_timestamp_ntz(part(year, 1), part(month, 1), part(day, 1), part(hour, 0), F.lit(0), F.lit(0))
    return df.withColumn(out, stamp)


def time_of_day(text: Column) -> Column:
    """``H:m[:s]`` as an interval, NULL when it cannot be read."""
    p = F.split(text, ":")
    number = lambda i: F.try_element_at(p, F.lit(i)).try_cast("int")
    return F.make_dt_interval(F.lit(0), number(1), number(2), F.coalesce(number(3), F.lit(0)).cast("decimal(18,6)"))


def add_time_of_day(df: DataFrame, ts: str = "ts", time: str = "Time", all_or_nothing: bool = True) -> DataFrame:
    """Date plus time of day, then the time column is dropped. When any time
    cannot be read the dates stand alone (or, row by row, that row's date)."""
    shift = time_of_day(F.col(time))
    moved = (F.col(ts) + shift).cast("timestamp_ntz")
    if all_or_nothing:
        bad = df.agg(F.count_if(F.col(time).isNotNull() & shift.isNull()).alias("bad")).first()["bad"]
        if bad:
            return df
    return df.withColumn(ts, F.coalesce(moved, F.col(ts))).drop(time)


def constant_free(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """NULL a column inside the series where it does not vary."""
    w = whole_series(keys)
    return df.withColumns({c: F.when(F.stddev_samp(c).over(w) > 0, F.col(c)) for c in columns})
