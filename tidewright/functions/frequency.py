"""The frequency vocabulary and its arithmetic on timestamps.

One enum serves every operator; spelling variants are normalised at the edge.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Frequency:
    label: str
    unit: str  # "minute" | "month"
    every: int  # grid step in that unit
    widest_gap: int | None  # largest gap, in seconds, still read as this label
    season: int  # periods in one seasonal cycle
    lookback: int  # periods to look back when imputing
    valid_cap: int  # validation rows at most
    min_train: int  # training rows at least
    horizons: tuple[tuple[str, int], ...]  # (label, steps)
    cv_days: tuple[int, int, int]  # initial, period, horizon


_DAY = 86400
_LONG = ("30d", "90d")


def _days(per_day: int) -> tuple[tuple[str, int], ...]:
    return tuple((name, int(name[:-1]) * per_day) for name in _LONG)


# Frequency labels, gap ladder, split sizes, horizons, CV windows.
FREQUENCIES: dict[str, Frequency] = {
    f.label: f
    for f in (
        Frequency("min", "minute", 1, 60, 1440, 1440, 90, 180, _days(1440), (90, 7, 30)),
        Frequency("5min", "minute", 5, 300, 288, 288, 90, 180, _days(288), (90, 7, 30)),
        Frequency("15min", "minute", 15, 900, 96, 96, 90, 180, _days(96), (90, 7, 30)),
        Frequency("30min", "minute", 30, 1800, 48, 48, 90, 180, _days(48), (90, 7, 30)),
        Frequency("h", "minute", 60, 3600, 24, 24, 90, 180, _days(24), (14, 3, 7)),
        Frequency("6h", "minute", 360, 6 * 3600, 4, 4, 90, 180, _days(4), (90, 7, 30)),
        Frequency("D", "minute", 1440, _DAY, 7, 7, 90, 180, _days(1), (90, 7, 30)),
        Frequency("W", "minute", 10080, 7 * _DAY, 52, 4, 12, 24, (("4w", 4), ("12w", 12)), (365, 30, 90)),
        Frequency("MS", "month", 1, 31 * _DAY, 12, 12, 6, 12, (("3m", 3), ("12m", 12)), (730, 180, 365)),
        Frequency("QS", "month", 3, 92 * _DAY, 4, 4, 4, 8, (("2q", 2), ("4q", 4)), (1095, 365, 365)),
        Frequency("YS", "month", 12, None, 1, 1, 2, 5, (("1y", 1), ("3y", 3)), (3650, 1095, 1095)),
    )
}

# Accepted spellings.
ALIASES = {
    "H": "h", "T": "min", "1min": "min", "d": "D", "B": "D", "W-SUN": "W",
    "M": "MS", "ME": "MS", "Q": "QS", "QE": "QS", "Y": "YS", "YE": "YS",
}

# Look-back periods kept for result parity (``compat=True``).
COMPAT_LOOKBACK = {"D": 7, "W": 4}

SUB_HOURLY = ("min", "5min", "15min", "30min")


def frequency(label: str) -> Frequency:
    label = ALIASES.get(label, label)
    if label not in FREQUENCIES:
        raise ValueError(f"unknown frequency {label!r}; expected one of {sorted(FREQUENCIES)}")
    return FREQUENCIES[label]


def label_for_gap(seconds: Column) -> Column:
    """Map a gap in seconds to a frequency label."""
    ladder = None
    for f in FREQUENCIES.values():
        if f.widest_gap is None:
            continue
        test = seconds <= F.lit(f.widest_gap)
        ladder = F.when(test, F.lit(f.label)) if ladder is None else ladder.when(test, F.lit(f.label))
    return ladder.otherwise(F.lit("YS"))


def coarse_label_for_gap(seconds: Column) -> Column:
    """The six-label ladder used when choosing cross-validation windows."""
    return (
        F.when(seconds <= 3600, "h").when(seconds <= _DAY, "D").when(seconds <= 7 * _DAY, "W")
        .when(seconds <= 31 * _DAY, "MS").when(seconds <= 92 * _DAY, "QS").otherwise("YS")
    )


def resample_target(label: Column) -> Column:
    """Frequency a series should be resampled to, NULL when it can stay."""
    return F.when(label.isin(*SUB_HOURLY), F.lit("h"))


def step_interval(label: str, steps: Column | int = 1) -> Column:
    f = frequency(label)
    n = (steps if isinstance(steps, Column) else F.lit(steps)) * F.lit(f.every)
    if f.unit == "month":
        return F.make_ym_interval(F.lit(0), n.cast("int"))
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"))


def add_steps(ts: Column, steps: Column | int, label: str) -> Column:
    return (ts + step_interval(label, steps)).cast("timestamp_ntz")


def seconds_between(a: Column, b: Column) -> Column:
    return F.timestamp_diff("SECOND", a, b)


def steps_between(a: Column, b: Column, label: str) -> Column:
    """Whole grid steps from ``a`` to ``b``."""
    f = frequency(label)
    if f.unit == "month":
        months = (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))
        return F.floor(months / F.lit(f.every)).cast("long")
    return F.floor(seconds_between(a, b) / F.lit(f.every * 60)).cast("long")


def by_label(label: Column, fn) -> Column:
    """CASE over the vocabulary: ``fn(Frequency) -> Column`` picked per row."""
    out = None
    for f in FREQUENCIES.values():
        value = fn(f)
        out = F.when(label == f.label, value) if out is None else out.when(label == f.label, value)
    return out


def floor_to(ts: Column, label: str) -> Column:
    """Start of the grid slot that holds ``ts`` (weeks start on Monday)."""
    f = frequency(label)
    whole = {"h": "hour", "D": "day", "W": "week", "MS": "month", "QS": "quarter", "YS": "year", "min": "minute"}
    if f.label in whole:
        return F.date_trunc(whole[f.label], ts).cast("timestamp_ntz")
    if f.label == "6h":
        hours = F.hour(ts) - F.hour(ts) % 6
        return (F.date_trunc("day", ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hours)).cast("timestamp_ntz")
    minutes = F.minute(ts) - F.minute(ts) % f.every
    return (
        F.date_trunc("hour", ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), minutes)
    ).cast("timestamp_ntz")
