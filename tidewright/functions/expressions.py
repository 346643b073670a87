"""Column expressions: calendar fields, error metrics, guards.

Nothing here touches a DataFrame; each function returns a Column that stays
inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

YEAR_DAYS = 365.25
TINY = 1e-9


def safe_divide(a: Column, b: Column) -> Column:
    """NULL instead of an ANSI division error."""
    return a / F.nullif(b, F.lit(0))


def as_null(col: Column) -> Column:
    """NaN becomes NULL; every operator here treats NULL as missing."""
    return F.when(~F.isnan(col), col)


def clip_non_negative(col: Column) -> Column:
    """``max(col, 0)`` that leaves NULL alone."""
    return F.when(col < 0, F.lit(0.0)).otherwise(col)


# ---------------------------------------------------------------- calendar

def calendar_columns(ts: Column, weekend_days: Sequence[int] = (5, 6)) -> dict[str, Column]:
    """Day-of-week (Monday 0), weekend flag, month, day of year, annual waves."""
    angle = F.lit(2.0) * F.pi() * F.dayofyear(ts) / F.lit(YEAR_DAYS)
    return {
        "dow": F.weekday(ts),
        "is_weekend": F.weekday(ts).isin(*weekend_days).cast("int"),
        "month": F.month(ts),
        "dayofyear": F.dayofyear(ts),
        "sin_annual": F.sin(angle),
        "cos_annual": F.cos(angle),
    }


# ------------------------------------------------------------ error metrics
# Aggregate expressions over matched actual / prediction rows.

def mape(y: Column, p: Column) -> Column:
    return F.avg(F.abs(safe_divide(y - p, y))) * 100


def smape(y: Column, p: Column) -> Column:
    """Works on magnitudes: the sign of either side is dropped first."""
    a, b = F.abs(y), F.abs(p)
    return F.avg(safe_divide(F.abs(a - b), (a + b) / 2)) * 100


def wmape(y: Column, p: Column, weight: Column | None = None) -> Column:
    """Weighted mean absolute error x100, weights ``|y|`` unless given.

    Not the usual WAPE: the numerator is weighted too, so it is in units of y.
    """
    w = F.abs(y) if weight is None else weight
    both = y.isNotNull() & p.isNotNull()
    num = F.sum(F.when(both, F.abs(y - p) * w))
    return num / F.greatest(F.lit(TINY), F.sum(F.when(both, w))) * 100


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(F.avg((y - p) * (y - p)))


METRICS = {"mape": mape, "smape": smape, "wmape": wmape, "rmse": rmse}


# ------------------------------------------------------------------ guards

def pearson(x: Column, y: Column) -> Column:
    """Correlation aggregate; NULL when either side is constant.

    The builtin ``corr`` raises a division error there under ANSI mode.
    """
    return F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))


def overfit_degradation(train: Column, valid: Column) -> Column:
    return F.coalesce(safe_divide(valid - train, train), F.lit(0.0))


def is_overfit(train: Column, valid: Column, threshold: float = 0.2) -> Column:
    """Relative degradation beyond the threshold; a zero train score never counts."""
    return overfit_degradation(train, valid) > F.lit(threshold)


def overfit_message(train: Column, valid: Column, threshold: float = 0.2) -> Column:
    pct = overfit_degradation(train, valid) * 100
    return F.when(
        is_overfit(train, valid, threshold), F.format_string("overfit: valid score %.1f%% above train", pct)
    ).otherwise(F.format_string("ok: valid score %.1f%% above train", pct))


def overfit_ratio(train: Column, valid: Column) -> Column:
    return F.when(train > 0, valid / F.nullif(train, F.lit(0))).otherwise(F.lit(1.0))
