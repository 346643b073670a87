"""Public holidays by rule, as column expressions over a table of years.

A rule gives at most one day a year: a fixed date, a weekday of a month, or a distance
from Easter Sunday (Gregorian computus). Some countries also keep a substitute for a day
that falls on a weekend.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators.layout import spread_join

MON, TUE, WED, THU, FRI, SAT, SUN = range(7)


def easter(year: Column) -> Column:
    """Easter Sunday of the Gregorian calendar, a date."""
    century = F.floor(year / 100)
    lunar = F.pmod(year, F.lit(19))
    leap = F.floor(century / 4)
    moon = F.floor((8 * century + 13) / 25)
    # age of the moon, then days from 21 March to the full moon, with its two exceptions
    epact = F.pmod(19 * lunar + century - leap - moon + 15, F.lit(30))
    full = epact - F.when((epact == 29) | ((epact == 28) & (lunar > 10)), 1).otherwise(0)
    # the Sunday after
    weekday = F.pmod(year + F.floor(year / 4) + full + 2 - century + leap, F.lit(7))
    return F.date_add(F.make_date(year.cast("int"), F.lit(3), F.lit(21)), (full + 7 - weekday).cast("int"))


@dataclass(frozen=True)
class Rule:
    name: str
    day: Callable[[Column], Column]
    first: int = 0
    last: int = 9999
    substitute: bool = False  # Friday for a Saturday, Monday for a Sunday


def fixed(month: int, day: int) -> Callable[[Column], Column]:
    return lambda year: F.make_date(year, F.lit(month), F.lit(day))


def from_easter(days: int) -> Callable[[Column], Column]:
    return lambda year: F.date_add(easter(year), days)


def nth(weekday: int, n: int, month: int) -> Callable[[Column], Column]:
    """The n-th such weekday of a month; the last one for ``n = -1``."""

    def day(year: Column) -> Column:
        if n < 0:
            end = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
            return F.date_add(end, -F.pmod(F.weekday(end) - weekday, F.lit(7)))
        start = F.make_date(year, F.lit(month), F.lit(1))
        return F.date_add(start, F.pmod(F.lit(weekday) - F.weekday(start), F.lit(7)) + 7 * (n - 1))

    return day


#: nationwide public holidays, fixed by law
COUNTRIES: dict[str, list[Rule]] = {
    "US": [
        Rule("New Year's Day", fixed(1, 1), substitute=True),
        Rule("Martin Luther King Jr. Day", nth(MON, 3, 1), 1986),
        Rule("Washington's Birthday", nth(MON, 3, 2), 1971),
        Rule("Memorial Day", nth(MON, -1, 5), 1971),
        Rule("Juneteenth", fixed(6, 19), 2021, substitute=True),
        Rule("Independence Day", fixed(7, 4), substitute=True),
        Rule("Labor Day", nth(MON, 1, 9)),
        Rule("Columbus Day", nth(MON, 2, 10), 1971),
        Rule("Veterans Day", fixed(11, 11), 1978, substitute=True),
        Rule("Thanksgiving Day", nth(THU, 4, 11), 1942),
        Rule("Christmas Day", fixed(12, 25), substitute=True),
    ],
    "DE": [
        Rule("Neujahr", fixed(1, 1)),
        Rule("Karfreitag", from_easter(-2)),
        Rule("Ostermontag", from_easter(1)),
        Rule("Tag der Arbeit", fixed(5, 1)),
        Rule("Christi Himmelfahrt", from_easter(39)),
        Rule("Pfingstmontag", from_easter(50)),
        Rule("Tag der Deutschen Einheit", fixed(10, 3), 1990),
        Rule("Reformationstag", fixed(10, 31), 2017, 2017),
        Rule("Erster Weihnachtstag", fixed(12, 25)),
        Rule("Zweiter Weihnachtstag", fixed(12, 26)),
    ],
    "FR": [
        Rule("Jour de l'an", fixed(1, 1)),
        Rule("Lundi de Pâques", from_easter(1)),
        Rule("Fête du Travail", fixed(5, 1)),
        Rule("Fête de la Victoire", fixed(5, 8), 1982),
        Rule("Ascension", from_easter(39)),
        Rule("Lundi de Pentecôte", from_easter(50)),
        Rule("Fête nationale", fixed(7, 14)),
        Rule("Assomption", fixed(8, 15)),
        Rule("Toussaint", fixed(11, 1)),
        Rule("Armistice", fixed(11, 11)),
        Rule("Noël", fixed(12, 25)),
    ],
}


def calendar(years: DataFrame, country: str, rules: Sequence[Rule] | None = None) -> DataFrame:
    """(country, date, name, substitute) of every holiday of the rows' ``year``."""
    if rules is None:
        if country not in COUNTRIES:
            raise ValueError(f"no holidays known for {country!r}; give rules")
        rules = COUNTRIES[country]
    year = F.col("year").cast("int")
    days = []
    for rule in rules:
        day = rule.day(year)
        valid = (year >= rule.first) & (year <= rule.last)
        entry = lambda d, other, ok: F.when(ok, F.struct(d.alias("date"), F.lit(rule.name).alias("name"), F.lit(other).alias("substitute")))  # noqa: B023, E731
        days.append(entry(day, False, valid))
        if rule.substitute:
            moved = F.when(F.weekday(day) == SAT, F.date_sub(day, 1)).when(F.weekday(day) == SUN, F.date_add(day, 1))
            days.append(entry(moved, True, valid & moved.isNotNull()))
    found = years.select(F.explode(F.filter(F.array(*days), lambda x: x.isNotNull())).alias("d"))
    return found.select(F.lit(country).alias("country"), "d.*")


def years_of(df: DataFrame, ts: str = "ts", ahead: int = 1) -> DataFrame:
    """Years from the first to the last row and ``ahead`` more (a substitute of New Year's
    Day lies in the year before): one small row per year, from one aggregation."""
    ends = df.agg(F.year(F.min(ts)).alias("a"), F.year(F.max(ts)).alias("b"))
    return ends.select(F.explode(F.sequence("a", F.col("b") + ahead)).alias("year"))


def flag(df: DataFrame, countries: Sequence[str], country: str = "country", ts: str = "ts", ahead: int = 1) -> DataFrame:
    """``is_holiday`` for rows whose column ``country`` says whose calendar applies; 0 for a
    country that is not listed, a null country or a null time."""
    years = years_of(df, ts, ahead)
    days = None
    for c in countries:
        one = calendar(years, c).select(F.col("country").alias("_c"), F.col("date").alias("_day"))
        days = one if days is None else days.unionByName(one)
    days = days.distinct().withColumn("_h", F.lit(1))
    keyed = df.withColumns({"_c": F.col(country), "_day": F.col(ts).cast("date")})
    return spread_join(keyed, days, ["_c", "_day"], how="left").withColumn("is_holiday", F.coalesce("_h", F.lit(0))).drop("_c", "_day", "_h")
