"""Holiday rules against other sources of the same days."""

from datetime import date, datetime

import pytest
from dateutil.easter import easter
from pyspark.sql import functions as F

from tidewright.functions import holidays


@pytest.fixture(scope="module")
def years(spark):
    return spark.range(1583, 2400).select(F.col("id").cast("int").alias("year"))


def test_easter(years):
    got = years.select("year", holidays.easter(F.col("year")).alias("d")).collect()
    assert all(r.d == easter(r.year) for r in got) and len(got) == 817


def test_known_days(spark):
    years = spark.range(2016, 2025).select(F.col("id").alias("year"))
    us = {(r.date, r.substitute): r.name for r in holidays.calendar(years, "US").collect()}
    for day, moved, name in [
        (date(2021, 12, 31), True, "New Year's Day"), (date(2022, 1, 1), False, "New Year's Day"), (date(2021, 7, 5), True, "Independence Day"),
        (date(2020, 7, 3), True, "Independence Day"), (date(2022, 6, 20), True, "Juneteenth"), (date(2023, 5, 29), False, "Memorial Day"),
        (date(2024, 11, 28), False, "Thanksgiving Day"), (date(2024, 1, 15), False, "Martin Luther King Jr. Day"), (date(2024, 9, 2), False, "Labor Day"),
    ]:
        assert us[day, moved] == name
    assert (date(2020, 6, 19), False) not in us and (date(2021, 6, 19), False) in us
    de = {r.date: r.name for r in holidays.calendar(years, "DE").collect()}
    assert de[date(2024, 3, 29)] == "Karfreitag" and de[date(2024, 5, 20)] == "Pfingstmontag" and de[date(2017, 10, 31)] == "Reformationstag"
    assert date(2018, 10, 31) not in de
    fr = holidays.calendar(years, "FR").groupBy(F.year("date")).count().collect()
    assert all(r["count"] == 11 for r in fr)
    with pytest.raises(ValueError):
        holidays.calendar(years, "XX")


def test_flags_by_country(spark):
    rows = [("US", datetime(2021, 7, 5, 13)), ("DE", datetime(2021, 7, 5)), ("DE", datetime(2021, 10, 3)), (None, datetime(2021, 12, 25)), ("US", None), ("US", datetime(2021, 12, 31))]
    d = spark.createDataFrame(rows, "country string, ts timestamp_ntz")
    got = {(r.country, r.ts): r.is_holiday for r in holidays.flag(d, ["US", "DE"]).collect()}
    assert [got[r] for r in rows] == [1, 0, 1, 0, 0, 1]
    assert holidays.flag(d.limit(0), ["US"]).count() == 0
