"""Public holidays by country."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import DAILY_BY_PRIORITY, daily_by_priority, query, table
from tidewright.functions import holidays

# Easter by the nineteen-year table of remainders, another way than the expressions'.
_EASTER = """e1 AS (SELECT yr, yr % 19 AS a, yr // 100 AS b, yr % 100 AS c FROM years),
e2 AS (SELECT *, b // 4 AS d, b % 4 AS e, (b - (b + 8) // 25 + 1) // 3 AS g FROM e1),
e3 AS (SELECT *, (19 * a + b - d - g + 15) % 30 AS h FROM e2),
e4 AS (SELECT *, (32 + 2 * e + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e3),
e5 AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS m FROM e4),
easter AS (SELECT yr, make_date(yr, m // 31, m % 31 + 1) AS sunday FROM e5)"""


def _nth(weekday: int, n: int, month: int) -> str:
    first = f"make_date(yr, {month}, 1)"
    return f"{first} + (({weekday} - isodow({first}) + 7) % 7 + {7 * (n - 1)})::INTEGER"


_US = ", ".join([
    "('New Year''s Day', make_date(yr, 1, 1), 0, true)",
    f"('Martin Luther King Jr. Day', {_nth(1, 3, 1)}, 1986, false)",
    f"('Washington''s Birthday', {_nth(1, 3, 2)}, 1971, false)",
    "('Memorial Day', make_date(yr, 5, 31) - (isodow(make_date(yr, 5, 31)) - 1)::INTEGER, 1971, false)",
    "('Juneteenth', make_date(yr, 6, 19), 2021, true)",
    "('Independence Day', make_date(yr, 7, 4), 0, true)",
    f"('Labor Day', {_nth(1, 1, 9)}, 0, false)",
    f"('Columbus Day', {_nth(1, 2, 10)}, 1971, false)",
    "('Veterans Day', make_date(yr, 11, 11), 1978, true)",
    f"('Thanksgiving Day', {_nth(4, 4, 11)}, 1942, false)",
    "('Christmas Day', make_date(yr, 12, 25), 0, true)",
])
_DE = ", ".join([
    "('Neujahr', make_date(yr, 1, 1), 0, 9999)", "('Karfreitag', sunday - 2, 0, 9999)", "('Ostermontag', sunday + 1, 0, 9999)",
    "('Tag der Arbeit', make_date(yr, 5, 1), 0, 9999)", "('Christi Himmelfahrt', sunday + 39, 0, 9999)", "('Pfingstmontag', sunday + 50, 0, 9999)",
    "('Tag der Deutschen Einheit', make_date(yr, 10, 3), 1990, 9999)", "('Reformationstag', make_date(yr, 10, 31), 2017, 2017)",
    "('Erster Weihnachtstag', make_date(yr, 12, 25), 0, 9999)", "('Zweiter Weihnachtstag', make_date(yr, 12, 26), 0, 9999)",
])


def _days_sql(ahead: int) -> str:
    return f"""years AS (SELECT unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + {ahead + 1}))::INTEGER AS yr FROM orders), {_EASTER},
us AS (SELECT v.* FROM years, LATERAL (VALUES {_US}) AS v(name, date, since, moves) WHERE yr >= since),
de AS (SELECT v.* FROM easter, LATERAL (VALUES {_DE}) AS v(name, date, since, until) WHERE yr BETWEEN since AND until),
days AS (SELECT 'US' AS country, date, name, false AS substitute FROM us
  UNION ALL SELECT 'US', date + (CASE isodow(date) WHEN 6 THEN -1 ELSE 1 END)::INTEGER, name, true FROM us WHERE moves AND isodow(date) >= 6
  UNION ALL SELECT 'DE', date, name, false FROM de)"""


@query("holiday_calendar", f"WITH {_days_sql(40)} SELECT country, date::DATE AS date, name, substitute FROM days")
def holiday_calendar(spark, sf):
    """Two countries from the first order to forty years after the last."""
    years = holidays.years_of(table(spark, sf, "orders"), "o_orderdate", ahead=40)
    return holidays.calendar(years, "US").unionByName(holidays.calendar(years, "DE"))


@query("holidays_by_country", f"""
WITH {_days_sql(1)}, d AS (SELECT *, CASE series_id WHEN '1-URGENT' THEN 'US' WHEN '2-HIGH' THEN 'DE' WHEN '3-MEDIUM' THEN 'ZZ' END AS country FROM ({DAILY_BY_PRIORITY}) AS q)
SELECT series_id, country, ts, y, (CASE WHEN EXISTS (SELECT 1 FROM days WHERE days.country = d.country AND days.date = d.ts::DATE) THEN 1 ELSE 0 END)::INTEGER AS is_holiday FROM d
""")
def holidays_by_country(spark, sf):
    of = F.create_map(*[F.lit(x) for x in ("1-URGENT", "US", "2-HIGH", "DE", "3-MEDIUM", "ZZ")])
    return holidays.flag(daily_by_priority(spark, sf).withColumn("country", of[F.col("series_id")]), ["US", "DE"])
