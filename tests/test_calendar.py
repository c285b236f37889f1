from __future__ import annotations

from calendar import day_name, month_name, monthrange
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from starloom.plans.calendar import (
    calendar,
    calendar_basic,
    calendar_extended,
    calendar_from_fact,
    extended_columns,
    normalize_date_dim,
    read_calendar,
    span,
)

AS_OF = date(2005, 6, 15)


def sunday_week(d: date) -> int:
    """Week of the year, counted by walking the days."""
    week, day = 1, date(d.year, 1, 1)
    while day < d:
        day += timedelta(days=1)
        week += day.isoweekday() == 7
    return week


def model(d: date) -> dict:
    """The extended columns of a day, worked out with the standard library."""
    weekday = d.isoweekday() % 7 + 1
    last = monthrange(d.year, d.month)[1]
    quarter = (d.month + 2) // 3
    first_of_quarter = date(d.year, 3 * quarter - 2, 1)
    end_month = 3 * quarter
    name, month = day_name[d.weekday()], month_name[d.month]
    suffix = "th" if 10 < d.day < 14 else {1: "st", 2: "nd", 3: "rd"}.get(d.day % 10, "th")

    def sundays(x: date) -> int:
        return (x - date(1899, 12, 31)).days // 7

    return {
        "DateKey": int(d.strftime("%Y%m%d")), "Date": d, "Day": d.day, "DaySuffix": suffix, "Weekday": weekday,
        "WeekDayName": name, "WeekDayName_Short": name[:3].upper(), "WeekDayName_FirstLetter": name[0], "DOWInMonth": d.day,
        "DayOfYear": d.timetuple().tm_yday, "WeekOfMonth": sunday_week(d) - sunday_week(d.replace(day=1)) + 1,
        "WeekOfYear": sunday_week(d), "Month": d.month, "MonthName": month, "MonthName_Short": month[:3].upper(),
        "MonthName_FirstLetter": month[0], "Quarter": quarter,
        "QuarterName": {1: "First", 2: "second", 3: "third", 4: "fourth"}[quarter], "Year": d.year,
        "MMYYYY": d.strftime("%m%Y"), "MonthYear": f"{d.year}{month[:3].upper()}", "IsWeekend": weekday in (1, 7),
        "IsHoliday": (d.month, d.day) == (12, 25), "HolidayName": "Christmas" if (d.month, d.day) == (12, 25) else None,
        "SpecialDays": "Valentines Day" if (d.month, d.day) == (2, 14) else None,
        "FinancialYear": None, "FinancialQuater": None, "FinancialMonth": None,
        "FirstDateofYear": date(d.year, 1, 1), "LastDateofYear": date(d.year, 12, 31),
        "FirstDateofQuater": first_of_quarter,
        "LastDateofQuater": date(d.year, end_month, monthrange(d.year, end_month)[1]),
        "FirstDateofMonth": d.replace(day=1), "LastDateofMonth": d.replace(day=last),
        "FirstDateofWeek": d - timedelta(days=weekday - 1), "LastDateofWeek": d + timedelta(days=7 - weekday),
        "CurrentYear": d.year - AS_OF.year, "CurrentQuater": (d.year - AS_OF.year) * 4 + quarter - 2,
        "CurrentMonth": (d.year - AS_OF.year) * 12 + d.month - AS_OF.month, "CurrentWeek": sundays(d) - sundays(AS_OF),
        "CurrentDay": (d - AS_OF).days,
    }


def test_extended_calendar_day_by_day(spark):
    found = calendar_extended(spark, "2000-01-01", "2010-12-31", as_of=AS_OF).orderBy("Date").collect()
    assert len(found) == 4017
    assert (found[0].Date, found[-1].Date) == (date(2000, 1, 1), date(2010, 12, 30))
    assert len(found[0]) == 41
    for row in found:
        assert row.asDict() == model(row.Date)
    by_day = {r.Date: r for r in found}
    assert by_day[date(2000, 12, 31)].WeekOfYear == 54


def test_quarter_bounds_of_the_run_date(spark):
    found = calendar_extended(spark, "2001-01-01", "2001-12-31", as_of=AS_OF, quarter_bounds="as_of")
    assert rows(found.select("FirstDateofQuater", "LastDateofQuater").distinct()) == [(date(2005, 4, 1), date(2005, 6, 30))]
    with pytest.raises(ValueError):
        calendar_extended(spark, "2001-01-01", "2001-12-31", quarter_bounds="other")


def test_fiscal_columns(spark):
    d = F.to_date(F.lit("2004-11-20"))
    columns = extended_columns(d, AS_OF, fiscal_start_month=7)
    got = spark.range(1).select(columns["FinancialYear"], columns["FinancialQuater"], columns["FinancialMonth"]).first()
    assert tuple(got) == (2005, 2, 5)


def test_empty_span(spark):
    assert calendar_extended(spark, "2001-01-01", "2001-01-01", as_of=AS_OF).count() == 0
    assert calendar_extended(spark, "2001-01-01", "2001-01-01", as_of=AS_OF, end_inclusive=True).count() == 1


def test_basic_calendar(spark):
    found = calendar_basic(spark, "2010-01-01", "2010-12-31").orderBy("date_key").collect()
    assert len(found) == 365
    for row in found:
        d = row.full_date
        assert tuple(row) == (
            int(d.strftime("%Y%m%d")), d, d.isoweekday(), day_name[d.weekday()], d.month, month_name[d.month],
            (d.month + 2) // 3, d.year, int(d.isoweekday() > 5),
        )


def test_calendar_of_a_fact(spark):
    fact = spark.createDataFrame([("2020-02-29",), ("2019-01-05",), ("2020-02-29",)], "event_date string")
    expected = [(20190105, date(2019, 1, 5)), (20200229, date(2020, 2, 29))]
    assert [tuple(r) for r in calendar_from_fact(fact, "event_date").collect()] == expected
    assert span(fact, "event_date") == (date(2019, 1, 5), date(2020, 2, 29))
    assert span(fact.limit(0), "event_date") is None
    assert rows(calendar(None, fact, "event_date")) == expected


def test_foreign_calendars(spark):
    a = spark.createDataFrame([("20200229", "2020-02-29"), ("20200229", "2020-02-29")], "DateKey string, FullDateAlternateKey string")
    b = spark.createDataFrame([(20200229, date(2020, 2, 29))], "datekey int, Date date")
    both = spark.createDataFrame([(1, date(2020, 1, 1), date(2021, 1, 1))], "DATEKEY int, Date date, FullDateAlternateKey date")
    other = spark.createDataFrame([(1,)], "day int")
    for source in (a, b):
        known = normalize_date_dim(source)
        assert rows(known) == [(20200229, date(2020, 2, 29))]
        assert known.dtypes == [("date_key", "int"), ("full_date", "date")]
    assert rows(normalize_date_dim(both)) == [(1, date(2021, 1, 1))]
    assert normalize_date_dim(other) is None
    fact = spark.createDataFrame([("2019-01-05",)], "event_date string")
    assert rows(calendar(other, fact, "event_date")) == [(20190105, date(2019, 1, 5))]
    assert rows(calendar(a, fact, "event_date")) == [(20200229, date(2020, 2, 29))]


def test_no_database_settings_no_database_calendar(spark):
    assert read_calendar(spark, {"SQL_HOST": "h"}) is None
