"""Calendar dimensions.

A calendar is one row per day of a span, so its size is set by the span and not by the facts.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import HOLIDAYS, QUARTER_NAMES, SPECIAL_DAYS
from ..functions.keys import date_key
from ..sources.jdbc import read_jdbc, sqlserver_settings

# A Sunday; week boundaries are counted from it.
_SUNDAY = "1899-12-31"


def _date(value: date | str) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


def days(spark: SparkSession, start: date | str, end: date | str, end_inclusive: bool = True, name: str = "full_date") -> DataFrame:
    """One row per day from `start` to `end`."""
    first, last = _date(start), _date(end)
    if not end_inclusive:
        last -= timedelta(days=1)
    count = max(0, (last - first).days + 1)
    return spark.range(count).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias(name))


def span(df: DataFrame, col: str) -> tuple[date, date] | None:
    """First and last date of a column; None when it holds none."""
    row = df.agg(F.min(F.to_date(col)), F.max(F.to_date(col))).first()
    return None if row[0] is None else (row[0], row[1])


def calendar_basic(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """Nine columns per day, end included; Monday is day 1 of the week."""
    d = F.col("full_date")
    monday_first = F.weekday(d) + 1
    return days(spark, start, end).select(
        date_key(d).alias("date_key"),
        "full_date",
        monday_first.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.month(d).alias("month_of_year"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("calendar_quarter"),
        F.year(d).alias("calendar_year"),
        (monday_first > 5).cast("int").alias("is_weekend"),
    )


def calendar_from_fact(df: DataFrame, col: str) -> DataFrame:
    """The days that occur in a fact: `date_key`, `full_date`, in date order. NULL dates give a row of NULLs."""
    found = df.select(F.to_date(col).alias("full_date")).distinct()
    return found.select(date_key(F.col("full_date")).alias("date_key"), "full_date").orderBy("full_date")


def normalize_date_dim(df: DataFrame) -> DataFrame | None:
    """Bring a foreign calendar to `date_key int, full_date date`; None when its columns are not recognised.

    Column names are matched in any case: `datekey` for the key, and `fulldatealternatekey` or else `date` for the day.
    """
    by_name = {c.lower(): c for c in reversed(df.columns)}
    key = by_name.get("datekey")
    day = by_name.get("fulldatealternatekey", by_name.get("date"))
    if key is None or day is None:
        return None
    typed = df.select(F.col(f"`{key}`").cast("int").alias("date_key"), F.to_date(F.col(f"`{day}`")).alias("full_date"))
    return typed.groupBy("date_key").agg(F.min("full_date").alias("full_date"))


def read_calendar(spark: SparkSession, environ: Mapping[str, str] = os.environ, table: str = "dbo.DimDate") -> DataFrame | None:
    """The calendar table of the database that the environment names (SQL_HOST, SQL_DB, SQL_USER, SQL_PWD); None without them."""
    settings = sqlserver_settings(environ)
    if settings is None:
        return None
    return read_jdbc(spark, settings.pop("url"), table, settings)


def calendar(source: DataFrame | None, fact: DataFrame, col: str) -> DataFrame:
    """The calendar read from elsewhere if there is a usable one, else the days of the fact."""
    known = normalize_date_dim(source) if source is not None else None
    return calendar_from_fact(fact, col) if known is None else known


def week_of_year(d: Column) -> Column:
    """Week number with weeks from Sunday; week 1 holds January 1, so a year can have 54."""
    lead = F.dayofweek(F.trunc(d, "year")) - 1
    return (F.floor((F.dayofyear(d) - 1 + lead) / 7) + 1).cast("int")


def _quarter_number(d: Column) -> Column:
    return F.year(d) * 4 + F.quarter(d)


def _month_number(d: Column) -> Column:
    return F.year(d) * 12 + F.month(d)


def _week_number(d: Column) -> Column:
    return F.floor(F.datediff(d, F.lit(_SUNDAY).cast("date")) / 7)


def _yearly(d: Column, rules: tuple) -> Column:
    """Name of the yearly day a date is, else NULL."""
    name = F.lit(None).cast("string")
    for month, day, label in rules:
        name = F.when((F.month(d) == month) & (F.day(d) == day), label).otherwise(name)
    return name


def _fiscal(d: Column, start_month: int | None) -> tuple[Column, Column, Column]:
    """Fiscal year (named after the calendar year it ends in), quarter and month; NULL without a start month."""
    if start_month is None:
        unset = F.lit(None).cast("int")
        return unset, unset, unset
    shifted = F.add_months(d, (13 - start_month) % 12)
    return F.year(shifted), F.quarter(shifted), F.month(shifted)


def extended_columns(
    d: Column,
    as_of: date | str,
    quarter_bounds: str = "row",
    holidays: tuple = HOLIDAYS,
    special_days: tuple = SPECIAL_DAYS,
    fiscal_start_month: int | None = None,
) -> dict[str, Column]:
    """The 41 columns of the extended calendar over a date column, by name and in order.

    `as_of` stands for today in the columns that count from it. `quarter_bounds` is `row` for the quarter of the row's own
    date, or `as_of` for the quarter of that day in every row.
    """
    if quarter_bounds not in ("row", "as_of"):
        raise ValueError("quarter_bounds is 'row' or 'as_of'")
    now = F.lit(_date(as_of))
    in_quarter = d if quarter_bounds == "row" else now
    first_of_quarter = F.trunc(in_quarter, "quarter")
    weekday = F.dayofweek(d)
    weekday_name, month_name = F.date_format(d, "EEEE"), F.date_format(d, "MMMM")
    short_month = F.upper(F.left(month_name, F.lit(3)))
    fiscal_year, fiscal_quarter, fiscal_month = _fiscal(d, fiscal_start_month)
    holiday = _yearly(d, holidays)
    suffix = (
        F.when(F.day(d).isin(11, 12, 13), "th")
        .when(F.day(d) % 10 == 1, "st")
        .when(F.day(d) % 10 == 2, "nd")
        .when(F.day(d) % 10 == 3, "rd")
        .otherwise("th")
    )
    return {
        "DateKey": date_key(d),
        "Date": d,
        "Day": F.day(d),
        "DaySuffix": suffix,
        "Weekday": weekday,
        "WeekDayName": weekday_name,
        "WeekDayName_Short": F.upper(F.left(weekday_name, F.lit(3))),
        "WeekDayName_FirstLetter": F.left(weekday_name, F.lit(1)),
        "DOWInMonth": F.day(d),  # the day of the month, as this column has always held
        "DayOfYear": F.dayofyear(d),
        "WeekOfMonth": week_of_year(d) - week_of_year(F.trunc(d, "month")) + 1,
        "WeekOfYear": week_of_year(d),
        "Month": F.month(d),
        "MonthName": month_name,
        "MonthName_Short": short_month,
        "MonthName_FirstLetter": F.left(month_name, F.lit(1)),
        "Quarter": F.quarter(d),
        "QuarterName": F.element_at(F.array(*[F.lit(q) for q in QUARTER_NAMES]), F.quarter(d)),
        "Year": F.year(d),
        "MMYYYY": F.date_format(d, "MMyyyy"),
        "MonthYear": F.concat(F.year(d).cast("string"), short_month),
        "IsWeekend": weekday.isin(1, 7),
        "IsHoliday": holiday.isNotNull(),
        "HolidayName": holiday,
        "SpecialDays": _yearly(d, special_days),
        "FinancialYear": fiscal_year,
        "FinancialQuater": fiscal_quarter,
        "FinancialMonth": fiscal_month,
        "FirstDateofYear": F.trunc(d, "year"),
        "LastDateofYear": F.make_date(F.year(d), F.lit(12), F.lit(31)),
        "FirstDateofQuater": first_of_quarter,
        "LastDateofQuater": F.date_sub(F.add_months(first_of_quarter, 3), 1),
        "FirstDateofMonth": F.trunc(d, "month"),
        "LastDateofMonth": F.last_day(d),
        "FirstDateofWeek": F.date_sub(d, weekday - 1),
        "LastDateofWeek": F.date_add(d, 7 - weekday),
        "CurrentYear": F.year(d) - F.year(now),
        "CurrentQuater": _quarter_number(d) - _quarter_number(now),
        "CurrentMonth": _month_number(d) - _month_number(now),
        "CurrentWeek": (_week_number(d) - _week_number(now)).cast("int"),
        "CurrentDay": F.datediff(d, now),
    }


def calendar_extended(
    spark: SparkSession,
    start: date | str,
    end: date | str,
    as_of: date | str | None = None,
    end_inclusive: bool = False,
    **options,
) -> DataFrame:
    """The extended calendar of a span, end excluded unless asked for. `options` are those of `extended_columns`."""
    today = date.today() if as_of is None else as_of
    columns = extended_columns(F.col("full_date"), today, **options)
    return days(spark, start, end, end_inclusive).select(*[c.alias(name) for name, c in columns.items()])
