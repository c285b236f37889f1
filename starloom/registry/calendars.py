"""Calendars over the span of the orders, each day with what happened on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import Side, attach
from ..plans.calendar import calendar, calendar_basic, calendar_extended, calendar_from_fact, days, extended_columns, span
from .base import query, table

_SPAN_SQL = """span AS (SELECT MIN(o_orderdate)::DATE AS lo, MAX(o_orderdate)::DATE AS hi FROM orders),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM span),
per_day AS (SELECT o_orderdate::DATE AS day, COUNT(*) AS n FROM orders GROUP BY 1)"""

_KEY = "CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER)"


def _int(expression: str) -> str:
    return f"CAST({expression} AS INTEGER)"


def _with_orders(calendar_rows: DataFrame, day: str, orders: DataFrame) -> DataFrame:
    per_day = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    joined = attach(calendar_rows, Side(per_day, {day: "day"}, {"n": "n_orders"}, "left"))
    return joined.withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


@query(
    "calendar_basic",
    f"""WITH {_SPAN_SQL} SELECT {_KEY} AS date_key, d AS full_date, {_int("isodow(d)")} AS day_of_week, dayname(d) AS day_name,
      {_int("month(d)")} AS month_of_year, monthname(d) AS month_name, {_int("quarter(d)")} AS calendar_quarter,
      {_int("year(d)")} AS calendar_year, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend,
      COALESCE(n, 0) AS n_orders FROM days LEFT JOIN per_day ON d = day""",
)
def basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return _with_orders(calendar_basic(spark, *span(orders, "o_orderdate")), "full_date", orders)


_FIRST_OF_YEAR = "make_date(year(d), 1, 1)"
_FIRST_OF_MONTH = "make_date(year(d), month(d), 1)"
_FIRST_OF_QUARTER = "make_date(year(d), (quarter(d) - 1) * 3 + 1, 1)"
_AS_OF = "DATE '2005-06-15'"


def _week_sql(d: str) -> str:
    return f"((dayofyear({d}) - 1 + dayofweek(make_date(year({d}), 1, 1))) // 7 + 1)"


_EXTENDED_SQL = {
    "DateKey": _KEY,
    "Date": "d",
    "Day": _int("day(d)"),
    "DaySuffix": """CASE WHEN day(d) IN (1, 21, 31) THEN 'st' WHEN day(d) IN (2, 22) THEN 'nd' WHEN day(d) IN (3, 23) THEN 'rd'
      ELSE 'th' END""",
    "Weekday": _int("dayofweek(d) + 1"),
    "WeekDayName": "dayname(d)",
    "WeekDayName_Short": "upper(substr(dayname(d), 1, 3))",
    "WeekDayName_FirstLetter": "substr(dayname(d), 1, 1)",
    "DOWInMonth": _int("day(d)"),
    "DayOfYear": _int("dayofyear(d)"),
    "WeekOfMonth": _int(f"{_week_sql('d')} - {_week_sql(_FIRST_OF_MONTH)} + 1"),
    "WeekOfYear": _int(_week_sql("d")),
    "Month": _int("month(d)"),
    "MonthName": "monthname(d)",
    "MonthName_Short": "upper(substr(monthname(d), 1, 3))",
    "MonthName_FirstLetter": "substr(monthname(d), 1, 1)",
    "Quarter": _int("quarter(d)"),
    "QuarterName": "CASE quarter(d) WHEN 1 THEN 'First' WHEN 2 THEN 'second' WHEN 3 THEN 'third' ELSE 'fourth' END",
    "Year": _int("year(d)"),
    "MMYYYY": "strftime(d, '%m%Y')",
    "MonthYear": "CAST(year(d) AS VARCHAR) || upper(substr(monthname(d), 1, 3))",
    "IsWeekend": "isodow(d) >= 6",
    "IsHoliday": "month(d) = 12 AND day(d) = 25",
    "HolidayName": "CASE WHEN month(d) = 12 AND day(d) = 25 THEN 'Christmas' END",
    "SpecialDays": "CASE WHEN month(d) = 2 AND day(d) = 14 THEN 'Valentines Day' END",
    "FinancialYear": "CAST(NULL AS INTEGER)",
    "FinancialQuater": "CAST(NULL AS INTEGER)",
    "FinancialMonth": "CAST(NULL AS INTEGER)",
    "FirstDateofYear": _FIRST_OF_YEAR,
    "LastDateofYear": "make_date(year(d), 12, 31)",
    "FirstDateofQuater": _FIRST_OF_QUARTER,
    "LastDateofQuater": f"CAST({_FIRST_OF_QUARTER} + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)",
    "FirstDateofMonth": _FIRST_OF_MONTH,
    "LastDateofMonth": "last_day(d)",
    "FirstDateofWeek": "CAST(d - CAST(dayofweek(d) AS INTEGER) AS DATE)",
    "LastDateofWeek": "CAST(d + CAST(6 - dayofweek(d) AS INTEGER) AS DATE)",
    "CurrentYear": _int(f"date_diff('year', {_AS_OF}, d)"),
    "CurrentQuater": _int(f"date_diff('quarter', {_AS_OF}, d)"),
    "CurrentMonth": _int(f"date_diff('month', {_AS_OF}, d)"),
    "CurrentWeek": _int(
        f"(date_diff('day', DATE '1899-12-31', d) // 7) - (date_diff('day', DATE '1899-12-31', {_AS_OF}) // 7)"
    ),
    "CurrentDay": _int(f"date_diff('day', {_AS_OF}, d)"),
}


@query(
    "calendar_extended",
    f"""WITH {_SPAN_SQL} SELECT {", ".join(f'{e} AS "{c}"' for c, e in _EXTENDED_SQL.items())}, COALESCE(n, 0) AS n_orders
    FROM days LEFT JOIN per_day ON d = day""",
)
def extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rows = calendar_extended(spark, *span(orders, "o_orderdate"), as_of="2005-06-15", end_inclusive=True)
    return _with_orders(rows, "Date", orders)


_RELATIVE = ("CurrentYear", "CurrentQuater", "CurrentMonth", "CurrentWeek", "CurrentDay")


@query(
    "calendar_relative",
    f"""WITH {_SPAN_SQL} SELECT d AS "Date", {", ".join(f'{_EXTENDED_SQL[c]} AS "{c}"' for c in _RELATIVE)},
      DATE '2005-04-01' AS "FirstDateofQuater", DATE '2005-06-30' AS "LastDateofQuater", COALESCE(n, 0) AS n_orders
    FROM days LEFT JOIN per_day ON d = day WHERE d < (SELECT hi FROM span)""",
)
def relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rows = calendar_extended(spark, *span(orders, "o_orderdate"), as_of="2005-06-15", quarter_bounds="as_of")
    columns = rows.select("Date", *_RELATIVE, "FirstDateofQuater", "LastDateofQuater")
    return _with_orders(columns, "Date", orders)


@query(
    "calendar_from_orders",
    f"SELECT {_KEY} AS date_key, d AS full_date FROM (SELECT DISTINCT o_orderdate::DATE AS d FROM orders) AS found",
)
def from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_from_fact(table(spark, sf_dir, "orders"), "o_orderdate")


@query(
    "calendar_fallback",
    f"SELECT {_KEY} AS date_key, d AS full_date FROM (SELECT DISTINCT ts::DATE AS d FROM events) AS found",
)
def fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar table without the known columns is not used; the days of the events are."""
    events = table(spark, sf_dir, "events")
    unusable = events.select(F.to_date("ts").alias("calendar_day"))
    return calendar(unusable, events, "ts")


@query(
    "calendar_normalized",
    f"SELECT {_KEY} AS date_key, d AS full_date FROM (SELECT DISTINCT l_shipdate::DATE AS d FROM lineitem) AS found",
)
def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A foreign calendar, here one row per line with other column names, in the known shape."""
    day = F.to_date("l_shipdate")
    foreign = table(spark, sf_dir, "lineitem").select(
        F.date_format(day, "yyyyMMdd").alias("DATEKEY"), day.alias("FullDateAlternateKey"), F.lit("x").alias("Note")
    )
    return calendar(foreign, foreign, "FullDateAlternateKey")


@query(
    "calendar_attributes_of_lines",
    f"""SELECT {_EXTENDED_SQL["Year"]} AS "Year", {_EXTENDED_SQL["QuarterName"]} AS "QuarterName",
      {_EXTENDED_SQL["WeekOfYear"]} AS "WeekOfYear", COUNT(*) AS n_lines
    FROM (SELECT l_shipdate::DATE AS d FROM lineitem) AS shipped GROUP BY 1, 2, 3""",
)
def attributes_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by calendar attributes: counted per day first, so attributes are worked out once per day."""
    per_day = table(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    columns = extended_columns(F.col("day"), "2005-06-15")
    by = ["Year", "QuarterName", "WeekOfYear"]
    return per_day.select("n", *[columns[c].alias(c) for c in by]).groupBy(*by).agg(F.sum("n").alias("n_lines"))


@query(
    "calendar_days_without_orders",
    f"WITH {_SPAN_SQL} SELECT d AS full_date FROM days WHERE d NOT IN (SELECT ts::DATE FROM events UNION SELECT day + 1 FROM per_day)",
)
def quiet_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    busy = orders.select(F.date_add(F.to_date("o_orderdate"), 1).alias("day")).distinct()
    other = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day")).distinct()
    return days(spark, *span(orders, "o_orderdate")).subtract(busy.union(other).withColumnRenamed("day", "full_date"))
