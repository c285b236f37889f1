"""Gold aggregates and star queries.

Facts are first reduced to one row per combination of dimension keys, which every task does on its own rows before anything
is shuffled; only those rows are joined to the dimensions and grouped by their attributes. Hot keys shrink to a row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions import money
from ..operators.joins import Side, attach, lookup

_AMOUNT = "amount"
_ROWS = "__rows"


def reduce_fact(fact: DataFrame, keys: Sequence[str | Column], amount: str, scale: int | None = None) -> DataFrame:
    """Rows and amounts per combination of keys. `scale` says that a double amount is a decimal with so many digits."""
    exact = isinstance(fact.schema[amount].dataType, DecimalType)
    return fact.groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS), *money.partial(F.col(amount), _AMOUNT, scale, exact))


def merge_reduced(reduced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Reduced rows of several reductions added up to one per combination of keys, of the same columns and types."""
    merged = reduced.groupBy(*keys).agg(F.sum(_ROWS).alias(_ROWS), *money.merge(reduced.columns, _AMOUNT))
    return merged.select(*[F.col(f"`{n}`").cast(t).alias(n) for n, t in reduced.dtypes if n in merged.columns])


def finish(reduced: DataFrame, by: Sequence[str], digits: int | None = None) -> DataFrame:
    """Group reduced rows by attributes: `num_events`, `total_charges`, `avg_charges`, rounded when `digits` is given."""
    merged = reduced.groupBy(*by).agg(F.sum(_ROWS).alias("num_events"), *money.merge(reduced.columns, _AMOUNT))
    return _measures(merged, by, "num_events", digits)


def _measures(grouped: DataFrame, by: Sequence[str], rows: str, digits: int | None) -> DataFrame:
    total, mean = money.total(grouped.columns, _AMOUNT), money.mean(grouped.columns, _AMOUNT)
    if digits is not None:
        total, mean = F.round(total, digits), F.round(mean, digits)
    return grouped.select(*by, F.col(rows).alias("num_events"), total.alias("total_charges"), mean.alias("avg_charges"))


def star_totals(
    fact: DataFrame,
    keys: Sequence[str | Column],
    amount: str,
    sides: Sequence[Side],
    by: Sequence[str],
    digits: int | None = None,
    not_null: Sequence[str] = (),
    scale: int | None = None,
) -> DataFrame:
    """Count, sum and average of a fact by attributes of its dimensions."""
    joined = attach(reduce_fact(fact, keys, amount, scale), *sides)
    return finish(joined.na.drop(subset=list(not_null)) if not_null else joined, by, digits)


def totals(
    fact: DataFrame,
    by: Sequence[str | Column],
    names: Sequence[str],
    amount: str,
    digits: int | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Count, sum and average by columns of the fact itself."""
    return _measures(reduce_fact(fact, by, amount, scale), names, _ROWS, digits)


def _month_start(day: str) -> Column:
    """Month as a date: cheaper to group by than its text."""
    return F.trunc(F.to_date(day), "month").alias("__month")


def _with_month(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumn("event_month", F.date_format("__month", "yyyy-MM")).select(*columns)


_MEASURES = ("num_events", "total_charges", "avg_charges")


REGION_KEYS = ("region_key", "smoker")
PROVIDER_KEYS = ("preferred_provider", "network_tier", "__month")


def reduce_by_region(silver: DataFrame, more: Sequence[str] = (), scale: int | None = None) -> DataFrame:
    """Silver rows reduced to region and smoker flag."""
    return reduce_fact(silver, [*more, *REGION_KEYS], "charge_amount", scale)


def reduce_by_provider(
    silver: DataFrame,
    more: Sequence[str] = (),
    day: str = "event_date",
    amount: str = "charge_amount",
    scale: int | None = None,
) -> DataFrame:
    """Silver rows reduced to provider, tier and month."""
    return reduce_fact(silver, [*more, "preferred_provider", "network_tier", _month_start(day)], amount, scale)


def region_smoker_of(reduced: DataFrame, dim_region: DataFrame) -> DataFrame:
    """Charges by region name and smoker flag from reduced rows, of one reduction or of several; in no order."""
    side = Side(dim_region, {"region_key": "region_key"}, {"region_name": "region_name"}, "left")
    return finish(attach(reduced, side), ["region_name", "smoker"])


def provider_month_of(reduced: DataFrame) -> DataFrame:
    """Charges by provider, tier and month from reduced rows, of one reduction or of several; in no order."""
    return _with_month(finish(reduced, PROVIDER_KEYS), ["preferred_provider", "network_tier", "event_month", *_MEASURES])


def gold_region_smoker(silver: DataFrame, dim_region: DataFrame, scale: int | None = None) -> DataFrame:
    """Charges by region name and smoker flag, largest total first; rows without a region stay, under NULL."""
    return region_smoker_of(reduce_by_region(silver, (), scale), dim_region).orderBy(F.desc("total_charges"), "region_name", "smoker")


def gold_provider_month(
    silver: DataFrame, day: str = "event_date", amount: str = "charge_amount", scale: int | None = None
) -> DataFrame:
    """Charges by provider, tier and month, in month order and largest total first."""
    result = provider_month_of(reduce_by_provider(silver, (), day, amount, scale))
    return result.orderBy("event_month", F.desc("total_charges"), "preferred_provider", "network_tier")


def gold_region_smoker_rounded(
    fact: DataFrame, dim_region: DataFrame, dim_profile: DataFrame, scale: int | None = None
) -> DataFrame:
    """Charges by region and smoker flag of a batch fact, in cents, in name order."""
    sides = [
        Side(dim_region, {"region_key": "region_key"}, {"region": "region"}, "left"),
        Side(dim_profile, {"risk_profile_key": "risk_profile_key"}, {"smoker": "smoker"}, "left"),
    ]
    keys, by = ["region_key", "risk_profile_key"], ["region", "smoker"]
    return star_totals(fact, keys, "charge_amount", sides, by, digits=2, scale=scale).orderBy(*by)


def gold_month(
    fact: DataFrame, day: str = "event_date", amount: str = "charge_amount", scale: int | None = None
) -> DataFrame:
    """Charges by month, in cents."""
    grouped = totals(fact, [_month_start(day)], ["__month"], amount, 2, scale)
    return _with_month(grouped, ["event_month", *_MEASURES]).orderBy("event_month")


def star_provider_region(
    silver: DataFrame, dim_provider: DataFrame, dim_region: DataFrame, scale: int | None = None
) -> DataFrame:
    """Charges by provider, tier and region of events that have all three, in cents, largest total first."""
    sides = [
        Side(
            dim_provider,
            {"provider_code": "provider_code"},
            {"preferred_provider": "preferred_provider", "network_tier": "network_tier"},
        ),
        Side(dim_region, {"region_key": "region_key"}, {"region_name": "region_name"}),
    ]
    by = ["preferred_provider", "network_tier", "region_name"]
    keys = ["provider_code", "region_key"]
    result = star_totals(silver, keys, "charge_amount", sides, by, 2, ["preferred_provider", "region_name"], scale)
    return result.orderBy(F.desc("total_charges"), *by)


def avg_month_smoker(
    silver: DataFrame, day: str = "event_date", flag: str = "smoker", amount: str = "charge_amount", scale: int | None = None
) -> DataFrame:
    """Average charge by month and smoker flag, in cents."""
    grouped = totals(silver, [_month_start(day), flag], ["__month", flag], amount, 2, scale)
    return _with_month(grouped, ["event_month", flag, "avg_charges"]).orderBy("event_month", flag)


def star_top(
    claims: DataFrame,
    dim_date: DataFrame,
    dim_insured: DataFrame,
    dim_region: DataFrame,
    n: int = 5,
    scale: int | None = None,
) -> DataFrame:
    """The `n` largest totals by year, smoker flag and region over the claims mart, in cents.

    The calendar is joined first, row by row, as it has few rows; claims are then reduced by year instead of by day.
    """
    dated = lookup(claims, dim_date, ["date_key"], ["calendar_year"], "inner")
    sides = [
        Side(dim_insured, {"insured_key": "insured_key"}, {"smoker": "smoker"}),
        Side(dim_region, {"region_key": "region_key"}, {"region": "region"}),
    ]
    by = ["calendar_year", "smoker", "region"]
    keys = ["calendar_year", "insured_key", "region_key"]
    result = star_totals(dated, keys, "charges", sides, by, 2, scale=scale).select(*by, "total_charges")
    return result.orderBy(F.desc("total_charges"), *by).limit(n)
