"""Sums of amounts in three steps, so that facts can be reduced before they are joined or shuffled.

`partial` aggregates rows, `merge` aggregates partials, `total` and `mean` read the result. The caller states what the amount
is:

* a double: a plain double sum, as `SUM` over the column gives. Its last digits depend on the order of the rows;
* a double whose values are decimals with a stated number of digits after the point (`scale=2` for cents): the sum is exact
  and does not depend on the order, at the speed of a double sum. Whole units of the last digit are added as 64-bit
  integers in three pieces of 21 bits, none of which can overflow below 4e12 rows per group. Groups with an amount that is
  no such number (NaN, infinite, too large for 64 bits, or with further digits) get the double sum;
* a decimal column: Spark's exact decimal sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_PIECE = 21
_MASK = (1 << _PIECE) - 1
# How far an amount may be from its decimal digits: a part of the last digit, or a few roundings of a double.
_DIGIT, _ROUNDING = 1e-3, 2e-15


def partial(amount: Column, name: str, scale: int | None = None, is_decimal: bool = False) -> list[Column]:
    """Aggregates over rows. The names of the columns say what kind of sum they hold."""
    count = F.count(amount).alias(f"{name}__n")
    if is_decimal:
        return [F.sum(amount).alias(f"{name}__decimal"), count]
    amount = amount.cast("double")
    plain = F.sum(amount).alias(f"{name}__double")
    if scale is None:
        return [plain, count]
    units = F.rint(amount * float(10**scale)).try_cast("bigint")
    further = F.abs(units.cast("double") / float(10**scale) - amount) > F.greatest(F.abs(amount) * _ROUNDING, F.lit(_DIGIT / 10**scale))
    return [
        F.sum(F.shiftright(units, 2 * _PIECE)).alias(f"{name}__{scale}_high"),
        F.sum(F.shiftright(units, _PIECE).bitwiseAND(F.lit(_MASK))).alias(f"{name}__{scale}_mid"),
        F.sum(units.bitwiseAND(F.lit(_MASK))).alias(f"{name}__{scale}_low"),
        F.max((units.isNull() | further) & amount.isNotNull()).alias(f"{name}__odd"),
        plain,
        count,
    ]


def merge(columns: Sequence[str], name: str) -> list[Column]:
    """Aggregates over partials, given the columns of these."""
    own = [c for c in columns if c.startswith(f"{name}__")]
    return [(F.max(c) if c.endswith("__odd") else F.sum(c)).alias(c) for c in own]


def total(columns: Sequence[str], name: str) -> Column:
    """The sum as a double; NULL when there was no amount."""
    if f"{name}__decimal" in columns:
        return F.col(f"{name}__decimal").cast("double")
    high = next((c for c in columns if c.startswith(f"{name}__") and c.endswith("_high")), None)
    if high is None:
        return F.col(f"{name}__double")
    scale = int(high.removeprefix(f"{name}__").removesuffix("_high"))
    whole = lambda c: F.col(c).cast("decimal(20,0)")
    piece = lambda n: F.lit(str(1 << n)).cast("decimal(14,0)")
    units = whole(high) * piece(2 * _PIECE) + whole(f"{name}__{scale}_mid") * piece(_PIECE) + whole(f"{name}__{scale}_low")
    exact = (units * F.lit(f"1e-{scale}").cast(f"decimal({scale + 1},{scale})")).cast("double")
    return F.when(F.col(f"{name}__odd"), F.col(f"{name}__double")).otherwise(exact)


def mean(columns: Sequence[str], name: str) -> Column:
    """The average over the amounts that are not NULL."""
    return F.when(F.col(f"{name}__n") > 0, total(columns, name) / F.col(f"{name}__n"))
