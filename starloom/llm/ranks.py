"""Positions of rows inside groups, without ever sorting one group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_TIE, _CELL, _COUNT, _BEFORE, _COARSE = "__tie", "__cell", "__count", "__before", "__coarse"
_FIRST = Window.unboundedPreceding


def tie_hash(columns: Sequence[str]) -> Column:
    """A hex digest that orders rows at random but always alike; null counts as empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys that may be null; the right keys go."""
    renamed = right.select(*[F.col(f"`{k}`").alias(f"__r_{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    on = [F.col(f"`{k}`").eqNullSafe(F.col(f"__r_{i}")) for i, k in enumerate(keys)]
    return left.join(renamed, on).drop(*[f"__r_{i}" for i in range(len(keys))])


def positions(
    rows: DataFrame, group: Sequence[str], order: Sequence[str], key: Sequence[str], name: str = "position"
) -> DataFrame:
    """Add the place of each row, from 0, inside its `group`, ordered by `order` and then by a digest of `key`.

    Nulls in `group` and `order` count as values (first in the order). Rows that agree in everything are numbered in any
    order among themselves. A group is cut into 256 cells by the digest for each value of `order`; only the rows of one
    cell are sorted together, and cells are put in line by their counts, so a group with a third of all rows is spread
    over hundreds of tasks. `rows` is read twice: stage what is costly to compute.
    """
    keys = [*group, *order]
    columns = [f"`{c}`" for c in rows.columns]
    rows = rows.withColumn(_TIE, tie_hash(key)).withColumn(_CELL, F.substring(_TIE, 1, 2))
    cells = rows.groupBy(*[F.col(f"`{k}`") for k in keys], _CELL).agg(F.count(F.lit(1)).alias(_COUNT))
    in_line = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(_CELL).rowsBetween(_FIRST, -1)
    before = cells.withColumn(_BEFORE, F.coalesce(F.sum(_COUNT).over(in_line), F.lit(0))).drop(_COUNT)
    if order:
        totals = cells.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.sum(_COUNT).alias(_COUNT))
        by_order = Window.partitionBy(*[F.col(f"`{g}`") for g in group]).orderBy(*[F.col(f"`{o}`") for o in order])
        totals = totals.withColumn(_COARSE, F.coalesce(F.sum(_COUNT).over(by_order.rowsBetween(_FIRST, -1)), F.lit(0)))
        before = _same(before, totals.drop(_COUNT), keys).withColumn(_BEFORE, F.col(_BEFORE) + F.col(_COARSE))
        before = before.drop(_COARSE)
    in_cell = Window.partitionBy(*[F.col(f"`{k}`") for k in keys], _CELL).orderBy(_TIE, *[F.col(f"`{k}`") for k in key])
    placed = rows.withColumn(name, F.row_number().over(in_cell).cast("bigint") - 1)
    placed = _same(placed, before, [*keys, _CELL])
    return placed.select(*columns, (F.col(name) + F.col(_BEFORE)).alias(name))
