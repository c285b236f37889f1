"""Dense ids and surrogate keys without a single-task window over the data."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from itertools import accumulate
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import stage

_POSITION = "__position"
_TIE = "__tie"
# monotonically_increasing_id() holds the partition above bit 33 and the row number below it.
_PART_SHIFT = 33


def _order(order_by: Sequence[Column | str] | Column | str) -> list[Column]:
    items = [order_by] if isinstance(order_by, (Column, str)) else list(order_by)
    return [F.col(c) if isinstance(c, str) else c for c in items]


def dense_id(
    df: DataFrame,
    order_by: Sequence[Column | str] | Column | str | None,
    name: str = "id",
    unique: bool = True,
    from_files: bool = False,
) -> DataFrame:
    """Add ids 1..n in the given order, as one `row_number` over all rows would, but in parallel.

    The rows are ranged and sorted once and written; every range then only needs the number of rows before it, one number
    per written range, which the projection that reads the rows carries along. Small ranges are merged at run time.

    Say `unique=False` when the order has ties: equal rows are then told apart by content and by the place they are read
    from, so that even many copies of one row spread over several ranges. The places must be the same if a task runs again,
    so the rows are written first, unless `from_files` says that they come from files without a shuffle on the way.

    Without an order (None) rows are numbered as they are read, a file's rows in file order, and nothing is shuffled.
    """
    order = [] if order_by is None else _order(order_by)
    columns = df.columns
    ranged = df
    if order and not unique:
        content = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
        ranged = (df if from_files else stage(df, "untied")).withColumn(_TIE, F.monotonically_increasing_id())
        order = [*order, content, F.col(_TIE)]
    if order:
        ranged = ranged.repartitionByRange(*order).sortWithinPartitions(*order)
    positioned = ranged.select(*[F.col(f"`{c}`") for c in columns], F.monotonically_increasing_id().alias(_POSITION))
    fixed = stage(positioned, "ranged")
    row_in_part = F.col(_POSITION).bitwiseAND(F.lit((1 << _PART_SHIFT) - 1))
    columns = [F.col(f"`{c}`") for c in columns]
    if len(fixed.inputFiles()) <= 1:  # one range: nothing comes before it
        return fixed.select(*columns, (row_in_part + 1).alias(name))
    part = F.shiftright(_POSITION, _PART_SHIFT).cast("int")
    counted = fixed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per written range
    sizes = {row.part: row.n for row in counted}
    before = [0, *accumulate(sizes.get(p, 0) for p in range(max(sizes, default=0)))]
    bases = F.from_json(F.lit(json.dumps(before)), "array<bigint>")
    return fixed.select(*columns, (F.get(bases, part) + row_in_part + 1).alias(name))


def surrogate_key(distinct_rows: DataFrame, name: str, order_by: Sequence[Column | str] | Column | str) -> DataFrame:
    """Number distinct rows 1..n in the given order, which must be unique over them. The same way for all sizes."""
    return dense_id(distinct_rows, order_by, name)


def grow_keys(
    known: DataFrame, rows: DataFrame, name: str, cols: Sequence[str], order_by: Sequence[Column | str] | Column | str | None = None
) -> DataFrame:
    """New rows (name, *cols) for a key table: distinct combinations of `cols` that `known` does not have, numbered on from its greatest key.

    NULL counts as a value. Keys once given never change, so the numbering is that of one run only within what came together.
    Only distinct combinations meet the table, and only new ones are ranged.
    """
    held = known.select(*[F.col(f"`{c}`").alias(f"__{c}") for c in cols])
    same = reduce(and_, (F.col(f"`{c}`").eqNullSafe(F.col(f"`__{c}`")) for c in cols))
    fresh = rows.select(*[f"`{c}`" for c in cols]).distinct().join(held, same, "left_anti")
    last = known.agg(F.max(name)).first()[0] or 0
    numbered = surrogate_key(fresh, name, list(cols) if order_by is None else order_by)
    return numbered.select((F.col(name) + F.lit(last).cast("bigint")).alias(name), *[f"`{c}`" for c in cols])


def first_seen_key(df: DataFrame, cols: Sequence[str], order: str, name: str) -> DataFrame:
    """Distinct combinations of `cols`, numbered by where they first appear along the column `order`.

    NULL counts as a value. `order` must be unique per row of `df`, so that the firsts are unique too.
    """
    firsts = df.groupBy(*cols).agg(F.min(order).alias("__first"))
    return surrogate_key(firsts, name, "__first").drop("__first")
