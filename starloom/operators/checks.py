"""Checks that declared keys hold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: `table_name`, `n_rows`."""
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows") for t, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break a primary key: NULL in any part, or more than one row. Column `n_rows` says how many rows."""
    missing = reduce(or_, (F.col(k).isNull() for k in keys))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where((F.col("n_rows") > 1) | missing)


def check_fk(child: DataFrame, child_keys: Sequence[str], parent: DataFrame, parent_keys: Sequence[str]) -> DataFrame:
    """Child keys without a parent row, with the number of child rows. Keys with a NULL part are not checked.

    Child rows are counted per key first, so what is matched is one row per key.
    """
    used = child.na.drop(subset=list(child_keys)).groupBy(*child_keys).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(*[F.col(p).alias(f"__{c}") for c, p in zip(child_keys, parent_keys, strict=True)])
    condition = [F.col(c) == F.col(f"__{c}") for c in child_keys]
    return used.join(known, condition, "left_anti")


@dataclass(frozen=True)
class Keys:
    """Declared keys: columns that are unique in a table, and (child, column, parent, column) references."""

    unique: Mapping[str, Sequence[str]]
    foreign: Sequence[tuple[str, str, str, str]] = field(default=())


def violations(tables: Mapping[str, DataFrame], keys: Keys) -> DataFrame:
    """One row per declared key: `table_name`, `rule`, `n_keys` that break it and the `n_rows` they hold; both 0 if it holds."""
    found = [(t, f"unique {', '.join(c)}", check_unique(tables[t], c)) for t, c in keys.unique.items()]
    for child, column, parent, key in keys.foreign:
        found.append((child, f"{column} in {parent}", check_fk(tables[child], [column], tables[parent], [key])))
    totals = [
        broken.agg(F.count(F.lit(1)).alias("n_keys"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")).select(
            F.lit(t).alias("table_name"), F.lit(rule).alias("rule"), "n_keys", "n_rows"
        )
        for t, rule, broken in found
    ]
    return reduce(DataFrame.unionByName, totals)


def unmatched(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows in total, and rows per key column that found no dimension row."""
    misses = [F.count(F.when(F.col(k).isNull(), 1)).alias(f"{k}_missing") for k in keys]
    return fact.agg(F.count(F.lit(1)).alias("n_rows"), *misses)
