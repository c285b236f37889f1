"""Row-set operators: distinct by key, set difference, top rows, batches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ids import dense_id


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key. Without an order any row survives; with one, the first row along it, NULL first.

    The least order value of each key is found by a hash aggregate over the key and that column alone, which combines
    copies before the shuffle, and brings its rows back by a join, whose skewed keys Spark can split. What still ties is
    decided by a hash of the content, so columns of any type are accepted; the choice among ties says nothing more.
    """
    if order_by is None:
        return df.dropDuplicates(list(keys))
    content = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    rows = df.withColumn("__content", content)
    for c in [*[c for c in order_by if c not in keys], "__content"]:
        value = F.col(f"`{c}`")
        least = rows.groupBy(*[F.col(f"`{k}`").alias(f"__key{i}") for i, k in enumerate(keys)]).agg(
            F.min(value).alias("__least"), F.max(value.isNull()).alias("__null")
        )
        same = reduce(and_, (F.col(f"`{k}`").eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(keys)))
        wanted = F.when(F.col("__null"), value.isNull()).otherwise(value == F.col("__least"))
        rows = rows.join(least, same).where(wanted).drop(*least.columns)
    return rows.dropDuplicates(list(keys)).select(*[f"`{c}`" for c in df.columns])


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of `left` that are not in `right`; copies are folded before rows are matched."""
    return left.distinct().subtract(right.distinct())


def top_rows(df: DataFrame, order_by: Sequence[Column | str], n: int) -> DataFrame:
    """The first `n` rows. End the order with a unique column, or the rows picked among ties can vary."""
    return df.orderBy(*order_by).limit(n)


def split_batches(df: DataFrame, n: int, key: str, name: str = "interval", dense: bool = False) -> DataFrame:
    """Number the rows with batches 1..n along the unique column `key`: n-1 batches of equal size, the rest in the last.

    Fewer rows than batches give one row per batch. With `dense` the key is 1..rows already, and no row moves.
    """
    numbered = df.withColumn("__row", F.col(key)) if dense else dense_id(df, key, "__row")
    size = max(1, numbered.count() // n)
    batch = F.least(F.lit(n), F.expr(f"(__row - 1) div {size}") + 1)
    return numbered.withColumn(name, batch.cast("int")).drop("__row")
