"""Joins with the one row of a key that spread keys with many rows over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = 256  # of one key in one task, at small sizes
KEYS = 10_000  # that can have more than that, at any size


def most_rows(total: int) -> int:
    """Rows of a key that one task may get, so that at most 10,000 keys of `total` rows have more: they are broadcast."""
    return max(ROWS, -(-total // KEYS))


def spread_join(many: DataFrame, one: DataFrame, key: str, by: str, most: int, how: str = "inner") -> DataFrame:
    """Rows of `many` with the row of their key from `one`, which says in a column `__n` how many rows the key has in `many`.

    Rows of a key with more than `most` are dealt out by a hash of the column `by`, so a row that is computed again goes where it
    went before, and the key's one row is repeated for each task. `__n` goes.
    """
    tasks = F.ceil(F.col("__n") / most).cast("int")
    hot = one.filter(F.col("__n") > most).select(F.col(key).alias("__hot"), tasks.alias("__tasks"))
    dealt = many.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
    salt = F.coalesce(F.pmod(F.xxhash64(by), F.col("__tasks")), F.lit(0)).cast("int")
    dealt = dealt.withColumn("__salt", salt).drop("__hot", "__tasks")
    others = [c for c in one.columns if c not in (key, "__n")]
    each = F.explode(F.sequence(F.lit(0), F.greatest(tasks, F.lit(1)) - 1)).alias("__other")
    rows = one.select(F.col(key).alias("__key"), *others, each)
    return dealt.join(rows, (F.col(key) == F.col("__key")) & (F.col("__salt") == F.col("__other")), how).drop("__key", "__salt", "__other")
