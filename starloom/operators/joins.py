"""Joins of large rows with lookups, safe against hot keys.

Plain joins are left to Spark, which broadcasts by its own size check and splits skewed probe partitions at run time. The
operators here add what it does not cover: a broadcast whose size is known, keys with too many rows for one task, and an
outer join whose optional side is the skewed one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, IntegralType, NumericType, TimestampNTZType, TimestampType

from .staging import stage

# A lookup is broadcast when its counted rows take no more than this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_BYTES, _FIELD_BYTES = 16, 8
_PLAIN = (NumericType, DateType, BooleanType, TimestampType, TimestampNTZType)
# Rows of one key that one task should hold; a key with more is spread over several tasks.
HOT_ROWS = 2_000_000

_SALT, _TASKS = "__salt", "__tasks"
# Over so many values are rows spread whose key is NULL and matches nothing.
_NULL_SALTS = 1024


# Operators that give no more rows than they get.
_NARROW = {"Project", "Filter", "SubqueryAlias", "LocalLimit", "GlobalLimit", "Sort", "Aggregate", "Deduplicate"}
# Files of a stored table whose footers the driver reads itself; of more, rows are counted by a job.
_FOOTERS = 16


def planned_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a frame: exact for literal rows only. Files may unpack to any size, and exploded rows are not foreseen."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _leaves(df: DataFrame) -> set[str] | None:
    """Kinds of a plan's leaves; None if anything above them may add rows."""
    leaves, todo = set(), [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        children = node.children()
        if children.isEmpty():
            leaves.add(node.getClass().getSimpleName())
        elif children.size() > 1 or node.nodeName() not in _NARROW:
            return None
        else:
            todo.append(children.head())
    return leaves


def _footers(df: DataFrame, texts: Sequence[str]) -> tuple[int, int] | None:
    """Rows of the files that a frame is read from, and bytes that no row's texts exceed, from a few files' footers: a text is stored
    at least once where it is used, whatever the encoding. None if there are more files, or others than Parquet."""
    files = df.inputFiles()
    if not files or len(files) > _FOOTERS or not all(f.endswith(".parquet") for f in files):
        return None
    spark = df.sparkSession
    jvm, conf, rows, longest = spark._jvm, spark._jsc.hadoopConfiguration(), 0, 0
    for file in files:
        path = jvm.org.apache.hadoop.fs.Path(file)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf))
        try:
            rows += reader.getRecordCount()
            if texts:
                blocks = reader.getFooter().getBlocks()
                longest = max([longest, *(b.getTotalByteSize() for b in blocks)])
        finally:
            reader.close()
    return rows, longest


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the frame's rows take at most `limit` bytes: never an estimate.

    Literal rows are measured in the plan. Of a stored table that is only filtered, projected or reduced, the footers of its
    files say how many rows there are at most; that is enough, without a job, where even the longest possible texts fit. Anything
    else is counted, and text lengths are added up only where the count fits.
    """
    row = _ROW_BYTES + _FIELD_BYTES * len(df.columns)
    texts = [f.name for f in df.schema.fields if not isinstance(f.dataType, _PLAIN)]
    leaves = _leaves(df)
    if leaves is not None and leaves <= {"LocalRelation", "OneRowRelation"}:
        return planned_bytes(df) <= limit
    found = _footers(df, texts) if leaves == {"LogicalRelation"} else None
    if found and found[0] * (row + found[1]) <= limit:
        return True
    rows = df.count() if found is None or found[0] * row > limit else found[0]
    if rows * row > limit:
        return False
    if not texts or not rows:
        return True
    lengths = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in texts]
    return rows * row + (df.agg(F.sum(reduce(add, lengths))).first()[0] or 0) <= limit


def _key_names(count: int) -> list[str]:
    return [f"__key{i}" for i in range(count)]


def _condition(left: Sequence[str], right: Sequence[str], null_safe: bool) -> Column:
    pairs = zip(left, right, strict=True)
    return reduce(and_, (F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b) for a, b in pairs))


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int = HOT_ROWS, null_safe: bool = False) -> DataFrame | None:
    """Keys that hold more than `rows` rows, as `__key0`, ..., with the number of tasks to spread each over; None without any.

    Only the key columns are read, and counted on the map side first. At most one key in `rows` rows can be hot, so the
    result is small beside the data. NULL is a key only with `null_safe`.
    """
    if df.count() <= rows:  # from the files' footers where the rows are stored
        return None
    names = _key_names(len(keys))
    counted = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)])
    if not null_safe:
        counted = counted.na.drop()
    counted = counted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows)
    hot = stage(counted.select(*names, F.ceil(F.col("n") / rows).cast("int").alias(_TASKS)), "hot")
    return None if hot.isEmpty() else hot


def _marked(df: DataFrame, keys: Sequence[str], hot: DataFrame, null_safe: bool) -> DataFrame:
    """The rows with the number of tasks of their key, NULL for keys that are not hot."""
    renamed = hot.toDF(*[f"__hot{i}" for i in range(len(keys))], _TASKS)
    columns = renamed.columns[:-1]
    return df.join(F.broadcast(renamed), _condition(keys, columns, null_safe), "left").drop(*columns)


def _salted(many: DataFrame, keys: Sequence[str], hot: DataFrame, null_safe: bool) -> DataFrame:
    """Rows of hot keys dealt out to salts by the place they are read from; every other row has salt 0.

    Read them from files, or stage them: a task that runs again must find the same places.
    """
    place = F.monotonically_increasing_id()
    salt = F.when(F.col(_TASKS).isNotNull(), F.pmod(place, F.col(_TASKS)))
    if not null_safe:
        salt = salt.when(reduce(or_, (F.col(k).isNull() for k in keys)), F.pmod(place, F.lit(_NULL_SALTS)))
    return _marked(many, keys, hot, null_safe).withColumn(_SALT, salt.otherwise(0).cast("int")).drop(_TASKS)


def _repeated(one: DataFrame, keys: Sequence[str], hot: DataFrame, null_safe: bool) -> DataFrame:
    """Rows of hot keys once per salt; `__tasks` stays."""
    salts = F.sequence(F.lit(0), F.coalesce(F.col(_TASKS), F.lit(1)) - 1)
    return _marked(one, keys, hot, null_safe).withColumn("__other", F.explode(salts))


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str] | Sequence[str] | str,
    take: Mapping[str, str] | Sequence[str] = (),
    how: str = "left",
    null_safe: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    unique: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Bring columns of `dim` to the rows of `fact`.

    `on` maps fact columns to dim columns and `take` maps dim columns to output names; plain names mean the same name on
    both sides. `how` is `left` or `inner`. With `null_safe`, NULL matches NULL.

    A dim within the broadcast bound is broadcast, so fact rows do not move. Of a larger one, few fact rows (an increment) only
    need the dim rows of their keys, which are found by broadcasting the keys, within their range. Else both sides are shuffled and read once;
    fact rows of keys with more than `hot_rows` rows are spread over salts, and their dim rows repeated for each. Say
    `unique=True` when no key occurs often in the fact, and hot keys are not looked for. Streams are joined plainly.
    """
    on = {on: on} if isinstance(on, str) else dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    take = dict(take) if isinstance(take, Mapping) else {c: c for c in take}
    keys, fact_keys = _key_names(len(on)), list(on)
    side = dim.select(
        *[F.col(d).alias(k) for k, d in zip(keys, on.values(), strict=True)],
        *[F.col(c).alias(out) for c, out in take.items()],
    )
    condition = _condition(fact_keys, keys, null_safe)

    if fits_broadcast(side, broadcast_bytes):
        return fact.join(F.broadcast(side), condition, how).drop(*keys)
    if fact.isStreaming:
        return fact.join(side, condition, how).drop(*keys)
    wanted = fact.select(*[F.col(c).alias(f"__want{i}") for i, c in enumerate(fact_keys)])
    if fits_broadcast(wanted, broadcast_bytes):
        found = F.broadcast(wanted.distinct())
        needed = _within(side, keys, wanted, null_safe).join(found, _condition(wanted.columns, keys, null_safe), "left_semi")
        if fits_broadcast(needed, broadcast_bytes):
            return fact.join(F.broadcast(needed), condition, how).drop(*keys)
    hot = None if unique else hot_keys(fact, fact_keys, hot_rows, null_safe)
    if hot is None:
        return fact.join(side, condition, how).drop(*keys)
    many, one = _salted(fact, fact_keys, hot, null_safe), _repeated(side, keys, hot, null_safe)
    return many.join(one, condition & (F.col(_SALT) == F.col("__other")), how).drop(*keys, _SALT, "__other", _TASKS)


def _within(side: DataFrame, keys: Sequence[str], wanted: DataFrame, null_safe: bool) -> DataFrame:
    """The rows between the least and the greatest wanted key: files that lie in key order are then skipped by their footers."""
    whole = len(keys) == 1 and not null_safe and all(isinstance(d.schema[0].dataType, IntegralType) for d in (side, wanted))
    if not whole:
        return side
    least, greatest = wanted.agg(F.min(wanted.columns[0]), F.max(wanted.columns[0])).first()
    return side.where(F.lit(False)) if least is None else side.where(F.col(keys[0]).between(least, greatest))


@dataclass(frozen=True)
class Side:
    """A table to join: `on` maps columns of the rows to columns of the table, `take` its columns to output names."""

    table: DataFrame
    on: Mapping[str, str]
    take: Mapping[str, str] = field(default_factory=dict)
    how: str = "inner"


def attach(rows: DataFrame, *sides: Side) -> DataFrame:
    """Join tables one after the other, leaving the way to Spark. Later sides can use columns taken from earlier ones."""
    for side in sides:
        keys = _key_names(len(side.on))
        table = side.table.select(
            *[F.col(f"`{c}`").alias(k) for k, c in zip(keys, side.on.values(), strict=True)],
            *[F.col(f"`{c}`").alias(out) for c, out in side.take.items()],
        )
        rows = rows.join(table, _condition(list(side.on), keys, False), side.how).drop(*keys)
    return rows


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], take: Sequence[str], how: str = "left") -> DataFrame:
    """Left join by same-named columns in which NULL matches NULL."""
    return lookup(left, right, on, take, how, null_safe=True)


def expand(header: DataFrame, detail: DataFrame, on: str, how: str = "left", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join headers to their detail rows by a same-named key; `left` keeps headers without any.

    Spark can split a skewed left side of a left join but not a skewed right one, which is the side a hot header's details
    are on. Details of headers with more than `hot_rows` of them are therefore spread over salts and the header repeated
    for each; as such a header is known to have details, its repeats that meet none are dropped. Details are read once for
    the join, and their keys once before it.
    """
    key = "__detail_key"
    detail = detail.withColumnRenamed(on, key)
    condition = F.col(on) == F.col(key)
    columns = [*header.columns, *[c for c in detail.columns if c != key]]
    hot = hot_keys(detail, [key], hot_rows)
    if hot is None:
        return header.join(detail, condition, how).select(*columns)
    many, one = _salted(detail, [key], hot, False), _repeated(header, [on], hot, False)
    joined = one.join(many, condition & (F.col(_SALT) == F.col("__other")), how)
    return joined.where(F.col(_TASKS).isNull() | F.col(key).isNotNull()).select(*columns)
