"""Silver: bronze events with their dimension attributes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.facts import build_silver
from ..sinks.tables import drop_partitions, overwrite_partitions, write_table
from ..sources.streams import stream_table
from . import ledger
from .bronze import KEY, drain, refresh
from .gold import GoldTables, drop_reductions, reduce_loads
from .ledger import LOAD, beside

Dims = Mapping[str, DataFrame]


def stream_silver(spark: SparkSession, bronze: str, dims: Dims) -> DataFrame:
    """The bronze table as a stream, left-joined to the static dimensions."""
    return build_silver(stream_table(spark, bronze), dims, keep=[LOAD])


def _laid_out(rows: DataFrame) -> DataFrame:
    """Rows gathered by load, large loads over several tasks, and in order of date, so that a month is found by file footers."""
    return rows.hint("rebalance", LOAD).sortWithinPartitions(LOAD, "event_date")


def _ensure_table(spark: SparkSession, bronze: str, dims: Dims, table: str, location: str | None) -> None:
    """Create silver without rows where no load has created it, so that readers find it."""
    if not spark.catalog.tableExists(table):
        empty = build_silver(spark.table(bronze).where(F.lit(False)), dims, keep=[LOAD])
        write_table(empty, table, partition_by=[LOAD], path=location)


def append_silver(
    spark: SparkSession, bronze: str, dims: Dims, table: str, checkpoint: str, location: str | None = None
) -> None:
    """Append the enriched rows of bronze loads that are new, as a stream joined to the static dimensions.

    A load's files appear together, and its rows keep its name as their partition, so a load that is streamed again, after a
    lost checkpoint or because it was written again, replaces itself.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        overwrite_partitions(batch, table, [LOAD], location)

    drain(stream_silver(spark, bronze, dims), publish, checkpoint)
    refresh(spark, table)
    _ensure_table(spark, bronze, dims, table, location)


# Which silver columns say that a dimension has no row for a key, and the key. A member's columns may be NULL for other
# reasons; then the load is enriched once more than needed. Silver has no plan key where there is no plan.
_MISSES = {
    "member": (("sex", "smoker", "region", "region_key"), "member_id"),
    "provider": (("provider_key",), "provider_code"),
    "date": (("date_key",), "event_date"),
    "plan": (("plan_key",), None),
}


def unmatched_of(table: str) -> str:
    return f"{table}__unmatched"


def _unmatched(silver: DataFrame) -> DataFrame:
    """Per load, the distinct keys that found no dimension row: (dimension, key), and one row without either.

    Each dimension's misses are read on their own, with no other columns, and where the files' footers know of no NULL
    nothing is read at all.
    """
    none = F.lit(None).cast("string")
    parts = [silver.select(none.alias("dimension"), none.alias("key"), LOAD)]
    for name, (columns, key) in _MISSES.items():
        missing = reduce(lambda a, b: a & b, (F.col(c).isNull() for c in columns))
        if key:
            missing &= F.col(key).isNotNull()
        value = F.col(key).cast("string") if key else none
        parts.append(silver.where(missing).select(F.lit(name).alias("dimension"), value.alias("key"), LOAD))
    return reduce(DataFrame.unionByName, parts).distinct()


def _note_unmatched(spark: SparkSession, table: str, loads: Sequence[str]) -> None:
    """Keep the unmatched keys of loads."""
    found = _unmatched(spark.table(table).where(F.col(LOAD).isin(list(loads))))
    overwrite_partitions(found, unmatched_of(table), [LOAD], beside(spark, table, "unmatched"))


def _take_in(
    spark: SparkSession,
    bronze: str,
    dims: Dims,
    table: str,
    versions: Mapping[str, int],
    location: str | None,
    gold: GoldTables | None,
) -> None:
    """Enrich whole loads, keep their unmatched keys, and note them once all that is done; then reduce them."""
    loads = sorted(versions)
    changed = spark.table(bronze).where(F.col(LOAD).isin(loads))
    overwrite_partitions(_laid_out(build_silver(changed, dims, keep=[LOAD])), table, [LOAD], location)
    spark.catalog.refreshTable(table)
    _note_unmatched(spark, table, loads)
    ledger.note(spark, table, versions, 1)
    if gold:
        reduce_loads(spark, table, gold, loads)


def _drop_loads(spark: SparkSession, table: str, loads: Sequence[str], gold: GoldTables | None) -> None:
    if loads:
        for name in (table, unmatched_of(table)):
            if spark.catalog.tableExists(name):
                drop_partitions(spark, name, LOAD, loads)
        ledger.note(spark, table, dict.fromkeys(loads), 0)
        if gold:
            drop_reductions(spark, table, gold, loads)


def enrich_silver(
    spark: SparkSession,
    bronze: str,
    dims: Dims,
    table: str,
    checkpoint: str,
    location: str | None = None,
    after: Callable[[Sequence[str]], None] | None = None,
    gold: GoldTables | None = None,
) -> None:
    """Bring silver up to date with the bronze loads that were written since the last run.

    Bronze's ledger is read as a stream, so only what was noted since is looked at, and neither files nor partitions of bronze are
    listed. Each changed load is enriched as a whole and replaces its silver partition. A load that is written twice, a
    replayed micro-batch and a lost checkpoint all end with the same rows: silver's own ledger says which version of a load it has.

    `after` is called with the loads once they are in silver. With `gold`, its reductions follow; should that fail, they are
    made by the next refresh of gold. Loads that bronze no longer has go from silver and the reductions.
    """
    ledger.ensure(spark, bronze, KEY)
    ledger.ensure(spark, table)

    def publish(batch: DataFrame, batch_id: int) -> None:
        noted = ledger.streamed(batch)
        if not noted:
            return
        refresh(spark, bronze)
        own = ledger.loads(spark, table)
        versions = {x: e.version for x, e in noted.items() if e.n_rows and (x not in own or (own[x].taken or 0) < e.version)}
        if versions:
            _take_in(spark, bronze, dims, table, versions, location, gold)
            if after:
                after(sorted(versions))
        _drop_loads(spark, table, [x for x, e in noted.items() if not e.n_rows and x in own], gold)

    if spark.catalog.tableExists(bronze):
        drain(stream_table(spark, ledger.ledger_of(bronze)), publish, checkpoint)
    refresh(spark, table)
    _ensure_table(spark, bronze, dims, table, location)


def repair_silver(
    spark: SparkSession,
    bronze: str,
    dims: Dims,
    table: str,
    location: str | None = None,
    gold: GoldTables | None = None,
) -> list[str]:
    """Enrich again the loads with keys that had no dimension row and have one now; returns them.

    The unmatched keys of each load were kept when it was written, so the dimensions meet one row per key and load, and of bronze
    only the partitions of the loads that are hit are read.
    """
    if not spark.catalog.tableExists(unmatched_of(table)):
        return []
    spark.catalog.refreshTable(unmatched_of(table))
    missed = spark.table(unmatched_of(table))
    day = next(c for c in dims["date"].columns if c.lower() in ("full_date", "date"))
    hit = []
    for name, column in {"member": "member_id", "provider": "provider_code", "date": day}.items():
        known = dims[name].select(F.col(column).cast("string").alias("__key"))
        hit.append(missed.where(F.col("dimension") == name).join(known, F.col("key") == F.col("__key"), "left_semi").select(LOAD))
    loads = {r[LOAD] for r in reduce(DataFrame.unionByName, hit).distinct().collect()}
    loads |= _with_new_plans(spark, bronze, dims, table, [r[LOAD] for r in missed.where("dimension = 'plan'").select(LOAD).distinct().collect()])
    versions = {x: e.version for x, e in ledger.loads(spark, bronze).items() if x in loads}
    if versions:
        _take_in(spark, bronze, dims, table, versions, location, gold)
        refresh(spark, table)
    return sorted(versions)


def _with_new_plans(spark: SparkSession, bronze: str, dims: Dims, table: str, loads: Sequence[str]) -> set[str]:
    """Of loads without some plan, those with a plan in bronze that is there now and that silver does not have."""
    if not loads:
        return set()
    of_load = lambda t: spark.table(t).where(F.col(LOAD).isin(list(loads))).select(LOAD, F.col("plan_key").cast("int").alias("plan_key"))
    known = dims["plan"].select(F.col("plan_key").alias("__plan"))
    there = of_load(bronze).distinct().join(known, F.col("plan_key") == F.col("__plan"), "left_semi")
    return {r[LOAD] for r in there.subtract(of_load(table).distinct()).select(LOAD).distinct().collect()}


def rebuild_silver(
    spark: SparkSession,
    bronze: str,
    dims: Dims,
    table: str,
    location: str | None = None,
    gold: GoldTables | None = None,
) -> None:
    """Build silver anew from all of bronze, which also repairs rows that were enriched before their dimension rows arrived.

    An existing table of the same columns is replaced load by load, and loads it should not have go last, so it is never
    empty on the way. With `gold`, the reductions that its refresh by load adds up are made anew as well; without, the next
    refresh by load sees that silver's versions are newer and makes them.
    """
    ledger.ensure(spark, bronze, KEY)
    rows = _laid_out(build_silver(spark.table(bronze), dims, keep=[LOAD]))
    if spark.catalog.tableExists(table) and dict(spark.table(table).dtypes) != dict(rows.dtypes):
        write_table(rows, table, partition_by=[LOAD], overwrite_schema=True, path=location)
    else:
        overwrite_partitions(rows, table, [LOAD], location)
    refresh(spark, table)
    versions = {x: e.version for x, e in ledger.loads(spark, bronze).items()}
    held = list(ledger.loads(spark, table))
    _note_unmatched(spark, table, sorted(versions))
    ledger.note(spark, table, versions, 1)
    _drop_loads(spark, table, [x for x in held if x not in versions], gold)
    if gold:
        reduce_loads(spark, table, gold)
