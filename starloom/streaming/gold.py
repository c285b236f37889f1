"""Gold: aggregates refreshed from silver, as a whole or load by load.

Read as a whole, silver is scanned again at every refresh. Load by load, each silver load is reduced once, when it changes, and
kept as a partition of a small table; a refresh only adds those reductions up. Both give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.gold import (
    PROVIDER_KEYS,
    REGION_KEYS,
    merge_reduced,
    provider_month_of,
    reduce_by_provider,
    reduce_by_region,
    region_smoker_of,
)
from ..sinks.tables import drop_partitions, overwrite_partitions, partition_values, write_table
from . import ledger
from .ledger import LOAD


@dataclass(frozen=True)
class GoldTables:
    """Names of the two gold tables; with `root`, they are external below it.

    `scale` says that the charges are decimals with so many digits, whose sums are then exact.
    """

    region_smoker: str
    provider_month: str
    root: str | None = None
    scale: int | None = None

    def location(self, table: str) -> str | None:
        return f"{self.root}/{table}" if self.root else None

    @property
    def reduced(self) -> tuple[str, str]:
        """Names of the tables that hold one reduction per silver load."""
        return f"{self.region_smoker}_by_load", f"{self.provider_month}_by_load"


def overwrite_rows(df: DataFrame, table: str, location: str | None = None) -> None:
    """Replace a table's rows, creating the table if it is not there. Its columns stay."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df = df.select(*spark.table(table).columns)
    write_table(df, table, path=location)


_MARK = "__reduced"


def _behind(spark: SparkSession, silver: str, gold: GoldTables) -> dict[str, ledger.Entry]:
    """Silver's loads that were noted after the version up to which all are reduced."""
    mark = ledger.noted(spark, gold.reduced[0], _MARK)
    return ledger.since(spark, silver, mark.taken if mark else 0)


# Reductions of single loads, and of tiers, from which they are merged into one tier.
MOST_PARTS = 64
_TIER = "__tier-"


def _tiers(spark: SparkSession, gold: GoldTables) -> dict[str, int]:
    """The tier that holds each load's reduction, of those that are in one."""
    return {x: e.greatest for x, e in ledger.entries(spark, gold.reduced[0]).items() if e.greatest}


def _parts(spark: SparkSession, gold: GoldTables, tiers: dict[str, int]) -> tuple[list[str], list[str]]:
    """Partitions that count: of single loads, and of tiers. What a tier has replaced, or has been replaced, may still be there."""
    there = partition_values(spark, gold.reduced[0], LOAD)
    live = {f"{_TIER}{n}" for n in tiers.values()}
    return [p for p in there if not p.startswith(_TIER) and p not in tiers], sorted(p for p in there if p in live)


def reduce_loads(spark: SparkSession, silver: str, gold: GoldTables, loads: Sequence[str] | None = None) -> None:
    """Reduce the given silver loads, or all of them after a rebuild, and keep the reductions. What was kept of a load stays until
    its new reduction is complete; of all loads, those that silver does not have go last.

    When many loads have piled up their reductions are merged into a tier, and many tiers into one, so that there are at most some
    hundred partitions, however many loads. If a load in a tier is written again, the loads of that tier are reduced anew.
    """
    behind, tiers = _behind(spark, silver, gold), _tiers(spark, gold)
    rows, again = spark.table(silver), list(tiers)
    if loads is not None:
        hit = {tiers[x] for x in loads if x in tiers}
        again = [x for x, n in tiers.items() if n in hit]
        loads = sorted({*loads, *again})
        rows = rows.where(F.col(LOAD).isin(loads))
    by_region, by_provider = gold.reduced
    of_region = reduce_by_region(rows, [LOAD], gold.scale)
    of_provider = reduce_by_provider(rows, [LOAD], scale=gold.scale)
    for table, reduced in ((by_region, of_region), (by_provider, of_provider)):
        overwrite_partitions(reduced, table, [LOAD], gold.location(table))
        spark.catalog.refreshTable(table)
    ledger.note(spark, by_region, dict.fromkeys(again), None)  # from here on their own reductions count
    if loads is None:
        held = set(partition_values(spark, silver, LOAD))
        _drop(spark, gold, [v for v in partition_values(spark, by_region, LOAD) if v not in held])
    elif again:
        _drop(spark, gold, [f"{_TIER}{n}" for n in hit])
    if behind and (loads is None or behind.keys() <= set(loads)):
        ledger.note(spark, by_region, {_MARK: max(e.version for e in behind.values())}, None)
    _merge_parts(spark, gold)


def _merge_parts(spark: SparkSession, gold: GoldTables) -> None:
    """Merge reductions into a tier where too many have piled up: write it, note which loads it holds, drop what it replaces."""
    there = partition_values(spark, gold.reduced[0], LOAD)
    if len(there) <= MOST_PARTS:
        return
    tiers = _tiers(spark, gold)
    singles, live = _parts(spark, gold, tiers)
    if len(singles) > MOST_PARTS:
        merged, held = singles, singles
    elif len(live) > MOST_PARTS:
        merged = live[: MOST_PARTS // 2]
        held = [x for x, n in tiers.items() if f"{_TIER}{n}" in merged]
    else:
        return
    number = max([*tiers.values(), *(int(p.removeprefix(_TIER)) for p in there if p.startswith(_TIER)), 0]) + 1
    for table, keys in zip(gold.reduced, (REGION_KEYS, PROVIDER_KEYS)):
        rows = merge_reduced(spark.table(table).where(F.col(LOAD).isin(merged)), keys)
        overwrite_partitions(rows.withColumn(LOAD, F.lit(f"{_TIER}{number}")), table, [LOAD], gold.location(table))
        spark.catalog.refreshTable(table)
    ledger.note(spark, gold.reduced[0], dict.fromkeys(held), None, number)
    _drop(spark, gold, merged)


def _drop(spark: SparkSession, gold: GoldTables, parts: Sequence[str]) -> None:
    for table in gold.reduced:
        if parts and spark.catalog.tableExists(table):
            drop_partitions(spark, table, LOAD, parts)


def drop_reductions(spark: SparkSession, silver: str, gold: GoldTables, loads: Sequence[str]) -> None:
    """Drop the reductions of loads that are gone from silver; the others of their tiers are reduced anew."""
    tiers = _tiers(spark, gold)
    if any(x in tiers for x in loads):
        reduce_loads(spark, silver, gold, [x for x in loads if x in tiers])
    _drop(spark, gold, loads)


def refresh_gold(spark: SparkSession, silver: str, dim_region: DataFrame, gold: GoldTables, by_load: bool = False) -> None:
    """Refresh both gold tables, from silver or from its reductions. Tables keep no order: sort when reading.

    Loads whose reduction is older than silver's rows, after a rebuild or a run that failed between the two, are reduced first.
    """
    if by_load:
        behind = _behind(spark, silver, gold)
        if behind or not spark.catalog.tableExists(gold.reduced[0]):
            drop_reductions(spark, silver, gold, [x for x, e in behind.items() if not e.n_rows])
            reduce_loads(spark, silver, gold, sorted(behind))
        parts = [p for some in _parts(spark, gold, _tiers(spark, gold)) for p in some]
        by_region, by_provider = (spark.table(t).where(F.col(LOAD).isin(parts)) for t in gold.reduced)
    else:
        rows = spark.table(silver)
        by_region, by_provider = reduce_by_region(rows, (), gold.scale), reduce_by_provider(rows, scale=gold.scale)
    overwrite_rows(region_smoker_of(by_region, dim_region), gold.region_smoker, gold.location(gold.region_smoker))
    overwrite_rows(provider_month_of(by_provider), gold.provider_month, gold.location(gold.provider_month))
