"""End-to-end runs: the streamed lakehouse, the batch star schema and the claims mart."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import BATCH_DAYS, BATCH_START, CLAIM_YEAR, INTERVALS
from ..operators.checks import Keys, row_counts, violations
from ..operators.ids import dense_id, grow_keys
from ..operators.rows import split_batches
from ..operators.staging import make_folder, scratch, stage
from ..sinks.tables import Buckets, insert_rows, reset, write_table
from ..streaming import ledger
from ..streaming.bronze import append_increment, ingest_bronze
from ..streaming.gold import GoldTables, refresh_gold
from ..streaming.silver import enrich_silver, rebuild_silver, repair_silver
from .calendar import calendar, calendar_basic
from .dimensions import (
    build_dim_insured,
    build_dim_member,
    build_dim_plan,
    build_dim_region,
    build_profile_dim,
    build_region_enriched,
    conform_provider,
    derive_insured,
    number_rows,
    provider_rows,
    type_rows,
)
from .facts import add_event_date, build_claims, build_events, build_fact
from .gold import gold_month, gold_region_smoker_rounded


@dataclass(frozen=True)
class Layout:
    """Where a run keeps its tables and files. `prefix` starts every table name; with `root`, tables are external below it.

    `scale` says that charges are decimals with so many digits, whose sums are then exact; None adds them up as doubles. `buckets` puts
    members and bronze in so many buckets of members: beyond the broadcast bound neither is shuffled to be joined.
    """

    prefix: str = ""
    root: str | None = None
    scale: int | None = None
    buckets: int | None = None

    def table(self, name: str) -> str:
        return f"{self.prefix}{name}"

    def location(self, name: str) -> str | None:
        return f"{self.root}/tables/{name}" if self.root else None

    def write(self, df: DataFrame, name: str, **options) -> DataFrame:
        """Write a table and return it as read back."""
        write_table(df, self.table(name), path=self.location(name), **options)
        return df.sparkSession.table(self.table(name))

    def checkpoint(self, base: str, name: str) -> str:
        return f"{base}/checkpoints/{self.prefix}{name}"


def reset_stream(spark: SparkSession, layout: Layout, base: str, name: str) -> None:
    """Drop a streamed table together with its data and its own checkpoint."""
    location = layout.location(name)
    paths = [layout.checkpoint(base, name), *([location] if location else [])]
    reset(spark, [layout.table(name)], paths)


def gold_tables(layout: Layout) -> GoldTables:
    """The gold tables of a streamed run."""
    names = layout.table("gold_charges_by_region_smoker"), layout.table("gold_charges_by_provider_month")
    return GoldTables(*names, root=f"{layout.root}/tables" if layout.root else None, scale=layout.scale)


@scratch()
def run_medallion(
    spark: SparkSession,
    insurance: DataFrame,
    order: str | None,
    dim_date: DataFrame,
    layout: Layout,
    base: str,
    increment: str | None = "increment-1",
) -> dict[str, str]:
    """Insurance rows to dimensions, event files, bronze, silver and gold, then one batch increment through all of them.

    A run starts anew: streamed tables of an earlier one go together with their checkpoints. `continue_medallion` goes on
    from there. The events arrive in three intervals, each a load.
    `order` is a unique column that fixes member ids, None for the order the rows are read in; `base` is the folder for event
    files and checkpoints.
    Returns the table names. Intermediate results are deleted at the end.
    """
    for name in ("fact_insurance_bronze", "fact_insurance_silver"):
        reset_stream(spark, layout, base, name)
    reset(spark, [layout.table("dim_member")], [p for p in [layout.location("dim_member")] if p])
    rows = number_rows(insurance, order)
    region = layout.write(build_dim_region(rows), "dim_region")
    of_member = Buckets("member_id", layout.buckets) if layout.buckets else None
    member = layout.write(build_dim_member(rows, region, keep_region=True), "dim_member", buckets=of_member)
    layout.write(build_profile_dim(member), "dim_risk_profile")
    dims = {
        "member": member,
        "provider": layout.write(conform_provider(provider_rows(spark)), "dim_provider"),
        "date": layout.write(dim_date, "dim_date"),
        "plan": layout.write(build_dim_plan(spark), "dim_plan"),
    }

    gold = gold_tables(layout)
    files = event_files(layout, base)
    reset(spark, gold.reduced, [*[p for p in map(gold.location, gold.reduced) if p], files])
    batches = stage(split_batches(build_events(rows), INTERVALS, "member_id", dense=True), "batches")
    for interval in range(1, INTERVALS + 1):
        batches.where(F.col("interval") == interval).write.mode("append").partitionBy("interval").json(files)
        _ingest(spark, layout, base)
    _refresh(spark, layout, base, dims, region)
    return continue_medallion(spark, layout, base, increment) if increment else medallion_tables(layout)


def event_files(layout: Layout, base: str) -> str:
    """The folder that event files arrive in."""
    return f"{base}/stream_input/{layout.prefix}events"


def _ingest(spark: SparkSession, layout: Layout, base: str) -> None:
    name = "fact_insurance_bronze"
    make_folder(spark, event_files(layout, base))
    place, checkpoint = layout.location(name), layout.checkpoint(base, name)
    ingest_bronze(spark, event_files(layout, base), layout.table(name), checkpoint, location=place, buckets=layout.buckets)


def _refresh(spark: SparkSession, layout: Layout, base: str, dims: dict[str, DataFrame], region: DataFrame) -> None:
    name, gold = "fact_insurance_silver", gold_tables(layout)
    bronze, silver = layout.table("fact_insurance_bronze"), layout.table(name)
    enrich_silver(spark, bronze, dims, silver, layout.checkpoint(base, name), layout.location(name), gold=gold)
    refresh_gold(spark, silver, region.withColumnRenamed("region", "region_name"), gold, by_load=True)


def medallion_tables(layout: Layout) -> dict[str, str]:
    """Names of the tables of a streamed run."""
    gold = gold_tables(layout)
    tables = ("dim_region", "dim_member", "dim_risk_profile", "dim_provider", "dim_date", "dim_plan")
    return {
        **{t: layout.table(t) for t in tables},
        "bronze": layout.table("fact_insurance_bronze"),
        "silver": layout.table("fact_insurance_silver"),
        "gold_region_smoker": gold.region_smoker,
        "gold_provider_month": gold.provider_month,
    }


def _dims(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {d: spark.table(layout.table(f"dim_{d}")) for d in ("member", "provider", "date", "plan")}


def add_members(spark: SparkSession, layout: Layout, base: str, insurance: DataFrame, order: str | None, batch: str) -> None:
    """Take in new insurance rows: members numbered on from the last one, new regions and profiles likewise, and their events as a file.

    Rows that are there keep their keys. The batch's name, with the number its members start from, is noted before anything
    is written, so a batch that failed half-way goes on with the same numbers, and one that is complete is passed over.
    """
    table = {d: layout.table(f"dim_{d}") for d in ("member", "region", "risk_profile")}
    known = {d: spark.table(t) for d, t in table.items()}
    begun = ledger.noted(spark, table["member"], batch)
    if begun and begun.n_rows:
        return
    start = begun.taken if begun else known["member"].agg(F.max("member_id")).first()[0] or 0
    if not begun:
        ledger.note(spark, table["member"], {batch: start}, None)
    rows = number_rows(insurance, order)
    rows = stage(rows.withColumn("member_id", F.col("member_id") + F.lit(start).cast("bigint")), "members")
    named = rows.select(F.col("region").cast("string").alias("region")).na.drop()
    insert_rows(stage(grow_keys(known["region"], named, "region_key", ["region"]), "regions"), table["region"])
    spark.catalog.refreshTable(table["region"])
    member = build_dim_member(rows, spark.table(table["region"]), keep_region=True)
    there = known["member"].where(F.col("member_id") > start).select(F.col("member_id").alias("__id"))
    member = stage(member.join(there, F.col("member_id") == F.col("__id"), "left_anti"), "member")
    insert_rows(member, table["member"])
    spark.catalog.refreshTable(table["member"])
    profile = ["sex", "smoker", "region_key"]
    added = spark.table(table["member"]).where(F.col("member_id") > start)
    fresh = stage(grow_keys(known["risk_profile"], added, "risk_profile_key", profile), "profiles")
    insert_rows(fresh, table["risk_profile"])
    build_events(rows).write.mode("overwrite").json(f"{event_files(layout, base)}/members={batch}")
    ledger.note(spark, table["member"], {batch: start}, 1)


@scratch()
def continue_medallion(
    spark: SparkSession,
    layout: Layout,
    base: str,
    increment: str | None = None,
    insurance: DataFrame | None = None,
    order: str | None = None,
    batch: str = "members-2",
) -> dict[str, str]:
    """Go on from an earlier run's tables and checkpoints: take in new insurance rows under a batch name, event files that have
    arrived and, if named, an increment.

    Only loads that are new or changed are enriched and reduced. Loads with events whose dimension rows have come since are
    enriched again.
    """
    if insurance is not None:
        add_members(spark, layout, base, insurance, order, batch)
    dims = _dims(spark, layout)
    _ingest(spark, layout, base)
    if increment:
        append_increment(spark, layout.table("fact_insurance_bronze"), increment)
    if insurance is not None:
        repair_silver(spark, layout.table("fact_insurance_bronze"), dims, *_silver(layout), gold_tables(layout))
    _refresh(spark, layout, base, dims, spark.table(layout.table("dim_region")))
    return medallion_tables(layout)


def _silver(layout: Layout) -> tuple[str, str | None]:
    name = "fact_insurance_silver"
    return layout.table(name), layout.location(name)


@scratch()
def rebuild_medallion(spark: SparkSession, layout: Layout) -> dict[str, str]:
    """Silver anew from all of bronze with the dimensions as they are now, its reductions and both gold tables."""
    gold = gold_tables(layout)
    rebuild_silver(spark, layout.table("fact_insurance_bronze"), _dims(spark, layout), *_silver(layout), gold)
    region = spark.table(layout.table("dim_region")).withColumnRenamed("region", "region_name")
    refresh_gold(spark, layout.table("fact_insurance_silver"), region, gold, by_load=True)
    return medallion_tables(layout)


BATCH_KEYS = Keys(
    unique={
        "dim_region": ("region_key",),
        "dim_member": ("member_id",),
        "dim_risk_profile": ("risk_profile_key",),
        "dim_plan": ("plan_key",),
        "fact_insurance_silver": ("member_id",),
    },
    foreign=(
        ("dim_member", "region_key", "dim_region", "region_key"),
        ("fact_insurance_silver", "member_id", "dim_member", "member_id"),
        ("fact_insurance_silver", "region_key", "dim_region", "region_key"),
        ("fact_insurance_silver", "plan_key", "dim_plan", "plan_key"),
        ("fact_insurance_silver", "risk_profile_key", "dim_risk_profile", "risk_profile_key"),
    ),
)
MART_KEYS = Keys(
    unique={"dim_date": ("date_key",), "dim_insured": ("insured_key",), "dim_region": ("region_key",), "fact_claims": ("claim_key",)},
    foreign=(
        ("fact_claims", "insured_key", "dim_insured", "insured_key"),
        ("fact_claims", "region_key", "dim_region", "region_key"),
        ("fact_claims", "date_key", "dim_date", "date_key"),
    ),
)


@scratch()
def run_batch(
    spark: SparkSession, insurance: DataFrame, order: str | None, layout: Layout, date_source: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The batch star schema: five dimensions, the fact and two gold tables, written and returned as read back.

    `violations` says how often the star's declared keys are broken.
    """
    rows = add_event_date(number_rows(insurance, order), BATCH_START, BATCH_DAYS)
    region = layout.write(build_dim_region(rows), "dim_region")
    member = layout.write(build_dim_member(rows, region), "dim_member")
    profile = layout.write(build_profile_dim(member), "dim_risk_profile")
    tables = {
        "dim_region": region,
        "dim_member": member,
        "dim_risk_profile": profile,
        "dim_plan": layout.write(build_dim_plan(spark), "dim_plan"),
        "dim_date": layout.write(calendar(date_source, rows, "event_date"), "dim_date"),
    }
    fact = layout.write(build_fact(rows, member, profile), "fact_insurance_silver")
    star = {**tables, "fact_insurance_silver": fact}
    return {
        **star,
        "violations": violations(star, BATCH_KEYS),
        "gold_region_smoker": layout.write(gold_region_smoker_rounded(fact, region, profile, layout.scale), "gold_region_smoker"),
        "gold_month": layout.write(gold_month(fact, scale=layout.scale), "gold_month"),
    }


@scratch()
def run_mart(
    insurance: DataFrame, providers: DataFrame, order: str | None, layout: Layout, year: int = CLAIM_YEAR
) -> dict[str, DataFrame]:
    """The claims mart: calendar, insured and region dimensions and the claims fact, with the row count of each table.

    `violations` says how often the mart's declared keys are broken.
    """
    insured = dense_id(derive_insured(type_rows(insurance)), order, "claim_key")
    dim_insured = layout.write(build_dim_insured(insured, "claim_key"), "dim_insured")
    dim_region = layout.write(build_region_enriched(insured, providers), "dim_region")
    days = calendar_basic(insurance.sparkSession, f"{year}-01-01", f"{year}-12-31")
    tables = {
        "dim_date": layout.write(days, "dim_date"),
        "dim_insured": dim_insured,
        "dim_region": dim_region,
        "fact_claims": layout.write(build_claims(insured, dim_insured, dim_region, year), "fact_claims"),
    }
    return {**tables, "row_counts": row_counts(tables), "violations": violations(tables, MART_KEYS)}
