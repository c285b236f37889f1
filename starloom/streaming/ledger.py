"""Ledgers: which loads a table holds, of which version, from which files.

A table filled by loads has a small table beside it, `<table>__ledger`. When a load has been written completely, a row is
added there with a version that grows with time, the rows it has, and which version of the layer before it was made from. A load
that goes gets a row that says 0 rows, and a name that is no load one without a number. The newest version counts. What a
layer has still to take in are the rows that were noted since, so neither files nor partitions of the data are listed, a lost
checkpoint forgets nothing, and what fails half-way is done again.

There is one short row per load, so the driver writes and reads them itself, as JSON lines, without a job; Spark sees them as a table
and streams it. The source files of bronze's loads, which may be many, are in a table of their own, `<table>__files`,
which is only read when a checkpoint is lost. One writer at a time, as for the tables themselves.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.staging import delete_path, make_folder, read_texts, write_text
from ..sinks.tables import drop_table, external_location, partition_values, table_location

LOAD = "load_id"
SOURCE_FILE = "source_file"
SCHEMA = f"{LOAD} string, version bigint, taken bigint, n_rows bigint, greatest bigint"
# Files of a ledger from which it is written anew as one.
MOST_FILES = 50


@dataclass(frozen=True)
class Entry:
    """A load's row: its version, the version it was made from, its rows and its greatest key."""

    load_id: str
    version: int
    taken: int | None = None
    n_rows: int | None = None
    greatest: int | None = None


def ledger_of(table: str) -> str:
    return f"{table}__ledger"


def beside(spark: SparkSession, table: str, kind: str) -> str | None:
    """The place of a table's companion: beside an external table, None (managed) otherwise."""
    location = external_location(spark, table)
    return f"{location}__{kind}" if location else None


def _create(spark: SparkSession, table: str, kind: str, schema: str) -> str:
    """The folder of a table's companion, which is created unless it is there."""
    name = f"{table}__{kind}"
    if not spark.catalog.tableExists(name):
        place = beside(spark, table, kind)
        spark.sql(f"CREATE TABLE {name} ({schema}) USING json" + (f" LOCATION '{place}'" if place else ""))
        make_folder(spark, table_location(spark, name))  # a stream of a table without rows finds no folder otherwise
    return table_location(spark, name)


def _write(spark: SparkSession, folder: str, rows: Sequence[dict]) -> None:
    lines = [json.dumps({k: v for k, v in row.items() if v is not None}) for row in rows]
    write_text(spark, f"{folder}/{time.time_ns()}-{uuid.uuid4().hex[:8]}.json", "\n".join(lines))


def _add(spark: SparkSession, table: str, rows: Sequence[Entry]) -> None:
    folder = _create(spark, table, "ledger", SCHEMA)
    _write(spark, folder, [asdict(r) for r in rows])
    texts = read_texts(spark, folder)
    if len(texts) > MOST_FILES:
        _write(spark, folder, [asdict(r) for r in _newest(texts).values()])
        for path in texts:
            delete_path(spark, path)


def _newest(texts: Mapping[str, str]) -> dict[str, Entry]:
    found: dict[str, Entry] = {}
    for line in (x for text in texts.values() for x in text.splitlines() if x):
        row = Entry(**json.loads(line))
        if row.load_id not in found or found[row.load_id].version < row.version:
            found[row.load_id] = row
    return found


def entries(spark: SparkSession, table: str) -> dict[str, Entry]:
    """The newest row of every name in the ledger; none without one."""
    name = ledger_of(table)
    return _newest(read_texts(spark, table_location(spark, name))) if spark.catalog.tableExists(name) else {}


def loads(spark: SparkSession, table: str) -> dict[str, Entry]:
    """The loads that the table holds."""
    return {x: e for x, e in entries(spark, table).items() if e.n_rows}


def streamed(batch: DataFrame) -> dict[str, Entry]:
    """The newest rows of loads, present or gone, among those that a stream of a ledger brings."""
    found: dict[str, Entry] = {}
    for row in batch.where(F.col("n_rows").isNotNull()).collect():
        if row[LOAD] not in found or found[row[LOAD]].version < row.version:
            found[row[LOAD]] = Entry(**row.asDict())
    return found


def write_noted(rows: DataFrame, table: str, load_id: str, write: Callable[[DataFrame], None], greatest: str) -> int:
    """Write one load and note what is counted on the way: its rows, its greatest key and its files, which the driver has listed
    to read them. Returns the number of rows; without any, nothing is noted."""
    seen, spark = Observation(), rows.sparkSession
    most = F.max(greatest).cast("bigint") if greatest in rows.columns else F.max(F.lit(None).cast("bigint"))
    file = F.col(SOURCE_FILE) if SOURCE_FILE in rows.columns else F.lit(None).cast("string")
    write(rows.observe(seen, F.count(F.lit(1)).alias("n"), most.alias("greatest"), F.collect_set(file).alias("files")))
    found = seen.get
    if found["n"]:
        _add_files(spark, table, [(load_id, f) for f in found["files"]])
        _add(spark, table, [Entry(load_id, time.time_ns(), None, found["n"], found["greatest"])])
    return found["n"]


def _add_files(spark: SparkSession, table: str, named: Sequence[tuple[str, str]]) -> None:
    if named:
        folder = _create(spark, table, "files", f"{LOAD} string, {SOURCE_FILE} string")
        _write(spark, folder, [{LOAD: x, SOURCE_FILE: f} for x, f in named])


def files(spark: SparkSession, table: str, load_ids: Sequence[str]) -> DataFrame:
    """(load_id, source_file) of loads, as far as their files are known."""
    name = f"{table}__files"
    if not spark.catalog.tableExists(name):
        return spark.createDataFrame([], f"{LOAD} string, {SOURCE_FILE} string")
    spark.catalog.refreshTable(name)
    return spark.table(name).where(F.col(LOAD).isin(list(load_ids)))


def note(spark: SparkSession, table: str, taken: Mapping[str, int | None], n_rows: int | None, greatest: int | None = None) -> None:
    """Note names with the version they were made from, and the rows of each: None for a name that is no load, 0 for a load that goes."""
    version = time.time_ns()
    if taken:
        _add(spark, table, [Entry(x, version, v, n_rows, greatest) for x, v in sorted(taken.items())])


def noted(spark: SparkSession, table: str, name: str) -> Entry | None:
    """What was noted last under a name."""
    return entries(spark, table).get(name)


def since(spark: SparkSession, table: str, version: int) -> dict[str, Entry]:
    """Loads, present or gone, that were noted after a version."""
    return {x: e for x, e in entries(spark, table).items() if e.version > version and e.n_rows is not None}


def adopt(spark: SparkSession, table: str, greatest: str | None = None) -> None:
    """Note loads of the table that its ledger does not know: those of an older table, or of a run that was killed before it
    could. Drop the ledger of a table that is gone. Partitions are listed from the catalog."""
    if not spark.catalog.tableExists(table):
        drop_table(spark, ledger_of(table))
        return
    known = loads(spark, table)
    unknown = [v for v in partition_values(spark, table, LOAD) if v not in known]
    if not unknown:
        return
    rows = spark.table(table).where(F.col(LOAD).isin(unknown))
    most = F.max(greatest).cast("bigint") if greatest in rows.columns else F.lit(None).cast("bigint")
    if SOURCE_FILE in rows.columns:
        found = rows.select(LOAD, SOURCE_FILE).na.drop().distinct().collect()  # as many as the driver has listed to read them
        _add_files(spark, table, [(r[LOAD], r[SOURCE_FILE]) for r in found])
    counted = rows.groupBy(LOAD).agg(F.count(F.lit(1)).alias("n"), most.alias("greatest")).collect()
    _add(spark, table, [Entry(r[LOAD], time.time_ns(), None, r.n, r.greatest) for r in counted])


def ensure(spark: SparkSession, table: str, greatest: str | None = None) -> None:
    """Note the loads of a table that has no ledger yet; a table without loads gets an empty one."""
    if not spark.catalog.tableExists(ledger_of(table)):
        adopt(spark, table, greatest)
        if spark.catalog.tableExists(table):
            _create(spark, table, "ledger", SCHEMA)
