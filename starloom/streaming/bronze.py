"""Bronze: event files and batch increments, each load its own partition.

Every load is written as one partition `load_id`, named after its source. Writing it again replaces it, also by nothing, so
replayed micro-batches and repeated increments add nothing. A streaming file sink is not used: its readers would not see rows that a batch adds.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..constants import EVENT_SCHEMA, INCREMENT_PREFIX, INCREMENT_ROWS
from ..operators.rows import top_rows
from ..operators.staging import path_exists, stage
from ..sinks.tables import Buckets, drop_partitions, overwrite_partitions
from ..sources.streams import INTERVAL, RECORD, stream_json
from . import ledger
from .ledger import LOAD, SOURCE_FILE

STREAM_LOAD = "stream-"
# The key whose greatest value each load's ledger row holds.
KEY = "member_id"
# Known files up to which their names are a filter on the scan, so that they are not opened; more are left out by a join.
_FEW_FILES = 5_000


def drain(stream: DataFrame, publish, checkpoint: str) -> None:
    """Run a stream over everything available, then stop; returns when it is done."""
    query = (
        stream.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def refresh(spark: SparkSession, table: str) -> None:
    """Let this session see what a stream, which runs in a session of its own, has written."""
    if spark.catalog.tableExists(table):
        spark.catalog.refreshTable(table)


def ingest_bronze(
    spark: SparkSession,
    path: str,
    table: str,
    checkpoint: str,
    schema: str | StructType = EVENT_SCHEMA,
    max_files: int | None = None,
    location: str | None = None,
    source: str | None = None,
    restart: bool = False,
    folders: str = INTERVAL,
    rejects: str | None = None,
    buckets: int | None = None,
) -> None:
    """Load the event files that have arrived since the last run.

    Loads are named `stream-<source>-<batch>`. The source defaults to a digest of path and checkpoint, so several sources
    can fill one table. Every load is written and then noted in the table's ledger with the files it came from. If the table
    has loads of a source whose checkpoint is gone, the files of these loads are passed over, whether they are still in the
    input or not, and only others make new loads, `stream-<source>-r<restart>-<batch>`: nothing is dropped, read twice or lost.
    For a source that was named, this is refused unless `restart` says so, as the name may be another source's.

    With `rejects`, lines that are no JSON of the schema go to a table of that name, with their file and load, in place of
    rows of NULLs in bronze. With `buckets`, bronze is created in so many buckets of members, as a member table of as many is
    joined with it without a shuffle.
    """
    name = source or f"{zlib.crc32(f'{path}|{checkpoint}'.encode()):08x}"
    prefix = f"{STREAM_LOAD}{name}-"
    known = None
    fresh = not path_exists(spark, f"{checkpoint}/offsets")
    if fresh:
        ledger.adopt(spark, table, KEY)
        earlier = [x for x in ledger.loads(spark, table) if x.startswith(prefix)]
        if earlier:
            if source and not restart:
                raise ValueError(f"{table} has loads of a source {source}, but its checkpoint is not at {checkpoint}")
            read = ledger.files(spark, table, earlier)
            unnamed = set(earlier) - {r[LOAD] for r in read.select(LOAD).distinct().collect()}
            if unnamed:
                raise ValueError(f"{table} does not say from which files it has {sorted(unnamed)[:3]}")
            known = stage(read.select(F.col(SOURCE_FILE).alias("__file")).distinct(), "known")
    marker = f"{prefix}restarts"
    begun = ledger.noted(spark, table, marker)
    restarts = (begun.taken if begun else 0) + (known is not None)
    if known is not None:
        ledger.note(spark, table, {marker: restarts}, None)

    def publish(batch: DataFrame, batch_id: int) -> None:
        rows = batch if known is None else batch.join(known, F.col(SOURCE_FILE) == F.col("__file"), "left_anti")
        load = f"{prefix}r{restarts}-{batch_id}" if restarts else f"{prefix}{batch_id}"
        if rejects:
            rows = set_aside(rows, rejects, load, beside(spark, table, "rejects", location))
        write_load(rows, table, load, location, buckets)

    stream = stream_json(spark, path, schema, max_files, folders, SOURCE_FILE, RECORD if rejects else None)
    if known is not None and known.count() <= _FEW_FILES:
        stream = stream.where(~F.col(SOURCE_FILE).isin([r[0] for r in known.collect()]))
    drain(stream, publish, checkpoint)
    if not spark.catalog.tableExists(table):
        write_load(spark.createDataFrame([], stream.schema).drop(RECORD), table, prefix, location, buckets)
    refresh(spark, table)


def beside(spark: SparkSession, table: str, kind: str, location: str | None) -> str | None:
    """The place of a companion of a table that may not be there yet."""
    return f"{location}__{kind}" if location else None


def set_aside(rows: DataFrame, rejects: str, load_id: str, location: str | None = None) -> DataFrame:
    """The rows that could be read; the records that could not are kept as a load of the reject table: record, reason, source_file."""
    bad = rows.where(F.col(RECORD).isNotNull())
    bad = bad.select(F.col(RECORD).alias("record"), F.lit("malformed").alias("reason"), SOURCE_FILE, F.lit(load_id).alias(LOAD))
    overwrite_partitions(bad, rejects, [LOAD], location)
    return rows.where(F.col(RECORD).isNull()).drop(RECORD)


def write_load(rows: DataFrame, table: str, load_id: str, location: str | None = None, buckets: int | None = None) -> None:
    """Replace one load and note it in the ledger; no rows leave no load, but a table. The rows are counted as they are written."""
    spark = rows.sparkSession
    there = spark.catalog.tableExists(table)
    by = Buckets(KEY, buckets) if buckets else None
    write = lambda rows: overwrite_partitions(rows, table, [LOAD], location, by)
    n_rows = ledger.write_noted(rows.withColumn(LOAD, F.lit(load_id)), table, load_id, write, KEY)
    spark.catalog.refreshTable(table)
    if there and not n_rows:
        drop_partitions(spark, table, LOAD, [load_id])
        ledger.note(spark, table, {load_id: None}, 0)


def _highest_loads(spark: SparkSession, bronze: str, n: int) -> DataFrame:
    """Streamed loads that can hold the `n` rows with the highest members: from the one with the greatest member down, until `n`
    rows read so far are above all that the next load holds. The ledger knows the greatest member of each."""
    held = [(x, e.greatest) for x, e in ledger.loads(spark, bronze).items() if x.startswith(STREAM_LOAD)]
    held.sort(key=lambda load: (load[1] is None, -(load[1] or 0), load[0]))
    count = 1
    while True:
        rows = spark.table(bronze).where(F.col(LOAD).isin([x for x, _ in held[:count]]))
        if count >= len(held):
            return rows
        above = F.col(KEY).isNotNull() if held[count][1] is None else F.col(KEY) > held[count][1]
        if rows.where(above).limit(n).count() >= n:
            return rows
        count *= 2


def append_increment(spark: SparkSession, bronze: str, load_id: str, n: int = INCREMENT_ROWS) -> None:
    """Add the `n` streamed events of the highest members again as a new load, ids prefixed. Repeating a load replaces it.

    Only streamed loads are read, so an increment never picks up another one's rows, and of those only as many as can hold the
    highest members. Rows without a member come last and are found where all loads together have fewer than `n` others.
    """
    ledger.ensure(spark, bronze, KEY)
    newest = top_rows(_highest_loads(spark, bronze, n), [F.desc(KEY), "event_id"], n)
    prefixed = F.concat(F.lit(INCREMENT_PREFIX), F.col("event_id"))
    newest = newest.withColumn("event_id", prefixed).withColumn(SOURCE_FILE, F.lit(None).cast("string"))
    write_load(newest, bronze, load_id)
