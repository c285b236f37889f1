"""Table sinks. Tables are Parquet unless `fmt` says otherwise."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from ..operators.staging import delete_path


@dataclass(frozen=True)
class Buckets:
    """Rows of a table dealt out by a hash of a column. Tables in as many buckets of columns of one type are joined on them without
    a shuffle of either; a table that is overwritten in buckets is dropped first."""

    column: str
    count: int


# Between the place of a table and the name of the folder that its rows were swapped to.
_SWAPPED = "__at_"


def ensure_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    """Create the database if it is not there and switch to it."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}" + (f" LOCATION '{location}'" if location else ""))
    spark.sql(f"USE {db}")


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    overwrite_schema: bool = False,
    path: str | None = None,
    buckets: Buckets | None = None,
) -> None:
    """Write a managed table, or an external one at `path`, in `buckets` if they are given.

    Overwriting replaces the schema for Parquet; `overwrite_schema` asks formats that guard it to do so too. A Parquet table that
    is there keeps its rows until the new ones are complete: they are written to a folder of their own, which the table is then
    pointed at (`swap_rows`), so a write that fails changes nothing, and the rows may come from the table itself.
    """
    spark = df.sparkSession
    if mode == "overwrite" and fmt == "parquet" and buckets is None and spark.catalog.tableExists(name):
        about = _described(spark, name)
        if about.get("Provider") == fmt and (path is None or _base(about["Location"]).endswith(path.rstrip("/"))):
            swap_rows(df, name, partition_by)
            return
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets.count, buckets.column).sortBy(buckets.column)
    if overwrite_schema:
        writer = writer.option("overwriteSchema", "true")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def _base(location: str) -> str:
    """The place of a table before any swap."""
    return location.rstrip("/").rsplit(_SWAPPED, 1)[0]


def _described(spark: SparkSession, what: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE EXTENDED {what}").collect()  # as it is: a filter on it would start a job
    return {r.col_name: r.data_type for r in rows if r.col_name in ("Location", "Type", "Provider", "Partition Provider")}


def table_location(spark: SparkSession, name: str) -> str:
    return _described(spark, name)["Location"]


def external_location(spark: SparkSession, name: str) -> str | None:
    """The place of an external table before any swap; None for a managed one."""
    about = _described(spark, name)
    return _base(about["Location"]) if about.get("Type") == "EXTERNAL" else None


def swap_rows(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet table by rows and columns that may come from itself: write first, then change its location, then delete.

    The new folder lies beside the old one. Where neither columns nor partitions change, the catalog is told the new location in
    one step; else the table is created anew over files that are already complete.
    """
    spark = df.sparkSession
    about = _described(spark, name)
    old, managed = about["Location"].rstrip("/"), about["Type"] == "MANAGED"
    new = f"{_base(old)}{_SWAPPED}{uuid.uuid4().hex[:12]}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    try:
        writer.parquet(new)
    except Exception:
        delete_path(spark, new)
        raise
    plain = not partition_by and "Partition Provider" not in about
    if not plain or spark.table(name).dtypes != df.dtypes:
        spark.sql(f"DROP TABLE {name}")  # deletes the old files of a managed table; the new ones are complete
        listed = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
        by = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        place = "" if managed else f" LOCATION '{new}'"
        spark.sql(f"CREATE TABLE {name} ({listed}) USING parquet{by}{place}")
    if managed or plain:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{new}'")
    if partition_by:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    delete_path(spark, old)


def replace_table(df: DataFrame, name: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Overwrite a table by rows that may come from that same table."""
    write_table(df, name, fmt=fmt, partition_by=partition_by, overwrite_schema=True)


def append_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Add rows to a table. Not for a folder written by a streaming file sink: readers of that ignore other files."""
    df.write.format(fmt).mode("append").saveAsTable(name)


def insert_rows(df: DataFrame, name: str) -> None:
    """Add rows to a table that is there, in its buckets and partitions; columns are taken by name."""
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name)


def overwrite_partitions(
    df: DataFrame, name: str, partition_by: Sequence[str], path: str | None = None, buckets: Buckets | None = None
) -> None:
    """Replace just the partitions that the rows fall in; the table is created if it is not there, in `buckets` if they are given.

    Running it again with the same rows changes nothing, which makes loads and replayed micro-batches repeatable.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        write_table(df, name, partition_by=partition_by, path=path, buckets=buckets)
        return
    # insertInto takes this from the session, not from the writer's options
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def partition_values(spark: SparkSession, name: str, column: str) -> list[str]:
    """The values of a table's only partition column, from the catalog; no data is read. Signs that the catalog escapes are restored."""
    return [unquote(row[0].removeprefix(f"{column}=")) for row in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def drop_partitions(spark: SparkSession, name: str, column: str, values: Sequence[str]) -> None:
    """Drop partitions of a table with their files, also where the table is external. Those not there are passed over."""
    for value in set(values) & set(partition_values(spark, name, column)) if values else ():
        part = f"{column}={_quoted(value)}"
        rows = spark.sql(f"DESCRIBE EXTENDED {name} PARTITION ({part})").collect()
        location = next((r.data_type for r in rows if r.col_name == "Location"), None)  # the partition's comes before the table's
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({part})")
        if location:
            delete_path(spark, location)
    if values:
        spark.catalog.refreshTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table together with its files, wherever they are."""
    if spark.catalog.tableExists(name):
        location = _described(spark, name).get("Location")
        spark.sql(f"DROP TABLE {name}")
        if location:
            delete_path(spark, location)


def refresh_table(spark: SparkSession, name: str, sql: str) -> None:
    """Replace the rows of an existing table by a query's result."""
    spark.sql(f"INSERT OVERWRITE TABLE {name} {sql}")


def ctas(spark: SparkSession, name: str, sql: str, fmt: str = "parquet", path: str | None = None) -> None:
    """Create a table from a query unless it exists. It is a copy: later changes of the source do not reach it."""
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt}{location} AS {sql}")


def load_mart(tables: Mapping[str, DataFrame], fmt: str = "parquet") -> None:
    """Append each frame to the table of its name, creating those that are missing."""
    for name, df in tables.items():
        append_table(df, name, fmt)


def reset(spark: SparkSession, tables: Sequence[str], paths: Sequence[str] = ()) -> None:
    """Drop tables and delete the folders that belong to them: external data and the checkpoints of the streams that fill them.

    A stream whose table is dropped must lose its checkpoint too, or it takes its input as already read.
    """
    for name in tables:
        if spark.catalog.tableExists(name) and _SWAPPED in _described(spark, name).get("Location", ""):
            drop_table(spark, name)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        for beside in ("ledger", "files", "unmatched"):
            drop_table(spark, f"{name}__{beside}")
    for path in paths:
        delete_path(spark, path)
