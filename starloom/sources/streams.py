"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Spark forgets files that are older than this against the newest one; none is meant to be.
_ANY_AGE = "36500d"
INTERVAL = "interval int"
# The column that holds a line which could not be read.
RECORD = "__record"


def stream_json(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    max_files: int | None = None,
    folders: str = INTERVAL,
    file: str | None = None,
    record: str | None = None,
) -> DataFrame:
    """JSON-lines files as they arrive anywhere below `path`, those already there included, whatever their age.

    `folders` are columns, as DDL, that are taken from folders named `name=value` on the way to a file; NULL where there is
    no such folder, and kept from the file where the schema has the name itself. `max_files` caps the files per micro-batch;
    `file` names a column for the path of the file that a row comes from, `record` one for lines that are no JSON of the schema.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFileAge", _ANY_AGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if record is not None:
        whole = StructType.fromDDL(schema) if isinstance(schema, str) else StructType(list(schema.fields))
        reader = reader.schema(whole.add(record, "string")).option("columnNameOfCorruptRecord", record)
    rows = reader.json(path)
    for field in StructType.fromDDL(folders).fields if folders else []:
        if field.name not in rows.columns:
            value = F.regexp_extract(F.col("_metadata.file_path"), f"/{field.name}=([^/]*)/", 1)
            rows = rows.withColumn(field.name, F.url_decode(F.nullif(value, F.lit(""))).cast(field.dataType))
    return rows if file is None else rows.withColumn(file, F.col("_metadata.file_path"))


def stream_table(spark: SparkSession, table: str) -> DataFrame:
    """Rows added to a table."""
    return spark.readStream.table(table)
