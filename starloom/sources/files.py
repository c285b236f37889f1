"""File, path and literal sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: str | StructType | None = None, **options) -> DataFrame:
    """CSV with a header. Give a schema (all text, typed later) to avoid the pass that infers types. `options` are Spark's."""
    reader = spark.read.option("header", True).options(**options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_json_array(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """Files that hold one JSON array of records each. One file is one task: give many files, not one large file."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_json_nested(spark: SparkSession, path: str, field: str, schema: str | StructType | None = None) -> DataFrame:
    """Documents with a list of records under `field`, as one row per record."""
    return read_json_array(spark, path, schema).selectExpr(f"inline(`{field}`)")


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A folder of files as a table."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def lookup_table(spark: SparkSession, rows: Sequence, schema: str | StructType | None = None) -> DataFrame:
    """A small table from literal rows: tuples with a schema, or `Row` objects."""
    return spark.createDataFrame(list(rows), schema)


def extract_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Chosen columns; the projection reaches the scan."""
    return df.select(*cols)
