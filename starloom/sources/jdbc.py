"""Relational sources over JDBC."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

SQLSERVER_DRIVER = "com.microsoft.sqlserver.jdbc.SQLServerDriver"


@dataclass(frozen=True)
class Partitioning:
    """Parallel read of a table by ranges of a numeric, date or timestamp column; without it one task reads everything."""

    column: str
    lower: object
    upper: object
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def sqlserver_url(host: str, database: str, port: int = 1433, login_timeout: int = 30) -> str:
    """Connection URL with encryption on and the server certificate checked."""
    settings = {
        "database": database,
        "encrypt": "true",
        "trustServerCertificate": "false",
        "loginTimeout": str(login_timeout),
    }
    return f"jdbc:sqlserver://{host}:{port};" + "".join(f"{k}={v};" for k, v in settings.items())


def sqlserver_settings(environ: Mapping[str, str] = os.environ) -> dict[str, str] | None:
    """Url, user, password and driver from SQL_HOST, SQL_DB, SQL_USER and SQL_PWD; None when any is missing."""
    values = [environ.get(k) for k in ("SQL_HOST", "SQL_DB", "SQL_USER", "SQL_PWD")]
    if not all(values):
        return None
    host, database, user, password = values
    return {"url": sqlserver_url(host, database), "user": user, "password": password, "driver": SQLSERVER_DRIVER}


def table_options(
    url: str, table: str, props: Mapping[str, str] | None = None, partition: Partitioning | None = None
) -> dict[str, str]:
    """Reader options for a table scan."""
    return {"url": url, "dbtable": table, **(props or {}), **(partition.options() if partition else {})}


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    props: Mapping[str, str] | None = None,
    partition: Partitioning | None = None,
) -> DataFrame:
    """Table scan; filters and column selection go to the database."""
    return spark.read.format("jdbc").options(**table_options(url, table, props, partition)).load()


def read_jdbc_query(spark: SparkSession, url: str, sql: str, props: Mapping[str, str] | None = None) -> DataFrame:
    """Result of a query that the database runs; `SELECT 1 AS ok` probes a connection."""
    return spark.read.format("jdbc").options(url=url, query=sql, **(props or {})).load()


def partition_bounds(
    spark: SparkSession, url: str, table: str, column: str, partitions: int, props: Mapping[str, str] | None = None
) -> Partitioning | None:
    """Range partitioning over the column's present span; None for an empty table."""
    row = read_jdbc_query(spark, url, f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}", props).first()
    return None if row[0] is None else Partitioning(column, row[0], row[1], partitions)
