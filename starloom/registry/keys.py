"""Ids, keys and synthetic columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import BATCH_DAYS, BATCH_START, CLAIM_YEAR, EVENT_PROVIDERS
from ..functions.clean import pick_by_modulo
from ..functions.keys import date_by_hash, date_by_modulo, date_key, prefixed_id, sparse_id
from ..operators.ids import dense_id, first_seen_key, grow_keys, surrogate_key
from .base import query, table
from .facts import hash_date_sql


@query(
    "dense_ids",
    "SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders",
)
def dense_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return dense_id(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_custkey", "id")


@query(
    "dense_ids_as_read",
    "SELECT COUNT(*) AS n_rows, CAST(1 AS BIGINT) AS first_id, COUNT(*) AS last_id, COUNT(*) AS n_ids FROM lineitem",
)
def dense_ids_as_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = dense_id(table(spark, sf_dir, "lineitem").select("l_orderkey"), None)
    per_id = numbered.groupBy("id").agg(F.count(F.lit(1)).alias("__rows"))
    return per_id.agg(
        F.sum("__rows").alias("n_rows"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.count(F.lit(1)).alias("n_ids"),
    )


@query(
    "dense_ids_ties",
    """SELECT l_returnflag, l_linestatus, MIN(id) AS first_id, MAX(id) AS last_id, COUNT(DISTINCT id) AS n_ids
    FROM (SELECT *, row_number() OVER (ORDER BY l_returnflag, l_linestatus) AS id FROM lineitem) AS numbered GROUP BY 1, 2""",
)
def dense_ids_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order with a handful of values: rows with equal ones still spread over all ranges."""
    by = ["l_returnflag", "l_linestatus"]
    numbered = dense_id(table(spark, sf_dir, "lineitem").select(*by), by, unique=False, from_files=True)
    per_id = numbered.groupBy(*by, "id").agg(F.count(F.lit(1)).alias("__rows"))
    return per_id.groupBy(*by).agg(
        F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count(F.lit(1)).alias("n_ids")
    )


@query("sparse_ids", "SELECT COUNT(*) AS n_rows, COUNT(*) AS n_ids FROM lineitem")
def sparse_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "lineitem").select(sparse_id().alias("id")).groupBy("id").count()
    return ids.agg(F.sum("count").alias("n_rows"), F.count(F.lit(1)).alias("n_ids"))


@query(
    "surrogate_keys",
    """SELECT p_brand, p_type, row_number() OVER (ORDER BY p_brand, p_type) AS part_key
    FROM (SELECT DISTINCT p_brand, p_type FROM part) AS kinds""",
)
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = table(spark, sf_dir, "part").select("p_brand", "p_type").distinct()
    return surrogate_key(kinds, "part_key", ["p_brand", "p_type"])


@query(
    "surrogate_keys_by_ranges",
    """SELECT l_partkey, l_suppkey, row_number() OVER (ORDER BY l_partkey, l_suppkey) AS pair_key
    FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) AS pairs""",
)
def surrogate_keys_by_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key set beyond the one-task bound is numbered by ranges."""
    pairs = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    return surrogate_key(pairs, "pair_key", ["l_partkey", "l_suppkey"])


@query(
    "first_seen_keys",
    """SELECT o_custkey, o_orderpriority, row_number() OVER (ORDER BY first_order) AS seen_key
    FROM (SELECT o_custkey, o_orderpriority, MIN(o_orderkey) AS first_order FROM orders GROUP BY 1, 2) AS firsts""",
)
def first_seen_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_seen_key(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"], "o_orderkey", "seen_key")


@query(
    "prefixed_ids",
    """SELECT l_orderkey, l_linenumber, 'E' || CASE WHEN l_orderkey < 1000000 THEN lpad(CAST(l_orderkey AS VARCHAR), 6, '0')
        ELSE CAST(l_orderkey AS VARCHAR) END AS event_id,
      'E' || CAST(l_orderkey + 5000000 AS VARCHAR) AS wide_id FROM lineitem""",
)
def prefixed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_orderkey")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        prefixed_id("E", key, 6).alias("event_id"),
        prefixed_id("E", key + 5_000_000, 6).alias("wide_id"),
    )


@query(
    "modulo_assign",
    """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 1 THEN 'P001' WHEN 2 THEN 'P002' ELSE 'P003' END AS provider_code,
      CAST(o_orderkey % 4 + 1 AS INTEGER) AS plan_key FROM orders""",
)
def modulo_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", pick_by_modulo(key, EVENT_PROVIDERS).alias("provider_code"), pick_by_modulo(key, [1, 2, 3, 4]).alias("plan_key")
    )


@query(
    "modulo_dates",
    """SELECT o_orderkey, CAST(DATE '2019-01-01' + CAST(o_orderkey % 1461 AS INTEGER) AS DATE) AS event_date,
      CAST(strftime(DATE '2019-01-01' + CAST(o_orderkey % 1461 AS INTEGER), '%Y%m%d') AS INTEGER) AS date_key FROM orders""",
)
def modulo_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = table(spark, sf_dir, "orders").select(
        "o_orderkey", date_by_modulo(F.col("o_orderkey"), BATCH_START, BATCH_DAYS).alias("event_date")
    )
    return dated.withColumn("date_key", date_key(F.col("event_date")))


@query("hash_dates", f"SELECT o_orderkey, {hash_date_sql('o_orderkey', CLAIM_YEAR)} AS date_key FROM orders")
def hash_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", date_by_hash(F.col("o_orderkey"), CLAIM_YEAR).alias("date_key"))


@query(
    "keys_two_runs",
    """WITH early AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 0),
    keyed AS (SELECT row_number() OVER (ORDER BY c_nationkey, c_mktsegment) AS segment_key, * FROM early),
    late AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer EXCEPT SELECT * FROM early)
    SELECT segment_key, c_nationkey, c_mktsegment, 1 AS run FROM keyed UNION ALL
    SELECT (SELECT COUNT(*) FROM keyed) + row_number() OVER (ORDER BY c_nationkey, c_mktsegment), c_nationkey, c_mktsegment, 2 FROM late""",
)
def keys_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys given to the combinations of some rows, and then to those that all rows add: the first ones stay."""
    customer, columns = table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"]
    first = surrogate_key(customer.where("c_acctbal < 0").select(*columns).distinct(), "segment_key", columns)
    second = grow_keys(first, customer, "segment_key", columns)
    return first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))
