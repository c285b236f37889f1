"""Row-set operators and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import check_fk, check_unique, row_counts
from ..operators.rows import dedupe, difference, split_batches, top_rows
from .base import query, table


@query(
    "split_batches",
    """SELECT o_orderkey, CAST(least(3, (row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1)
      // greatest(1, (SELECT COUNT(*) FROM orders) // 3) + 1) AS INTEGER) AS interval FROM orders""",
)
def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.struct("o_totalprice", "o_orderkey").alias("place"))
    return split_batches(orders, 3, "place").select("o_orderkey", "interval")


@query(
    "set_difference",
    "SELECT l_partkey, l_suppkey FROM lineitem EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'",
)
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    pair = ["l_partkey", "l_suppkey"]
    return difference(lines.select(*pair), lines.where("l_returnflag = 'R'").select(*pair))


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query(
    "dedupe_by_key",
    """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
      ORDER BY event_id) AS place FROM events) AS placed WHERE place = 1""",
)
def dedupe_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    return dedupe(events, ["user_id", "event_type"], ["event_id"])


@query("dedupe_any", "SELECT COUNT(*) AS n_rows FROM (SELECT DISTINCT o_custkey FROM orders) AS keys")
def dedupe_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(table(spark, sf_dir, "orders"), ["o_custkey"]).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "top_k",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
)
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return top_rows(orders, [F.desc("o_totalprice"), "o_orderkey"], 25)


_COUNTED = ("customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations")


@query(
    "row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in _COUNTED),
)
def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts({t: table(spark, sf_dir, t) for t in _COUNTED})


@query(
    "key_violations",
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "fk_violations",
    """SELECT user_id, COUNT(*) AS n_rows FROM events
    WHERE user_id NOT IN (SELECT c_custkey * 2 FROM customer) GROUP BY 1""",
)
def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against keys that are doubled, so that every other one is missing."""
    doubled = table(spark, sf_dir, "customer").select((F.col("c_custkey") * 2).alias("key"))
    return check_fk(table(spark, sf_dir, "events"), ["user_id"], doubled, ["key"])


@query(
    "fk_holds",
    """SELECT l_orderkey, COUNT(*) AS n_rows FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY 1""",
)
def fk_holds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_fk(table(spark, sf_dir, "lineitem"), ["l_orderkey"], table(spark, sf_dir, "orders"), ["o_orderkey"])
