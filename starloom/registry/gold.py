"""Gold aggregates and star queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import Side
from ..plans.gold import (
    avg_month_smoker,
    gold_month,
    gold_provider_month,
    gold_region_smoker,
    gold_region_smoker_rounded,
    star_provider_region,
    star_top,
    star_totals,
    totals,
)
from .base import CENTS, NUMBERED_SQL, SILVER_SQL, cents, customers_with_region, mean, query, table, total
from .facts import CLAIMS_SQL, claims_tables, fact_tables, silver_tables

_LINE = "l_extendedprice"


@query(
    "star_provider_region",
    f"""SELECT s_name AS provider, n_name AS nation, r_name AS region, COUNT(*) AS num_events,
      {cents(total(_LINE))} AS total_charges, {cents(mean(_LINE))} AS avg_charges
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey
    WHERE s_name IS NOT NULL AND r_name IS NOT NULL GROUP BY ALL""",
)
def star_supplier_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = [
        Side(table(spark, sf_dir, "supplier"), {"l_suppkey": "s_suppkey"}, {"s_name": "provider", "s_nationkey": "__nation"}),
        Side(table(spark, sf_dir, "nation"), {"__nation": "n_nationkey"}, {"n_name": "nation", "n_regionkey": "__region"}),
        Side(table(spark, sf_dir, "region"), {"__region": "r_regionkey"}, {"r_name": "region"}),
    ]
    by = ["provider", "nation", "region"]
    result = star_totals(table(spark, sf_dir, "lineitem"), ["l_suppkey"], _LINE, sides, by, 2, ["provider", "region"], CENTS)
    return result.orderBy(F.desc("total_charges"), *by)


@query(
    "star_silver",
    f"""WITH {SILVER_SQL}
    SELECT p.preferred_provider, p.network_tier, r.region AS region_name, COUNT(*) AS num_events,
      {cents(total("charge_amount"))} AS total_charges, {cents(mean("charge_amount"))} AS avg_charges
    FROM silver s JOIN dim_provider p ON s.provider_code = p.provider_code JOIN dim_region r ON s.region_key = r.region_key
    GROUP BY 1, 2, 3""",
)
def star_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, dims = silver_tables(spark, sf_dir)
    region = dims["region"].withColumnRenamed("region", "region_name")
    return star_provider_region(silver, dims["provider"], region, CENTS)


_SEGMENT_SQL = """FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2"""


def _by_segment(spark: SparkSession, sf_dir: str, digits: int | None) -> DataFrame:
    customer = customers_with_region(spark, sf_dir)
    side = Side(customer, {"o_custkey": "c_custkey"}, {"region_name": "region_name", "c_mktsegment": "segment"})
    by = ["region_name", "segment"]
    return star_totals(table(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice", [side], by, digits, scale=CENTS)


@query(
    "gold_region_segment",
    f"""SELECT r_name AS region_name, c_mktsegment AS segment, COUNT(*) AS num_events,
      {total("o_totalprice")} AS total_charges, {mean("o_totalprice")} AS avg_charges {_SEGMENT_SQL}""",
)
def gold_region_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_segment(spark, sf_dir, None).orderBy(F.desc("total_charges"))


@query(
    "gold_region_segment_rounded",
    f"""SELECT r_name AS region_name, c_mktsegment AS segment, COUNT(*) AS num_events,
      {cents(total("o_totalprice"))} AS total_charges, {cents(mean("o_totalprice"))} AS avg_charges {_SEGMENT_SQL}""",
)
def gold_region_segment_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_segment(spark, sf_dir, 2).orderBy("region_name", "segment")


@query(
    "gold_region_smoker",
    f"""WITH {SILVER_SQL}
    SELECT r.region AS region_name, smoker, COUNT(*) AS num_events, {total("charge_amount")} AS total_charges,
      {mean("charge_amount")} AS avg_charges
    FROM silver s LEFT JOIN dim_region r ON s.region_key = r.region_key GROUP BY 1, 2""",
)
def region_smoker(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, dims = silver_tables(spark, sf_dir)
    return gold_region_smoker(silver, dims["region"].withColumnRenamed("region", "region_name"), CENTS)


@query(
    "gold_region_smoker_rounded",
    f"""WITH {NUMBERED_SQL}
    SELECT r.region, p.smoker, COUNT(*) AS num_events, {cents(total("charges"))} AS total_charges,
      {cents(mean("charges"))} AS avg_charges
    FROM numbered n JOIN dim_member m ON n.member_id = m.member_id LEFT JOIN dim_region r ON m.region_key = r.region_key
      LEFT JOIN dim_profile p ON m.sex = p.sex AND m.smoker = p.smoker AND m.region_key = p.region_key
    GROUP BY 1, 2""",
)
def region_smoker_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fact_tables(spark, sf_dir)
    return gold_region_smoker_rounded(tables["fact"], tables["region"], tables["profile"], CENTS)


@query(
    "gold_provider_month",
    f"""SELECT s_name AS preferred_provider, l_linestatus AS network_tier, strftime(l_shipdate, '%Y-%m') AS event_month,
      COUNT(*) AS num_events, {total(_LINE)} AS total_charges, {mean(_LINE)} AS avg_charges
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3""",
)
def provider_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.trunc(F.to_date("l_shipdate"), "month").alias("__month")
    side = Side(table(spark, sf_dir, "supplier"), {"l_suppkey": "s_suppkey"}, {"s_name": "preferred_provider"})
    by = ["preferred_provider", "l_linestatus", "__month"]
    keys = ["l_suppkey", "l_linestatus", month]
    grouped = star_totals(table(spark, sf_dir, "lineitem"), keys, _LINE, [side], by, scale=CENTS)
    return grouped.select(
        "preferred_provider",
        F.col("l_linestatus").alias("network_tier"),
        F.date_format("__month", "yyyy-MM").alias("event_month"),
        "num_events",
        "total_charges",
        "avg_charges",
    ).orderBy("event_month", F.desc("total_charges"), "preferred_provider")


@query(
    "gold_silver_provider_month",
    f"""WITH {SILVER_SQL}
    SELECT preferred_provider, network_tier, strftime(event_date, '%Y-%m') AS event_month, COUNT(*) AS num_events,
      {total("charge_amount")} AS total_charges, {mean("charge_amount")} AS avg_charges
    FROM silver GROUP BY 1, 2, 3""",
)
def silver_provider_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_provider_month(silver_tables(spark, sf_dir)[0], scale=CENTS)


@query(
    "gold_month",
    f"""SELECT strftime(o_orderdate, '%Y-%m') AS event_month, COUNT(*) AS num_events,
      {cents(total("o_totalprice"))} AS total_charges, {cents(mean("o_totalprice"))} AS avg_charges
    FROM orders GROUP BY 1""",
)
def month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_month(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", CENTS)


@query(
    "avg_month_flag",
    f"""SELECT strftime(l_shipdate, '%Y-%m') AS event_month, l_returnflag, {cents(mean(_LINE))} AS avg_charges
    FROM lineitem GROUP BY 1, 2""",
)
def month_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return avg_month_smoker(table(spark, sf_dir, "lineitem"), "l_shipdate", "l_returnflag", _LINE, CENTS)


@query(
    "star_top5",
    f"""WITH {CLAIMS_SQL}
    SELECT CAST(2010 AS INTEGER) AS calendar_year, i.smoker, r.region, {cents(total("f.charges"))} AS total_charges
    FROM claims f JOIN dim_insured i ON f.insured_key = i.insured_key JOIN dim_regions r ON f.region_key = r.region_key
    GROUP BY 1, 2, 3 ORDER BY total_charges DESC, smoker NULLS FIRST, region NULLS FIRST LIMIT 5""",
)
def top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = claims_tables(spark, sf_dir)
    return star_top(tables["claims"], tables["date"], tables["insured"], tables["region"], scale=CENTS)


@query(
    "gold_net_amount",
    """SELECT l_returnflag, l_linestatus, COUNT(*) AS num_events,
      ROUND(SUM(l_extendedprice * (1 - l_discount) * (1 + l_tax) / 3), 2) AS total_charges,
      ROUND(AVG(l_extendedprice * (1 - l_discount) * (1 + l_tax) / 3), 2) AS avg_charges FROM lineitem GROUP BY 1, 2""",
)
def net_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An amount with endless digits: a plain double sum, rounded at the end."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")) / 3
    by = ["l_returnflag", "l_linestatus"]
    return totals(table(spark, sf_dir, "lineitem").withColumn("net", net), by, by, "net", 2)
