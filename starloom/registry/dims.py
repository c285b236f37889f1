"""Dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import pick_by_modulo
from ..operators.joins import Side, attach, lookup, null_safe_join
from ..plans.dimensions import (
    build_dim_insured,
    build_dim_plan,
    build_dim_provider,
    build_dim_region,
    build_region_enriched,
    conform_provider,
    derive_insured,
    provider_rows,
    type_rows,
)
from ..sinks.tables import Buckets, write_table
from .base import NUMBERED_SQL, PLAN_SQL, PROVIDER_SQL, RAW_SQL, insurance, layout, query, table
from .facts import INSURED_SQL, member_tables, providers


@query("dim_region", f"WITH {NUMBERED_SQL} SELECT * FROM dim_region")
def region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim_region(insurance(spark, sf_dir))


@query(
    "dim_region_with_null",
    f"""WITH {RAW_SQL} SELECT row_number() OVER (ORDER BY region NULLS FIRST) AS region_key, region AS region_name
    FROM (SELECT DISTINCT region FROM raw) AS names""",
)
def region_with_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim_region(insurance(spark, sf_dir), drop_null=False, name="region_name")


@query("dim_member", f"WITH {NUMBERED_SQL} SELECT * FROM dim_member")
def member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return member_tables(spark, sf_dir)["member"]


@query("dim_profile", f"WITH {NUMBERED_SQL} SELECT * FROM dim_profile")
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return member_tables(spark, sf_dir)["profile"]


@query(
    "dim_plan",
    f"""WITH {PLAN_SQL} SELECT dim_plan.*, n_orders
    FROM dim_plan JOIN (SELECT o_orderkey % 4 + 1 AS k, COUNT(*) AS n_orders FROM orders GROUP BY 1) AS used ON plan_key = k""",
)
def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").groupBy(pick_by_modulo(F.col("o_orderkey"), [1, 2, 3, 4]).alias("k"))
    used = orders.agg(F.count(F.lit(1)).alias("n_orders"))
    return attach(build_dim_plan(spark), Side(used, {"plan_key": "k"}, {"n_orders": "n_orders"}))


@query(
    "dim_provider",
    """SELECT region, preferred_provider, network_tier,
      row_number() OVER (ORDER BY region, preferred_provider, network_tier) AS provider_key
    FROM (SELECT r_name AS region, s_name AS preferred_provider, n_name AS network_tier
      FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) AS rows""",
)
def provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = attach(
        table(spark, sf_dir, "supplier"),
        Side(table(spark, sf_dir, "nation"), {"s_nationkey": "n_nationkey"}, {"n_name": "network_tier", "n_regionkey": "r"}),
        Side(table(spark, sf_dir, "region"), {"r": "r_regionkey"}, {"r_name": "region"}),
    )
    return build_dim_provider(rows.select("region", F.col("s_name").alias("preferred_provider"), "network_tier"))


@query(
    "dim_provider_listed",
    f"""WITH {PROVIDER_SQL} SELECT provider_code, preferred_provider, network_tier, CAST(NULL AS VARCHAR) AS region,
      provider_key, n_events
    FROM dim_provider JOIN (SELECT CASE event_id % 3 WHEN 1 THEN 'P001' WHEN 2 THEN 'P002' ELSE 'P003' END AS code,
      COUNT(*) AS n_events FROM events GROUP BY 1) AS used ON provider_code = code""",
)
def provider_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = pick_by_modulo(F.col("event_id"), ["P003", "P001", "P002"]).alias("code")
    used = table(spark, sf_dir, "events").groupBy(code).agg(F.count(F.lit(1)).alias("n_events"))
    listed = conform_provider(provider_rows(spark))
    return attach(listed, Side(used, {"provider_code": "code"}, {"n_events": "n_events"}))


@query("dim_insured", f"WITH {INSURED_SQL} SELECT * FROM dim_insured")
def insured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim_insured(derive_insured(type_rows(insurance(spark, sf_dir))), "row_no")


@query("dim_region_enriched", f"WITH {INSURED_SQL} SELECT * FROM dim_regions")
def region_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_region_enriched(derive_insured(type_rows(insurance(spark, sf_dir))), providers(spark, sf_dir))


@query(
    "null_safe_lookup",
    f"WITH {INSURED_SQL} SELECT row_no, region_key FROM derived LEFT JOIN dim_regions USING (region) WHERE derived.region "
    f"IS NOT NULL UNION ALL SELECT row_no, region_key FROM derived JOIN dim_regions ON dim_regions.region IS NULL "
    f"WHERE derived.region IS NULL",
)
def null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive_insured(type_rows(insurance(spark, sf_dir)))
    regions = build_region_enriched(rows, providers(spark, sf_dir))
    return null_safe_join(rows.select("row_no", "region"), regions, ["region"], ["region_key"]).select("row_no", "region_key")


@query(
    "hot_key_lookup",
    """SELECT e.event_id, e.user_key, u.first_event, u.n_events
    FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_key FROM events) AS e
    LEFT JOIN (SELECT user_id, MIN(event_id) AS first_event, COUNT(*) AS n_events FROM events GROUP BY 1) AS u
      ON e.user_key = u.user_id""",
)
def hot_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows share one key, and the lookup counts as too large to broadcast: the key is spread over salts."""
    events = table(spark, sf_dir, "events")
    users = events.groupBy("user_id").agg(F.min("event_id").alias("first_event"), F.count(F.lit(1)).alias("n_events"))
    user = F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id"))
    rows = events.select("event_id", user.cast("bigint").alias("user_key"))
    return lookup(rows, users, {"user_key": "user_id"}, ["first_event", "n_events"], broadcast_bytes=5_000, hot_rows=100)


@query(
    "colocated_lookup",
    """SELECT o_orderkey, o_orderstatus, o_custkey, c_mktsegment, c_nationkey FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def colocated_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides in as many buckets of the key, as large members and bronze are: beyond the broadcast bound neither is shuffled."""
    place, _ = layout(spark, "colocated")
    orders, customers = place.table("orders"), place.table("customers")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    write_table(rows, orders, path=place.location("orders"), partition_by=["o_orderstatus"], buckets=Buckets("o_custkey", 8))
    write_table(table(spark, sf_dir, "customer"), customers, path=place.location("customers"), buckets=Buckets("c_custkey", 8))
    take = ["c_mktsegment", "c_nationkey"]
    return lookup(spark.table(orders), spark.table(customers), {"o_custkey": "c_custkey"}, take, unique=True, broadcast_bytes=0)


@query(
    "existence_lookup",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem",
)
def existence_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A left join on a unique key that takes nothing keeps every row once."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lookup(lines, table(spark, sf_dir, "part"), {"l_partkey": "p_partkey"})
