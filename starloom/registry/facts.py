"""Facts, and the dimension sets they are built with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import BATCH_DAYS, BATCH_START, CLAIM_YEAR
from ..operators.checks import check_fk, unmatched
from ..operators.joins import lookup
from ..operators.staging import stage
from ..plans.calendar import calendar_extended
from ..plans.dimensions import (
    build_dim_member,
    build_dim_plan,
    build_dim_region,
    build_profile_dim,
    conform_provider,
    number_rows,
    provider_rows,
)
from ..plans.facts import add_event_date, build_events, build_fact, build_silver
from ..plans.runs import run_mart
from .base import (
    EVENTS_SQL,
    NUMBERED_SQL,
    SILVER_END,
    SILVER_SQL,
    SILVER_START,
    TYPED_SQL,
    insurance,
    layout,
    query,
    table,
)


def member_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Numbered rows, and the region, member and risk-profile dimensions."""
    rows = number_rows(insurance(spark, sf_dir), "row_no")
    region = build_dim_region(rows)
    member = stage(build_dim_member(rows, region, keep_region=True), "member")
    return {"rows": rows, "region": region, "member": member, "profile": build_profile_dim(member)}


def silver_dims(spark: SparkSession, region: DataFrame, member: DataFrame) -> dict[str, DataFrame]:
    return {
        "region": region,
        "member": member,
        "provider": conform_provider(provider_rows(spark)),
        "plan": build_dim_plan(spark),
        "date": calendar_extended(spark, SILVER_START, SILVER_END, as_of=SILVER_END, end_inclusive=True),
    }


def silver_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Silver in one batch, and its dimensions."""
    rows = number_rows(insurance(spark, sf_dir), "row_no")
    region = build_dim_region(rows)
    dims = silver_dims(spark, region, stage(build_dim_member(rows, region, keep_region=True), "member"))
    return build_silver(build_events(rows), dims), dims


def fact_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The batch fact and its dimensions."""
    tables = member_tables(spark, sf_dir)
    dated = add_event_date(tables["rows"], BATCH_START, BATCH_DAYS)
    return {**tables, "fact": build_fact(dated, tables["member"], tables["profile"])}


def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is known about regions: all but one of them, one without a tier."""
    name = F.col("r_name")
    return table(spark, sf_dir, "region").where(name != "ASIA").select(
        F.lower(name).alias("region"),
        F.concat(F.lit("Provider "), F.col("r_regionkey").cast("string")).alias("preferred_provider"),
        F.when(name != "EUROPE", F.when(F.col("r_regionkey") % 2 == 0, "Tier A").otherwise("Tier B")).alias("network_tier"),
    )


def claims_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The claims mart's fact and dimensions."""
    place, _ = layout(spark, "claims")
    built = run_mart(insurance(spark, sf_dir), providers(spark, sf_dir), "row_no", place)
    names = {"insured": "dim_insured", "region": "dim_region", "date": "dim_date", "claims": "fact_claims"}
    return {short: built[name] for short, name in names.items()}


INSURED_SQL = (
    TYPED_SQL
    + """, derived AS (
  SELECT row_no, age, sex, smoker, bmi, children, charges, lower(trim(region)) AS region,
    CASE WHEN age BETWEEN 0 AND 17 THEN '0-17' WHEN age BETWEEN 18 AND 24 THEN '18-24' WHEN age BETWEEN 25 AND 34 THEN '25-34'
         WHEN age BETWEEN 35 AND 44 THEN '35-44' WHEN age BETWEEN 45 AND 54 THEN '45-54'
         WHEN age BETWEEN 55 AND 64 THEN '55-64' WHEN age BETWEEN 65 AND 200 THEN '65+' ELSE 'unknown' END AS age_band,
    CASE WHEN bmi < 18.5 THEN 'Underweight' WHEN bmi < 25 THEN 'Normal' WHEN bmi < 30 THEN 'Overweight' ELSE 'Obese' END
      AS bmi_category
  FROM typed
), dim_insured AS (
  SELECT row_number() OVER (ORDER BY first_row) AS insured_key, age, age_band, sex, smoker, bmi, bmi_category, children
  FROM (SELECT age, age_band, sex, smoker, bmi, bmi_category, children, MIN(row_no) AS first_row FROM derived
        GROUP BY ALL) AS firsts
), listed AS (
  SELECT lower(r_name) AS region, 'Provider ' || CAST(r_regionkey AS VARCHAR) AS preferred_provider,
    CASE WHEN r_name = 'EUROPE' THEN NULL WHEN r_regionkey % 2 = 0 THEN 'Tier A' ELSE 'Tier B' END AS network_tier
  FROM region WHERE r_name <> 'ASIA'
), dim_regions AS (
  SELECT row_number() OVER (ORDER BY n.region NULLS LAST, preferred_provider NULLS LAST, network_tier NULLS LAST)
    AS region_key, n.region, preferred_provider, network_tier
  FROM (SELECT DISTINCT region FROM derived) AS n LEFT JOIN listed ON n.region IS NOT DISTINCT FROM listed.region
)"""
)

# Eight 32-bit pieces of the hash, folded: the same remainder as that of the whole number.
_HEX = "CAST('0x' || substr(sha256(CAST(claim_key AS VARCHAR)), {start}, 8) AS BIGINT)"


def hash_day_sql(key: str) -> str:
    """Day of the year less one, by the hash of a key."""
    fold = "CAST(0 AS BIGINT)"
    for piece in range(8):
        fold = f"(({fold}) * 251 + {_HEX.replace('claim_key', key).format(start=8 * piece + 1)}) % 365"
    return fold


def hash_date_sql(key: str, year: int) -> str:
    day = f"(DATE '{year}-01-01' + CAST({hash_day_sql(key)} AS INTEGER))"
    return f"CAST(strftime({day}, '%Y%m%d') AS INTEGER)"


CLAIMS_SQL = (
    INSURED_SQL
    + f""", numbered AS (SELECT row_number() OVER (ORDER BY row_no) AS claim_key, * FROM derived), claims AS (
  SELECT claim_key, i.insured_key, r.region_key, {hash_date_sql("claim_key", CLAIM_YEAR)} AS date_key, n.charges
  FROM numbered n
    JOIN dim_insured i ON n.age IS NOT DISTINCT FROM i.age AND n.age_band = i.age_band AND n.sex IS NOT DISTINCT FROM i.sex
      AND n.smoker = i.smoker AND n.bmi IS NOT DISTINCT FROM i.bmi AND n.bmi_category = i.bmi_category
      AND n.children IS NOT DISTINCT FROM i.children
    LEFT JOIN dim_regions r ON n.region IS NOT DISTINCT FROM r.region
)"""
)


@query("events_source", f"WITH {EVENTS_SQL} SELECT * FROM events_src")
def events_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_events(number_rows(insurance(spark, sf_dir), "row_no"))


@query("silver_batch", f"WITH {SILVER_SQL} SELECT * FROM silver")
def silver_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_tables(spark, sf_dir)[0].drop("fact_key")


@query(
    "hash_keys_distinct",
    f"WITH {EVENTS_SQL} SELECT COUNT(*) AS n_rows, COUNT(DISTINCT event_id) AS n_keys FROM events_src",
)
def hash_keys_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = silver_tables(spark, sf_dir)[0]
    per_key = silver.groupBy("fact_key").agg(F.count(F.lit(1)).alias("__rows"))
    return per_key.agg(F.sum("__rows").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"))


_FACT_SQL = (
    NUMBERED_SQL
    + """, fact AS (
  SELECT m.region_key, CAST(n.member_id % 4 + 1 AS INTEGER) AS plan_key,
    CAST(strftime(DATE '2019-01-01' + CAST(n.member_id % 1461 AS INTEGER), '%Y%m%d') AS INTEGER) AS date_key, n.member_id,
    n.charges AS charge_amount, CAST(DATE '2019-01-01' + CAST(n.member_id % 1461 AS INTEGER) AS DATE) AS event_date,
    p.risk_profile_key
  FROM numbered n LEFT JOIN dim_member m ON n.member_id = m.member_id
    LEFT JOIN dim_profile p ON m.sex = p.sex AND m.smoker = p.smoker AND m.region_key = p.region_key
)"""
)


@query("fact_keys", f"WITH {_FACT_SQL} SELECT * FROM fact")
def fact_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_tables(spark, sf_dir)["fact"]


@query(
    "fact_unmatched",
    f"""WITH {_FACT_SQL} SELECT COUNT(*) AS n_rows, COUNT(*) - COUNT(region_key) AS region_key_missing,
      COUNT(*) - COUNT(risk_profile_key) AS risk_profile_key_missing FROM fact""",
)
def fact_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmatched(fact_tables(spark, sf_dir)["fact"], ["region_key", "risk_profile_key"])


@query("claims_fact", f"WITH {CLAIMS_SQL} SELECT * FROM claims")
def claims_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims_tables(spark, sf_dir)["claims"]


@query(
    "fact_calendar_misses",
    """SELECT COUNT(*) AS n_rows,
      COUNT(*) FILTER (WHERE NOT (o_orderdate >= DATE '2000-01-01' AND o_orderdate < DATE '2010-12-31')) AS date_key_missing
    FROM orders""",
)
def fact_calendar_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = calendar_extended(spark, "2000-01-01", "2010-12-31", as_of="2010-12-31")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("event_date"))
    return unmatched(lookup(orders, days, {"event_date": "Date"}, {"DateKey": "date_key"}), ["date_key"])


@query(
    "fact_calendar_orphans",
    """SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, COUNT(*) AS n_rows FROM orders
    WHERE NOT (o_orderdate >= DATE '2000-01-01' AND o_orderdate < DATE '2010-12-31') GROUP BY 1""",
)
def fact_calendar_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = calendar_extended(spark, "2000-01-01", "2010-12-31", as_of="2010-12-31")
    day = F.to_date("o_orderdate")
    keyed = table(spark, sf_dir, "orders").select((F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).alias("date_key"))
    return check_fk(keyed, ["date_key"], days, ["DateKey"])
