"""Registration, table access and the insurance-shaped rows that many queries start from."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import Side, attach
from ..operators.staging import new_path
from ..plans.runs import Layout
from ..session import tune

# The amounts of the given tables have two decimals.
CENTS = 2

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that gives the same rows."""

    def register(run: Query) -> Query:
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(tune(spark), sf_dir)

        QUERIES[name] = tuned
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def layout(spark: SparkSession, label: str) -> tuple[Layout, str]:
    """Fresh table names and a fresh folder, below the folder that the cluster shares."""
    base = new_path(spark, label)
    return Layout(f"{label}_{uuid.uuid4().hex[:8]}_", base, CENTS), base


def customers_with_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with `region_key` and `region_name`."""
    return attach(
        table(spark, sf_dir, "customer"),
        Side(table(spark, sf_dir, "nation"), {"c_nationkey": "n_nationkey"}, {"n_regionkey": "region_key"}),
        Side(table(spark, sf_dir, "region"), {"region_key": "r_regionkey"}, {"r_name": "region_name"}),
    )


def insurance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed insurance row per order: text columns with missing and malformed values, numbered by `row_no`."""
    customer = customers_with_region(spark, sf_dir).select("c_custkey", "region_name")
    rows = attach(table(spark, sf_dir, "orders"), Side(customer, {"o_custkey": "c_custkey"}, {"region_name": "region_name"}))
    k, c = F.col("o_orderkey"), F.col("o_custkey")

    def text(column, **broken):
        value = column.cast("string")
        for every, token in broken.items():
            value = F.when(k % int(every[1:]) == 0, F.lit(token)).otherwise(value)
        return value

    bmi = F.concat((F.lit(15) + c % 25).cast("string"), F.lit("."), (c % 10).cast("string"))
    region = F.when(k % 3 == 0, F.concat(F.lit(" "), F.col("region_name"), F.lit(" "))).otherwise(F.lower("region_name"))
    return rows.select(
        k.alias("row_no"),
        text(c % 100, _79="30.7", _83="", _89="NULL", _97="nan").alias("age"),
        F.when(c % 101 != 0, F.when(c % 2 == 0, "male").otherwise("female")).alias("sex"),
        text(bmi, _53="NaN").alias("bmi"),
        text(c % 6, _61="null").alias("children"),
        F.when(F.col("o_orderpriority").startswith("1"), "yes").otherwise("no").alias("smoker"),
        F.when(k % 113 != 0, region).alias("region"),
        text(F.col("o_totalprice"), _223="n/a", _211="nan").alias("charges"),
    )


# ---- the same rows in SQL, as common table expressions ----

RAW_SQL = """raw AS (
  SELECT o_orderkey AS row_no,
    CASE WHEN o_orderkey % 97 = 0 THEN 'nan' WHEN o_orderkey % 89 = 0 THEN 'NULL' WHEN o_orderkey % 83 = 0 THEN ''
         WHEN o_orderkey % 79 = 0 THEN '30.7' ELSE CAST(o_custkey % 100 AS VARCHAR) END AS age,
    CASE WHEN o_custkey % 101 = 0 THEN NULL WHEN o_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex,
    CASE WHEN o_orderkey % 53 = 0 THEN 'NaN'
         ELSE CAST(15 + o_custkey % 25 AS VARCHAR) || '.' || CAST(o_custkey % 10 AS VARCHAR) END AS bmi,
    CASE WHEN o_orderkey % 61 = 0 THEN 'null' ELSE CAST(o_custkey % 6 AS VARCHAR) END AS children,
    CASE WHEN o_orderpriority LIKE '1%' THEN 'yes' ELSE 'no' END AS smoker,
    CASE WHEN o_orderkey % 113 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN ' ' || r_name || ' ' ELSE lower(r_name) END AS region,
    CASE WHEN o_orderkey % 211 = 0 THEN 'nan' WHEN o_orderkey % 223 = 0 THEN 'n/a'
         ELSE CAST(o_totalprice AS VARCHAR) END AS charges
  FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

TYPED_SQL = (
    RAW_SQL
    + """, typed AS (
  SELECT row_no,
    CASE WHEN regexp_full_match(age, '[0-9]+') THEN TRY_CAST(age AS INTEGER) END AS age, sex,
    CASE WHEN lower(bmi) <> 'nan' THEN TRY_CAST(bmi AS DOUBLE) END AS bmi,
    CASE WHEN regexp_full_match(children, '[0-9]+') THEN TRY_CAST(children AS INTEGER) END AS children,
    smoker, region,
    CASE WHEN lower(charges) <> 'nan' THEN TRY_CAST(charges AS DOUBLE) END AS charges
  FROM raw
)"""
)

NUMBERED_SQL = (
    TYPED_SQL
    + """, numbered AS (
  SELECT row_number() OVER (ORDER BY row_no) AS member_id, * FROM typed
), dim_region AS (
  SELECT row_number() OVER (ORDER BY region) AS region_key, region
  FROM (SELECT DISTINCT region FROM numbered WHERE region IS NOT NULL) AS names
), dim_member AS (
  SELECT member_id, age, sex, bmi, children, smoker, dim_region.region_key, dim_region.region
  FROM numbered LEFT JOIN dim_region ON numbered.region = dim_region.region
), dim_profile AS (
  SELECT row_number() OVER (ORDER BY sex NULLS FIRST, smoker NULLS FIRST, region_key NULLS FIRST) AS risk_profile_key,
    sex, smoker, region_key
  FROM (SELECT DISTINCT sex, smoker, region_key FROM dim_member) AS combinations
)"""
)

PLAN_SQL = """dim_plan AS (
  SELECT * FROM (VALUES (1, 'Bronze', 6000, 60, 'Basic'), (2, 'Silver', 3000, 40, 'Standard'),
    (3, 'Gold', 1000, 20, 'Premium'), (4, 'Platinum', 500, 10, 'Premium+'))
    AS plans(plan_key, plan_name, deductible_usd, copay_usd, coverage_tier)
)"""

PROVIDER_SQL = """dim_provider AS (
  SELECT * FROM (VALUES ('P001', 'Blue Ridge Health', 'Gold', CAST(1 AS BIGINT)),
    ('P002', 'Cville Care Network', 'Silver', CAST(2 AS BIGINT)), ('P003', 'Piedmont Clinic', 'Bronze', CAST(3 AS BIGINT)))
    AS providers(provider_code, preferred_provider, network_tier, provider_key)
)"""

# Events of the numbered rows, and silver over them with a calendar from 2025-03-01 to 2025-12-31 (so some days miss).
SILVER_START, SILVER_END = "2025-03-01", "2025-12-31"
EVENTS_SQL = (
    NUMBERED_SQL
    + """, events_src AS (
  SELECT 'E' || CASE WHEN member_id < 1000000 THEN lpad(CAST(member_id AS VARCHAR), 6, '0')
      ELSE CAST(member_id AS VARCHAR) END AS event_id,
    member_id, CAST(member_id % 4 + 1 AS INTEGER) AS plan_key,
    CASE member_id % 3 WHEN 1 THEN 'P001' WHEN 2 THEN 'P002' ELSE 'P003' END AS provider_code,
    CAST(DATE '2025-01-01' + CAST(member_id % 365 AS INTEGER) AS DATE) AS event_date,
    charges AS charge_amount
  FROM numbered
)"""
)
SILVER_SQL = (
    EVENTS_SQL
    + f""", {PLAN_SQL}, {PROVIDER_SQL}, bronze AS (SELECT * FROM events_src), silver AS (
  SELECT b.event_id, b.member_id, b.provider_code, b.event_date, b.charge_amount, m.sex, m.smoker, m.region, m.region_key,
    p.provider_key, p.network_tier, p.preferred_provider, pl.plan_key, pl.plan_name, pl.coverage_tier,
    CASE WHEN b.event_date BETWEEN DATE '{SILVER_START}' AND DATE '{SILVER_END}'
      THEN CAST(year(b.event_date) * 10000 + month(b.event_date) * 100 + day(b.event_date) AS INTEGER) END AS date_key
  FROM bronze b LEFT JOIN dim_member m ON b.member_id = m.member_id
    LEFT JOIN dim_provider p ON b.provider_code = p.provider_code
    LEFT JOIN dim_plan pl ON b.plan_key = pl.plan_key
)"""
)
# The same with an increment: the 25 highest members once more, ids prefixed.
INCREMENT_SQL = SILVER_SQL.replace(
    "bronze AS (SELECT * FROM events_src)",
    """bronze AS (
  SELECT * FROM events_src UNION ALL
  SELECT 'INC_' || event_id, member_id, plan_key, provider_code, event_date, charge_amount
  FROM (SELECT * FROM events_src ORDER BY member_id DESC, event_id LIMIT 25) AS newest
)""",
)


def total(amount: str) -> str:
    """Sum that does not depend on row order, as a double."""
    return f"CAST(SUM(CAST({amount} AS DECIMAL(18,2))) AS DOUBLE)"


def mean(amount: str) -> str:
    return f"({total(amount)} / COUNT({amount}))"


def cents(value: str) -> str:
    """Rounded half up on the written digits."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,15)), 2) AS DOUBLE)"
