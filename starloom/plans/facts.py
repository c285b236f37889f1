"""Fact rows and their dimension keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (
    CLAIM_YEAR,
    EVENT_DAYS,
    EVENT_ID_PREFIX,
    EVENT_ID_WIDTH,
    EVENT_PLANS,
    EVENT_PROVIDERS,
    EVENT_START,
    INSURED_COLUMNS,
    SILVER_COLUMNS,
)
from ..functions.clean import pick_by_modulo
from ..functions.keys import date_by_hash, date_by_modulo, date_key, hash_key, prefixed_id
from ..operators.joins import lookup, null_safe_join
from .dimensions import type_rows


def add_event_date(rows: DataFrame, start: str, days: int, id_col: str = "member_id") -> DataFrame:
    """Deterministic event date from a dense id."""
    return rows.withColumn("event_date", date_by_modulo(F.col(id_col), start, days))


def plan_of(id_col: str = "member_id"):
    """Plan key 1..4 from a dense id."""
    return (F.pmod(F.col(id_col), F.lit(EVENT_PLANS)) + 1).cast("int")


def build_events(rows: DataFrame, id_col: str = "member_id") -> DataFrame:
    """Billing events of numbered insurance rows: one event per row."""
    member = F.col(id_col)
    return type_rows(rows.select(id_col, "charges")).select(
        prefixed_id(EVENT_ID_PREFIX, member, EVENT_ID_WIDTH).alias("event_id"),
        member.alias("member_id"),
        plan_of(id_col).alias("plan_key"),
        pick_by_modulo(member, EVENT_PROVIDERS).alias("provider_code"),
        date_by_modulo(member, EVENT_START, EVENT_DAYS).alias("event_date"),
        F.col("charges").alias("charge_amount"),
    )


def _column(df: DataFrame, *names: str) -> str:
    by_name = {c.lower(): c for c in df.columns}
    for name in names:
        if name in by_name:
            return by_name[name]
    raise ValueError(f"none of {names} in {df.columns}")


def build_silver(events: DataFrame, dims: Mapping[str, DataFrame], keep: Sequence[str] = ()) -> DataFrame:
    """Events with member, provider, calendar and plan attributes, all left joins; the same for batches and streams.

    `dims` holds `member`, `provider`, `date` (either calendar) and `plan`. `keep` names event columns to carry along.
    A dimension row that arrives later leaves NULLs in rows already built: rebuild to repair them.
    """
    typed = events.select(
        "event_id",
        F.col("member_id").cast("bigint").alias("member_id"),
        "provider_code",
        F.to_date("event_date").alias("event_date"),
        F.col("charge_amount").cast("double").alias("charge_amount"),
        F.col("plan_key").alias("__plan"),
        *keep,
    )
    calendar = dims["date"]
    day, key = _column(calendar, "full_date", "date"), _column(calendar, "date_key", "datekey")
    joined = lookup(typed, dims["member"], ["member_id"], ["sex", "smoker", "region", "region_key"], unique=True)
    joined = lookup(joined, dims["provider"], ["provider_code"], ["provider_key", "network_tier", "preferred_provider"])
    joined = lookup(joined, calendar, {"event_date": day}, {key: "date_key"})
    joined = lookup(joined, dims["plan"], {"__plan": "plan_key"}, ["plan_key", "plan_name", "coverage_tier"])
    return joined.withColumn("fact_key", hash_key("event_id")).select(*SILVER_COLUMNS, *keep)


def build_fact(rows: DataFrame, dim_member: DataFrame, dim_profile: DataFrame) -> DataFrame:
    """Batch fact of numbered, dated insurance rows: date, member, plan, region and risk-profile keys with the charge.

    Date and plan keys follow from the row itself, so those dimensions are not joined; `unmatched` and `check_fk` tell
    whether they hold every key.
    """
    dated = type_rows(rows.select("member_id", "event_date", "charges")).select(
        "member_id",
        F.to_date("event_date").alias("event_date"),
        F.col("charges").alias("charge_amount"),
        plan_of().alias("plan_key"),
    )
    profile = ["sex", "smoker", "region_key"]
    fact = lookup(dated, dim_member, ["member_id"], profile, unique=True)
    fact = lookup(fact, dim_profile, profile, ["risk_profile_key"])
    return fact.select(
        "region_key",
        "plan_key",
        date_key(F.col("event_date")).alias("date_key"),
        "member_id",
        "charge_amount",
        "event_date",
        "risk_profile_key",
    )


def build_claims(insured: DataFrame, dim_insured: DataFrame, dim_region: DataFrame, year: int = CLAIM_YEAR) -> DataFrame:
    """Mart fact of derived insurance rows that carry their dense `claim_key`: insured, region and date keys with the charges.

    NULL attributes match NULL.
    """
    claims = insured.select("claim_key", *INSURED_COLUMNS, "region", "charges")
    keyed = null_safe_join(claims, dim_insured, INSURED_COLUMNS, ["insured_key"])
    keyed = null_safe_join(keyed, dim_region, ["region"], ["region_key"])
    return keyed.select(
        "claim_key", "insured_key", "region_key", date_by_hash(F.col("claim_key"), year).alias("date_key"), "charges"
    )
