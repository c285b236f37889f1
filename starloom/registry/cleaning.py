"""Cleaning and categorising the landed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import band, cast_columns, find_tokens, normalize_text, null_tokens, threshold, try_cast_columns
from ..plans.dimensions import derive_insured, type_rows
from .base import RAW_SQL, TYPED_SQL, insurance, query, table
from .facts import INSURED_SQL

_TOKENS = "('nan', 'null', '')"


@query(
    "null_tokens",
    f"""WITH {RAW_SQL} SELECT row_no, {", ".join(
        f"CASE WHEN lower({c}) IN {_TOKENS} THEN NULL ELSE {c} END AS {c}" for c in ("age", "bmi", "children"))} FROM raw""",
)
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["age", "bmi", "children"]
    return null_tokens(insurance(spark, sf_dir), cols).select("row_no", *cols)


@query("find_tokens", f"WITH {RAW_SQL} SELECT row_no, age FROM raw WHERE lower(age) = 'nan'")
def malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_tokens(insurance(spark, sf_dir), "age", ["nan"]).select("row_no", "age")


@query("try_casts", f"WITH {TYPED_SQL} SELECT row_no, age, bmi, children, charges FROM typed")
def try_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_rows(insurance(spark, sf_dir)).select("row_no", "age", "bmi", "children", "charges")


@query(
    "try_casts_raw",
    f"""WITH {RAW_SQL} SELECT row_no, CASE WHEN regexp_full_match(age, '[0-9]+') THEN TRY_CAST(age AS INTEGER) END AS age,
      isnan(TRY_CAST(bmi AS DOUBLE)) AS bmi_is_nan FROM raw""",
)
def try_casts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without clearing tokens first, the text `NaN` becomes a number that is not one."""
    typed = try_cast_columns(insurance(spark, sf_dir), {"age": "int", "bmi": "double"})
    return typed.select("row_no", "age", F.isnan("bmi").alias("bmi_is_nan"))


@query(
    "strict_casts",
    "SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderdate::DATE AS o_orderdate FROM orders",
)
def strict_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return cast_columns(orders, {"o_orderkey": "int", "o_orderdate": "date"})


@query("bands", f"WITH {INSURED_SQL} SELECT row_no, age, age_band FROM derived")
def bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_rows(insurance(spark, sf_dir)).select("row_no", "age", band(F.col("age")).alias("age_band"))


@query(
    "thresholds",
    f"""WITH {INSURED_SQL} SELECT row_no, bmi_category, CASE WHEN bmi IS NULL THEN 'missing' ELSE bmi_category END AS strict_category
    FROM derived""",
)
def thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    bmi = F.col("bmi")
    return type_rows(insurance(spark, sf_dir)).select(
        "row_no", threshold(bmi).alias("bmi_category"), threshold(bmi, null_label="missing").alias("strict_category")
    )


@query("normalize_text", f"WITH {RAW_SQL} SELECT row_no, lower(trim(region)) AS region FROM raw")
def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_text(insurance(spark, sf_dir), ["region"]).select("row_no", "region")


@query("derive_insured", f"WITH {INSURED_SQL} SELECT * FROM derived")
def insured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_insured(type_rows(insurance(spark, sf_dir)))
