from __future__ import annotations

import hashlib
import math
from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from starloom.functions import money
from starloom.functions.clean import (
    band,
    cast_columns,
    find_tokens,
    normalize_text,
    null_tokens,
    pick_by_modulo,
    threshold,
    try_cast_columns,
)
from starloom.functions.keys import date_by_hash, date_by_modulo, date_key, hash_key, prefixed_id, sparse_id


def frame(spark, values, schema):
    return spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], schema)


def test_tokens_become_null_and_are_found(spark):
    df = frame(spark, ["nan", "NaN", "NULL", "", " ", " nan", "12", None], "age string")
    assert rows(null_tokens(df, ["age"])) == [(" ",), (" nan",), ("12",), (None,)] + [(None,)] * 4
    assert rows(find_tokens(df, "age")) == [("",), ("NULL",), ("NaN",), ("nan",)]
    assert find_tokens(df, "age", ["nan"]).count() == 2


def test_a_double_nan_counts_as_missing(spark):
    df = frame(spark, [float("nan"), 1.5], "bmi double")
    assert rows(null_tokens(df, ["bmi"])) == [(1.5,), (None,)]


def test_tolerant_and_strict_casts(spark):
    df = frame(spark, [("30.7", "nan"), ("31", "1.25"), ("x", None)], "age string, bmi string")
    typed = try_cast_columns(df, {"age": "int", "bmi": "double"})
    ages = [r.age for r in typed.collect()]
    assert ages == [None, 31, None]
    assert math.isnan(typed.first().bmi)
    assert rows(try_cast_columns(null_tokens(df, ["bmi"]), {"bmi": "double"}), "bmi") == [(1.25,), (None,), (None,)]
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        cast_columns(df, {"age": "int"}).collect()


def test_text_is_trimmed_and_lowered(spark):
    df = frame(spark, [" Southwest ", None], "region string")
    assert rows(normalize_text(df, ["region"])) == [("southwest",), (None,)]


BAND_EDGES = {
    None: "unknown", float("nan"): "unknown", -0.5: "unknown", 0.0: "0-17", 17.0: "0-17", 17.5: "unknown", 18.0: "18-24",
    24.0: "18-24", 24.5: "unknown", 25.0: "25-34", 34.0: "25-34", 35.0: "35-44", 44.0: "35-44", 45.0: "45-54", 54.0: "45-54",
    55.0: "55-64", 64.0: "55-64", 64.5: "unknown", 65.0: "65+", 200.0: "65+", 200.5: "unknown",
}


def test_bands_at_their_edges(spark):
    df = frame(spark, list(BAND_EDGES), "age double").select("age", band(F.col("age")).alias("b"))
    assert [r.b for r in df.collect()] == list(BAND_EDGES.values())


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-5, 210), min_size=2, max_size=80))
def test_bands_change_only_at_their_edges(spark, ages):
    edges = sorted(e for e in BAND_EDGES if e is not None and e == e)
    df = frame(spark, sorted(ages), "age double").select("age", band(F.col("age")).alias("b"))
    found = [(r.age, r.b) for r in df.collect()]
    for (x, a), (y, b) in zip(found, found[1:]):
        assert a == b or any(x <= e <= y for e in edges)


def test_thresholds_and_missing_values(spark):
    values = [18.49, 18.5, 24.99, 25.0, 29.99, 30.0, None, float("nan")]
    df = frame(spark, values, "bmi double")
    assert [r[0] for r in df.select(threshold(F.col("bmi"))).collect()] == [
        "Underweight", "Normal", "Normal", "Overweight", "Overweight", "Obese", "Obese", "Obese",
    ]
    strict = [r[0] for r in df.select(threshold(F.col("bmi"), null_label="missing")).collect()]
    assert strict[-3:] == ["Obese", "missing", "missing"]


def test_round_robin_labels(spark):
    df = spark.range(1, 7)
    assert [r[0] for r in df.select(pick_by_modulo(F.col("id"), ["P003", "P001", "P002"])).collect()] == [
        "P001", "P002", "P003", "P001", "P002", "P003",
    ]


def test_prefixed_ids_keep_all_digits(spark):
    df = frame(spark, [1, 999999, 1234567, 12345678], "id bigint")
    found = [r[0] for r in df.select(prefixed_id("E", F.col("id"), 6)).collect()]
    assert found == ["E000001", "E999999", "E1234567", "E12345678"]


def test_dates_by_modulo_and_their_keys(spark):
    df = spark.range(1, 800).select("id", date_by_modulo(F.col("id"), "2025-01-01", 365).alias("d"))
    for row in df.select("id", "d", date_key(F.col("d")).alias("k")).collect():
        expected = date(2025, 1, 1) + timedelta(days=row.id % 365)
        assert (row.d, row.k) == (expected, int(expected.strftime("%Y%m%d")))


def test_dates_by_hash_against_hashlib(spark):
    df = spark.range(1, 3000).select("id", date_by_hash(F.col("id"), 2010).alias("k"))
    for row in df.collect():
        day = int(hashlib.sha256(str(row.id).encode()).hexdigest(), 16) % 365
        assert row.k == int((date(2010, 1, 1) + timedelta(days=day)).strftime("%Y%m%d"))


def test_hash_and_sparse_keys_are_distinct(spark):
    df = spark.range(0, 5000, 1, 4).select(hash_key(F.col("id").cast("string")).alias("h"), sparse_id().alias("s"))
    assert df.select("h").distinct().count() == df.select("s").distinct().count() == 5000


def summed(df, scale=None):
    exact = df.schema["v"].dataType.typeName().startswith("decimal")
    parts = df.groupBy("k").agg(*money.partial(F.col("v"), "v", scale, exact))
    merged = parts.groupBy("k").agg(*money.merge(parts.columns, "v"))
    total, mean = money.total(merged.columns, "v"), money.mean(merged.columns, "v")
    return {r.k: (r.t, r.m) for r in merged.select("k", total.alias("t"), mean.alias("m")).collect()}


def test_sums_of_doubles_cut_no_digits_and_do_not_overflow(spark):
    tiny = spark.range(1_000_000).select(F.lit(1).alias("k"), F.lit(0.1234567).alias("v"))
    tiny = tiny.unionByName(spark.range(1_000_000).select(F.lit(2).alias("k"), F.lit(1e-7).alias("v")))
    result = summed(tiny)
    assert abs(result[1][0] - 123456.7) < 1e-4 and abs(result[2][0] - 0.1) < 1e-9
    exact = summed(tiny.withColumn("v", F.col("v").cast("decimal(18,7)")))
    assert {k: t for k, (t, _) in exact.items()} == {1: 123456.7, 2: 0.1}
    large = spark.range(10_000_000).select(F.lit(1).alias("k"), F.lit(9.9e11).alias("v"))
    assert abs(summed(large)[1][0] / 9.9e18 - 1) < 1e-9
    assert summed(large, 2)[1] == (9.9e18, 9.9e11)
    assert summed(large.withColumn("v", F.col("v").cast("decimal(18,2)")))[1] == (9.9e18, 9.9e11)


def test_sums_are_exact_whatever_the_order(spark):
    values = [(1, i / 100 - 37.0) for i in range(10_000)] + [(1, 0.005), (1, -0.000001), (2, None)]
    first = summed(spark.createDataFrame(values, "k int, v double").repartition(7), 6)
    second = summed(spark.createDataFrame(values[::-1], "k int, v double").repartition(3), 6)
    assert first == second
    assert first[1][0] == 129950.004999
    assert first[2] == (None, None)


def test_sums_of_numbers_beyond_the_limit_fall_back(spark):
    df = spark.createDataFrame([(1, 1e15), (1, 0.5), (2, float("nan")), (2, 1.0), (3, float("inf"))], "k int, v double")
    result = summed(df, 6)
    assert result[1][0] == 1e15 + 0.5
    assert math.isnan(result[2][0])
    assert result[3][0] == float("inf")


def test_further_digits_are_not_cut(spark):
    from starloom.functions.money import partial, total

    rows = [("a", 0.125)] * 3 + [("b", 0.1 + 0.2), ("b", 1e12 + 0.25)] + [("c", 0.29)] * 7 + [("c", -1.15), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v double").groupBy("k").agg(*partial(F.col("v"), "v", 2))
    found = {r.k: (r.odd, r.s) for r in df.select("k", F.col("v__odd").alias("odd"), total(df.columns, "v").alias("s")).collect()}
    assert found["a"] == (True, 0.375) and found["b"] == (False, 1e12 + 0.55) and found["c"] == (False, 0.88)
