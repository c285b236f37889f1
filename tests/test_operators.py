from __future__ import annotations

import os
import random
import subprocess
import sys
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from starloom.operators.checks import Keys, check_fk, check_unique, row_counts, unmatched, violations
from starloom.operators.ids import dense_id, first_seen_key, surrogate_key
from starloom.operators.joins import Side, attach, expand, fits_broadcast, hot_keys, lookup, null_safe_join
from starloom.operators.rows import dedupe, difference, split_batches, top_rows
from starloom.operators.staging import new_path, shared_dir, stage


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def test_dense_ids_equal_the_global_row_number(spark):
    values = random.Random(1).sample(range(100_000), 5_000)
    df = spark.createDataFrame([(v, str(v)) for v in values], "v int, t string").repartition(9)
    found = {r.v: r.id for r in dense_id(df, F.desc("v")).collect()}
    assert found == {v: i for i, v in enumerate(sorted(values, reverse=True), 1)}


def test_dense_ids_split_many_copies(spark):
    """Nearly all rows are copies of one row; every range still takes its part of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(0, 20_000, 1, 6).select(F.when(F.col("id") < 18_000, 5).otherwise(F.col("id")).cast("int").alias("v"))
    numbered = dense_id(df, "v", unique=False)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert rows(numbered.agg(F.min("id"), F.max("id"), F.countDistinct("id"))) == [(1, 20_000, 20_000)]
    by_value = numbered.groupBy("v").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n"))
    assert by_value.where("hi - lo + 1 != n").count() == 0
    written = numbered.inputFiles()
    sizes = [spark.read.parquet(f).count() for f in written]
    assert len(sizes) >= 3 and max(sizes) < 12_000


def test_dense_ids_of_nothing(spark):
    assert dense_id(spark.range(0), "id", "n").count() == 0


def test_surrogate_keys_agree_on_both_ways(spark):
    df = spark.createDataFrame([(c,) for c in ["b", "a", None, "d", "c"]], "name string")
    small = rows(surrogate_key(df, "k", "name"))
    assert small == rows(surrogate_key(df.repartition(5), "k", "name"))
    assert (None, 1) in small and ("a", 2) in small


def test_first_seen_keys_treat_null_as_a_value(spark):
    data = [(1, "x", None), (2, "y", 1.0), (3, "x", None), (4, None, None), (5, "y", 1.0)]
    df = spark.createDataFrame(data, "n int, a string, b double").repartition(3)
    assert rows(first_seen_key(df, ["a", "b"], "n", "k"), "k", "a", "b") == [(1, "x", None), (2, "y", 1.0), (3, None, None)]


def test_lookup_keeps_rows_and_names_apart(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, name string")
    dim = spark.createDataFrame([(1, "one"), (3, "three"), (None, "none")], "k bigint, name string")
    assert rows(lookup(fact, dim, ["k"], {"name": "dim_name"})) == [(1, "a", "one"), (2, "b", None), (None, "c", None)]
    assert rows(lookup(fact, dim, ["k"], {"name": "dim_name"}, "inner")) == [(1, "a", "one")]
    assert rows(lookup(fact, dim, ["k"], {"name": "d"}, null_safe=True))[-1] == (None, "c", "none")
    assert lookup(fact, dim, ["k"]).columns == ["k", "name"]


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_salts_give_the_rows_of_the_plain_join(spark, how, null_safe):
    fact = spark.range(0, 6_000, 1, 4).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 900).cast("int").alias("a"),
        (F.col("id") % 2).cast("double").alias("b"),
    )
    key = F.when(F.col("id") < 800, F.col("id")).alias("a")
    dim = spark.range(801).select(key, F.expr("explode(array(0D, 1D, NULL)) AS b"))
    dim = dim.withColumn("name", F.concat_ws("-", "a", "b"))
    plain = lookup(fact, dim, ["a", "b"], ["name"], how, null_safe)
    routed = lookup(fact, dim, ["a", "b"], ["name"], how, null_safe, broadcast_bytes=1, hot_rows=100)
    assert "__other" in plan_of(routed) and "__other" not in plan_of(plain)
    assert rows(routed) == rows(plain)


@pytest.mark.parametrize("null_safe", [False, True])
def test_few_rows_reduce_a_large_lookup(spark, null_safe):
    fact = spark.createDataFrame([(5, "a"), (5, "b"), (99_999, "c"), (None, "d")], "k int, t string")
    dim = spark.range(5000).select(F.when(F.col("id") != 7, F.col("id")).alias("k"), (F.col("id") * 2).alias("v"))
    reduced = lookup(fact, dim, ["k"], ["v"], null_safe=null_safe, broadcast_bytes=1000)
    assert "LeftSemi" in plan_of(reduced) and "SortMergeJoin" not in plan_of(reduced)
    assert rows(reduced) == [(5, "a", 10), (5, "b", 10), (99_999, "c", None), (None, "d", 14 if null_safe else None)]


def test_hot_keys_are_all_found(spark):
    df = spark.range(0, 30_000, 1, 5).select(F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 7 != 0, F.col("id")).alias("k"))
    assert rows(hot_keys(df, ["k"], 100)) == [(-1, 100)]
    assert rows(hot_keys(df, ["k"], 100, null_safe=True)) == [(-1, 100), (None, 29)]
    assert hot_keys(df, ["k"], 10_000) is None and hot_keys(df, ["k"]) is None


def test_equal_doubles_meet_whatever_their_salt(spark):
    fact = spark.createDataFrame([(0.0,)] * 50 + [(-0.0,)] * 50 + [(float("nan"),)] * 50, "k double")
    dim = spark.createDataFrame([(0.0, "zero"), (float("nan"), "nan"), (1.0, "one"), (2.0, "two")], "k double, name string")
    routed = lookup(fact, dim, ["k"], ["name"], broadcast_bytes=1, hot_rows=20)
    assert "Generate explode" in plan_of(routed)
    assert rows(routed.groupBy("name").count()) == [("nan", 50), ("zero", 100)]


def test_broadcast_bound_is_counted(spark):
    assert fits_broadcast(spark.range(100), 100 * 24)
    assert not fits_broadcast(spark.range(101), 100 * 24)
    assert not fits_broadcast(spark.range(100).withColumn("b", F.lit(1)), 100 * 24)
    assert not fits_broadcast(spark.range(10).withColumn("b", F.repeat(F.lit("x"), F.lit(300))), 100 * 24)
    assert fits_broadcast(spark.range(0).withColumn("b", F.lit("x")), 100)


def test_dense_ids_as_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("t\n" + "".join(f"x{i}\n" for i in range(500)))
    df = spark.read.option("header", True).csv(f"{tmp_path}/a.csv")
    assert [r.n for r in dense_id(df, None, "n").orderBy(F.expr("int(substr(t, 2))")).collect()] == list(range(1, 501))


def test_null_safe_join_matches_nulls(spark):
    left = spark.createDataFrame([("x", None), (None, 1), ("z", 1)], "a string, b int")
    right = spark.createDataFrame([("x", None, 10), (None, 1, 20)], "a string, b int, k int")
    assert rows(null_safe_join(left, right, ["a", "b"], ["k"])) == [("x", None, 10), ("z", 1, None), (None, 1, 20)]


def test_attach_uses_columns_of_earlier_sides(spark):
    base = spark.createDataFrame([(1,), (2,), (3,)], "a int")
    one = spark.createDataFrame([(1, 10), (2, 20)], "a int, b int")
    two = spark.createDataFrame([(10, "ten")], "b int, name string")
    joined = attach(base, Side(one, {"a": "a"}, {"b": "b"}, "left"), Side(two, {"b": "b"}, {"name": "n"}, "left"))
    assert rows(joined) == [(1, 10, "ten"), (2, 20, None), (3, None, None)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_expand_splits_a_header_with_a_small_share_of_the_rows(spark, how, tmp_path):
    header = spark.range(1200).select(F.when(F.col("id") < 1190, F.col("id")).alias("k"), F.col("id").alias("h"))
    spark.range(6000).select(
        F.when(F.col("id") % 200 == 0, 5).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 1000).cast("int").alias("k"),
        F.col("id").alias("d"),
    ).write.parquet(f"{tmp_path}/detail")
    detail = spark.read.parquet(f"{tmp_path}/detail")
    plain = header.join(detail.withColumnRenamed("k", "x"), F.col("k") == F.col("x"), how).drop("x")
    routed = expand(header, detail, "k", how, hot_rows=12)  # key 5 has half a percent of the rows
    assert plan_of(routed).count("ReadSchema: struct<k:int,d:bigint>") == 1 and "Generate explode" in plan_of(routed)
    assert rows(routed) == rows(plain)
    assert rows(expand(header, detail, "k", how)) == rows(plain)


def test_distinct_by_key(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (1, "c", 1), (2, None, 5)], "k int, t string, o int")
    assert rows(dedupe(df, ["k"], ["o", "t"])) == [(1, "c", 1), (2, None, 5)]
    assert rows(dedupe(df.where("t != 'c'"), ["k"], ["o"])) == [(1, "a", 2)]
    assert dedupe(df, ["k"]).count() == 2


def test_difference_is_distinct_and_null_safe(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "a int")
    right = spark.createDataFrame([(2,)], "a int")
    assert rows(difference(left, right)) == [(1,), (None,)]
    assert rows(difference(left, spark.createDataFrame([(None,)], "a int"))) == [(1,), (2,)]


def test_top_rows(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 9)], "k int, v int")
    found = top_rows(df, [F.desc("v"), "k"], 2)
    assert [tuple(r) for r in found.collect()] == [(3, 9), (1, 5)]
    assert "TakeOrderedAndProject" in plan_of(found)


@settings(max_examples=6, deadline=None)
@given(st.integers(0, 40), st.integers(1, 6))
def test_batches_cover_the_rows_once(spark, count, n):
    df = spark.range(count).select((F.col("id") * 7 + 3).alias("k"))
    found = {r.k: r.interval for r in split_batches(df, n, "k").collect()}
    size = max(1, count // n)
    assert found == {i * 7 + 3: min(n, i // size + 1) for i in range(count)}


def test_batches_of_ten_rows(spark):
    df = spark.range(1, 11)
    for dense in (False, True):
        sizes = rows(split_batches(df, 3, "id", dense=dense).groupBy("interval").count())
        assert sizes == [(1, 3), (2, 3), (3, 4)]


def test_checks(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c"), (None, "d")], "k int, t string")
    parent = spark.createDataFrame([(1,), (None,)], "p int")
    assert rows(check_unique(child, ["k", "t"])) == [(2, "c", 2), (None, "d", 1)]
    assert rows(check_fk(child, ["k"], parent, ["p"])) == [(2, 2)]
    assert rows(unmatched(child, ["k", "t"])) == [(5, 1, 0)]
    assert rows(row_counts({"child": child, "parent": parent})) == [("child", 5), ("parent", 2)]


def test_staged_rows_lie_in_the_configured_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_path(spark, "a") != new_path(spark, "a")
    staged = stage(spark.range(10).withColumn("a b", F.lit(1)))
    assert staged.count() == 10 and shared_dir(spark) in staged.inputFiles()[0]


def test_staged_rows_go_when_the_application_ends(tmp_path):
    """A session of its own, in a process of its own, leaves nothing behind."""
    code = (
        "from starloom.session import local_session\n"
        "from starloom.operators.staging import stage\n"
        f"s = local_session('own', 1, **{{'spark.checkpoint.dir': '{tmp_path}/shared'}})\n"
        "print('rows', stage(s.range(5)).count())\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert "rows 5" in done.stdout
    for _ in range(50):
        left = [f for _, _, files in os.walk(f"{tmp_path}/shared") for f in files]
        if not left:
            break
        time.sleep(0.2)
    assert not left


def test_distinct_by_key_takes_columns_of_any_type(spark):
    df = spark.sql("SELECT id % 3 AS k, id % 5 AS o, map('a', id) AS m, IF(id = 4, NULL, 'x') AS t FROM range(60)")
    df = df.unionByName(df)
    found = dedupe(df, ["k"], ["o"])
    assert "HashAggregate" in plan_of(found)
    assert [r[:2] for r in rows(found, "k", "o")] == [(0, 0), (1, 0), (2, 0)]
    again = dedupe(df.repartition(7), ["k"], ["o"])
    assert rows(found, "k", "m") == rows(again, "k", "m")
    assert rows(dedupe(df, ["k"], ["t"]), "k", "t") == [(0, "x"), (1, None), (2, "x")]


def test_declared_keys_are_reported(spark):
    tables = {
        "parent": spark.createDataFrame([(1,), (2,)], "p int"),
        "child": spark.createDataFrame([(1, 1), (1, 9), (3, 9), (None, 2)], "c int, p int"),
    }
    keys = Keys({"parent": ("p",), "child": ("c",)}, [("child", "p", "parent", "p")])
    assert sorted(tuple(r) for r in violations(tables, keys).collect()) == [
        ("child", "p in parent", 1, 2), ("child", "unique c", 2, 3), ("parent", "unique p", 0, 0),
    ]


def test_broadcasts_are_bounded_by_rows_not_by_estimates(spark, tmp_path):
    from starloom.operators.joins import fits_broadcast, lookup

    spark.range(5_000_000).selectExpr("id", "1 AS a").sort("id").write.parquet(f"{tmp_path}/small_files")
    stored = spark.read.parquet(f"{tmp_path}/small_files").select("a")
    exploded = spark.range(10).selectExpr("id", "explode(sequence(1, 500000)) AS k")
    assert not fits_broadcast(stored) and not fits_broadcast(exploded)
    assert fits_broadcast(stored.limit(10)) and fits_broadcast(spark.range(10).selectExpr("id", "explode(sequence(1, 5)) AS k"))
    spark.createDataFrame([(1, "x" * 1000)] * 100, "k int, t string").coalesce(1).write.parquet(f"{tmp_path}/texts")
    texts = spark.read.parquet(f"{tmp_path}/texts")
    assert fits_broadcast(texts, 200_000) and not fits_broadcast(texts, 90_000)
    fact = spark.range(10).selectExpr("id AS k")
    joined = lookup(fact, exploded.select("k"), ["k"], broadcast_bytes=10_000)
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().optimizedPlan().toString()


def test_keys_grow(spark):
    from starloom.operators.ids import grow_keys

    known = spark.createDataFrame([(1, "b", 1), (2, None, 1)], "k bigint, a string, b int")
    rows = spark.createDataFrame([("b", 1), ("a", 1), ("a", 1), (None, 1), (None, None), ("c", 2)], "a string, b int")
    assert sorted((r.k, r.a, r.b) for r in grow_keys(known, rows, "k", ["a", "b"]).collect()) == [(3, None, None), (4, "a", 1), (5, "c", 2)]
    assert grow_keys(known, rows.limit(1), "k", ["a", "b"]).count() == 0
    assert [r.k for r in grow_keys(known.limit(0), rows.where("a = 'c'"), "k", ["a"]).collect()] == [1]
