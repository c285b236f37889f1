from __future__ import annotations

import json
import os
import re
from datetime import date

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from conftest import rows
from starloom.constants import EVENT_SCHEMA
from starloom.operators.staging import delete_path
from starloom.plans.calendar import calendar_extended
from starloom.plans.dimensions import build_dim_plan, conform_provider, provider_rows
from starloom.plans.gold import gold_provider_month
from starloom.plans import runs
from starloom.plans.runs import Layout, continue_medallion, event_files, rebuild_medallion, reset_stream, run_medallion
from starloom.sinks.files import write_csv, write_json_batches
from starloom.sinks.tables import (
    append_table,
    ctas,
    ensure_database,
    load_mart,
    overwrite_partitions,
    partition_values,
    refresh_table,
    replace_table,
    reset,
    write_table,
)
from starloom.sources.files import extract_columns, lookup_table, read_csv, read_json_array, read_json_nested, read_path
from starloom.sources.jdbc import Partitioning, sqlserver_settings, sqlserver_url, table_options
from starloom.sources.streams import stream_json, stream_table
from starloom.streaming import bronze as bronze_module
from starloom.streaming import gold as gold_module
from starloom.streaming import ledger
from starloom.streaming import silver as silver_module
from starloom.streaming.bronze import append_increment, drain, ingest_bronze
from starloom.streaming.gold import GoldTables, reduce_loads, refresh_gold
from starloom.streaming.silver import append_silver, enrich_silver, rebuild_silver, repair_silver, stream_silver


def test_csv_keeps_text_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([(" a ", "x,y"), (None, 'q "z"'), ("NA", "line")], "a string, b string")
    write_csv(df, f"{tmp_path}/c")
    assert rows(read_csv(spark, f"{tmp_path}/c", df.schema)) == rows(df)
    assert read_csv(spark, f"{tmp_path}/c").columns == ["a", "b"]


def test_csv_tokens_decide_the_inferred_type(spark, tmp_path):
    (tmp_path / "t.csv").write_text("lower,upper\n1.5,1.5\nnan,NaN\n")
    assert dict(read_csv(spark, f"{tmp_path}/t.csv").dtypes) == {"lower": "string", "upper": "double"}


def test_json_documents(spark, tmp_path):
    records = [{"region": "a", "network_tier": None}, {"region": "b", "network_tier": "t"}]
    (tmp_path / "array.json").write_text(json.dumps(records, indent=1))
    (tmp_path / "nested.json").write_text(json.dumps({"regions": records}, indent=1))
    assert rows(read_json_array(spark, f"{tmp_path}/array.json"), "region", "network_tier") == [("a", None), ("b", "t")]
    assert rows(read_json_nested(spark, f"{tmp_path}/nested.json", "regions"), "region", "network_tier") == [("a", None), ("b", "t")]


def test_literal_rows_and_paths(spark, tmp_path):
    tuples = lookup_table(spark, [(1, "a")], "k int, t string")
    objects = lookup_table(spark, [Row(code="P1", active=True)])
    assert (tuples.dtypes, objects.dtypes) == ([("k", "int"), ("t", "string")], [("code", "string"), ("active", "boolean")])
    tuples.write.parquet(f"{tmp_path}/p")
    assert rows(extract_columns(read_path(spark, f"{tmp_path}/p"), ["t"])) == [("a",)]


def test_jdbc_options():
    url = sqlserver_url("h.example", "db")
    assert url.startswith("jdbc:sqlserver://h.example:1433;database=db;") and "encrypt=true;" in url
    assert "trustServerCertificate=false;" in url
    assert sqlserver_settings({"SQL_HOST": "h", "SQL_DB": "d", "SQL_USER": "u"}) is None
    found = sqlserver_settings({"SQL_HOST": "h", "SQL_DB": "d", "SQL_USER": "u", "SQL_PWD": "p"})
    assert (found["user"], found["password"]) == ("u", "p")
    options = table_options("u", "dbo.T", {"fetchsize": "1000"}, Partitioning("id", 1, 100, 8))
    assert options == {
        "url": "u", "dbtable": "dbo.T", "fetchsize": "1000", "partitionColumn": "id", "lowerBound": "1", "upperBound": "100",
        "numPartitions": "8",
    }


def test_tables(spark):
    ensure_database(spark, "loads_test")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, `two words` string")
    write_table(df, "t")
    append_table(df, "t")
    assert spark.table("t").count() == 4
    replace_table(spark.table("t").where("k = 1"), "t")
    assert rows(spark.table("t")) == [(1, "a"), (1, "a")]
    write_table(df.select("k"), "t", overwrite_schema=True)
    assert spark.table("t").columns == ["k"]
    refresh_table(spark, "t", "SELECT 7")
    assert rows(spark.table("t")) == [(7,)]
    ctas(spark, "copied", "SELECT * FROM t")
    refresh_table(spark, "t", "SELECT 8")
    ctas(spark, "copied", "SELECT * FROM t")
    assert rows(spark.table("copied")) == [(7,)]
    load_mart({"t": spark.table("copied"), "fresh": df})
    assert (spark.table("t").count(), spark.table("fresh").count()) == (2, 2)
    reset(spark, ["t", "copied", "fresh", "never_there"])
    assert not spark.catalog.tableExists("t")
    spark.sql("USE default")


def test_only_the_partitions_written_are_replaced(spark):
    a = spark.createDataFrame([(1, "a"), (2, "a")], "k int, load_id string")
    b = spark.createDataFrame([(3, "b")], "k int, load_id string")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    overwrite_partitions(a, "parts", ["load_id"])
    overwrite_partitions(b, "parts", ["load_id"])
    overwrite_partitions(a.where("k = 2").select("load_id", "k"), "parts", ["load_id"])
    assert rows(spark.table("parts")) == [(2, "a"), (3, "b")]
    increment = spark.table("parts").where("load_id = 'b'").withColumn("load_id", F.lit("c"))
    overwrite_partitions(increment, "parts", ["load_id"])
    assert rows(spark.table("parts")) == [(2, "a"), (3, "b"), (3, "c")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    reset(spark, ["parts"])


# ---- streams ----


class Flow:
    """Bronze and silver of a small event stream."""

    def __init__(self, spark, folder, label):
        self.spark, self.folder, self.label = spark, str(folder), label
        self.input = f"{self.folder}/input"
        self.bronze, self.silver = f"{label}_bronze", f"{label}_silver"
        self.dims = {
            "member": spark.createDataFrame(
                [(i, "male" if i % 2 else "female", "no", "west", 1) for i in range(1, 21)],
                "member_id bigint, sex string, smoker string, region string, region_key bigint",
            ),
            "provider": conform_provider(provider_rows(spark)),
            "date": calendar_extended(spark, "2025-01-01", "2025-01-21", as_of="2025-01-01"),
            "plan": build_dim_plan(spark),
        }

    def events(self, lo, hi):
        return self.spark.range(lo, hi + 1).selectExpr(
            "concat('E', lpad(id, 6, '0')) AS event_id", "id AS member_id", "int(id % 4 + 1) AS plan_key",
            "element_at(array('P001', 'P002', 'P003', 'P009'), int(id % 4) + 1) AS provider_code",
            "string(date_add(date'2025-01-01', int(id))) AS event_date", "id * 1.5D AS charge_amount",
        )

    def arrive(self, interval, lo, hi):
        self.events(lo, hi).coalesce(1).write.mode("append").json(f"{self.input}/interval={interval}")

    def ingest(self, max_files=None):
        ingest_bronze(self.spark, self.input, self.bronze, f"{self.folder}/cp_bronze", max_files=max_files, source="in")

    def enrich(self):
        enrich_silver(self.spark, self.bronze, self.dims, self.silver, f"{self.folder}/cp_silver")

    def count(self, table):
        return self.spark.table(table).count()

    def drop(self):
        reset(self.spark, [self.bronze, self.silver])


@pytest.fixture
def flow(spark, tmp_path, request):
    made = Flow(spark, tmp_path, re.sub(r"\W", "_", request.node.name))
    yield made
    made.drop()


def test_bronze_takes_each_file_once(flow):
    for interval, (lo, hi) in enumerate([(1, 10), (11, 20), (21, 30)], 1):
        flow.arrive(interval, lo, hi)
    flow.ingest(max_files=1)
    loads = rows(flow.spark.table(flow.bronze).groupBy("load_id").count())
    assert loads == [("stream-in-0", 10), ("stream-in-1", 10), ("stream-in-2", 10)]
    assert rows(flow.spark.table(flow.bronze).groupBy("interval").count()) == [(1, 10), (2, 10), (3, 10)]
    flow.ingest()
    assert flow.count(flow.bronze) == 30
    flow.arrive(4, 31, 35)
    flow.ingest()
    assert flow.count(flow.bronze) == 35


def test_old_and_nested_files_are_read(flow):
    flow.arrive(1, 1, 10)
    flow.ingest()
    flow.events(11, 15).coalesce(1).write.json(f"{flow.input}/late/deeper/interval=2")
    for folder, _, names in os.walk(f"{flow.input}/late"):
        for name in names:
            os.utime(f"{folder}/{name}", (1_000_000_000, 1_000_000_000))
    flow.ingest()
    assert rows(flow.spark.table(flow.bronze).groupBy("interval").count()) == [(1, 10), (2, 5)]


def test_sources_share_a_table(flow):
    spark = flow.spark
    flow.arrive(1, 1, 10)
    flow.ingest()
    flow.events(21, 23).write.json(f"{flow.folder}/other")
    ingest_bronze(spark, f"{flow.folder}/other", flow.bronze, f"{flow.folder}/cp_other")
    assert flow.count(flow.bronze) == 13
    with pytest.raises(ValueError, match="checkpoint"):
        ingest_bronze(spark, f"{flow.folder}/other", flow.bronze, f"{flow.folder}/cp_third", source="in")
    assert flow.count(flow.bronze) == 13


def test_a_lost_checkpoint_reads_everything_once(flow):
    spark = flow.spark
    flow.arrive(1, 1, 4)
    take = lambda: ingest_bronze(spark, flow.input, flow.bronze, f"{flow.folder}/cp_lost")
    take()
    flow.arrive(2, 5, 10)
    take()
    flow.enrich()
    assert flow.count(flow.silver) == 10
    delete_path(spark, f"{flow.folder}/cp_lost")
    take()
    assert flow.count(flow.bronze) == 10
    flow.enrich()
    assert flow.count(flow.silver) == 10


def archive(flow, interval):
    """Take an interval's files out of the input folder, as cleaning jobs do."""
    os.rename(f"{flow.input}/interval={interval}", f"{flow.folder}/archived-{interval}")


def test_a_lost_checkpoint_with_archived_input_loses_nothing(flow):
    spark = flow.spark
    take = lambda: ingest_bronze(spark, flow.input, flow.bronze, f"{flow.folder}/cp_lost")
    flow.arrive(1, 1, 6)
    flow.arrive(2, 7, 10)
    take()
    flow.enrich()
    archive(flow, 1)
    flow.arrive(3, 11, 13)
    for expected in (13, 13):
        delete_path(spark, f"{flow.folder}/cp_lost")
        take()
        flow.enrich()
        assert flow.count(flow.bronze) == flow.count(flow.silver) == expected
        assert spark.table(flow.silver).select("event_id").distinct().count() == expected
    flow.arrive(4, 14, 15)
    take()
    flow.enrich()
    assert flow.count(flow.bronze) == flow.count(flow.silver) == 15


def test_a_named_source_restarts_when_told(flow):
    flow.arrive(1, 1, 4)
    flow.ingest()
    delete_path(flow.spark, f"{flow.folder}/cp_bronze")
    flow.arrive(2, 5, 6)
    ingest_bronze(flow.spark, flow.input, flow.bronze, f"{flow.folder}/cp_bronze", source="in", restart=True)
    assert rows(flow.spark.table(flow.bronze).groupBy("load_id").count()) == [("stream-in-0", 4), ("stream-in-r1-0", 2)]


def test_a_load_that_was_not_noted_is_adopted(flow):
    flow.arrive(1, 1, 4)
    flow.ingest()
    for kind in ("ledger", "files"):
        flow.spark.sql(f"DROP TABLE {flow.bronze}__{kind}")
    delete_path(flow.spark, f"{flow.folder}/cp_bronze")
    ingest_bronze(flow.spark, flow.input, flow.bronze, f"{flow.folder}/cp_bronze", source="in", restart=True)
    assert flow.count(flow.bronze) == 4
    flow.enrich()
    assert flow.count(flow.silver) == 4


def test_a_lost_silver_checkpoint_doubles_nothing(flow):
    spark = flow.spark
    flow.arrive(1, 1, 6)
    flow.ingest()
    load = lambda: append_silver(spark, flow.bronze, flow.dims, flow.silver, f"{flow.folder}/cp_append")
    load()
    flow.arrive(2, 7, 10)
    flow.ingest()
    load()
    assert flow.count(flow.silver) == 10
    delete_path(spark, f"{flow.folder}/cp_append")
    load()
    assert flow.count(flow.silver) == 10
    delete_path(spark, f"{flow.folder}/cp_silver")
    flow.enrich()
    assert flow.count(flow.silver) == 10


def test_load_ids_may_have_any_sign(flow):
    spark = flow.spark
    flow.arrive(1, 1, 6)
    flow.ingest()
    names = ["inc 2025-01-01 10:00:00", "a/b=c", "it's", "50% off", "back\\slash", 'say "x"', "ünï"]
    for load in names:
        append_increment(spark, flow.bronze, load, 3)
    flow.enrich()
    assert (flow.count(flow.bronze), flow.count(flow.silver)) == (27, 27)
    assert sorted(partition_values(spark, flow.silver, "load_id")) == sorted([*names, "stream-in-0"])
    for load in names:
        append_increment(spark, flow.bronze, load, 0)
    flow.enrich()
    assert (flow.count(flow.bronze), flow.count(flow.silver)) == (6, 6)
    assert partition_values(spark, flow.silver, "load_id") == ["stream-in-0"]


def test_gold_follows_a_run_that_failed_after_silver(flow, monkeypatch):
    spark = flow.spark
    gold = GoldTables(f"{flow.label}_g1", f"{flow.label}_g2")
    region = spark.createDataFrame([(1, "west")], "region_key bigint, region_name string")
    flow.arrive(1, 1, 10)
    flow.ingest()
    take = lambda: enrich_silver(spark, flow.bronze, flow.dims, flow.silver, f"{flow.folder}/cp_silver", gold=gold)
    take()
    flow.arrive(2, 11, 15)
    flow.ingest()
    monkeypatch.setattr(silver_module, "reduce_loads", lambda *_: 1 / 0)
    with pytest.raises(Exception, match="division"):
        take()
    monkeypatch.undo()
    assert flow.count(flow.silver) == 15
    refresh_gold(spark, flow.silver, region, gold, by_load=True)
    assert sum(r[2] for r in rows(spark.table(gold.region_smoker))) == 15
    take()
    flow.dims["member"] = flow.dims["member"].withColumn("smoker", F.lit("yes"))
    rebuild_silver(spark, flow.bronze, flow.dims, flow.silver)  # not told about gold
    refresh_gold(spark, flow.silver, region, gold, by_load=True)
    assert rows(spark.table(gold.region_smoker), "smoker", "num_events") == [("yes", 15)]
    reset(spark, [gold.region_smoker, gold.provider_month, *gold.reduced])


def test_reductions_of_many_loads_are_merged(flow, monkeypatch):
    monkeypatch.setattr(gold_module, "MOST_PARTS", 4)
    spark, per_load = flow.spark, 3
    gold = GoldTables(f"{flow.label}_g1", f"{flow.label}_g2", scale=2)
    region = spark.createDataFrame([(1, "west")], "region_key bigint, region_name string")
    events = flow.events(1, 20).withColumn("source_file", F.lit(None).cast("string"))

    def load(name, n):
        rows_of = events.where(f"member_id <= {n}").withColumn("event_id", F.concat("event_id", F.lit(name)))
        bronze_module.write_load(rows_of, flow.bronze, name)

    def check():
        enrich_silver(spark, flow.bronze, flow.dims, flow.silver, f"{flow.folder}/cp_silver", gold=gold)
        refresh_gold(spark, flow.silver, region, gold, by_load=True)
        expected = rows(gold_provider_month(spark.table(flow.silver), scale=2))
        assert rows(spark.table(gold.provider_month)) == expected
        assert sum(r[2] for r in rows(spark.table(gold.region_smoker))) == flow.count(flow.silver)
        return [len(partition_values(spark, t, "load_id")) for t in gold.reduced]

    for k in range(9):
        for n in range(per_load):
            load(f"l{k}-{n}", 1 + n)
        assert max(check()) <= 9
    load("l0-0", 20)  # in a tier
    load("l8-2", 5)
    assert max(check()) <= 16
    load("l1-1", 0)  # goes
    check()
    rebuild_silver(spark, flow.bronze, flow.dims, flow.silver, gold=gold)
    check()
    assert flow.count(flow.silver) == 20 + 5 + 9 * 6 - 1 - 3 - 2
    reset(spark, [gold.region_smoker, gold.provider_month, *gold.reduced])


def test_repair_enriches_only_the_loads_that_were_hit(flow):
    spark = flow.spark
    for interval, (lo, hi) in enumerate([(1, 10), (15, 25), (40, 45)], 1):
        flow.arrive(interval, lo, hi)
    flow.ingest(max_files=1)
    flow.enrich()
    assert repair_silver(spark, flow.bronze, flow.dims, flow.silver) == []
    late = spark.createDataFrame([(i, "male", "yes", "east", 2) for i in range(21, 26)], flow.dims["member"].schema)
    flow.dims["member"] = flow.dims["member"].union(late)
    kept = ledger.loads(spark, flow.silver)
    assert repair_silver(spark, flow.bronze, flow.dims, flow.silver) == ["stream-in-1"]
    now = ledger.loads(spark, flow.silver)
    assert {x for x in now if now[x] != kept[x]} == {"stream-in-1"}
    assert spark.table(flow.silver).where("sex IS NULL").count() == 6
    assert repair_silver(spark, flow.bronze, flow.dims, flow.silver) == []
    flow.enrich()
    assert flow.count(flow.silver) == 27


def test_an_increment_reads_only_the_highest_loads(flow):
    spark = flow.spark
    for interval, (lo, hi) in enumerate([(1, 10), (31, 60), (11, 30)], 1):
        flow.arrive(interval, lo, hi)
    flow.ingest(max_files=1)
    files = bronze_module._highest_loads(spark, flow.bronze, 25).inputFiles()
    highest = rows(spark.table(flow.bronze).where("member_id = 60"), "load_id")[0][0]
    assert files and all(f"load_id={highest}" in f for f in files)
    for n in (5, 35, 55, 100):
        append_increment(spark, flow.bronze, f"increment-{n}", n)
        added = rows(spark.table(flow.bronze).where(F.col("load_id") == f"increment-{n}"), "member_id")
        assert sorted(r[0] for r in added) == list(range(61 - min(n, 60), 61))


def test_ledgers_are_folded(flow, monkeypatch):
    monkeypatch.setattr(ledger, "MOST_FILES", 4)
    flow.arrive(1, 1, 6)
    flow.ingest()
    for n in range(6):
        append_increment(flow.spark, flow.bronze, "increment-1", n)
    assert len(flow.spark.table(ledger.ledger_of(flow.bronze)).inputFiles()) <= 5
    flow.enrich()
    assert (flow.count(flow.bronze), flow.count(flow.silver)) == (11, 11)


def test_overwriting_keeps_the_rows_until_the_new_ones_are_complete(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS kept")
    for path in (None, f"{tmp_path}/kept"):
        write_table(spark.range(5), "kept", path=path)
        broken = spark.range(100, 110).select(F.when(F.col("id") == 109, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("bigint").alias("id"))
        with pytest.raises(Exception, match="no"):
            write_table(broken, "kept", path=path)
        assert rows(spark.table("kept")) == [(i,) for i in range(5)]
        write_table(spark.table("kept").where("id > 2"), "kept", path=path)
        write_table(spark.table("kept").selectExpr("id", "id * 2 AS twice"), "kept", path=path)
        assert rows(spark.table("kept")) == [(3, 6), (4, 8)]
        write_table(spark.table("kept").selectExpr("twice", "id % 2 AS part"), "kept", partition_by=["part"], path=path)
        assert rows(spark.table("kept")) == [(6, 1), (8, 0)]
        reset(spark, ["kept"], [path] if path else [])
        assert not spark.catalog.tableExists("kept")
        assert not [f for f in os.listdir(tmp_path) if f.startswith("kept")]


def test_a_load_that_becomes_empty_goes(flow):
    spark = flow.spark
    flow.arrive(1, 1, 6)
    flow.ingest()
    append_increment(spark, flow.bronze, "increment-1", 3)
    flow.enrich()
    assert (flow.count(flow.bronze), flow.count(flow.silver)) == (9, 9)
    append_increment(spark, flow.bronze, "increment-1", 0)
    flow.enrich()
    assert (flow.count(flow.bronze), flow.count(flow.silver)) == (6, 6)


def test_gold_by_load_follows_a_rebuild(flow):
    spark = flow.spark
    gold = GoldTables(f"{flow.label}_g1", f"{flow.label}_g2")
    region = spark.createDataFrame([(1, "west")], "region_key bigint, region_name string")
    flow.arrive(1, 1, 20)
    flow.arrive(2, 21, 30)
    flow.ingest(max_files=1)
    enrich_silver(spark, flow.bronze, flow.dims, flow.silver, f"{flow.folder}/cp_silver", gold=gold)
    refresh_gold(spark, flow.silver, region, gold, by_load=True)
    flow.dims["member"] = flow.dims["member"].withColumn("smoker", F.lit("yes"))
    rebuild_silver(spark, flow.bronze, flow.dims, flow.silver, gold=gold)
    refresh_gold(spark, flow.silver, region, gold, by_load=True)
    found = rows(spark.table(gold.region_smoker), "region_name", "smoker", "num_events")
    assert found == [("west", "yes", 20), (None, None, 10)]
    reset(spark, [gold.region_smoker, gold.provider_month, *gold.reduced])


def test_a_replayed_bronze_batch_adds_nothing(flow):
    flow.arrive(1, 1, 10)
    flow.ingest()
    os.remove(f"{flow.folder}/cp_bronze/commits/0")
    os.remove(f"{flow.folder}/cp_bronze/commits/.0.crc") if os.path.exists(f"{flow.folder}/cp_bronze/commits/.0.crc") else None
    flow.ingest()
    assert flow.count(flow.bronze) == 10


def test_silver_follows_new_repeated_and_appended_loads(flow):
    spark = flow.spark
    flow.arrive(1, 1, 20)
    flow.arrive(2, 21, 30)
    flow.ingest(max_files=1)
    flow.enrich()
    silver = spark.table(flow.silver)
    assert silver.count() == 30
    assert silver.where("region_key IS NULL").count() == 10  # members 21 to 30 are not known
    assert silver.where("provider_key IS NULL").count() == 7
    flow.enrich()
    assert flow.count(flow.silver) == 30

    again = spark.table(flow.bronze).where("load_id = 'stream-in-0'")
    again.write.mode("overwrite").parquet(f"{flow.folder}/copy")
    overwrite_partitions(spark.read.parquet(f"{flow.folder}/copy"), flow.bronze, ["load_id"])
    flow.enrich()
    assert flow.count(flow.silver) == 30

    append_increment(spark, flow.bronze, "increment-1", 5)
    append_increment(spark, flow.bronze, "increment-1", 5)
    assert flow.count(flow.bronze) == 35
    flow.enrich()
    assert flow.count(flow.silver) == 35
    added = rows(spark.table(flow.silver).where("event_id LIKE 'INC%'"), "event_id")
    assert added == [(f"INC_E0000{i}",) for i in range(26, 31)]
    append_increment(spark, flow.bronze, "increment-2", 5)
    flow.enrich()
    assert spark.table(flow.silver).where("event_id LIKE 'INC_INC%'").count() == 0
    assert flow.count(flow.silver) == 40


def test_events_that_occur_twice_stay_twice(flow):
    flow.arrive(1, 1, 5)
    flow.arrive(2, 1, 5)
    flow.ingest()
    flow.enrich()
    assert flow.count(flow.silver) == 10


def test_streamed_silver_equals_the_rebuilt_one(flow):
    spark = flow.spark
    flow.arrive(1, 1, 20)
    flow.arrive(2, 21, 30)
    flow.ingest(max_files=1)
    flow.enrich()
    streamed = rows(spark.table(flow.silver))
    rebuild_silver(spark, flow.bronze, flow.dims, flow.silver)
    assert rows(spark.table(flow.silver)) == streamed
    assert spark.table(flow.silver).select("load_id").distinct().count() == 2


def test_rebuilding_repairs_late_members(flow):
    spark = flow.spark
    flow.arrive(1, 15, 25)
    flow.ingest()
    flow.enrich()
    assert spark.table(flow.silver).where("sex IS NULL").count() == 5
    late = spark.createDataFrame([(i, "male", "yes", "east", 2) for i in range(21, 26)], flow.dims["member"].schema)
    flow.dims["member"] = flow.dims["member"].union(late)
    flow.enrich()
    assert spark.table(flow.silver).where("sex IS NULL").count() == 5
    rebuild_silver(spark, flow.bronze, flow.dims, flow.silver)
    assert spark.table(flow.silver).where("sex IS NULL").count() == 0
    flow.arrive(2, 30, 31)
    flow.ingest()
    flow.enrich()
    assert flow.count(flow.silver) == 13


def test_stream_static_joins_append(flow):
    spark = flow.spark
    flow.arrive(1, 1, 30)
    flow.ingest()
    assert stream_silver(spark, flow.bronze, flow.dims).isStreaming

    def load():
        append_silver(spark, flow.bronze, flow.dims, flow.silver, f"{flow.folder}/cp_append")
        return flow.count(flow.silver)

    assert (load(), load()) == (30, 30)
    flow.arrive(2, 31, 35)
    flow.ingest()
    assert load() == 35


def test_gold_is_refreshed_in_place(flow):
    spark = flow.spark
    flow.arrive(1, 1, 20)
    flow.ingest()
    flow.enrich()
    region = spark.createDataFrame([(1, "west")], "region_key bigint, region_name string")
    gold = GoldTables(f"{flow.label}_g1", f"{flow.label}_g2")
    refresh_gold(spark, flow.silver, region, gold)
    assert sum(r[2] for r in rows(spark.table(gold.region_smoker))) == 20
    append_increment(spark, flow.bronze, "increment-1")
    flow.enrich()
    refresh_gold(spark, flow.silver, region, gold)
    assert sum(r[2] for r in rows(spark.table(gold.region_smoker))) == 40
    assert rows(spark.table(gold.provider_month)) == rows(gold_provider_month(spark.table(flow.silver)))
    reset(spark, [gold.region_smoker, gold.provider_month])


def test_gold_load_by_load_equals_gold_of_all(flow):
    spark = flow.spark
    region = spark.createDataFrame([(1, "west")], "region_key bigint, region_name string")
    whole, parts = (GoldTables(f"{flow.label}_{n}1", f"{flow.label}_{n}2") for n in "wp")
    reduced = []

    def load():
        def after(loads):
            reduced.append(sorted(loads))
            reduce_loads(spark, flow.silver, parts, loads)

        enrich_silver(spark, flow.bronze, flow.dims, flow.silver, f"{flow.folder}/cp_silver", after=after)
        refresh_gold(spark, flow.silver, region, whole)
        refresh_gold(spark, flow.silver, region, parts, by_load=True)
        assert rows(spark.table(parts.region_smoker)) == rows(spark.table(whole.region_smoker))
        assert rows(spark.table(parts.provider_month)) == rows(spark.table(whole.provider_month))
        return sum(r[2] for r in rows(spark.table(parts.region_smoker)))

    flow.arrive(1, 1, 20)
    flow.ingest()
    assert load() == 20
    flow.arrive(2, 21, 30)
    flow.ingest()
    append_increment(spark, flow.bronze, "increment-1", 5)
    assert load() == 35
    assert load() == 35
    append_increment(spark, flow.bronze, "increment-1", 3)
    assert load() == 33
    assert reduced == [["stream-in-0"], ["increment-1", "stream-in-1"], ["increment-1"]]
    rebuild_silver(spark, flow.bronze, flow.dims, flow.silver)
    reduce_loads(spark, flow.silver, parts)
    assert load() == 33
    reset(spark, [t for g in (whole, parts) for t in (g.region_smoker, g.provider_month)] + list(parts.reduced))


def test_streams_read_folders_and_tables(flow):
    spark = flow.spark
    flow.arrive(7, 1, 3)
    stream = stream_json(spark, flow.input, EVENT_SCHEMA)
    assert "interval" in stream.columns
    seen = []
    drain(stream, lambda batch, _: seen.extend(r.interval for r in batch.collect()), f"{flow.folder}/cp")
    assert seen == [7, 7, 7]
    flow.ingest()
    assert stream_table(spark, flow.bronze).isStreaming


def test_reset_forgets_the_checkpoint(spark, tmp_path):
    place = Layout("reset_test_", str(tmp_path))
    location = place.location("events")
    spark.range(5).selectExpr("id AS member_id").write.json(f"{tmp_path}/in")

    def load():
        ingest_bronze(spark, f"{tmp_path}/in", place.table("events"), place.checkpoint(str(tmp_path), "events"),
                      "member_id bigint", location=location)
        return spark.table(place.table("events")).count()

    assert load() == 5
    reset_stream(spark, place, str(tmp_path), "events")
    assert not os.path.exists(location)
    assert load() == 5


def test_medallion_end_to_end(spark, tmp_path):
    insurance = spark.range(100).selectExpr(
        "id AS row_no", "string(id % 80) AS age", "if(id % 2 = 0, 'male', 'female') AS sex", "'27.5' AS bmi",
        "'1' AS children", "if(id % 5 = 0, 'yes', 'no') AS smoker", "element_at(array('ne','nw','se'), int(id % 3) + 1) AS region",
        "string(id + 0.25) AS charges",
    )
    calendar = calendar_extended(spark, "2025-01-01", "2025-12-31", as_of="2025-06-01", end_inclusive=True)
    run_medallion(spark, insurance.limit(60), "row_no", calendar, Layout("e2e_", str(tmp_path)), str(tmp_path))
    names = run_medallion(spark, insurance, "row_no", calendar, Layout("e2e_", str(tmp_path)), str(tmp_path))
    assert spark.table(names["bronze"]).count() == spark.table(names["silver"]).count() == 125
    assert rows(spark.table(names["bronze"]).where("load_id LIKE 'stream%'").groupBy("interval").count()) == [(1, 33), (2, 33), (3, 34)]
    gold = rows(spark.table(names["gold_region_smoker"]))
    assert sum(r[2] for r in gold) == 125
    assert spark.table(names["silver"]).where("date_key IS NULL OR region_key IS NULL OR plan_key IS NULL").count() == 0
    assert spark.table(names["silver"]).select("fact_key").distinct().count() == 125
    assert spark.table(names["bronze"]).where("load_id LIKE 'stream%'").groupBy("interval", "load_id").count().count() == 3
    late = spark.table(names["bronze"]).where("interval = 1").limit(7).drop("load_id", "interval")
    late.write.json(f"{event_files(Layout('e2e_', str(tmp_path)), str(tmp_path))}/interval=4")
    continue_medallion(spark, Layout("e2e_", str(tmp_path)), str(tmp_path), "increment-2")
    assert spark.table(names["bronze"]).count() == spark.table(names["silver"]).count() == 157
    assert sum(r[2] for r in rows(spark.table(names["gold_region_smoker"]))) == 157


def _people(spark, lo, hi, region):
    return spark.range(lo, hi).selectExpr(
        "id AS row_no", "string(id % 80) AS age", "if(id % 2 = 0, 'male', 'female') AS sex", "'27.5' AS bmi",
        "'1' AS children", "if(id % 5 = 0, 'yes', 'no') AS smoker", f"{region} AS region", "string(id + 0.25) AS charges",
    )


def test_new_members_keep_old_keys(spark, tmp_path):
    place, base = Layout("grown_", str(tmp_path)), str(tmp_path)
    calendar = calendar_extended(spark, "2025-01-01", "2025-12-31", as_of="2025-06-01", end_inclusive=True)
    names = run_medallion(spark, _people(spark, 0, 30, "if(id % 2 = 0, 'ne', 'sw')"), "row_no", calendar, place, base, None)
    before = {d: rows(spark.table(names[d])) for d in ("dim_region", "dim_member", "dim_risk_profile")}
    more = _people(spark, 30, 40, "if(id % 2 = 0, 'aa', 'ne')")
    for _ in range(2):  # the second time, the batch is known
        continue_medallion(spark, place, base, None, more, "row_no", "second")
        for d, old in before.items():
            assert set(old) <= set(rows(spark.table(names[d])))
        assert rows(spark.table(names["dim_region"])) == [(1, "ne"), (2, "sw"), (3, "aa")]
        assert spark.table(names["dim_member"]).count() == spark.table(names["silver"]).count() == 40
        assert spark.table(names["silver"]).where("region_key IS NULL OR smoker IS NULL").count() == 0
        assert sum(r[2] for r in rows(spark.table(names["gold_region_smoker"]))) == 40
    assert rebuild_medallion(spark, place) == names
    assert sum(r[2] for r in rows(spark.table(names["gold_region_smoker"]))) == 40


def test_a_batch_of_members_that_failed_goes_on(spark, tmp_path, monkeypatch):
    place, base = Layout("failed_", str(tmp_path)), str(tmp_path)
    calendar = calendar_extended(spark, "2025-01-01", "2025-01-31", as_of="2025-01-01")
    names = run_medallion(spark, _people(spark, 0, 6, "'ne'"), "row_no", calendar, place, base, None)
    more = _people(spark, 6, 10, "'sw'")
    monkeypatch.setattr(runs, "build_events", lambda _: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        continue_medallion(spark, place, base, None, more, "row_no", "second")
    monkeypatch.undo()
    continue_medallion(spark, place, base, None, more, "row_no", "second")
    assert [r[0] for r in rows(spark.table(names["dim_member"]), "member_id")] == [1, 10, *range(2, 10)]
    assert spark.table(names["silver"]).count() == 10 and spark.table(names["dim_region"]).count() == 2


def test_unmatched_keys_are_read_from_rows_without_a_match(spark, tmp_path):
    columns = "sex string, smoker string, region string, region_key bigint, member_id bigint, provider_key bigint, provider_code string"
    schema = f"{columns}, date_key int, event_date date, plan_key int, load_id string"
    whole = ("m", "no", "ne", 1, 1, 1, "P1", 20250101, date(2025, 1, 1), 1)
    missed = (None, None, None, None, 2, None, "P9", None, date(2030, 1, 1), None)
    partly = ("m", None, None, None, 3, None, None, None, None, 1)  # a member with NULLs, and keys that are NULL
    silver = [(*whole, "a"), (*whole, "a"), (*whole, "b"), (*missed, "b"), (*missed, "b"), (*partly, "c"), (*([None] * 10), "d")]
    spark.createDataFrame(silver, schema).write.parquet(f"{tmp_path}/s")
    found = silver_module._unmatched(spark.read.parquet(f"{tmp_path}/s"))
    keys = [("date", "2030-01-01", "b"), ("member", "2", "b"), ("plan", None, "b"), ("plan", None, "d"), ("provider", "P9", "b")]
    assert found.columns == ["dimension", "key", "load_id"] and found.count() == 9
    assert rows(found.where("dimension IS NOT NULL")) == keys
    assert rows(found.where("dimension IS NULL")) == [(None, None, x) for x in "abcd"]
    plan = found._jdf.queryExecution().toString()
    assert "Generate" not in plan
    for column in ("smoker", "provider_key", "date_key", "plan_key"):  # what the scans leave to the footers
        assert re.search(rf"PushedFilters: \[[^\]]*IsNull\({column}\)", plan)


def test_a_run_on_no_rows(spark, tmp_path):
    place, base = Layout("none_", str(tmp_path)), str(tmp_path)
    calendar = calendar_extended(spark, "2025-01-01", "2025-01-31", as_of="2025-01-01")
    names = run_medallion(spark, _people(spark, 0, 0, "'ne'"), "row_no", calendar, place, base)
    assert {t: spark.table(t).count() for n, t in names.items() if n not in ("dim_provider", "dim_date", "dim_plan")} == dict.fromkeys(
        (t for n, t in names.items() if n not in ("dim_provider", "dim_date", "dim_plan")), 0
    )
    continue_medallion(spark, place, base, None, _people(spark, 0, 5, "'ne'"), "row_no", "first")
    assert spark.table(names["silver"]).count() == 5


def test_json_batches_are_folders(spark, tmp_path):
    write_json_batches(spark.range(1, 11), f"{tmp_path}/b", 3, "id")
    assert sorted(f for f in os.listdir(f"{tmp_path}/b") if f.startswith("interval")) == ["interval=1", "interval=2", "interval=3"]
