"""Sources and sinks in round trips, and the streamed loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from ..constants import INSURANCE_SCHEMA, INTERVALS
from ..operators.checks import row_counts
from ..operators.staging import new_path
from ..plans.calendar import calendar_extended
from ..plans.dimensions import build_dim_provider
from ..plans.gold import star_provider_region
from ..plans.runs import Layout, continue_medallion, gold_tables, run_batch, run_mart, run_medallion
from ..sinks.files import write_csv, write_json_batches
from ..sinks.tables import append_table, ctas, load_mart, refresh_table, replace_table, write_table
from ..sources.files import extract_columns, read_csv, read_json_array, read_json_nested, read_path
from ..streaming.bronze import append_increment, ingest_bronze
from ..streaming.gold import refresh_gold
from ..streaming.silver import append_silver, enrich_silver, rebuild_silver, repair_silver
from .base import (
    INCREMENT_SQL,
    NUMBERED_SQL,
    RAW_SQL,
    SILVER_END,
    SILVER_SQL,
    SILVER_START,
    cents,
    insurance,
    layout,
    mean,
    query,
    table,
    total,
)
from .facts import CLAIMS_SQL, providers, silver_tables

# ---- files ----

_DOCUMENT_ROWS = 1000


def _documents(rows: DataFrame, key: str, path: str, field: str | None = None) -> None:
    """Write rows as JSON documents of up to `_DOCUMENT_ROWS` records, one file each: an array, or an object with one."""
    record = F.struct(*rows.columns)
    grouped = rows.groupBy((F.col(key) / _DOCUMENT_ROWS).cast("bigint").alias("document"))
    records = grouped.agg(F.collect_list(record).alias("records"))  # bounded: `key` is unique
    body = F.col("records") if field is None else F.struct(F.col("records").alias(field))
    records.select("document", F.to_json(body).alias("value")).write.partitionBy("document").text(path)


def _with_interval(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("interval", IntegerType())])


_RECORDS = "s_suppkey, s_name, s_nationkey"


@query("json_array", f"SELECT {_RECORDS} FROM supplier")
def json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "json-array")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    _documents(rows, "s_suppkey", path)
    return read_json_array(spark, path, rows.schema).select(*rows.columns)


@query("json_nested", f"SELECT {_RECORDS} FROM supplier")
def json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "json-nested")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    _documents(rows, "s_suppkey", path, "regions")
    return read_json_nested(spark, path, "regions", StructType([StructField("regions", ArrayType(rows.schema))]))


@query(
    "provider_from_documents",
    """SELECT region, preferred_provider, network_tier,
      row_number() OVER (ORDER BY region, preferred_provider, network_tier) AS provider_key
    FROM (SELECT CAST(s_nationkey AS VARCHAR) AS region, s_name AS preferred_provider,
      CASE WHEN s_acctbal < 5000 THEN 'Basic' ELSE 'Premium' END AS network_tier FROM supplier) AS rows""",
)
def provider_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provider dimension from JSON array documents, types inferred."""
    path = new_path(spark, "providers")
    rows = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.col("s_nationkey").cast("string").alias("region"),
        F.col("s_name").alias("preferred_provider"),
        F.when(F.col("s_acctbal") < 5000, "Basic").otherwise("Premium").alias("network_tier"),
    )
    _documents(rows, "s_suppkey", path)
    return build_dim_provider(read_json_array(spark, path).select("region", "preferred_provider", "network_tier"))


@query(
    "json_roundtrip",
    f"""SELECT o_orderkey, o_custkey, o_totalprice, CAST(least({INTERVALS},
      (row_number() OVER (ORDER BY o_orderkey) - 1) // greatest(1, (SELECT COUNT(*) FROM orders) // {INTERVALS}) + 1) AS INTEGER)
      AS interval FROM orders""",
)
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines in one folder per batch; the folder's number comes back as a column."""
    path = new_path(spark, "json-lines")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    write_json_batches(rows, path, INTERVALS, "o_orderkey")
    return spark.read.schema(_with_interval(rows.schema)).json(path)


@query(
    "csv_roundtrip",
    f"""WITH {RAW_SQL} SELECT CASE WHEN age = '' THEN NULL ELSE age END AS age, sex, bmi, children, smoker, region, charges
    FROM raw""",
)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed rows through CSV, all text; an empty text and a missing one are the same there."""
    path = new_path(spark, "csv")
    columns = [c.split()[0] for c in INSURANCE_SCHEMA.split(", ")]
    rows = insurance(spark, sf_dir).select(*columns)
    write_csv(rows.withColumn("age", F.when(F.col("age") != "", F.col("age"))), path)
    return read_csv(spark, path, INSURANCE_SCHEMA)


@query("csv_inferred", "SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_totalprice, o_orderstatus FROM orders")
def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "csv-inferred")
    write_csv(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), path)
    return read_csv(spark, path)


@query("extract_columns", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "extract")
    columns = ["s_suppkey", "s_name", "s_nationkey"]
    write_csv(extract_columns(table(spark, sf_dir, "supplier"), columns), path)
    return read_csv(spark, path, "s_suppkey bigint, s_name string, s_nationkey int")


@query("path_scan", "SELECT o_orderpriority, COUNT(*) AS n_rows FROM orders GROUP BY 1")
def path_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_path(spark, f"{sf_dir}/orders.parquet")
    return rows.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_rows"))


# ---- tables ----


@query("table_overwrite", "SELECT c_custkey, c_mktsegment FROM customer")
def table_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwriting a table replaces its rows and its columns."""
    place, _ = layout(spark, "overwrite")
    customer = table(spark, sf_dir, "customer")
    place.write(customer.select("c_custkey", "c_name"), "customer")
    return place.write(customer.select("c_custkey", "c_mktsegment"), "customer", overwrite_schema=True)


@query("table_self_overwrite", "SELECT c_custkey, c_acctbal * 2 AS c_acctbal FROM customer")
def table_self_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table overwritten by rows read from itself."""
    place, _ = layout(spark, "self")
    rows = place.write(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "customer")
    replace_table(rows.withColumn("c_acctbal", F.col("c_acctbal") * 2), place.table("customer"))
    return spark.table(place.table("customer"))


@query("append", "SELECT event_id, event_type FROM events")
def append(spark: SparkSession, sf_dir: str) -> DataFrame:
    place, _ = layout(spark, "append")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    place.write(events.where("event_type = 'click'"), "events")
    append_table(events.where("event_type <> 'click' OR event_type IS NULL"), place.table("events"))
    return spark.table(place.table("events"))


@query(
    "insert_overwrite",
    "SELECT o_orderstatus, COUNT(*) AS n_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price "
    "FROM orders GROUP BY 1",
)
def insert_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gold table refreshed in SQL: its earlier rows go."""
    place, _ = layout(spark, "refresh")
    name = place.table("gold")
    orders = place.write(table(spark, sf_dir, "orders"), "orders")
    old = orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total_price"))
    place.write(old, "gold")
    refresh_table(
        spark,
        name,
        "SELECT o_orderstatus, COUNT(*), CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) "
        f"FROM {place.table('orders')} GROUP BY o_orderstatus",
    )
    return spark.table(name)


@query("ctas", "SELECT p_brand, COUNT(*) AS n_parts FROM part GROUP BY 1")
def create_as(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created once from a query; asking again leaves the table as it is."""
    place, _ = layout(spark, "ctas")
    place.write(table(spark, sf_dir, "part"), "part")
    name, location = place.table("brands"), place.location("brands")
    ctas(spark, name, f"SELECT p_brand, COUNT(*) AS n_parts FROM {place.table('part')} GROUP BY p_brand", path=location)
    ctas(spark, name, "SELECT 'other' AS p_brand, CAST(0 AS BIGINT) AS n_parts", path=location)
    return spark.table(name)


@query(
    "load_mart",
    f"""WITH {CLAIMS_SQL} SELECT 'dim_date' AS table_name, CAST(365 AS BIGINT) AS n_rows
    UNION ALL SELECT 'dim_insured', COUNT(*) FROM dim_insured UNION ALL SELECT 'dim_region', COUNT(*) FROM dim_regions
    UNION ALL SELECT 'fact_claims', COUNT(*) FROM claims""",
)
def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claims mart end to end, then appended to a second set of tables and counted there."""
    place, _ = layout(spark, "mart")
    built = run_mart(insurance(spark, sf_dir), providers(spark, sf_dir), "row_no", place)
    names = {t: f"{place.prefix}loaded_{t}" for t in ("dim_date", "dim_insured", "dim_region", "fact_claims")}
    for t, name in names.items():
        write_table(built[t].limit(0), name, path=place.location(f"loaded_{t}"))
    load_mart({name: built[t] for t, name in names.items()})
    return row_counts({t: spark.table(name) for t, name in names.items()})


# ---- streams ----

_EVENT_COLUMNS = "event_id, user_id, event_type, value"


@query(
    "bronze_ingest",
    f"""SELECT {_EVENT_COLUMNS}, interval, CASE WHEN interval = 1 THEN 'stream-nested-0' ELSE
      'stream-intervals-' || CAST(interval - 2 AS VARCHAR) END AS load_id FROM (
      SELECT *, CAST(least({INTERVALS}, (row_number() OVER (ORDER BY event_id) - 1)
        // greatest(1, (SELECT COUNT(*) FROM events) // {INTERVALS}) + 1) AS INTEGER) AS interval FROM events) AS batched""",
)
def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three intervals arrive one after the other, each becomes a load; a run without new files adds nothing.

    The first comes from a source of its own, in a folder of a folder.
    """
    place, base = layout(spark, "bronze")
    columns = _EVENT_COLUMNS.split(", ")
    name, location = place.table("events"), place.location("events")
    rows = table(spark, sf_dir, "events").select(*columns)
    batches = new_path(spark, "intervals")
    write_json_batches(rows, batches, INTERVALS, "event_id")
    landed = spark.read.schema(_with_interval(rows.schema)).json(batches)

    def ingest(source: str) -> None:
        checkpoint = f"{base}/checkpoint/{source}"
        ingest_bronze(spark, f"{base}/input/{source}", name, checkpoint, rows.schema, location=location, source=source)

    for interval in range(1, INTERVALS + 1):
        source, folder = ("nested", "nested/a/b") if interval == 1 else ("intervals", "intervals")
        arrived = landed.where(F.col("interval") == interval)
        arrived.write.mode("append").partitionBy("interval").json(f"{base}/input/{folder}")
        ingest(source)
    ingest("nested")
    ingest("intervals")
    return spark.table(name).select(*columns, F.col("interval").cast("int").alias("interval"), "load_id")


def _medallion(spark: SparkSession, sf_dir: str, increment: str | None) -> tuple[dict[str, str], Layout, str]:
    place, base = layout(spark, "medallion")
    calendar = calendar_extended(spark, SILVER_START, SILVER_END, as_of=SILVER_END, end_inclusive=True)
    return run_medallion(spark, insurance(spark, sf_dir), "row_no", calendar, place, base, increment), place, base


def _dims(spark: SparkSession, names: dict[str, str]) -> dict[str, DataFrame]:
    return {d: spark.table(names[f"dim_{d}"]) for d in ("member", "provider", "date", "plan")}


@query("silver_stream", f"WITH {SILVER_SQL} SELECT * FROM silver")
def silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, _, _ = _medallion(spark, sf_dir, None)
    return spark.table(names["silver"]).drop("fact_key", "load_id")


@query("silver_append", f"WITH {SILVER_SQL} SELECT * FROM silver")
def silver_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream-static joins, appended as they come."""
    names, place, base = _medallion(spark, sf_dir, None)
    target, location = place.table("silver_appended"), place.location("silver_appended")
    append_silver(spark, names["bronze"], _dims(spark, names), target, f"{base}/checkpoints/appended", location)
    return spark.table(target).drop("fact_key", "load_id")


@query("silver_rebuild", f"WITH {INCREMENT_SQL} SELECT * FROM silver")
def silver_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, place, _ = _medallion(spark, sf_dir, "increment-1")
    location = place.location("fact_insurance_silver")
    rebuild_silver(spark, names["bronze"], _dims(spark, names), names["silver"], location)
    return spark.table(names["silver"]).drop("fact_key", "load_id")


@query(
    "increment",
    f"""WITH {INCREMENT_SQL} SELECT *, CASE WHEN event_id LIKE 'INC%' THEN 'increment-1' ELSE 'stream' END AS load_kind
    FROM (SELECT event_id, member_id, plan_key, provider_code, event_date, charge_amount FROM bronze) AS b""",
)
def increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An increment applied twice counts once."""
    names, _, _ = _medallion(spark, sf_dir, "increment-1")
    append_increment(spark, names["bronze"], "increment-1")
    kind = F.when(F.col("load_id").startswith("stream-"), "stream").otherwise(F.col("load_id"))
    return spark.table(names["bronze"]).select(
        "event_id",
        "member_id",
        "plan_key",
        "provider_code",
        F.to_date("event_date").alias("event_date"),
        "charge_amount",
        kind.alias("load_kind"),
    )


@query(
    "gold_refresh",
    f"""WITH {INCREMENT_SQL} SELECT preferred_provider, network_tier, strftime(event_date, '%Y-%m') AS event_month,
      COUNT(*) AS num_events, {total("charge_amount")} AS total_charges, {mean("charge_amount")} AS avg_charges
    FROM silver GROUP BY 1, 2, 3""",
)
def gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after an increment, refreshed load by load."""
    names, _, _ = _medallion(spark, sf_dir, "increment-1")
    return spark.table(names["gold_provider_month"])


@query(
    "gold_refresh_region",
    f"""WITH {INCREMENT_SQL} SELECT r.region AS region_name, smoker, COUNT(*) AS num_events,
      {total("charge_amount")} AS total_charges, {mean("charge_amount")} AS avg_charges
    FROM silver s LEFT JOIN dim_region r ON s.region_key = r.region_key GROUP BY 1, 2""",
)
def gold_refresh_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After an increment and a rebuild of silver, gold from all of silver takes the place of gold by load."""
    names, place, _ = _medallion(spark, sf_dir, "increment-1")
    rebuild_silver(spark, names["bronze"], _dims(spark, names), names["silver"], place.location("fact_insurance_silver"))
    region = spark.table(names["dim_region"]).withColumnRenamed("region", "region_name")
    refresh_gold(spark, names["silver"], region, gold_tables(place))
    return spark.table(names["gold_region_smoker"])


@query(
    "gold_refresh_after_rebuild",
    f"""WITH {INCREMENT_SQL} SELECT r.region AS region_name, 'changed' AS smoker, COUNT(*) AS num_events,
      {total("charge_amount")} AS total_charges, {mean("charge_amount")} AS avg_charges
    FROM silver s LEFT JOIN dim_region r ON s.region_key = r.region_key GROUP BY 1""",
)
def gold_refresh_after_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members change, silver is rebuilt, and gold by load follows."""
    names, place, _ = _medallion(spark, sf_dir, "increment-1")
    dims = _dims(spark, names)
    dims["member"] = dims["member"].withColumn("smoker", F.lit("changed"))
    gold = gold_tables(place)
    rebuild_silver(spark, names["bronze"], dims, names["silver"], place.location("fact_insurance_silver"), gold)
    region = spark.table(names["dim_region"]).withColumnRenamed("region", "region_name")
    refresh_gold(spark, names["silver"], region, gold, by_load=True)
    return spark.table(names["gold_region_smoker"])


@query(
    "medallion_two_runs",
    f"""WITH {INCREMENT_SQL} SELECT preferred_provider, network_tier, strftime(event_date, '%Y-%m') AS event_month,
      COUNT(*) AS num_events, {total("charge_amount")} AS total_charges, {mean("charge_amount")} AS avg_charges
    FROM silver GROUP BY 1, 2, 3""",
)
def medallion_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run without an increment, and a second one that goes on from it and adds one; a third has nothing to do."""
    _, place, base = _medallion(spark, sf_dir, None)
    continue_medallion(spark, place, base, "increment-1")
    return spark.table(continue_medallion(spark, place, base)["gold_provider_month"])


@query("silver_repair", f"WITH {SILVER_SQL} SELECT * FROM silver")
def silver_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver enriched while the later half of the members and a provider were missing, then only the loads that were hit again."""
    names, place, base = _medallion(spark, sf_dir, None)
    dims, target, location = _dims(spark, names), place.table("silver_repaired"), place.location("silver_repaired")
    last = dims["member"].agg(F.max("member_id")).first()[0] or 0
    early = {**dims, "member": dims["member"].where(F.col("member_id") <= last // 2), "provider": dims["provider"].where("provider_key > 1")}
    enrich_silver(spark, names["bronze"], early, target, f"{base}/checkpoints/repaired", location)
    repair_silver(spark, names["bronze"], dims, target, location)
    return spark.table(target).drop("fact_key", "load_id")


@query(
    "members_two_runs",
    f"WITH {SILVER_SQL} SELECT event_id, member_id, provider_code, event_date, charge_amount, sex, smoker, region FROM silver",
)
def members_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run on the first half of the insurance rows, and a second that takes in the rest as new members: the events of one run on all."""
    rows, (place, base) = insurance(spark, sf_dir), layout(spark, "two_runs")
    half = (rows.agg(F.max("row_no")).first()[0] or 0) // 2
    calendar = calendar_extended(spark, SILVER_START, SILVER_END, as_of=SILVER_END, end_inclusive=True)
    run_medallion(spark, rows.where(F.col("row_no") <= half), "row_no", calendar, place, base, None)
    rest = rows.where(F.col("row_no") > half)
    names = continue_medallion(spark, place, base, None, rest, "row_no", "second")
    columns = ["event_id", "member_id", "provider_code", "event_date", "charge_amount", "sex", "smoker", "region"]
    return spark.table(names["silver"]).select(*columns)


@query(
    "event_rejects",
    """SELECT event_id % 7 = 0 AS broken, COUNT(*) AS n_rows, MIN(event_id) AS first_event, MAX(event_id) AS last_event
    FROM events GROUP BY 1""",
)
def event_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event files with lines that break off: bronze takes the others, the reject table the broken lines with their file."""
    place, base = layout(spark, "rejects")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    line = F.to_json(F.struct(*rows.columns))
    broken = F.concat(F.lit('{"event_id":'), F.col("event_id"), F.lit(',"user_id":'))
    lines = rows.select(F.when(F.col("event_id") % 7 == 0, broken).otherwise(line).alias("value"))
    lines.write.text(f"{base}/input")
    bronze_name, rejects = place.table("events"), place.table("rejects")
    ingest_bronze(
        spark, f"{base}/input", bronze_name, f"{base}/checkpoint", rows.schema, location=place.location("events"), rejects=rejects
    )
    read = spark.table(bronze_name).select("event_id", F.lit(False).alias("broken"))
    number = F.regexp_extract("record", r'"event_id":(\d+)', 1).cast("bigint")
    left = spark.table(rejects).where("reason = 'malformed' AND source_file IS NOT NULL")
    both = read.unionByName(left.select(number.alias("event_id"), F.lit(True).alias("broken")))
    return both.groupBy("broken").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event")
    )


@query(
    "star_violations",
    """SELECT 'orders' AS table_name, COUNT(*) AS n_broken FROM orders WHERE o_orderkey IS NOT NULL
    GROUP BY o_orderkey HAVING COUNT(*) > 1""",
)
def star_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared keys that a batch run and a mart run break: none."""
    place, _ = layout(spark, "checked")
    rows = insurance(spark, sf_dir)
    batch = run_batch(spark, rows, "row_no", place)["violations"]
    place, _ = layout(spark, "checked")
    mart = run_mart(rows, providers(spark, sf_dir), "row_no", place)["violations"]
    broken = batch.unionByName(mart).where("n_rows > 0")
    return broken.groupBy("table_name").agg(F.sum("n_rows").alias("n_broken"))


@query(
    "medallion",
    f"""WITH {INCREMENT_SQL} SELECT p.preferred_provider, p.network_tier, r.region AS region_name, COUNT(*) AS num_events,
      {cents(total("charge_amount"))} AS total_charges, {cents(mean("charge_amount"))} AS avg_charges
    FROM silver s JOIN dim_provider p ON s.provider_code = p.provider_code JOIN dim_region r ON s.region_key = r.region_key
    GROUP BY 1, 2, 3""",
)
def medallion(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, place, _ = _medallion(spark, sf_dir, "increment-1")
    region = spark.table(names["dim_region"]).withColumnRenamed("region", "region_name")
    return star_provider_region(spark.table(names["silver"]), spark.table(names["dim_provider"]), region, place.scale)


@query(
    "batch_star",
    f"""WITH {NUMBERED_SQL}
    SELECT strftime(DATE '2019-01-01' + CAST(member_id % 1461 AS INTEGER), '%Y-%m') AS event_month, COUNT(*) AS num_events,
      {cents(total("charges"))} AS total_charges, {cents(mean("charges"))} AS avg_charges FROM numbered GROUP BY 1""",
)
def batch_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    place, _ = layout(spark, "batch")
    return run_batch(spark, insurance(spark, sf_dir), "row_no", place)["gold_month"]


@query(
    "silver_equals_batch",
    f"WITH {SILVER_SQL} SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM silver",
)
def silver_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the streamed silver that the batch build does not have, and the other way round."""
    names, _, _ = _medallion(spark, sf_dir, None)
    streamed = spark.table(names["silver"]).drop("load_id")
    built = silver_tables(spark, sf_dir)[0]
    sided = streamed.withColumn("__side", F.lit(1)).unionByName(built.withColumn("__side", F.lit(-1)))
    per_row = sided.groupBy(*built.columns).agg(F.sum("__side").alias("d"), F.count(F.when(F.col("__side") == 1, 1)).alias("n"))
    return per_row.agg(F.sum("n").alias("n_rows"), F.sum(F.abs("d")).alias("n_different"))
