"""Ingestion and sinks: the given tables are written as files in the shared work folder and loaded back."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.catalog import query
from tierflow.catalog.sqltext import r
from tierflow.functions.columns import money, rounded, parse_variant
from tierflow.session import work_path
from tierflow.sources import landing
from tierflow.streaming import feeds


def events_as_json(t, by=None):
    """The events table as JSON line files, one folder per event type if asked."""
    path = work_path(t.spark, "events-json")
    rows = t.events.withColumn("ts", F.col("ts").cast("string"))
    writer = rows.write.partitionBy(by) if by else rows.write
    writer.json(path)
    return path


@query("s1_land_json", "SELECT 'events' AS source_system, count(*) AS records, count(DISTINCT event_id) AS ids FROM events")
def s1(t):
    raw = landing.land_raw(t.spark, events_as_json(t), "events")
    return raw.groupBy("source_system").agg(F.count("*").alias("records"), F.countDistinct("raw_id").alias("ids"))


@query(
    "s2_json_array_documents",
    """SELECT p_partkey, pos, name, value FROM (
      SELECT p_partkey, 0 AS pos, 'size' AS name, CAST(p_size AS DOUBLE) AS value FROM part
      UNION ALL SELECT p_partkey, 1, 'price', p_retailprice FROM part)""",
)
def s2(t):
    def entry(name, value):
        return F.struct(F.lit(name).alias("name"), F.col(value).cast("double").alias("value"))

    docs = t.part.select("p_partkey", F.to_json(F.array(entry("size", "p_size"), entry("price", "p_retailprice"))).alias("doc"))
    return landing.explode_array_document(docs, "doc", {"name": "string", "value": "double"})


@query("s3_csv_load", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority FROM orders")
def s3(t):
    path = work_path(t.spark, "orders-csv")
    rows = t.orders.withColumn("o_orderdate", F.date_format("o_orderdate", "dd.MM.yyyy"))
    rows.write.option("header", "true").option("quoteAll", "true").csv(path)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"
    return landing.read_csv(t.spark, path, schema, "part-*", "5-LOW", dateFormat="dd.MM.yyyy", quote='"')


@query("s4_load_with_transform", "SELECT event_id, ts, upper(event_type) AS event_type, CAST(value AS DOUBLE) AS value FROM events")
def s4(t):
    schema = "event_id bigint, ts string, event_type string, value double"
    loaded = t.spark.read.schema(schema).json(events_as_json(t))
    return loaded.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.upper("event_type").alias("event_type"), "value")


ORDER_SCHEMA = "o_orderkey bigint, o_totalprice double"


def orders_with_bad_rows(t):
    """Orders as JSON lines by priority; in the urgent folder every tenth key carries a text for its price."""
    path = work_path(t.spark, "orders-json")
    broken = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderkey") % 10 == 0)
    price = F.when(broken, F.lit('"n/a"')).otherwise(F.col("o_totalprice").cast("string"))
    line = F.format_string('{"o_orderkey":%d,"o_totalprice":%s}', F.col("o_orderkey"), price)
    t.orders.select(line.alias("value"), "o_orderpriority").write.partitionBy("o_orderpriority").text(path)
    return path


@query(
    "s5_bad_record_policies",
    """SELECT 'CONTINUE' AS policy, count(*) FILTER (WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderkey % 10 = 0)) AS loaded FROM orders
    UNION ALL SELECT 'SKIP_FILE', count(*) FILTER (WHERE o_orderpriority <> '1-URGENT') FROM orders
    UNION ALL SELECT 'ABORT', 0""",
)
def s5(t):
    path = orders_with_bad_rows(t)

    def loaded(policy):
        rows = landing.load_with_policy(t.spark, path, ORDER_SCHEMA, policy)
        return rows.agg(F.count("o_orderkey").alias("loaded")).select(F.lit(policy).alias("policy"), "loaded")

    try:
        loaded("ABORT").first()
        aborted = loaded("ABORT")
    except PySparkException as stopped:
        if "MALFORMED_RECORD" not in str(stopped):
            raise
        # The load stops at the first bad row, so nothing arrives.
        aborted = t.spark.range(1).select(F.lit("ABORT").alias("policy"), F.lit(0).cast("bigint").alias("loaded"))
    return loaded("CONTINUE").unionByName(loaded("SKIP_FILE")).unionByName(aborted)


@query(
    "s6_validate_without_loading",
    "SELECT '{\"o_orderkey\":' || o_orderkey || ',\"o_totalprice\":\"n/a\"}' AS bad_row FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 10 = 0",
)
def s6(t):
    return landing.bad_rows(t.spark, orders_with_bad_rows(t), ORDER_SCHEMA).select("bad_row")


EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(t):
    return feeds.file_stream(t.spark, t.folder, EVENT_SCHEMA, pattern="events.parquet")


@query("s7_continuous_load", f"SELECT event_type, count(*) AS events, {r('sum(CAST(value AS DECIMAL(15,2)))', 2)} AS total FROM events GROUP BY 1")
def s7(t):
    target = work_path(t.spark, "events-stream")
    feeds.ingest(event_stream(t), target, work_path(t.spark, "checkpoint")).awaitTermination()
    loaded = t.spark.read.schema(EVENT_SCHEMA).parquet(target)
    return loaded.groupBy("event_type").agg(F.count("*").alias("events"), rounded(F.sum(money("value")), 2).alias("total"))


@query("s8_exactly_once_append", "SELECT count(*) AS rows, count(DISTINCT event_id) AS ids FROM events")
def s8(t):
    target, checkpoint = work_path(t.spark, "once"), work_path(t.spark, "checkpoint")
    for _ in range(2):  # the second run finds no unread file
        feeds.append_once(event_stream(t), target, checkpoint).awaitTermination()
    return t.spark.read.parquet(target).agg(F.count("*").alias("rows"), F.countDistinct("event_id").alias("ids"))


@query(
    "s9_batch_append_and_refresh",
    "SELECT (SELECT count(*) FROM events) AS events, (SELECT count(*) FROM orders) AS orders, (SELECT count(DISTINCT user_id) FROM events) AS users",
)
def s9(t):
    events_path, orders_path = work_path(t.spark, "events"), work_path(t.spark, "orders")
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")

    def refresh():
        events, orders = t.spark.read.parquet(events_path), t.spark.read.parquet(orders_path)
        return events.agg(F.count("*").alias("events"), F.countDistinct("user_id").alias("users")).select(
            "events", orders.agg(F.count("*").alias("n")).scalar().alias("orders"), "users"
        )

    landing.load_batch({"events": (t.events.where(early), events_path), "orders": (t.orders, orders_path)}, refresh)
    return landing.load_batch({"events": (t.events.where(~early), events_path)}, refresh)


@query(
    "s10_materializations",
    " UNION ALL ".join(f"SELECT '{kind}' AS kind, o_orderstatus, count(*) AS n FROM orders GROUP BY 2" for kind in ("table", "view", "ephemeral")),
)
def s10(t):
    base = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    made = {
        "table": landing.materialize(base, "status_table", "table", work_path(t.spark, "status")),
        "view": landing.materialize(base, "status_view", "view"),
        "ephemeral": landing.materialize(base, "status_plain", "ephemeral"),
    }
    return reduce(DataFrame.unionByName, [rows.select(F.lit(kind).alias("kind"), "*") for kind, rows in made.items()])


@query("s11_truncate_and_load", "SELECT count(*) AS rows, min(o_orderdate) AS first_day FROM orders WHERE o_orderstatus = 'O'")
def s11(t):
    path = work_path(t.spark, "reload")
    landing.truncate_and_load(t.orders, path)
    landing.truncate_and_load(t.orders.where(F.col("o_orderstatus") == "O"), path)
    return t.spark.read.parquet(path).agg(F.count("*").alias("rows"), F.min("o_orderdate").alias("first_day"))


@query(
    "s12_compaction",
    f"""SELECT count(*) AS rows, {r('sum(CAST(l_extendedprice AS DECIMAL(15,2)))', 2)} AS total FROM lineitem""",
)
def s12(t):
    small, large = work_path(t.spark, "small"), work_path(t.spark, "large")
    t.lineitem.repartition(24).write.parquet(small)
    landing.compact(t.spark, small, large)
    before = landing.file_sizes(t.spark.read.parquet(small)).agg(F.count("*").alias("n")).scalar()
    after = landing.file_sizes(t.spark.read.parquet(large)).agg(F.count("*").alias("n")).scalar()
    totals = t.spark.read.parquet(large).agg(F.count("*").alias("rows"), rounded(F.sum(money("l_extendedprice")), 2).alias("total"))
    return totals.where(after < before)  # no row where compaction left as many files


@query(
    "s13_load_audit",
    f"""SELECT CAST(o_orderdate AS DATE) AS load_date, count(*) AS num_loads, count(*) FILTER (WHERE o_orderstatus <> 'P') AS successful,
    count(*) FILTER (WHERE o_orderstatus = 'P') AS failed, CAST(sum(1 + o_orderkey % 4) AS BIGINT) AS total_files,
    CAST(sum(o_custkey) AS BIGINT) AS total_rows, {r('sum(o_custkey * 1000) / 1073741824.0', 6)} AS total_gb,
    {r('avg(o_custkey * 1000 / CAST(1 + o_orderkey % 4 AS DOUBLE))', 2)} AS avg_file_size_bytes FROM orders GROUP BY 1""",
)
def s13(t):
    # Orders stand for loads: status, a file count, a row count and bytes follow from their columns.
    loads = t.orders.select(
        F.col("o_orderdate").alias("at"),
        F.when(F.col("o_orderstatus") == "P", "LOAD_FAILED").otherwise("LOADED").alias("status"),
        (1 + F.col("o_orderkey") % 4).alias("files"),
        F.col("o_custkey").alias("row_count"),
        (F.col("o_custkey") * 1000).alias("bytes"),
    )
    audit = landing.load_audit(loads, "at")
    return audit.withColumns({"total_gb": rounded("total_gb", 6), "avg_file_size_bytes": rounded("avg_file_size_bytes", 2)})


@query(
    "s14_schema_evolution",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN o_orderstatus ELSE o_orderstatus || '-v2' END AS order_status FROM orders""",
)
def s14(t):
    cut = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    old = t.orders.where(cut).select("o_orderkey", "o_orderstatus")
    new = t.orders.where(~cut).select("o_orderkey", "o_orderstatus", F.concat("o_orderstatus", F.lit("-v2")).alias("order_status"))
    return landing.evolve(old, new, {"order_status": F.col("o_orderstatus")})


@query(
    "s1_land_and_parse",
    "SELECT event_id, user_id, event_type, value, ts FROM events",
)
def s1_parse(t):
    raw = landing.land_raw(t.spark, events_as_json(t), "events")
    fields = {"event_id": "bigint", "user_id": "bigint", "event_type": "string", "value": "double", "ts": "timestamp_ntz"}
    return parse_variant(raw, "raw_data", fields)
