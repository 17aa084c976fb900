"""Incremental, historical and streaming operators on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.catalog import query
from tierflow.catalog.ingest import EVENT_SCHEMA, event_stream
from tierflow.catalog.sqltext import r
from tierflow.functions.columns import hour_of, money, rounded
from tierflow.operators import history, intervals, merging
from tierflow.operators.sessions import sessionize
from tierflow.plans import domain, layers
from tierflow.plans.refresh import refresh
from tierflow.session import work_path
from tierflow.sources import landing
from tierflow.sources.versions import VersionedTable
from tierflow.streaming import feeds


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


MID = "2024-01-15"
CUT = "1998-01-01"


def ids(frame):
    return frame.agg(F.count("*").alias("rows"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query(
    "st1_change_capture",
    f"SELECT count(*) AS rows, min(event_id) AS first_id, max(event_id) AS last_id FROM events WHERE ts >= TIMESTAMP '{MID}'",
)
def st1(t):
    # The stream starts after the first load, so only what arrives later is a change.
    folder, target, checkpoint = (work_path(t.spark, n) for n in ("raw", "changes", "checkpoint"))
    landing.append(t.events.where(F.col("ts") < ntz(MID)), folder)
    feeds.skip_existing(feeds.file_stream(t.spark, folder, EVENT_SCHEMA), checkpoint).awaitTermination()
    landing.append(t.events.where(F.col("ts") >= ntz(MID)), folder)
    feeds.append_once(feeds.file_stream(t.spark, folder, EVENT_SCHEMA), target, checkpoint).awaitTermination()
    return ids(t.spark.read.schema(EVENT_SCHEMA).option("recursiveFileLookup", "true").parquet(target))


@query(
    "st2_has_unread_data",
    f"SELECT count(*) > 0 AS has_unread, count(*) AS unread_rows FROM events WHERE ts >= TIMESTAMP '{MID}'",
)
def st2(t):
    folder, log = work_path(t.spark, "raw"), work_path(t.spark, "log")
    landing.append(t.events.where(F.col("ts") < ntz(MID)), folder)
    rows = t.spark.read.schema(EVENT_SCHEMA).parquet(folder)
    landing.append(landing.file_sizes(rows), log)
    landing.append(t.events.where(F.col("ts") >= ntz(MID)), folder)
    rows = t.spark.read.schema(EVENT_SCHEMA).parquet(folder)
    unread = feeds.unread_files(rows, t.spark.read.parquet(log))
    fresh = rows.withColumn("file", F.col("_metadata.file_path")).join(unread, "file", "left_semi")
    return fresh.agg((F.count("*") > 0).alias("has_unread"), F.count("*").alias("unread_rows"))


@query(
    "st3_conditional_fan_out",
    """SELECT CASE WHEN user_id % 3 = 0 THEN 'verified' ELSE 'guest' END AS route, count(*) AS rows, min(event_id) AS first_id,
    max(event_id) AS last_id FROM events GROUP BY 1""",
)
def st3(t):
    target, checkpoint = work_path(t.spark, "routed"), work_path(t.spark, "checkpoint")

    def split(batch):
        label = F.when(F.col("user_id") % 3 == 0, "VERIFIED").otherwise("GUEST")
        verified, guest = layers.route(batch.select("*", label.alias("account_type"), *layers.empty_identity()))
        return {"verified": verified, "guest": guest}

    for _ in range(2):  # the second run reads nothing
        feeds.fan_out(event_stream(t), split, target, checkpoint).awaitTermination()

    def side(name):
        rows = t.spark.read.parquet(f"{target}/{name}")
        return ids(rows).select(F.lit(name).alias("route"), "*")

    return side("verified").unionByName(side("guest"))


@query(
    "st4_high_water_increment",
    """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F'
    AND o_orderdate < TIMESTAMP '1998-01-01')""",
)
def st4(t):
    loaded = t.orders.where((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < ntz(CUT)))
    return merging.high_water(t.orders, loaded, "o_orderdate").select("o_orderkey", "o_orderdate")


HALF = "(SELECT max(p_partkey) // 2 FROM part)"


@query(
    "st5_upsert_partial_columns",
    f"""WITH tgt AS (SELECT * FROM titles_raw WHERE version <= {HALF} QUALIFY row_number() OVER (PARTITION BY title_id ORDER BY version DESC) = 1),
    src AS (SELECT * FROM titles_raw WHERE version > {HALF} QUALIFY row_number() OVER (PARTITION BY title_id ORDER BY version DESC) = 1)
    SELECT coalesce(t.title_id, s.title_id) AS title_id, CASE WHEN s.title_id IS NOT NULL THEN s.title_name ELSE t.title_name END AS title_name,
    CASE WHEN s.title_id IS NOT NULL THEN s.imdb_score ELSE t.imdb_score END AS imdb_score,
    CASE WHEN t.title_id IS NOT NULL THEN t.rating ELSE s.rating END AS rating,
    CASE WHEN t.title_id IS NOT NULL THEN t.production_status ELSE s.production_status END AS production_status
    FROM tgt t FULL JOIN src s ON t.title_id = s.title_id""",
)
def st5(t):
    raw = domain.titles_raw(t).select("title_id", "title_name", "imdb_score", "rating", "production_status", "version")
    half = raw.agg(F.floor(F.max("version") / 2).alias("h")).scalar()
    target = history.overwrite_latest(raw.where(F.col("version") <= half), ["title_id"], ["version"])
    merged = merging.upsert(
        target, raw.where(F.col("version") > half), ["title_id"], ["version"], ["title_name", "imdb_score", "version"]
    )
    return merged.drop("version")


BOX_ORDER = "ingestion_ts DESC, gross_usd DESC, title_id DESC, report_date DESC, theater_id DESC, tickets_sold DESC"
BOX_PICK = f"QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY {BOX_ORDER}) = 1"


@query(
    "st6_upsert_records",
    f"""WITH tgt AS (SELECT * FROM box WHERE ingestion_ts < TIMESTAMP '{CUT}' {BOX_PICK}),
    src AS (SELECT * FROM box WHERE ingestion_ts >= TIMESTAMP '{CUT}' {BOX_PICK})
    SELECT coalesce(t.record_id, s.record_id) AS record_id, coalesce(s.title_id, t.title_id) AS title_id,
    coalesce(s.report_date, t.report_date) AS report_date, coalesce(s.tickets_sold, t.tickets_sold) AS tickets_sold,
    {r('coalesce(s.gross_usd, t.gross_usd)', 4)} AS gross_usd, coalesce(t.theater_id, s.theater_id) AS theater_id
    FROM tgt t FULL JOIN src s ON t.record_id = s.record_id""",
)
def st6(t):
    box = domain.box_office(t).select(
        "record_id", "title_id", "report_date", "tickets_sold", "gross_usd", "ingestion_ts", "theater_id"
    )
    order = ["ingestion_ts", "gross_usd", "title_id", "report_date", "theater_id", "tickets_sold"]
    target = history.overwrite_latest(box.where(F.col("ingestion_ts") < ntz(CUT)), ["record_id"], order)
    changing = ["title_id", "report_date", "tickets_sold", "gross_usd", "ingestion_ts"]
    merged = merging.upsert(target, box.where(F.col("ingestion_ts") >= ntz(CUT)), ["record_id"], order, changing)
    return merged.drop("ingestion_ts").withColumn("gross_usd", rounded("gross_usd", 4))


@query(
    "st6_upsert_touched_partitions",
    f"""SELECT year(o_orderdate) AS year, count(*) AS orders, {r("sum(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '2000-01-01' THEN 0 ELSE CAST(o_totalprice AS DECIMAL(15,2)) END)", 2)} AS total FROM orders GROUP BY 1""",
)
def st6_touched(t):
    path = work_path(t.spark, "orders-by-year")
    rows = t.orders.select("o_orderkey", money("o_totalprice").alias("price"), F.year("o_orderdate").alias("year"))
    merging.replace_partitions(rows, path, ["year"])
    waived = t.orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") >= ntz("2000-01-01")))
    waived = waived.select("o_orderkey", F.lit(0).cast("decimal(15,2)").alias("price"), F.year("o_orderdate").alias("year"))
    merging.upsert_touched_partitions(t.spark, path, waived, ["o_orderkey", "year"], ["price"], ["year"])
    return t.spark.read.parquet(path).groupBy(F.col("year").cast("bigint").alias("year")).agg(
        F.count("*").alias("orders"), rounded(F.sum("price"), 2).alias("total")
    )


@query(
    "st7_apply_changes",
    """WITH f AS (SELECT o_custkey, o_totalprice, CASE o_orderstatus WHEN 'F' THEN 'DELETE' WHEN 'P' THEN 'UPDATE' ELSE 'INSERT' END AS a FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT c_custkey AS custkey, coalesce(o_totalprice, c_acctbal) AS amount FROM customer LEFT JOIN f ON c_custkey = o_custkey
    WHERE a IS NULL OR a <> 'DELETE'""",
)
def st7(t):
    target = t.customer.select(F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("amount"))
    action = F.when(F.col("o_orderstatus") == "F", "DELETE").when(F.col("o_orderstatus") == "P", "UPDATE").otherwise("INSERT")
    feed = t.orders.select(
        F.col("o_custkey").alias("custkey"), F.col("o_totalprice").alias("amount"), "o_orderdate", "o_orderkey", action.alias("_action")
    )
    return merging.apply_changes(target, feed, ["custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "st8_lookback_merge",
    f"""WITH tgt AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS total FROM orders
      WHERE o_orderdate < TIMESTAMP '{CUT}' AND o_orderstatus <> 'P' GROUP BY 1),
    src AS (SELECT CAST(o_orderdate AS DATE) AS day, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS total FROM orders GROUP BY 1)
    SELECT coalesce(s.day, t.day) AS day, {r('coalesce(s.total, t.total)', 2)} AS total FROM tgt t
    FULL JOIN (SELECT * FROM src WHERE day >= (SELECT max(day) FROM tgt) - 7) s ON s.day = t.day""",
)
def st8(t):
    def daily(frame):
        return frame.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.sum(money("o_totalprice")).alias("total"))

    stored = daily(t.orders.where((F.col("o_orderdate") < ntz(CUT)) & (F.col("o_orderstatus") != "P")))
    return merging.lookback_merge(stored, daily(t.orders), ["day"], "day").withColumn("total", rounded("total", 2))


def order_states(t, until):
    rows = t.orders.where(F.col("o_orderdate") < ntz(until)) if until else t.orders
    return history.overwrite_latest(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderstatus", "o_orderpriority"
    )


STATE_SQL = """SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders {w}
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""


@query(
    "st9_change_feed",
    f"""WITH v1 AS ({STATE_SQL.format(w="WHERE o_orderdate < TIMESTAMP '1996-01-01'")}),
    v2 AS (SELECT * FROM ({STATE_SQL.format(w='')}) WHERE o_orderstatus <> 'F')
    SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(b.o_orderstatus, a.o_orderstatus) AS o_orderstatus,
    coalesce(b.o_orderpriority, a.o_orderpriority) AS o_orderpriority,
    CASE WHEN a.o_custkey IS NULL THEN 'INSERT' WHEN b.o_custkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS _action
    FROM v1 a FULL JOIN v2 b ON a.o_custkey = b.o_custkey
    WHERE a.o_custkey IS NULL OR b.o_custkey IS NULL OR a.o_orderstatus <> b.o_orderstatus OR a.o_orderpriority <> b.o_orderpriority""",
)
def st9(t):
    new = order_states(t, None).where(F.col("o_orderstatus") != "F")
    return merging.change_feed(order_states(t, "1996-01-01"), new, ["o_custkey"])


@query(
    "st10_replace_partitions",
    f"""SELECT year(o_orderdate) AS year, count(*) AS orders, {r("sum(CASE WHEN year(o_orderdate) = 1998 THEN 2 ELSE 1 END * CAST(o_totalprice AS DECIMAL(15,2)))", 2)} AS total
    FROM orders GROUP BY 1""",
)
def st10(t):
    path = work_path(t.spark, "by-year")
    rows = t.orders.select("o_orderkey", money("o_totalprice").alias("price"), F.year("o_orderdate").alias("year"))
    merging.replace_partitions(rows, path, ["year"])
    corrected = rows.where(F.col("year") == 1998).withColumn("price", (F.col("price") * 2).cast("decimal(15,2)"))
    for _ in range(2):  # repeating the load changes nothing
        merging.replace_partitions(corrected, path, ["year"])
    return t.spark.read.parquet(path).groupBy(F.col("year").cast("bigint").alias("year")).agg(
        F.count("*").alias("orders"), rounded(F.sum("price"), 2).alias("total")
    )


KINDS = {"events": "count", "total": "sum", "low": "min", "high": "max"}


def event_totals(frame):
    return frame.groupBy("event_type").agg(
        F.count("*").alias("events"), F.sum(money("value")).alias("total"), F.min("value").alias("low"), F.max("value").alias("high")
    )


@query(
    "st11_additive_maintenance",
    f"""SELECT event_type, count(*) AS events, {r('sum(CAST(value AS DECIMAL(15,2)))', 2)} AS total, min(value) AS low, max(value) AS high FROM events GROUP BY 1""",
)
def st11(t):
    stored = event_totals(t.events.where(F.col("ts") < ntz(MID)))
    delta = event_totals(t.events.where(F.col("ts") >= ntz(MID)))
    return merging.add_increment(stored, delta, ["event_type"], KINDS).withColumn("total", rounded("total", 2))


@query(
    "st12_refresh_in_order",
    f"""SELECT franchise, genre, title_count, total_tickets, {r('total_gross_usd', 2)} AS total_gross_usd, total_streams FROM agg_franchise""",
)
def st12(t):
    tables = refresh(t, work_path(t.spark, "layers"))
    return tables["agg_franchise"].select(
        "franchise", "genre", "title_count", "total_tickets", rounded("total_gross_usd", 2).alias("total_gross_usd"), "total_streams"
    )


@query(
    "st13_incremental_or_full",
    """SELECT user_id, count(*) AS events, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1""",
)
def st13(t):
    # Counts are maintained from the stored half; distinct counts are not additive and are rebuilt in full.
    def counts(frame):
        return frame.groupBy("user_id").agg(F.count("*").alias("events"))

    early = F.col("ts") < ntz(MID)
    kept = merging.add_increment(counts(t.events.where(early)), counts(t.events.where(~early)), ["user_id"], {"events": "count"})
    if merging.can_maintain({"kinds": "count_distinct"}):
        raise AssertionError("distinct counts must be rebuilt")
    full = t.events.groupBy("user_id").agg(F.countDistinct("event_type").alias("kinds"))
    return kept.join(full, "user_id")


@query(
    "st14_freshness",
    f"""WITH f AS (SELECT 'orders' AS source, max(o_orderdate) AS last_refresh FROM orders UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem
      UNION ALL SELECT 'events', max(ts) FROM events)
    SELECT source, last_refresh, {r('(epoch_us((SELECT max(last_refresh) FROM f)) - epoch_us(last_refresh)) / 60000000.0', 3)} AS lag_minutes FROM f""",
)
def st14(t):
    sources = {
        "orders": t.orders.select(F.col("o_orderdate").alias("at")),
        "lineitem": t.lineitem.select(F.col("l_shipdate").alias("at")),
        "events": t.events.select(F.col("ts").alias("at")),
    }
    return merging.freshness(sources, "at").withColumn("lag_minutes", rounded("lag_minutes", 3))


@query(
    "st15_tumbling_hours",
    f"""SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS events, {r('sum(CAST(value AS DECIMAL(15,2)))', 2)} AS total FROM events GROUP BY 1, 2""",
)
def st15(t):
    return t.events.groupBy(hour_of("ts").alias("hour"), "event_type").agg(
        F.count("*").alias("events"), rounded(F.sum(money("value")), 2).alias("total")
    )


def maintained(t, partial):
    """The stored parts of the event stream, each batch reduced by ``partial``."""
    target = work_path(t.spark, "parts")
    feeds.maintain(event_stream(t), partial, target, work_path(t.spark, "checkpoint")).awaitTermination()
    return t.spark.read.parquet(target)


@query(
    "st15_tumbling_hours_stream",
    f"""SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS events, {r('sum(CAST(value AS DECIMAL(15,2)))', 2)} AS total FROM events GROUP BY 1, 2""",
)
def st15_stream(t):
    parts = maintained(t, lambda batch: feeds.window_partials(batch, "ts", ["event_type"], "value", "1 hour"))
    merged = feeds.merged_windows(parts, ["event_type"]).withColumnRenamed("window_start", "hour")
    return merged.withColumn("total", rounded("total", 2))


@query(
    "st15_windows_kept_up",
    f"""SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS events, {r('sum(CAST(value AS DECIMAL(15,2)))', 2)} AS total FROM events GROUP BY 1, 2""",
)
def st15_kept(t):
    table = VersionedTable(t.spark, work_path(t.spark, "windows"), ["window_start", "event_type"])
    change = feeds.fold_windows("ts", ["event_type"], "value", "1 hour")
    feeds.keep_up(event_stream(t), table, change, work_path(t.spark, "checkpoint")).awaitTermination()
    found = table.read().select(F.col("window_start").alias("hour"), "event_type", F.col("_rows").alias("events"), "total")
    return found.withColumn("total", rounded("total", 2))


@query(
    "st18_sliding_windows_stream",
    f"""SELECT to_timestamp(w * 900)::TIMESTAMP AS window_start, event_type, count(*) AS events, {r('sum(CAST(value AS DECIMAL(15,2)))', 2)} AS total
    FROM (SELECT event_type, value, unnest(generate_series(epoch_us(ts) // 900000000 - 3, epoch_us(ts) // 900000000)) AS w FROM events) GROUP BY 1, 2""",
)
def st18_stream(t):
    parts = maintained(t, lambda batch: feeds.window_partials(batch, "ts", ["event_type"], "value", "1 hour", "15 minutes"))
    return feeds.merged_windows(parts, ["event_type"]).withColumn("total", rounded("total", 2))


@query(
    "st16_stream_deduplicated",
    """SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id) = 1""",
)
def st16_stream(t):
    keys, order = ["user_id", "event_type", "day"], ["ts", "event_id"]
    dated = lambda batch: batch.select("event_id", "ts", "user_id", "event_type", F.col("ts").cast("date").alias("day"))
    parts = maintained(t, lambda batch: feeds.first_partials(dated(batch), keys, order))
    return feeds.merged_firsts(parts, keys, order).select("event_id", *keys)


GAP_SQL = """SELECT event_id, user_id, ts, sum(CASE WHEN last IS NULL OR epoch_us(ts) - epoch_us(last) >= 21600000000 THEN 1 ELSE 0 END)
  OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last FROM events)"""


@query("st17_gap_sessions", f"SELECT event_id, user_id, CAST(n AS BIGINT) AS session_number FROM ({GAP_SQL})")
def st17(t):
    sessions = sessionize(t.events.select("event_id", "user_id", "ts"), "user_id", "ts", "event_id", 6 * 3600)
    return sessions.select("event_id", "user_id", "session_number")


@query(
    "st17_session_windows_stream",
    f"""SELECT user_id, min(ts) AS session_start, count(*) AS events FROM ({GAP_SQL}) GROUP BY user_id, n""",
)
def st17_stream(t):
    parts = maintained(t, lambda batch: feeds.session_partials(batch, "user_id", "ts", "event_id", 6 * 3600))
    return feeds.merged_sessions(parts, "user_id", 6 * 3600)


@query(
    "st19_load_files_then_upsert",
    """SELECT c_custkey, c_name, CASE WHEN c_nationkey < 10 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal FROM customer""",
)
def st19(t):
    path = work_path(t.spark, "customers-csv")
    changed = t.customer.where(F.col("c_nationkey") < 10).select("c_custkey", "c_name", (F.col("c_acctbal") + 100).alias("c_acctbal"))
    changed.write.option("header", "true").csv(path)
    incoming = landing.read_csv(t.spark, path, "c_custkey bigint, c_name string, c_acctbal double", "part-*")
    return merging.upsert(t.customer.select("c_custkey", "c_name", "c_acctbal"), incoming, ["c_custkey"], ["c_name"])


@query("sc1_overwrite_latest", STATE_SQL.format(w=""))
def sc1(t):
    return order_states(t, None)


VERSIONS_SQL = """versions AS (SELECT *, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from, o_orderkey) AS nxt FROM
    (SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority, o_orderdate AS valid_from FROM orders
     WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
     QUALIFY lag(o_orderkey) OVER w IS NULL OR lag(o_orderstatus) OVER w <> o_orderstatus OR lag(o_orderpriority) OVER w <> o_orderpriority))"""


def customer_versions(t, tracked=("o_orderstatus", "o_orderpriority")):
    return history.versions_from_log(t.orders, "o_custkey", "o_orderdate", "o_orderkey", list(tracked))


@query(
    "sc2_versions_from_log",
    f"""WITH {VERSIONS_SQL} SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority, valid_from,
    coalesce(nxt, TIMESTAMP '9999-12-31') AS valid_to, nxt IS NULL AS is_current FROM versions""",
)
def sc2(t):
    return customer_versions(t)


FAN_CHECK = ["account_type", "email_hash", "region", "country_code", "last_active_date", "lifetime_interactions", "titles_engaged", "preferred_device"]


def fans_until(t, until):
    events = domain.fan_events(t)
    return layers.dim_fans_of(events.where(F.col("event_ts") < ntz(until)) if until else events)


def fan_snapshots(t):
    """Three runs: half the period, then without one account group, then everything."""
    first = history.snapshot(None, fans_until(t, "1998-01-10"), "fan_id", FAN_CHECK, ntz("1998-01-10"))
    kept = fans_until(t, "1998-01-20").where(F.col("first_name") != "BUILDING")
    second = history.snapshot(first, kept, "fan_id", FAN_CHECK, ntz("1998-01-20"))
    return history.snapshot(second, fans_until(t, None), "fan_id", FAN_CHECK, ntz("1998-02-01"))


SNAP_PART = """SELECT fan_id, min(segment) AS segment, count(*) AS n, count(DISTINCT title_id) AS titles, max(CAST(event_ts AS DATE)) AS last_day,
   (SELECT 1) AS one FROM (SELECT fan_id, first_name AS segment, title_id, event_ts FROM fans WHERE fan_id IS NOT NULL {w}) GROUP BY fan_id"""


SNAP_SPANS = f"""WITH a AS ({SNAP_PART.format(w="AND event_ts < TIMESTAMP '1998-01-10'")}), b AS (SELECT * FROM ({SNAP_PART.format(w="AND event_ts < TIMESTAMP '1998-01-20'")}) WHERE segment <> 'BUILDING'),
    c AS ({SNAP_PART.format(w='')})
    SELECT fan_id, n AS lifetime_interactions, valid_from, valid_to FROM (
      SELECT a.fan_id, a.n, TIMESTAMP '1998-01-10' AS valid_from, CASE WHEN b.fan_id IS NULL OR b.n <> a.n THEN TIMESTAMP '1998-01-20'
         WHEN c.n <> a.n THEN TIMESTAMP '1998-02-01' END AS valid_to FROM a LEFT JOIN b USING (fan_id) JOIN c USING (fan_id)
      UNION ALL SELECT b.fan_id, b.n, TIMESTAMP '1998-01-20', CASE WHEN c.n <> b.n THEN TIMESTAMP '1998-02-01' END
         FROM b JOIN c USING (fan_id) LEFT JOIN a USING (fan_id) WHERE a.fan_id IS NULL OR a.n <> b.n
      UNION ALL SELECT c.fan_id, c.n, TIMESTAMP '1998-02-01', NULL FROM c LEFT JOIN b USING (fan_id) WHERE b.fan_id IS NULL OR b.n <> c.n)"""


@query("sc3_snapshot", SNAP_SPANS)
def sc3(t):
    return fan_snapshots(t).select("fan_id", "lifetime_interactions", "valid_from", "valid_to")


@query("sc3_segmented_snapshot", SNAP_SPANS)
def sc3_segmented(t):
    kept = history.SegmentedHistory(t.spark, work_path(t.spark, "snapshots"), "fan_id", FAN_CHECK)
    kept.run(fans_until(t, "1998-01-10"), ntz("1998-01-10"))
    kept.run(fans_until(t, "1998-01-20").where(F.col("first_name") != "BUILDING"), ntz("1998-01-20"))
    kept.run(fans_until(t, None), ntz("1998-02-01"))
    return kept.read().select("fan_id", "lifetime_interactions", "valid_from", "valid_to")


@query(
    "d16_snapshot_valid",
    f"""WITH spans AS ({SNAP_SPANS})
    SELECT (SELECT count(*) FROM (SELECT fan_id FROM spans WHERE valid_to IS NULL GROUP BY 1 HAVING count(*) > 1)) AS several_current,
      (SELECT count(*) FROM spans WHERE valid_to < valid_from) AS reversed, (SELECT count(*) FROM spans) AS versions""",
)
def d16_snapshot(t):
    spans = fan_snapshots(t)
    per_fan = spans.groupBy("fan_id").agg(
        F.count_if(F.col("valid_to").isNull()).alias("current"),
        F.count_if(F.col("valid_to") < F.col("valid_from")).alias("reversed"),
        F.count("*").alias("versions"),
    )
    return per_fan.agg(
        F.count_if(F.col("current") > 1).alias("several_current"), F.sum("reversed").alias("reversed"), F.sum("versions").alias("versions")
    )


@query(
    "sc4_rows_as_of",
    f"""WITH {VERSIONS_SQL} SELECT o_custkey, o_orderstatus, o_orderpriority, valid_from FROM versions
    WHERE valid_from <= TIMESTAMP '{CUT}' AND coalesce(nxt, TIMESTAMP '9999-12-31') > TIMESTAMP '{CUT}'""",
)
def sc4(t):
    return history.rows_at(customer_versions(t), ntz(CUT)).select("o_custkey", "o_orderstatus", "o_orderpriority", "valid_from")


@query(
    "j9_version_chain",
    f"""WITH {VERSIONS_SQL} SELECT n.o_orderpriority AS new_priority, o.o_orderpriority AS old_priority, count(*) AS moves
    FROM versions n JOIN versions o ON n.o_custkey = o.o_custkey AND o.nxt = n.valid_from
    WHERE n.o_orderpriority <> o.o_orderpriority GROUP BY 1, 2""",
)
def j9(t):
    chain = history.version_chain(customer_versions(t), "o_custkey", ["o_orderpriority"])
    moved = chain.where(F.col("new_o_orderpriority") != F.col("old_o_orderpriority"))
    return moved.groupBy(
        F.col("new_o_orderpriority").alias("new_priority"), F.col("old_o_orderpriority").alias("old_priority")
    ).agg(F.count("*").alias("moves"))


@query(
    "j9_facts_at_their_version",
    f"""WITH {VERSIONS_SQL} SELECT o_orderpriority AS priority, e.event_type, count(*) AS events FROM (SELECT * FROM fans JOIN events ON interaction_id = event_id) e
    LEFT JOIN versions v ON user_id = o_custkey AND valid_from <= event_ts AND coalesce(nxt, TIMESTAMP '9999-12-31') > event_ts GROUP BY 1, 2""",
)
def j9_facts(t):
    facts = domain.fan_activity(t).select(F.col("user_id").alias("o_custkey"), "event_type", "event_ts")
    found = intervals.join_valid(facts, customer_versions(t), ["o_custkey"], "event_ts", "valid_from", "valid_to")
    return found.groupBy(F.col("o_orderpriority").alias("priority"), "event_type").agg(F.count("*").alias("events"))


@query(
    "gq8_moved_fan_spend",
    f"""WITH spend AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate AS valid_from, CAST(o_totalprice AS DECIMAL(15,2)) AS price,
      lead(o_orderdate) OVER w AS nxt FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
    SELECT n.o_orderpriority AS new_region, o.o_orderpriority AS old_region, {r('CAST(sum(n.price - o.price) AS DOUBLE) / count(*)', 2)} AS spend_delta
    FROM spend n JOIN spend o ON n.o_custkey = o.o_custkey AND o.nxt = n.valid_from WHERE n.o_orderpriority <> o.o_orderpriority GROUP BY 1, 2""",
)
def gq8(t):
    # Every order is a version of its customer: the price is tracked with the key so that none collapse.
    log = t.orders.withColumn("price", money("o_totalprice")).withColumn("version", F.col("o_orderkey"))
    versions = history.versions_from_log(log, "o_custkey", "o_orderdate", "o_orderkey", ["o_orderpriority", "price", "version"])
    chain = history.version_chain(versions, "o_custkey", ["o_orderpriority", "price"])
    moved = chain.where(F.col("new_o_orderpriority") != F.col("old_o_orderpriority"))
    delta = F.sum(F.col("new_price") - F.col("old_price")).cast("double") / F.count("*")
    return moved.groupBy(
        F.col("new_o_orderpriority").alias("new_region"), F.col("old_o_orderpriority").alias("old_region")
    ).agg(rounded(delta, 2).alias("spend_delta"))
