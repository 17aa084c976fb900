"""Projection, parsing and filters on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.catalog import query
from tierflow.catalog.sqltext import r
from tierflow.functions import columns as C
from tierflow.functions.columns import hour_of, money, rounded
from tierflow.plans import domain

FAN_FIELDS = {
    "interaction_id": "bigint", "fan_id": "bigint", "session_id": "string", "account_type": "string", "email": "string",
    "first_name": "string", "last_name": "string", "region": "string", "country_code": "string", "event_type": "string",
    "event_ts": "timestamp_ntz", "title_id": "bigint", "device_type": "string",
}
TITLE_FIELDS = {
    "title_id": "bigint", "title_name": "string", "franchise": "string", "genre": "string", "rating": "string",
    "production_status": "string", "director": "string", "release_year": "int", "release_date": "date",
    "runtime_minutes": "int", "imdb_score": "double", "budget_usd": "decimal(15,2)",
}
BOX_FIELDS = {
    "record_id": "bigint", "title_id": "bigint", "theater_id": "bigint", "theater_name": "string", "report_date": "date",
    "region": "string", "country_code": "string", "local_currency": "string", "tickets_sold": "int", "screen_count": "int",
    "gross_local": "decimal(15,2)", "gross_usd": "decimal(15,4)",
}


def as_raw(df, fields):
    """Rows packed as variants, the way a landed file holds them."""
    return df.select(F.to_variant_object(F.struct(*fields)).alias("raw_data"))


@query("p1_parse_fan_event", f"SELECT {', '.join(FAN_FIELDS)} FROM fans")
def p1(t):
    return C.parse_variant(as_raw(domain.fan_events(t), FAN_FIELDS), "raw_data", FAN_FIELDS)


@query(
    "p2_parse_title",
    f"SELECT {', '.join(f for f in TITLE_FIELDS if f != 'budget_usd')}, CAST(budget_usd AS DOUBLE) AS budget_usd FROM titles_raw",
)
def p2(t):
    typed = C.parse_variant(as_raw(domain.titles_raw(t), TITLE_FIELDS), "raw_data", TITLE_FIELDS)
    return typed.withColumns({
        "budget_usd": F.col("budget_usd").cast("double"),
        "release_year": F.col("release_year").cast("int"),
    })


@query(
    "p3_parse_box_office",
    f"""SELECT {', '.join(f for f in BOX_FIELDS if not f.startswith('gross'))}, {r('gross_local', 2)} AS gross_local,
    {r('gross_usd', 4)} AS gross_usd FROM box""",
)
def p3(t):
    rows = domain.spread(domain.box_office(t), t.lineitem)
    typed = C.parse_variant(as_raw(rows, BOX_FIELDS), "raw_data", BOX_FIELDS)
    return typed.withColumns({"gross_local": rounded("gross_local", 2), "gross_usd": rounded("gross_usd", 4)})


@query(
    "p4_parse_once_then_aggregate",
    f"""SELECT CAST(props->>'$.k' AS BIGINT) AS k, count(*) AS events, {r('sum(CAST(value AS DECIMAL(15,2)))', 2)} AS revenue
    FROM events WHERE CAST(props->>'$.k' AS BIGINT) >= 50 GROUP BY 1""",
)
def p4(t):
    parsed = t.events.select(F.from_json("props", "k bigint").alias("p"), "value").select("p.k", "value")
    return parsed.where(F.col("k") >= 50).groupBy("k").agg(
        F.count("*").alias("events"), rounded(F.sum(money("value")), 2).alias("revenue")
    )


RATE_SQL = "(VALUES ('USD', 1.00), ('EUR', 1.08), ('GBP', 1.27), ('JPY', 0.01), ('BRL', 0.20)) rates(currency, rate)"


@query(
    "p5_currency_to_usd",
    f"""SELECT local_currency, count(*) AS records, CAST(sum(CAST(round(gross_local * CAST(rate AS DECIMAL(6,2)), 2) AS DECIMAL(18,2))) AS DOUBLE) AS usd
    FROM box JOIN {RATE_SQL} ON currency = local_currency GROUP BY 1""",
)
def p5(t):
    # The rates are a short fixed list: literals need neither a join nor a shuffle of the records by currency.
    rate = C.case_map("local_currency", domain.USD_RATES).cast("decimal(6,2)")
    usd = F.round(F.col("gross_local") * rate, 2).cast("decimal(18,2)")
    return domain.box_office(t).where(rate.isNotNull()).groupBy("local_currency").agg(
        F.count("*").alias("records"), F.sum(usd).cast("double").alias("usd")
    )


@query(
    "p5_currency_by_case",
    """SELECT region, CAST(sum(CAST(round(gross_local * CAST(CASE local_currency WHEN 'USD' THEN 1.00 WHEN 'EUR' THEN 1.08
      WHEN 'GBP' THEN 1.27 WHEN 'JPY' THEN 0.01 WHEN 'BRL' THEN 0.20 END AS DECIMAL(6,2)), 2) AS DECIMAL(18,2))) AS DOUBLE) AS usd FROM box GROUP BY 1""",
)
def p5_case(t):
    rate = C.case_map("local_currency", domain.USD_RATES).cast("decimal(6,2)")
    usd = F.round(F.col("gross_local") * rate, 2).cast("decimal(18,2)")
    return domain.box_office(t).groupBy("region").agg(F.sum(usd).cast("double").alias("usd"))


@query(
    "p6_assemble_json",
    """SELECT event_id, event_type, value, k FROM (SELECT event_id, event_type, value, CAST(props->>'$.k' AS BIGINT) AS k FROM events)""",
)
def p6(t):
    nested = F.struct("event_id", "event_type", "value", F.from_json("props", "k bigint").alias("props"))
    document = t.events.select(F.to_json(nested).alias("doc"))
    back = document.select(F.from_json("doc", "event_id bigint, event_type string, value double, props struct<k: bigint>").alias("d"))
    return back.select("d.event_id", "d.event_type", "d.value", F.col("d.props.k").alias("k"))


@query(
    "p7_surrogate_keys",
    """SELECT o_orderkey, md5(CAST(o_custkey AS VARCHAR)) AS customer_key,
    md5(concat_ws('-', CAST(o_custkey AS VARCHAR), o_orderpriority, coalesce(CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END, '_null_'))) AS separated_key,
    CASE WHEN o_orderstatus <> 'F' THEN md5(CAST(o_custkey AS VARCHAR) || o_orderpriority || o_orderstatus) END AS concat_key FROM orders""",
)
def p7(t):
    status = F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus"))
    return t.orders.select(
        "o_orderkey",
        C.concat_key("o_custkey").alias("customer_key"),
        C.surrogate_key("o_custkey", "o_orderpriority", status).alias("separated_key"),
        C.concat_key("o_custkey", "o_orderpriority", status).alias("concat_key"),
    )


@query("p8_hash_identity", "SELECT interaction_id, sha256(email) AS email_hash FROM fans")
def p8(t):
    return domain.fan_activity(t).select("interaction_id", C.sha256("email").alias("email_hash"))


@query(
    "p9_business_names_and_chained_columns",
    f"""SELECT l_orderkey AS "Order", l_linenumber AS "Line", {r('CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))', 4)} AS "Net Price",
    {r('CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) * (1 + CAST(l_tax AS DECIMAL(4,2)))', 4)} AS "Final Price" FROM lineitem""",
)
def p9(t):
    chained = (
        t.lineitem.withColumn("net", money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)")))
        .withColumn("final", F.col("net") * (1 + F.col("l_tax").cast("decimal(4,2)")))
    )
    return chained.select(
        F.col("l_orderkey").alias("Order"), F.col("l_linenumber").alias("Line"),
        rounded("net", 4).alias("Net Price"), rounded("final", 4).alias("Final Price"),
    )


@query(
    "f1_basic_filter",
    "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase' AND value > 20 AND user_id IS NOT NULL",
)
def f1(t):
    keep = (F.col("event_type") == "purchase") & (F.col("value") > 20) & F.col("user_id").isNotNull()
    return t.events.where(keep).select("event_id", "user_id", "value")


@query(
    "f2_last_days",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY",
)
def f2(t):
    start = C.newest(t.orders, "o_orderdate", lambda m: m - F.expr("INTERVAL 30 DAYS"))
    return t.orders.where(F.col("o_orderdate") >= start).select("o_orderkey", "o_orderdate")


@query(
    "f3_lists_and_ranges",
    """SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice BETWEEN 100000 AND 200000
    AND o_orderstatus <> 'F'""",
)
def f3(t):
    keep = C.one_of("o_orderpriority", ["1-URGENT", "2-HIGH"]) & F.col("o_totalprice").between(100000, 200000)
    return t.orders.where(keep & (F.col("o_orderstatus") != "F")).select("o_orderkey")


@query(
    "f4_half_open_range",
    """SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1998-02-01'""",
)
def f4(t):
    # The raw column is compared, so both bounds reach the parquet scan.
    at = F.col("l_shipdate")
    start, end = F.lit("1998-01-01").cast("timestamp_ntz"), F.lit("1998-02-01").cast("timestamp_ntz")
    return t.lineitem.where((at >= start) & (at < end)).select("l_orderkey", "l_linenumber", "l_shipdate")


@query(
    "f5_filter_on_computed",
    f"""SELECT record_id, {r('gross_usd', 4)} AS gross_usd FROM box WHERE gross_usd >= 50000""",
)
def f5(t):
    net = domain.box_office(t).select("record_id", "gross_usd").where(F.col("gross_usd") >= 50000)
    return net.withColumn("gross_usd", rounded("gross_usd", 4))


@query(
    "fn_scalar_functions",
    """SELECT o_orderkey, upper(o_orderpriority) AS up, lower(o_orderstatus) AS low, lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS padded,
    length(o_orderpriority) AS len, regexp_matches(o_orderpriority, '^[0-9]-[A-Z]+$') AS one_word,
    regexp_replace(o_orderpriority, '[0-9]-', '') AS word, right(o_orderpriority, 3) AS tail, substr(o_orderpriority, 1, 1) AS digit,
    o_orderpriority LIKE '%H%' AS has_h, greatest(o_custkey, 100) AS at_least, abs(o_custkey - 500) AS distance, o_custkey % 7 AS remainder,
    year(o_orderdate) AS y, month(o_orderdate) AS m, CAST(o_orderdate AS DATE) + 10 AS later, strftime(o_orderdate, '%Y-%m-%d') AS text_date,
    coalesce(nullif(o_orderstatus, 'O'), 'open') AS status FROM orders""",
)
def fn(t):
    p = F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey", F.upper(p).alias("up"), F.lower("o_orderstatus").alias("low"),
        F.lpad(F.col("o_custkey").cast("string"), 8, "0").alias("padded"), F.length(p).cast("bigint").alias("len"),
        p.rlike("^[0-9]-[A-Z]+$").alias("one_word"), F.regexp_replace(p, "[0-9]-", "").alias("word"),
        F.right(p, F.lit(3)).alias("tail"), F.substring(p, 1, 1).alias("digit"), p.like("%H%").alias("has_h"),
        F.greatest("o_custkey", F.lit(100)).alias("at_least"), F.abs(F.col("o_custkey") - 500).alias("distance"),
        (F.col("o_custkey") % 7).alias("remainder"), F.year("o_orderdate").cast("bigint").alias("y"),
        F.month("o_orderdate").cast("bigint").alias("m"), F.date_add(F.col("o_orderdate").cast("date"), 10).alias("later"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("text_date"),
        F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("O")), F.lit("open")).alias("status"),
    )


@query(
    "fn_time_parts_and_casts",
    """SELECT event_id, date_trunc('hour', ts) AS hour, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS days,
    TRY_CAST(event_type AS INTEGER) AS not_a_number, ts AS parsed FROM events""",
)
def fn_time(t):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return t.events.select(
        "event_id", hour_of("ts").alias("hour"),
        F.datediff(F.col("ts"), F.lit("2024-01-01").cast("date")).cast("bigint").alias("days"),
        F.expr("try_cast(event_type AS int)").alias("not_a_number"),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")).cast("timestamp_ntz").alias("parsed"),
    )
