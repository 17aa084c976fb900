"""Window, ordering, sampling and set operators on the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierflow.catalog import query
from tierflow.catalog.sqltext import r
from tierflow.functions.columns import calendar_date, money, ratio, rounded
from tierflow.operators import joining, ordered, picking
from tierflow.plans import domain, layers

TOTAL = "CAST(o_totalprice AS DECIMAL(15,2))"


@query(
    "w1_keep_latest",
    """SELECT record_id, title_id, theater_id, report_date, tickets_sold, CAST(gross_usd AS DOUBLE) AS gross_usd, ingestion_ts
    FROM box_dedup""",
)
def w1(t):
    return domain.box_office_dedup(t).select(
        "record_id", "title_id", "theater_id", "report_date", "tickets_sold",
        F.col("gross_usd").cast("double").alias("gross_usd"), "ingestion_ts",
    )


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]


@query(
    "w1_keep_latest_lines",
    f"""SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' DESC' for c in LINE_ORDER)}) = 1""",
)
def w1_lines(t):
    rows = picking.latest(t.lineitem, ["l_orderkey", "l_linenumber"], [F.desc(c) for c in LINE_ORDER])
    return rows.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")


@query(
    "w2_latest_attributes",
    """SELECT fan_id, account_type, email, first_name, last_name FROM fans WHERE fan_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY fan_id ORDER BY event_ts DESC, interaction_id DESC) = 1""",
)
def w2(t):
    fans = domain.fan_events(t).where(F.col("fan_id").isNotNull())
    newest = F.max_by(F.struct("account_type", "email", "first_name", "last_name"), F.struct("event_ts", "interaction_id"))
    return fans.groupBy("fan_id").agg(newest.alias("x")).select("fan_id", "x.*")


@query(
    "w3_one_row_per_fan",
    """SELECT fan_id, last_active_date, lifetime_interactions FROM dim_fans""",
)
def w3(t):
    guarded = picking.latest(layers.dim_fans(t), ["fan_id"], [F.desc("last_active_date"), F.asc("fan_key")])
    return guarded.select("fan_id", "last_active_date", "lifetime_interactions")


@query(
    "w4_validity_intervals",
    """SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate AS valid_from,
    coalesce(lead(o_orderdate) OVER w, TIMESTAMP '9999-12-31') AS valid_to, lead(o_orderdate) OVER w IS NULL AS is_current
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def w4(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("valid_from"))
    nxt = ordered.over_neighbours(
        rows, ["o_custkey"], ["valid_from", "o_orderkey"], 0, 1, lambda w: {"next_from": F.lead("valid_from").over(w)}
    )
    end = F.lit("9999-12-31").cast("timestamp_ntz")
    return nxt.select(
        "o_custkey", "o_orderkey", "o_orderstatus", "valid_from",
        F.coalesce("next_from", end).alias("valid_to"), F.col("next_from").isNull().alias("is_current"),
    )


def monthly_orders(t):
    """Monthly totals with every month of the range present; at most one row per calendar month."""
    sums = t.orders.groupBy(calendar_date("o_orderdate", "month").alias("month")).agg(
        F.count("*").alias("orders"), F.sum(money("o_totalprice")).alias("revenue")
    )
    span = sums.agg(F.min("month").alias("a"), F.max("month").alias("b"))
    months = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    filled = months.join(sums, "month", "left")
    return filled.withColumns({"orders": F.coalesce("orders", F.lit(0)), "revenue": F.coalesce("revenue", F.lit(0))})


MONTHS_SQL = f"""m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS orders, sum({TOTAL}) AS revenue
    FROM orders GROUP BY 1),
  f AS (SELECT CAST(g.month AS DATE) AS month, coalesce(orders, 0) AS orders, coalesce(revenue, 0) AS revenue FROM
    (SELECT unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS month FROM m) g LEFT JOIN m ON m.month = CAST(g.month AS DATE))"""


def change_pct(now, before):
    return rounded(ratio((now - before) * 100, before), 1)


def change_sql(c, n):
    lag = f"lag({c}, {n}) OVER (ORDER BY month)"
    return r(f"CAST(({c} - {lag}) * 100 AS DOUBLE) / nullif(CAST({lag} AS DOUBLE), 0)", 1)


@query(
    "w5_month_and_year_change",
    f"""WITH {MONTHS_SQL} SELECT month, strftime(month, '%Y-%m') AS month_label, orders, lag(orders, 1) OVER (ORDER BY month) AS prev_month_orders,
    {change_sql('orders', 1)} AS mom_pct, {change_sql('orders', 12)} AS yoy_pct FROM f""",
)
def w5(t):
    w = W.orderBy("month")  # one row per calendar month
    orders, last_month, last_year = F.col("orders"), F.lag("orders", 1).over(w), F.lag("orders", 12).over(w)
    return monthly_orders(t).select(
        "month", F.date_format("month", "yyyy-MM").alias("month_label"), "orders",
        last_month.alias("prev_month_orders"),
        change_pct(orders, last_month).alias("mom_pct"), change_pct(orders, last_year).alias("yoy_pct"),
    )


@query(
    "w6_top_n_per_group",
    """SELECT o_custkey, o_orderkey, o_orderdate, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS recency_rank
    FROM orders QUALIFY recency_rank <= 5""",
)
def w6(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return picking.top_n(rows, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 5, "recency_rank").withColumn(
        "recency_rank", F.col("recency_rank").cast("bigint")
    )


@query(
    "w7_global_ranking",
    f"""WITH c AS (SELECT o_custkey, CAST(sum({TOTAL}) AS DOUBLE) AS total_revenue FROM orders GROUP BY 1)
    SELECT o_custkey, {r('total_revenue', 2)} AS total_revenue, row_number() OVER (ORDER BY total_revenue DESC, o_custkey) AS revenue_row,
    rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank FROM c""",
)
def w7(t):
    sums = t.orders.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("total_revenue"))
    ranked = picking.global_rank(sums, "total_revenue", "o_custkey", "revenue_row", "revenue_rank")
    return ranked.select("o_custkey", rounded("total_revenue", 2).alias("total_revenue"), "revenue_row", "revenue_rank")


@query(
    "w8_rolling_rows",
    f"""SELECT event_id, count(*) OVER w AS rolling_count, {r('sum(CAST(value AS DECIMAL(15,2))) OVER w', 2)} AS rolling_sum FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 10 PRECEDING AND CURRENT ROW)""",
)
def w8(t):
    rows = t.events.select("event_id", "user_id", "ts", money("value").alias("value"))
    rolled = ordered.over_neighbours(
        rows, ["user_id"], ["ts", "event_id"], 10, 0,
        lambda w: {
            "rolling_count": F.count("*").over(w.rowsBetween(-10, 0)),
            "rolling_sum": rounded(F.sum("value").over(w.rowsBetween(-10, 0)), 2),
        },
    )
    return rolled.select("event_id", "rolling_count", "rolling_sum")


def daily_sales(t):
    """Daily ship totals: at most one row per calendar day, so the windows over it stay small."""
    return t.lineitem.groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(F.sum(money("l_quantity")).alias("quantity"))


DAILY_SQL = "d AS (SELECT CAST(l_shipdate AS DATE) AS day, sum(CAST(l_quantity AS DECIMAL(15,2))) AS quantity FROM lineitem GROUP BY 1)"


@query(
    "w9_seven_day_average",
    f"""WITH {DAILY_SQL} SELECT day, {r('CAST(sum(quantity) OVER w AS DOUBLE) / count(*) OVER w', 4)} AS avg_7_days FROM d
    WINDOW w AS (ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)""",
)
def w9(t):
    w = W.orderBy(F.unix_date("day")).rangeBetween(-6, 0)
    return daily_sales(t).select(
        "day", rounded(ratio(F.sum("quantity").over(w), F.count("*").over(w)), 4).alias("avg_7_days")
    )


@query(
    "w9_keyed_range_frame",
    f"""SELECT event_id, count(*) OVER w AS events, {r('CAST(sum(CAST(value AS DECIMAL(15,2))) OVER w AS DOUBLE)', 2)} AS total FROM events
    WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 3 HOUR PRECEDING AND CURRENT ROW)""",
)
def w9_keyed(t):
    hour = 3_600_000_000
    rows = t.events.select("event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), money("value").alias("value"))
    totals = {"events": F.lit(1).cast("bigint"), "total": F.col("value")}
    found = ordered.over_range(rows, ["event_type"], "at", 3 * hour, 0, totals)
    return found.select("event_id", "events", rounded("total", 2).alias("total"))


@query(
    "w10_thirty_periods_ago",
    f"""WITH {DAILY_SQL} SELECT day, CAST(quantity AS DOUBLE) AS quantity, CAST(lag(quantity, 30) OVER (ORDER BY day) AS DOUBLE) AS quantity_30_ago FROM d""",
)
def w10(t):
    ago = F.lag("quantity", 30).over(W.orderBy("day"))
    return daily_sales(t).select("day", F.col("quantity").cast("double").alias("quantity"), ago.cast("double").alias("quantity_30_ago"))


@query(
    "w11_running_total",
    f"""WITH {DAILY_SQL} SELECT day, CAST(sum(quantity) OVER (ORDER BY day) AS DOUBLE) AS running_quantity FROM d""",
)
def w11(t):
    w = W.orderBy("day").rowsBetween(W.unboundedPreceding, 0)
    return daily_sales(t).select("day", F.sum("quantity").over(w).cast("double").alias("running_quantity"))


@query(
    "w12_share_of_group",
    f"""SELECT event_id, {r('value / (CAST(sum(CAST(value AS DECIMAL(15,2))) OVER w AS DOUBLE) / count(*) OVER w)', 4)} AS pct_of_mean
    FROM events WINDOW w AS (PARTITION BY event_type)""",
)
def w12(t):
    # Joining the few group rows back avoids sorting whole groups in one task each.
    means = t.events.groupBy("event_type").agg(ratio(F.sum(money("value")), F.count("*")).alias("mean"))
    joined = t.events.select("event_id", "event_type", "value").join(joining.of_known_size(means), "event_type")
    return joined.select("event_id", rounded(ratio("value", "mean"), 4).alias("pct_of_mean"))


STAGES = ["signup", "view", "click", "purchase"]


@query(
    "w13_funnel",
    f"""WITH s AS (SELECT event_type AS stage, count(DISTINCT user_id) AS users, list_position(['signup', 'view', 'click', 'purchase'], event_type) AS sort_order
      FROM events WHERE event_type IN ('signup', 'view', 'click', 'purchase') GROUP BY 1)
    SELECT stage, sort_order, users, lag(users) OVER (ORDER BY sort_order) AS previous_users,
    {r('CAST(users AS DOUBLE) / nullif(CAST(lag(users) OVER (ORDER BY sort_order) AS DOUBLE), 0)', 4)} AS conversion_rate FROM s""",
)
def w13(t):
    counts = t.events.where(F.col("event_type").isin(STAGES)).groupBy(F.col("event_type").alias("stage")).agg(
        F.countDistinct("user_id").alias("users")
    )
    place = F.array_position(F.array(*[F.lit(s) for s in STAGES]), F.col("stage")).cast("int")
    before = F.lag("users").over(W.orderBy("sort_order"))  # one row per stage
    return counts.withColumn("sort_order", place).select(
        "stage", "sort_order", "users", before.alias("previous_users"), rounded(ratio("users", before), 4).alias("conversion_rate")
    )


@query("o1_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def o1(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query(
    "o2_mixed_order",
    "SELECT o_orderdate, o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey LIMIT 20",
)
def o2(t):
    rows = t.orders.select("o_orderdate", "o_orderkey", "o_totalprice")
    return rows.orderBy(F.desc("o_orderdate"), F.desc("o_totalprice"), F.asc("o_orderkey")).limit(20)


@query(
    "o3_custom_rank_order",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS orders FROM orders GROUP BY 1, 2",
)
def o3(t):
    counts = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("orders"))
    rank = F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "P", 2).otherwise(3)
    return counts.orderBy(rank, "o_orderpriority")


@query(
    "o4_union_with_padding",
    """SELECT interaction_id, fan_id, email, first_name, last_name, region, country_code, event_type, event_ts, title_id,
    device_type, CAST(value AS DOUBLE) AS value, account_type FROM fans""",
)
def o4(t):
    return layers.fans_unified(t).withColumn("value", F.col("value").cast("double"))


@query(
    "o5_union_of_metric_rows",
    """SELECT 'orders' AS table_name, 'row_count' AS metric, count(*) AS value FROM orders
    UNION ALL SELECT 'orders', 'distinct_customers', count(DISTINCT o_custkey) FROM orders
    UNION ALL SELECT 'events', 'row_count', count(*) FROM events
    UNION ALL SELECT 'events', 'errors', count(*) FILTER (WHERE event_type = 'error') FROM events""",
)
def o5(t):
    def rows(frame, table, metrics):
        made = [F.struct(F.lit(table).alias("table_name"), F.lit(m).alias("metric"), c.alias("value")) for m, c in metrics]
        return frame.agg(F.array(*made).alias("m")).select(F.inline("m"))

    parts = [
        rows(t.orders, "orders", [("row_count", F.count("*")), ("distinct_customers", F.countDistinct("o_custkey"))]),
        rows(t.events, "events", [("row_count", F.count("*")), ("errors", F.count_if(F.col("event_type") == "error"))]),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


BUCKET_SQL = "CAST('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8) AS BIGINT) % 10"


@query("o6_hash_sample", f"SELECT o_orderkey, o_custkey FROM orders WHERE {BUCKET_SQL.format(k='o_orderkey')} = 0")
def o6(t):
    return t.orders.where(picking.hash_bucket("o_orderkey", 10) == 0).select("o_orderkey", "o_custkey")


@query("o6_fixed_row_sample", "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100")
def o6_fixed(t):
    return t.orders.orderBy(picking.hash_order("o_orderkey"), "o_orderkey").limit(100).select("o_orderkey", "o_custkey")


@query(
    "o6_seeded_sample",
    f"SELECT o_orderkey, o_custkey FROM orders WHERE CAST('0x' || substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) < {int(0.1 * 2**32)}",
)
def o6_seeded(t):
    return picking.seeded_sample(t.orders, "o_orderkey", 0.1, seed=42).select("o_orderkey", "o_custkey")


@query(
    "o7_stratified_sample",
    """SELECT c_custkey, c_mktsegment FROM customer
    QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey) <= 20""",
)
def o7(t):
    order = [picking.hash_order("c_custkey"), F.asc("c_custkey")]
    return picking.top_n(t.customer.select("c_custkey", "c_mktsegment"), ["c_mktsegment"], order, 20)


@query(
    "o7_stratified_fraction",
    f"""SELECT c_custkey, c_mktsegment FROM customer WHERE {BUCKET_SQL.format(k='c_custkey')} <
    CASE c_mktsegment WHEN 'BUILDING' THEN 5 WHEN 'MACHINERY' THEN 1 ELSE 2 END""",
)
def o7_fraction(t):
    share = F.when(F.col("c_mktsegment") == "BUILDING", 5).when(F.col("c_mktsegment") == "MACHINERY", 1).otherwise(2)
    return t.customer.where(picking.hash_bucket("c_custkey", 10) < share).select("c_custkey", "c_mktsegment")
