"""Join operators on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.catalog import query
from tierflow.catalog.sqltext import r
from tierflow.functions.columns import calendar_date, newest, rounded
from tierflow.operators import joining
from tierflow.plans import domain, layers


def price(c="o_totalprice"):
    return F.col(c).cast("decimal(15,2)")


@query(
    "j1_fact_to_dim",
    f"""SELECT title_name, franchise, count(*) AS records, {r('sum(gross_usd)', 2)} AS gross
    FROM box JOIN titles USING (title_id) GROUP BY title_name, franchise""",
)
def j1(t):
    dim = domain.small_titles(t).select("title_id", "title_name", "franchise")
    return domain.box_office(t).join(dim, "title_id").groupBy("title_name", "franchise").agg(
        F.count("*").alias("records"), rounded(F.sum("gross_usd"), 2).alias("gross")
    )


@query(
    "j2_outer_join_daily",
    f"""SELECT title_id, report_date, region, total_tickets_sold, {r('total_gross_usd', 2)} AS total_gross_usd,
    theater_count, screen_count, {r('avg_ticket_price_usd', 3)} AS avg_ticket_price_usd, stream_count, unique_fans FROM fact""",
)
def j2(t):
    daily = layers.daily_performance(
        layers.theatrical_daily(domain.box_office_dedup(t)), layers.fan_daily(domain.fan_events(t))
    )
    return daily.withColumns({
        "total_gross_usd": rounded("total_gross_usd", 2),
        "avg_ticket_price_usd": rounded("avg_ticket_price_usd", 3),
    })


@query(
    "j3_stats_with_details",
    """SELECT s.fan_id, interaction_count, account_type, email FROM
    (SELECT fan_id, count(*) AS interaction_count FROM fans WHERE fan_id IS NOT NULL GROUP BY fan_id) s
    JOIN (SELECT * FROM fans WHERE fan_id IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY fan_id ORDER BY event_ts DESC, interaction_id DESC) = 1) d USING (fan_id)""",
)
def j3(t):
    return layers.fan_stats(domain.fan_events(t)).select("fan_id", "interaction_count", "account_type", "email")


@query(
    "j4_orphan_rows",
    """SELECT c_custkey, c_name FROM customer LEFT JOIN (SELECT DISTINCT user_id FROM events) e ON c_custkey = user_id
    WHERE user_id IS NULL""",
)
def j4(t):
    return joining.orphans(t.customer, t.events, "c_custkey", "user_id").select("c_custkey", "c_name")


@query(
    "j5_also_did",
    """SELECT event_type, count(DISTINCT user_id) AS shared_users FROM events
    WHERE event_type <> 'purchase' AND user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase')
    GROUP BY event_type""",
)
def j5(t):
    events = t.events.select("user_id", "event_type")
    buyers = events.where(F.col("event_type") == "purchase").select("user_id").distinct()
    others = events.where(F.col("event_type") != "purchase").join(buyers, "user_id", "left_semi")
    return others.groupBy("event_type").agg(F.countDistinct("user_id").alias("shared_users"))


@query(
    "j6_scalar_subquery",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)",
)
def j6(t):
    top = t.orders.agg(F.max("o_totalprice").alias("m")).scalar()
    return t.orders.where(F.col("o_totalprice") == top).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "j7_lifetime_value",
    f"""SELECT c_custkey, {r('coalesce(o.spend, 0)', 2)} AS order_spend, {r('coalesce(e.spend, 0)', 2)} AS event_spend,
    {r('coalesce(o.spend, 0) + coalesce(e.spend, 0)', 2)} AS lifetime_value FROM customer
    LEFT JOIN (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS spend FROM orders GROUP BY 1) o ON o_custkey = c_custkey
    LEFT JOIN (SELECT user_id, sum(CAST(value AS DECIMAL(15,2))) AS spend FROM events WHERE event_type = 'purchase' GROUP BY 1) e
      ON user_id = c_custkey""",
)
def j7(t):
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(price()).alias("o"))
    bought = t.events.where(F.col("event_type") == "purchase")
    events = bought.groupBy(F.col("user_id").alias("c_custkey")).agg(F.sum(price("value")).alias("e"))
    joined = t.customer.select("c_custkey").join(orders, "c_custkey", "left").join(events, "c_custkey", "left")
    o, e = F.coalesce("o", F.lit(0)), F.coalesce("e", F.lit(0))
    return joined.select(
        "c_custkey",
        rounded(o, 2).alias("order_spend"),
        rounded(e, 2).alias("event_spend"),
        rounded(o + e, 2).alias("lifetime_value"),
    )


@query(
    "j8_customer_360",
    f"""WITH top_type AS (SELECT user_id, min(event_type) AS primary_event_type FROM
        (SELECT user_id, event_type, rank() OVER (PARTITION BY user_id ORDER BY count(*) DESC) AS rk FROM events
         GROUP BY user_id, event_type) x WHERE rk = 1 GROUP BY user_id),
    recent AS (SELECT * FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 12 MONTH)
    SELECT c_custkey, c_name, n_name, region, coalesce(total_orders_12mo, 0) AS total_orders_12mo,
      {r('total_amount_12mo', 2)} AS total_amount_12mo, total_items, total_events, last_event_ts, primary_event_type, errors
    FROM customer LEFT JOIN places ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT o_custkey, count(*) AS total_orders_12mo, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS total_amount_12mo
               FROM recent GROUP BY 1) o ON o_custkey = c_custkey
    LEFT JOIN (SELECT o_custkey AS k, count(*) AS total_items FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) l ON l.k = c_custkey
    LEFT JOIN (SELECT user_id, count(*) AS total_events, max(ts) AS last_event_ts FROM events GROUP BY 1) e ON e.user_id = c_custkey
    LEFT JOIN top_type tt ON tt.user_id = c_custkey
    LEFT JOIN (SELECT user_id AS u, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY 1) er ON er.u = c_custkey""",
)
def j8(t):
    start = newest(t.orders, "o_orderdate", lambda m: m - F.expr("INTERVAL 12 MONTHS"))
    recent = t.orders.where(F.col("o_orderdate") >= start)
    orders = recent.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("total_orders_12mo"), F.sum(price()).alias("amount")
    )
    # Items are counted per order before the join, so one order with many lines is a single row there.
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    items = t.orders.join(lines, "o_orderkey").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum("n").alias("total_items")
    )
    events = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count("*").alias("total_events"),
        F.max("ts").alias("last_event_ts"),
        F.mode("event_type", True).alias("primary_event_type"),
        F.nullif(F.count_if(F.col("event_type") == "error"), F.lit(0)).alias("errors"),
    )
    wide = domain.with_place(t.customer, t, "c_nationkey", "left")
    for part in (orders, items, events):
        wide = wide.join(part, "c_custkey", "left")
    return wide.select(
        "c_custkey", "c_name", "n_name", "region",
        F.coalesce("total_orders_12mo", F.lit(0)).alias("total_orders_12mo"),
        rounded("amount", 2).alias("total_amount_12mo"),
        "total_items", "total_events", "last_event_ts", "primary_event_type", "errors",
    )


@query(
    "j10_first_days_after",
    f"""SELECT o_orderpriority, count(*) AS lines, {r('sum(CAST(l_extendedprice AS DECIMAL(15,2)))', 2)} AS revenue
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    WHERE CAST(l_shipdate AS DATE) BETWEEN CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) + 30 GROUP BY 1""",
)
def j10(t):
    joined = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    opened = F.col("o_orderdate").cast("date")
    early = joined.where(F.col("l_shipdate").cast("date").between(opened, F.date_add(opened, 30)))
    return early.groupBy("o_orderpriority").agg(
        F.count("*").alias("lines"), rounded(F.sum(price("l_extendedprice")), 2).alias("revenue")
    )


def order_spine(t):
    return t.orders.select("o_orderkey", F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("at"))


def event_features(t):
    shifted = F.col("ts") - F.expr(f"INTERVAL {domain.SHIFT_DAYS} DAYS")
    return t.events.select("user_id", shifted.alias("feature_at"), "event_type", "value")


@query(
    "j11_asof_features",
    """SELECT o_orderkey, o_custkey AS user_id, o_orderdate AS at, feature_at, event_type, value
    FROM orders ASOF LEFT JOIN (SELECT user_id AS u, ts - INTERVAL 9496 DAY AS feature_at, event_type, value FROM events) f
    ON o_custkey = u AND o_orderdate >= feature_at""",
)
def j11(t):
    return joining.asof_join(order_spine(t), event_features(t), ["user_id"], "at", "feature_at", "o_orderkey")


@query(
    "j12_region_month_grid",
    """SELECT r_name AS region, CAST(m.month AS DATE) AS month, coalesce(n, 0) AS orders FROM region
    CROSS JOIN (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate), INTERVAL 1 MONTH)) AS month FROM orders) m
    LEFT JOIN (SELECT region, date_trunc('month', o_orderdate) AS month, count(*) AS n FROM orders
       JOIN customer ON o_custkey = c_custkey JOIN places ON c_nationkey = n_nationkey GROUP BY 1, 2) o
      ON o.region = r_name AND o.month = m.month""",
)
def j12(t):
    bounds = t.orders.agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    months = bounds.select(F.sequence(F.trunc("a", "month"), "b", F.expr("INTERVAL 1 MONTH")).alias("m")).scalar()
    grid = t.region.select(F.col("r_name").alias("region"), months.alias("m")).select("region", F.explode("m").alias("month"))
    homes = t.customer.join(domain.places(t), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "region")
    counts = t.orders.join(homes, F.col("o_custkey") == F.col("c_custkey"))
    counts = counts.groupBy("region", calendar_date("o_orderdate", "month").alias("month")).agg(F.count("*").alias("n"))
    return grid.join(counts, ["region", "month"], "left").select("region", "month", F.coalesce("n", F.lit(0)).alias("orders"))


@query(
    "j13_time_condition_in_join",
    f"""SELECT c_custkey, count(o_orderkey) AS recent_orders, {r('coalesce(sum(CAST(o_totalprice AS DECIMAL(15,2))), 0)', 2)} AS recent_spend
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey
      AND o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 90 DAY GROUP BY c_custkey""",
)
def j13(t):
    start = newest(t.orders, "o_orderdate", lambda m: m - F.expr("INTERVAL 90 DAYS"))
    # The time condition concerns the right side only, so it filters there before the join.
    recent = t.orders.where(F.col("o_orderdate") >= start)
    return t.customer.join(recent, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(
        F.count("o_orderkey").alias("recent_orders"), rounded(F.coalesce(F.sum(price()), F.lit(0)), 2).alias("recent_spend")
    )


@query(
    "j14_calendar_join",
    """SELECT year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, strftime(o_orderdate, '%Y-%m') AS month_label,
    dayofweek(o_orderdate) IN (0, 6) AS is_weekend, count(*) AS orders FROM orders GROUP BY 1, 2, 3, 4""",
)
def j14(t):
    bounds = t.orders.agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    days = joining.calendar(bounds, "a", "b")
    counts = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("n"))
    return counts.join(days, "day").groupBy(
        F.col("year").cast("bigint").alias("year"), F.col("quarter").cast("bigint").alias("quarter"), "month_label", "is_weekend"
    ).agg(F.sum("n").alias("orders"))


@query(
    "j15_exists_and_not_exists",
    """SELECT c_custkey, c_mktsegment FROM customer
    WHERE EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey AND event_type = 'signup')
      AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""",
)
def j15(t):
    signed = t.events.where(F.col("event_type") == "signup")
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    return (
        t.customer.join(signed, F.col("user_id") == F.col("c_custkey"), "left_semi")
        .join(urgent, F.col("o_custkey") == F.col("c_custkey"), "left_anti")
        .select("c_custkey", "c_mktsegment")
    )


# Map positions derived from the keys: a square of two degrees.
PLACE_SQL = "40.0 + ({k} * 7919 % 2000) / 1000.0 AS {p}_lat, -75.0 + ({k} * 104729 % 2000) / 1000.0 AS {p}_lon"


def position(key, prefix):
    lat = F.lit(40.0) + (F.col(key) * 7919 % 2000) / F.lit(1000.0)
    lon = F.lit(-75.0) + (F.col(key) * 104729 % 2000) / F.lit(1000.0)
    return lat.alias(f"{prefix}_lat"), lon.alias(f"{prefix}_lon")


@query(
    "j16_within_distance",
    f"""WITH s AS (SELECT s_suppkey, {PLACE_SQL.format(k='s_suppkey', p='site')} FROM supplier),
    c AS (SELECT c_custkey, {PLACE_SQL.format(k='c_custkey', p='point')} FROM customer),
    d AS (SELECT s_suppkey, c_custkey, 2 * 6371008.8 * asin(sqrt(least(
        pow(sin(radians(CAST(point_lat - site_lat AS DOUBLE)) / 2), 2) + cos(radians(CAST(site_lat AS DOUBLE))) * cos(radians(CAST(point_lat AS DOUBLE))) *
        pow(sin(radians(CAST(point_lon - site_lon AS DOUBLE)) / 2), 2), 1.0))) AS m FROM s, c)
    SELECT s_suppkey, c_custkey, {r('m', 1)} AS distance_m FROM d WHERE m <= 5000""",
)
def j16(t):
    sites = t.supplier.select("s_suppkey", *position("s_suppkey", "site"))
    points = t.customer.select("c_custkey", *position("c_custkey", "point"))
    near = joining.within_distance(sites, points, 5000.0)
    return near.select("s_suppkey", "c_custkey", rounded("distance_m", 1).alias("distance_m"))


@query(
    "j17_match_indicator",
    """SELECT coalesce(c_custkey, o_custkey) AS custkey, orders, CASE WHEN c_custkey IS NULL THEN 'right_only'
      WHEN o_custkey IS NULL THEN 'left_only' ELSE 'both' END AS _merge
    FROM customer FULL JOIN (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1) o ON c_custkey = o_custkey""",
)
def j17(t):
    people = t.customer.select(F.col("c_custkey").alias("custkey"))
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("custkey")).agg(F.count("*").alias("orders"))
    return joining.match_indicator(people, per_customer, ["custkey"])


@query(
    "j17_cardinality_breaches",
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def j17_breaches(t):
    return joining.cardinality_breaches(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "j18_missing_combinations",
    """SELECT c_custkey, req.event_type FROM customer
    CROSS JOIN (VALUES ('signup'), ('click'), ('view'), ('purchase')) req(event_type)
    LEFT JOIN (SELECT DISTINCT user_id, event_type FROM events) e ON e.user_id = c_custkey AND e.event_type = req.event_type
    WHERE e.user_id IS NULL""",
)
def j18(t):
    present = t.events.select(F.col("user_id").alias("c_custkey"), "event_type")
    required = ["signup", "click", "view", "purchase"]
    return joining.missing_combinations(t.customer.select("c_custkey"), required, "event_type", present, ["c_custkey"])


@query(
    "j19_errors_near_slow_events",
    """SELECT s.event_id AS slow_id, e.event_id AS error_id, s.value FROM events s JOIN events e ON s.user_id = e.user_id
    WHERE s.event_type <> 'error' AND s.value > 20 AND e.event_type = 'error'
      AND abs(epoch_us(s.ts) - epoch_us(e.ts)) < 600 * 1000000""",
)
def j19(t):
    slow = t.events.where((F.col("event_type") != "error") & (F.col("value") > 20)).select(
        "user_id", F.col("event_id").alias("slow_id"), F.col("ts").alias("slow_at"), "value"
    )
    errors = t.events.where(F.col("event_type") == "error").select(
        "user_id", F.col("event_id").alias("error_id"), F.col("ts").alias("error_at")
    )
    near = joining.near_in_time(slow, errors, ["user_id"], "slow_at", "error_at", 600)
    return near.select("slow_id", "error_id", "value")


@query(
    "j20_inline_reference",
    """SELECT level, description, count(*) AS events FROM events
    JOIN (VALUES ('signup', 1, 'enters'), ('view', 2, 'looks'), ('click', 3, 'acts'), ('purchase', 4, 'buys')) ref(kind, level, description)
      ON kind = event_type GROUP BY 1, 2""",
)
def j20(t):
    rows = [("signup", 1, "enters"), ("view", 2, "looks"), ("click", 3, "acts"), ("purchase", 4, "buys")]
    ref = t.spark.createDataFrame(rows, "event_type string, level int, description string")
    counts = t.events.groupBy("event_type").agg(F.count("*").alias("events"))
    return counts.join(ref, "event_type").select("level", "description", "events")
