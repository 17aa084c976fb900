"""Aggregations on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.catalog import query
from tierflow.catalog.sqltext import r
from tierflow.functions.columns import calendar_date, hour_of, money, newest, ratio, rounded
from tierflow.operators import ordered, picking, sketches
from tierflow.plans import domain, layers
from tierflow.plans.refresh import refresh
from tierflow.session import work_path

DEC = "CAST({} AS DECIMAL(15,2))"
TOTAL = DEC.format("o_totalprice")


@query(
    "a1_theatrical_daily",
    f"""SELECT title_id, report_date, region, total_tickets_sold, {r('total_gross_usd', 2)} AS total_gross_usd, theater_count,
    screen_count, {r('avg_ticket_price_usd', 3)} AS avg_ticket_price_usd FROM theatrical_daily""",
)
def a1(t):
    daily = layers.theatrical_daily(domain.box_office_dedup(t))
    return daily.withColumns({
        "total_gross_usd": rounded("total_gross_usd", 2),
        "avg_ticket_price_usd": rounded("avg_ticket_price_usd", 3),
    })


@query("a2_fan_daily", "SELECT * FROM fan_daily")
def a2(t):
    return layers.fan_daily(domain.fan_events(t))


@query(
    "a3_fan_stats",
    """SELECT fan_id, signup_date, last_active_date, lifetime_interactions, titles_engaged, preferred_device, region,
    country_code FROM dim_fans""",
)
def a3(t):
    s = layers.fan_stats(domain.fan_events(t))
    return s.select(
        "fan_id", F.col("first_seen").cast("date").alias("signup_date"), F.col("last_seen").cast("date").alias("last_active_date"),
        F.col("interaction_count").alias("lifetime_interactions"), "titles_engaged", "preferred_device",
        F.col("primary_region").alias("region"), F.col("primary_country").alias("country_code"),
    )


@query(
    "a3_mode_open_domain",
    """SELECT fan_id, min(title_id) AS top_title FROM (SELECT fan_id, title_id,
      rank() OVER (PARTITION BY fan_id ORDER BY count(*) DESC) AS rk FROM fans WHERE fan_id IS NOT NULL
      GROUP BY fan_id, title_id) x WHERE rk = 1 GROUP BY fan_id""",
)
def a3_mode(t):
    return layers.fan_device_modes(t)


@query(
    "a4_franchise_performance",
    f"""SELECT franchise, genre, title_count, total_tickets, {r('total_gross_usd', 2)} AS total_gross_usd,
    {r('avg_ticket_price', 3)} AS avg_ticket_price, {r('weighted_ticket_price', 3)} AS weighted_ticket_price, total_streams,
    total_unique_fans, first_report_date, last_report_date FROM agg_franchise""",
)
def a4(t):
    return layers.agg_franchise(t).withColumns({
        "total_gross_usd": rounded("total_gross_usd", 2),
        "avg_ticket_price": rounded("avg_ticket_price", 3),
        "weighted_ticket_price": rounded("weighted_ticket_price", 3),
    })


@query(
    "a5_fan_lifetime_value",
    f"""SELECT region, country_code, account_type, fan_count, {r('avg_interactions', 4)} AS avg_interactions,
    {r('avg_titles_engaged', 4)} AS avg_titles_engaged, {r('avg_active_days', 4)} AS avg_active_days,
    active_last_30_days, active_last_7_days, top_device FROM agg_fan_value""",
)
def a5(t):
    return layers.agg_fan_value(t).withColumns(
        {c: rounded(c, 4) for c in ("avg_interactions", "avg_titles_engaged", "avg_active_days")}
    )


@query(
    "a6_layer_row_counts",
    """SELECT 'raw' AS layer, 'fan_events' AS table_name, count(*) AS row_count FROM fans
    UNION ALL SELECT 'raw', 'titles', count(*) FROM titles_raw UNION ALL SELECT 'raw', 'box_office', count(*) FROM box
    UNION ALL SELECT 'staged', 'fan_verified', count(*) FROM fans WHERE account_type = 'VERIFIED'
    UNION ALL SELECT 'staged', 'fan_guest', count(*) FROM fans WHERE account_type = 'GUEST'
    UNION ALL SELECT 'dimensional', 'dim_fans', count(*) FROM dim_fans
    UNION ALL SELECT 'dimensional', 'dim_titles', count(*) FROM dim_titles
    UNION ALL SELECT 'dimensional', 'fact_daily', count(*) FROM fact
    UNION ALL SELECT 'aggregate', 'franchise', count(*) FROM agg_franchise
    UNION ALL SELECT 'aggregate', 'fan_value', count(*) FROM agg_fan_value""",
)
def a6(t):
    # The layers are stored once, each from the one before, and then counted.
    stored = refresh(t, work_path(t.spark, "layers"))
    unified = stored["fans_unified"]
    tables = [
        ("raw", "fan_events", t.events),
        ("raw", "titles", t.part),
        ("raw", "box_office", domain.box_office(t)),
        ("staged", "fan_verified", unified.where(F.col("account_type") == "VERIFIED")),
        ("staged", "fan_guest", unified.where(F.col("account_type") == "GUEST")),
        ("dimensional", "dim_fans", stored["dim_fans"]),
        ("dimensional", "dim_titles", stored["dim_titles"]),
        ("dimensional", "fact_daily", stored["fact_daily"]),
        ("aggregate", "franchise", stored["agg_franchise"]),
        ("aggregate", "fan_value", stored["agg_fan_value"]),
    ]
    out = None
    for layer, name, frame in tables:
        row = frame.agg(F.count("*").alias("row_count"))
        row = row.select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
        out = row if out is None else out.unionByName(row)
    rank = F.array_position(F.array(*[F.lit(x) for x in ("raw", "staged", "dimensional", "aggregate")]), F.col("layer"))
    return out.orderBy(rank, "table_name")


@query(
    "a7_lineage_by_source",
    """SELECT o_orderpriority AS source, count(*) AS records, min(o_orderdate) AS first_load, max(o_orderdate) AS last_load
    FROM orders GROUP BY 1""",
)
def a7(t):
    return t.orders.groupBy(F.col("o_orderpriority").alias("source")).agg(
        F.count("*").alias("records"), F.min("o_orderdate").alias("first_load"), F.max("o_orderdate").alias("last_load")
    )


@query(
    "a8_correlation_by_group",
    f"""WITH e AS (SELECT user_id, CAST(sum({DEC.format('value')}) AS DOUBLE) / count(*) AS buzz FROM events GROUP BY 1),
    o AS (SELECT o_custkey, CAST(sum({TOTAL}) AS DOUBLE) AS revenue FROM orders GROUP BY 1)
    SELECT c_mktsegment, {r('corr(buzz, revenue)', 4)} AS correlation, {r('avg(CASE WHEN buzz > 10 THEN revenue END)', 1)} AS high_avg
    FROM e JOIN o ON user_id = o_custkey JOIN customer ON user_id = c_custkey GROUP BY 1""",
)
def a8(t):
    buzz = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(ratio(F.sum(money("value")), F.count("*")).alias("buzz"))
    paid = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(money("o_totalprice")).cast("double").alias("revenue"))
    segments = t.customer.select("c_custkey", "c_mktsegment")
    return buzz.join(paid, "c_custkey").join(segments, "c_custkey").groupBy("c_mktsegment").agg(
        rounded(F.corr("buzz", "revenue"), 4).alias("correlation"),
        rounded(F.avg(F.when(F.col("buzz") > 10, F.col("revenue"))), 1).alias("high_avg"),
    )


@query(
    "a9_cohort_by_first_order",
    f"""WITH c AS (SELECT o_custkey, min(o_orderdate) AS joined, sum({TOTAL}) AS spend FROM orders GROUP BY 1)
    SELECT CAST(date_trunc('year', joined) AS DATE) AS cohort_year, count(DISTINCT o_custkey) AS cohort_size,
    {r('sum(spend)', 2)} AS cohort_revenue, {r('CAST(sum(spend) AS DOUBLE) / count(DISTINCT o_custkey)', 2)} AS avg_ltv FROM c GROUP BY 1""",
)
def a9(t):
    people = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("joined"), F.sum(money("o_totalprice")).alias("spend"))
    # One row per customer by now, so the cohort size is a plain count.
    return people.groupBy(calendar_date("joined", "year").alias("cohort_year")).agg(
        F.count("*").alias("cohort_size"),
        rounded(F.sum("spend"), 2).alias("cohort_revenue"),
        rounded(ratio(F.sum("spend"), F.count("*")), 2).alias("avg_ltv"),
    )


@query(
    "a10_approximate_within_bounds",
    f"""SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers, {r('quantile_cont(o_totalprice, 0.5)', 2)} AS median FROM orders GROUP BY 1""",
)
def a10(t):
    # The exact figures are returned where the approximate ones lie within their bounds, and dropped elsewhere.
    g = t.orders.groupBy("o_orderpriority").agg(
        F.approx_count_distinct("o_custkey", 0.02).alias("near_customers"),
        F.approx_percentile("o_totalprice", 0.5, 10_000).alias("near_median"),
    )
    exact = t.orders.groupBy("o_orderpriority").agg(F.countDistinct("o_custkey").alias("customers"))
    middle = ordered.quantiles(t.orders, ["o_orderpriority"], "o_totalprice", {"median": ("cont", 0.5)})
    both = g.join(exact, "o_orderpriority").join(middle, "o_orderpriority")
    within = (F.abs(F.col("near_customers") - F.col("customers")) <= 0.1 * F.col("customers")) & (
        F.abs(F.col("near_median") - F.col("median")) <= 0.02 * F.col("median")
    )
    return both.where(within).select("o_orderpriority", "customers", rounded("median", 2).alias("median"))


@query(
    "a10_stored_sketches",
    """SELECT device_type, CAST(date_trunc('week', event_ts) AS DATE) AS week, count(*) AS events, count(DISTINCT fan_id) AS fans
    FROM fans GROUP BY 1, 2""",
)
def a10_stored(t):
    # Sketched day by day in two loads, the second with late rows of the first one's days, and read back by week.
    path, days = work_path(t.spark, "sketches"), ["day", "device_type"]
    events = domain.fan_activity(t).withColumn("day", F.col("event_ts").cast("date"))
    for late in (False, True):
        part = events.where((F.col("interaction_id") % 3 == 0) == late)
        sketches.sketched(part, days, {"fans": "fan_id"}, {"spend": "value"}).write.mode("append").parquet(path)
    weekly = t.spark.read.parquet(path).withColumn("week", calendar_date("day", "week"))
    merged = sketches.merged(weekly, ["device_type", "week"], ["fans"], ["spend"])
    found = sketches.estimates(merged, ["device_type", "week"], ["fans"], {"median_spend": ("spend", 0.5)})
    # Sets of this size are counted exactly; larger ones within the bounds that the tests check.
    return found.select("device_type", "week", F.col("n_rows").alias("events"), "fans")


@query(
    "a10_approximate_top_k",
    """SELECT l_returnflag, l_linenumber AS item, n FROM (SELECT l_returnflag, l_linenumber, count(*) AS n,
      row_number() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC, l_linenumber) AS rn FROM lineitem GROUP BY 1, 2) WHERE rn <= 3""",
)
def a10_top(t):
    # The sketch breaks ties at will and forgets what lies beyond its candidates, so it only stands beside the exact
    # counts: an item is taken by its count, and the sketch must not have counted more than there are.
    items = t.lineitem.groupBy("l_returnflag", F.col("l_linenumber").alias("item")).agg(F.count("*").alias("n"))
    exact = picking.top_n(items, ["l_returnflag"], [F.desc("n"), F.asc("item")], 3)
    sketch = t.lineitem.groupBy("l_returnflag").agg(F.expr("approx_top_k(l_linenumber, 10, 1000)").alias("top"))
    counted = F.filter("top", lambda x: x["item"] == F.col("item"))
    within = F.forall(counted, lambda x: x["count"] <= F.col("n"))
    return exact.join(sketch, "l_returnflag").where(within).select("l_returnflag", "item", "n")


@query(
    "a11_latency_p95",
    f"""SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS execution_count,
    {r(f"CAST(sum({DEC.format('value')}) AS DOUBLE) / count(*)", 4)} AS avg_duration,
    {r('quantile_cont(value, 0.95)', 4)} AS p95_duration, max(value) AS max_duration FROM events GROUP BY 1, 2""",
)
def a11(t):
    hourly = t.events.select("event_type", hour_of("ts").alias("hour"), "value")
    base = hourly.groupBy("event_type", "hour").agg(
        F.count("*").alias("execution_count"),
        rounded(ratio(F.sum(money("value")), F.count("*")), 4).alias("avg_duration"),
        F.max("value").alias("max_duration"),
    )
    p95 = ordered.quantiles(hourly, ["event_type", "hour"], "value", {"p95_duration": ("cont", 0.95)})
    return base.join(p95.withColumn("p95_duration", rounded("p95_duration", 4)), ["event_type", "hour"])


@query(
    "a12_distinct_samples",
    """SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS events, list_slice(list_sort(list(DISTINCT user_id)), 1, 5) AS sample_users
    FROM events GROUP BY 1, 2""",
)
def a12(t):
    daily = t.events.select("event_type", F.col("ts").cast("date").alias("day"), "user_id")
    counts = daily.groupBy("event_type", "day").agg(F.count("*").alias("events"))
    # Five users per group leave the map side, so the collected list stays short whatever the group size.
    few = picking.top_n(daily.distinct(), ["event_type", "day"], [F.asc("user_id")], 5)
    samples = few.groupBy("event_type", "day").agg(F.array_sort(F.collect_list("user_id")).alias("sample_users"))
    return counts.join(samples, ["event_type", "day"])


@query(
    "a13_wide_features",
    f"""WITH m AS (SELECT max(ts) AS d FROM events)
    SELECT c_custkey, {r('avg(value)', 4)} AS avg_value_30d, max(value) AS max_value_30d, {r('stddev_samp(value)', 3)} AS stddev_value_30d,
      max(CASE WHEN event_type = 'error' THEN 1 WHEN event_type IS NOT NULL THEN 0 END) AS error_flag_30d,
      count(*) FILTER (WHERE event_type = 'error') AS error_count_30d, CASE WHEN max(value) > 50 THEN 1 ELSE 0 END AS high_value_flag,
      max(CASE WHEN ts >= m.d - INTERVAL 7 DAY THEN CASE WHEN event_type = 'error' THEN 1 ELSE 0 END END) AS target_error_7d
    FROM customer CROSS JOIN m LEFT JOIN events ON user_id = c_custkey AND ts >= m.d - INTERVAL 30 DAY GROUP BY c_custkey""",
)
def a13(t):
    month, week = (newest(t.events, "ts", lambda m, d=d: m - F.expr(f"INTERVAL {d} DAYS")) for d in (30, 7))
    recent = t.events.where(F.col("ts") >= month).withColumn("last_week", F.col("ts") >= week)
    error = F.when(F.col("event_type") == "error", 1).otherwise(0)
    per_user = recent.groupBy(F.col("user_id").alias("c_custkey")).agg(
        rounded(F.avg("value"), 4).alias("avg_value_30d"),
        F.max("value").alias("max_value_30d"),
        rounded(F.stddev_samp("value"), 3).alias("stddev_value_30d"),
        F.max(error).alias("error_flag_30d"),
        F.count_if(F.col("event_type") == "error").alias("n_errors"),
        F.max(F.when(F.col("last_week"), error)).alias("target_error_7d"),
    )
    wide = t.customer.select("c_custkey").join(per_user, "c_custkey", "left")
    return wide.select(
        "c_custkey", "avg_value_30d", "max_value_30d", "stddev_value_30d", "error_flag_30d",
        F.coalesce("n_errors", F.lit(0)).alias("error_count_30d"),
        F.when(F.col("max_value_30d") > 50, 1).otherwise(0).alias("high_value_flag"),
        "target_error_7d",
    )


@query(
    "a14_having_not_single",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) <> 1",
)
def a14(t):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where(F.col("n") != 1)


@query(
    "a15_average_of_sums",
    f"""SELECT c_mktsegment, {r(f'avg(CAST(total AS DOUBLE))', 2)} AS avg_customer_total FROM
    (SELECT o_custkey, sum({TOTAL}) AS total FROM orders GROUP BY 1) JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def a15(t):
    totals = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(money("o_totalprice")).alias("total"))
    return totals.join(t.customer, "c_custkey").groupBy("c_mktsegment").agg(
        rounded(F.avg(F.col("total").cast("double")), 2).alias("avg_customer_total")
    )


@query(
    "a16_customer_lifetime_value",
    f"""WITH c AS (SELECT o_custkey, CAST(sum({TOTAL}) AS DOUBLE) / count(*) AS avg_purchase, count(*) AS n,
      date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) / 365.25 AS years FROM orders GROUP BY 1)
    SELECT {r('avg(avg_purchase * n / nullif(years, 0))', 2)} AS clv, count(*) AS customers FROM c""",
)
def a16(t):
    per = t.orders.groupBy("o_custkey").agg(
        ratio(F.sum(money("o_totalprice")), F.count("*")).alias("avg_purchase"),
        F.count("*").alias("n"),
        (F.datediff(F.max("o_orderdate"), F.min("o_orderdate")) / F.lit(365.25)).alias("years"),
    )
    clv = F.col("avg_purchase") * F.col("n") / F.nullif(F.col("years"), F.lit(0))
    return per.agg(rounded(F.avg(clv), 2).alias("clv"), F.count("*").alias("customers"))


@query(
    "a17_named_measures",
    f"""SELECT l_returnflag, l_linestatus, count(*) AS lines, {r("sum(CAST(l_quantity AS DECIMAL(15,2)))", 2)} AS total_quantity,
    {r("CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) / count(*)", 4)} AS avg_price,
    min(l_quantity) AS min_quantity, max(l_quantity) AS max_quantity FROM lineitem GROUP BY 1, 2""",
)
def a17(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("lines"),
        rounded(F.sum(money("l_quantity")), 2).alias("total_quantity"),
        rounded(ratio(F.sum(money("l_extendedprice")), F.count("*")), 4).alias("avg_price"),
        F.min("l_quantity").alias("min_quantity"),
        F.max("l_quantity").alias("max_quantity"),
    )


@query(
    "a18_top_n_and_other",
    f"""WITH b AS (SELECT p_brand, sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS sales FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
    k AS (SELECT *, dense_rank() OVER (ORDER BY sales DESC) AS rk FROM b)
    SELECT CASE WHEN rk <= 5 THEN p_brand ELSE 'Other' END AS brand, {r('sum(sales)', 2)} AS sales FROM k GROUP BY 1""",
)
def a18(t):
    # Sales are summed per part before the join and per brand before ranking: the ranked frame has one row per brand.
    per_part = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum(money("l_extendedprice")).alias("s"))
    brands = per_part.join(t.part, "p_partkey").groupBy("p_brand").agg(F.sum("s").alias("sales"))
    top = brands.select("sales").distinct().orderBy(F.desc("sales")).limit(5).agg(F.min("sales").alias("m")).scalar()
    label = F.when(F.col("sales") >= top, F.col("p_brand")).otherwise(F.lit("Other"))
    return brands.groupBy(label.alias("brand")).agg(rounded(F.sum("sales"), 2).alias("sales"))


@query(
    "a19_scalar_aggregates",
    """SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(DISTINCT user_id) FROM events) AS users,
    (SELECT max(l_shipdate) FROM lineitem) AS last_ship, (SELECT count(*) FROM part WHERE p_size > 25) AS large_parts""",
)
def a19(t):
    return t.orders.agg(F.count("*").alias("orders")).select(
        "orders",
        t.events.agg(F.countDistinct("user_id").alias("v")).scalar().alias("users"),
        t.lineitem.agg(F.max("l_shipdate").alias("v")).scalar().alias("last_ship"),
        t.part.where(F.col("p_size") > 25).agg(F.count("*").alias("v")).scalar().alias("large_parts"),
    )


@query("a20_distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_suppkey FROM lineitem")
def a20(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey").distinct()


@query(
    "a21_opening_window_roi",
    f"""SELECT franchise, {r('sum(gross_usd)', 2)} AS opening_gross,
    {r('CAST(sum(gross_usd) AS DOUBLE) / nullif(CAST(max(budget) AS DOUBLE), 0) * 100', 2)} AS roi_pct
    FROM box JOIN titles USING (title_id) JOIN (SELECT franchise AS f, sum(budget_usd) AS budget FROM titles GROUP BY 1) b ON b.f = franchise
    WHERE report_date BETWEEN release_date AND release_date + 30 GROUP BY franchise""",
)
def a21(t):
    dim = domain.titles(t)
    budgets = dim.groupBy("franchise").agg(F.sum("budget_usd").alias("budget"))
    opening = domain.box_office(t).join(domain.small_titles(t).select("title_id", "franchise", "release_date"), "title_id")
    opening = opening.where(F.col("report_date").between(F.col("release_date"), F.date_add("release_date", 30)))
    gross = opening.groupBy("franchise").agg(F.sum("gross_usd").alias("gross"))
    return gross.join(budgets, "franchise").select(
        "franchise", rounded("gross", 2).alias("opening_gross"), rounded(ratio("gross", "budget") * 100, 2).alias("roi_pct")
    )


@query(
    "a22_having_with_empty_groups",
    f"""SELECT c_custkey, {r(f'coalesce(sum({DEC.format("value")}), 0)', 2)} AS value_total FROM customer
    LEFT JOIN events ON user_id = c_custkey AND event_type = 'purchase' GROUP BY 1 HAVING coalesce(sum({DEC.format("value")}), 0) < 100""",
)
def a22(t):
    bought = t.events.where(F.col("event_type") == "purchase").groupBy(F.col("user_id").alias("c_custkey"))
    sums = bought.agg(F.sum(money("value")).alias("v"))
    all_customers = t.customer.select("c_custkey").join(sums, "c_custkey", "left").withColumn("v", F.coalesce("v", F.lit(0)))
    return all_customers.where(F.col("v") < 100).select("c_custkey", rounded("v", 2).alias("value_total"))
