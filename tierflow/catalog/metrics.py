"""The semantic model of the given tables, and queries through it."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierflow.catalog import query
from tierflow.catalog.sqltext import r
from tierflow.functions.columns import calendar_date, money, ratio, rounded
from tierflow.operators import joining
from tierflow.plans.semantic import Derived, Dimension, Fact, Metric, Model, Relationship, Table, WindowMetric
from tierflow.plans.semantic import query as ask


def price():
    return money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))


def home_nation(t):
    return t.nation.select(F.col("n_nationkey"), F.col("n_name"), F.col("n_regionkey"))


MODEL = Model(
    tables={
        "lines": Table(lambda t: t.lineitem, ("l_orderkey", "l_linenumber")),
        "orders": Table(lambda t: t.orders, ("o_orderkey",)),
        "customers": Table(lambda t: t.customer, ("c_custkey",), ("buyers",)),
        "nations": Table(home_nation, ("n_nationkey",)),
        "regions": Table(lambda t: t.region, ("r_regionkey",)),
        "parts": Table(lambda t: t.part, ("p_partkey",), ("titles",)),
    },
    relationships=[
        Relationship("lines", "l_orderkey", "orders", "o_orderkey"),
        Relationship("lines", "l_partkey", "parts", "p_partkey"),
        Relationship("orders", "o_custkey", "customers", "c_custkey"),
        Relationship("customers", "c_nationkey", "nations", "n_nationkey"),
        Relationship("nations", "n_regionkey", "regions", "r_regionkey"),
    ],
    dimensions={
        "brand": Dimension("parts", lambda: F.col("p_brand"), ("franchise",)),
        "region": Dimension("regions", lambda: F.col("r_name"), ("market",)),
        "segment": Dimension("customers", lambda: F.col("c_mktsegment")),
        "order_year": Dimension("orders", lambda: F.year("o_orderdate").cast("bigint")),
        "order_month": Dimension("orders", lambda: calendar_date("o_orderdate", "month")),
        "ship_day": Dimension("lines", lambda: F.col("l_shipdate").cast("date")),
        "ship_year": Dimension("lines", lambda: F.year("l_shipdate").cast("bigint")),
        "priority": Dimension("orders", lambda: F.col("o_orderpriority")),
        "line_status": Dimension("lines", lambda: F.col("l_linestatus")),
        "order_key": Dimension("lines", lambda: F.col("l_orderkey")),
    },
    facts={
        "net_price": Fact("lines", lambda: rounded(price(), 4)),
        "quantity": Fact("lines", lambda: F.col("l_quantity")),
    },
    metrics={
        "revenue": Metric("lines", lambda: F.sum(price()), synonyms=("total revenue",)),
        "units": Metric("lines", lambda: F.sum(money("l_quantity")), synonyms=("total quantity",)),
        "order_count": Metric("lines", lambda: F.countDistinct("l_orderkey")),
        "order_total": Metric("orders", lambda: F.sum(money("o_totalprice"))),
        "orders_placed": Metric("orders", lambda: F.count("*")),
        "avg_customer_value": Metric(
            "orders",
            lambda: F.avg(F.col("customer_total").cast("double")),
            per=("o_custkey",),
            inner={"customer_total": lambda: F.sum(money("o_totalprice"))},
        ),
        "revenue_per_unit": Derived(("revenue", "units"), lambda: ratio("revenue", "units")),
        "avg_7_days": WindowMetric(
            "units", ("ship_day", "ship_year"), "ship_day",
            lambda m, w: F.sum(m).over(w.rangeBetween(-6, 0)).cast("double") / F.count("*").over(w.rangeBetween(-6, 0)),
            order_expr=lambda: F.unix_date("ship_day"),
        ),
        "units_30_ago": WindowMetric("units", ("ship_day", "ship_year"), "ship_day", lambda m, w: F.lag(m, 30).over(w)),
        "running_units": WindowMetric(
            "units", ("ship_day", "ship_year"), "ship_day", lambda m, w: F.sum(m).over(w.rowsBetween(W.unboundedPreceding, 0))
        ),
    },
)

NET = "CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"
JOINED = """lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN part ON l_partkey = p_partkey"""


@query(
    "m1_dimension_values",
    """SELECT DISTINCT c_mktsegment AS segment, r_name AS region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def m1(t):
    return ask(MODEL, t, ["segment", "market"])


@query(
    "m2_join_only_when_needed",
    f"SELECT l_linestatus AS line_status, {r(f'sum({NET})', 2)} AS revenue FROM lineitem GROUP BY 1",
)
def m2(t):
    return ask(MODEL, t, ["line_status"], ["revenue"]).withColumn("revenue", rounded("revenue", 2))


@query(
    "m3_metrics_by_dimensions",
    f"""SELECT p_brand AS brand, r_name AS region, year(o_orderdate) AS order_year, {r(f'sum({NET})', 2)} AS revenue,
    count(DISTINCT l_orderkey) AS order_count FROM {JOINED} WHERE r_name IN ('ASIA', 'EUROPE') GROUP BY 1, 2, 3""",
)
def m3(t):
    found = ask(
        MODEL, t, ["brand", "region", "order_year"], ["revenue", "order_count"],
        where=lambda: F.col("region").isin("ASIA", "EUROPE"),
    )
    return found.withColumn("revenue", rounded("revenue", 2))


ORDERED = """orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey"""


@query(
    "m3_two_grains",
    f"""WITH a AS (SELECT c_mktsegment AS segment, r_name AS region, sum({NET}) AS revenue, count(DISTINCT l_orderkey) AS order_count FROM {JOINED} GROUP BY 1, 2),
    b AS (SELECT c_mktsegment AS segment, r_name AS region, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS order_total, count(*) AS orders_placed FROM {ORDERED} GROUP BY 1, 2)
    SELECT coalesce(a.segment, b.segment) AS segment, coalesce(a.region, b.region) AS region, {r('revenue', 2)} AS revenue, order_count,
    {r('order_total', 2)} AS order_total, orders_placed
    FROM a FULL JOIN b ON a.segment IS NOT DISTINCT FROM b.segment AND a.region IS NOT DISTINCT FROM b.region""",
)
def m3_two(t):
    found = ask(MODEL, t, ["segment", "region"], ["revenue", "order_count", "order_total", "orders_placed"])
    return found.withColumns({c: rounded(c, 2) for c in ("revenue", "order_total")})


@query(
    "m3_ordered_and_limited",
    f"""SELECT p_brand AS brand, {r(f'sum({NET})', 2)} AS revenue FROM {JOINED} WHERE year(o_orderdate) = 1998 GROUP BY 1
    ORDER BY sum({NET}) DESC, brand LIMIT 5""",
)
def m3_top(t):
    top = ask(
        MODEL, t, ["franchise"], ["total revenue"], where=lambda: F.col("order_year") == 1998, where_dimensions=["order_year"],
        order_by=[F.desc("revenue"), F.asc("brand")], limit=5,
    )
    return top.withColumn("revenue", rounded("revenue", 2))


@query(
    "m4_facts_row_level",
    f"""SELECT o_orderpriority AS priority, l_orderkey AS order_key, {r(NET, 4)} AS net_price, l_quantity AS quantity
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
)
def m4(t):
    return ask(MODEL, t, ["priority", "order_key"], facts=["net_price", "quantity"])


@query(
    "m5_aliases",
    f"SELECT c_mktsegment AS \"Segment\", count(*) AS \"Orders\" FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1",
)
def m5(t):
    return ask(MODEL, t, ["segment"], ["orders_placed"], aliases={"segment": "Segment", "orders_placed": "Orders"})


@query(
    "m6_window_metrics",
    f"""WITH d AS (SELECT CAST(l_shipdate AS DATE) AS ship_day, year(l_shipdate) AS ship_year, l_linestatus AS line_status, sum(CAST(l_quantity AS DECIMAL(15,2))) AS units
      FROM lineitem GROUP BY 1, 2, 3)
    SELECT ship_day, ship_year, line_status, CAST(units AS DOUBLE) AS units, {r('CAST(sum(units) OVER (PARTITION BY line_status ORDER BY ship_day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS DOUBLE) / count(*) OVER (PARTITION BY line_status ORDER BY ship_day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)', 4)} AS avg_7_days,
    CAST(lag(units, 30) OVER (PARTITION BY line_status ORDER BY ship_day) AS DOUBLE) AS units_30_ago,
    CAST(sum(units) OVER (PARTITION BY line_status ORDER BY ship_day) AS DOUBLE) AS running_units FROM d""",
)
def m6(t):
    found = ask(MODEL, t, ["ship_day", "ship_year", "line_status"], ["units", "avg_7_days", "units_30_ago", "running_units"])
    return found.withColumns({
        "units": F.col("units").cast("double"),
        "avg_7_days": rounded("avg_7_days", 4),
        "units_30_ago": F.col("units_30_ago").cast("double"),
        "running_units": F.col("running_units").cast("double"),
    })


@query(
    "m7_nested_and_derived",
    f"""SELECT segment, {r('sum(total)', 2)} AS order_total, {r('avg(CAST(total AS DOUBLE))', 2)} AS avg_customer_value FROM
    (SELECT c_mktsegment AS segment, o_custkey, sum(CAST(o_totalprice AS DECIMAL(15,2))) AS total FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) GROUP BY 1""",
)
def m7(t):
    found = ask(MODEL, t, ["segment"], ["order_total", "avg_customer_value"])
    return found.withColumns({c: rounded(c, 2) for c in ("order_total", "avg_customer_value")})


@query(
    "m7_derived_ratio",
    f"""SELECT p_brand AS brand, {r(f'CAST(sum({NET}) AS DOUBLE) / nullif(CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) AS DOUBLE), 0)', 4)} AS revenue_per_unit FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def m7_ratio(t):
    return ask(MODEL, t, ["brand"], ["revenue_per_unit"]).withColumn("revenue_per_unit", rounded("revenue_per_unit", 4))


@query(
    "d21_metric_equals_direct",
    """WITH a AS (SELECT c_mktsegment AS segment, count(*) AS metric FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1),
    b AS (SELECT c_mktsegment AS segment, CAST(sum(n) AS BIGINT) AS direct FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) JOIN customer ON o_custkey = c_custkey GROUP BY 1)
    SELECT coalesce(a.segment, b.segment) AS segment, metric, direct, CASE WHEN metric = direct THEN 'PASS' ELSE 'FAIL' END AS status
    FROM a FULL JOIN b ON a.segment = b.segment""",
)
def d21(t):
    metric = ask(MODEL, t, ["segment"], ["orders_placed"], aliases={"orders_placed": "metric"})
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    direct = per_customer.join(t.customer, "c_custkey").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.sum("n").alias("direct"))
    both = joining.match_indicator(metric, direct, ["segment"])
    same = (F.col("_merge") == "both") & (F.col("metric") == F.col("direct"))
    return both.select("segment", "metric", "direct", F.when(same, "PASS").otherwise("FAIL").alias("status"))
