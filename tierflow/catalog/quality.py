"""Quality metrics, expectations and tests on the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierflow.catalog import query
from tierflow.catalog.incremental import VERSIONS_SQL, customer_versions
from tierflow.catalog.sqltext import r
from tierflow.catalog.windows import MONTHS_SQL, change_pct, change_sql, monthly_orders
from tierflow.functions.columns import hour_of, money, ratio, rounded, sha256
from tierflow.operators import checks, joining
from tierflow.operators.checks import Expectation, measure
from tierflow.plans import domain, layers

SCORE_SQL = "count(*) FILTER (WHERE imdb_score < {lo} OR imdb_score > {hi} {null})"


@query(
    "d1_range_violations",
    """SELECT 'titles' AS table_name, 'null_is_violation' AS metric, CAST(count(*) FILTER (WHERE imdb_score < 1 OR imdb_score > 9 OR imdb_score IS NULL) AS DOUBLE) AS value FROM titles_raw
    UNION ALL SELECT 'titles', 'null_is_fine', CAST(count(*) FILTER (WHERE imdb_score < 1 OR imdb_score > 9) AS DOUBLE) FROM titles_raw""",
)
def d1(t):
    return measure(domain.titles_raw(t), "titles", {
        "null_is_violation": checks.out_of_range("imdb_score", 1, 9),
        "null_is_fine": checks.out_of_range("imdb_score", 1, 9, null_is_violation=False),
    })


@query(
    "d2_hash_format",
    """SELECT 'fans' AS table_name, 'bad_hash' AS metric, CAST(count(*) FILTER (WHERE email IS NULL) AS DOUBLE) AS value FROM fans
    UNION ALL SELECT 'fans', 'bad_plain', CAST(count(*) AS DOUBLE) FROM fans""",
)
def d2(t):
    fans = domain.fan_events(t).withColumn("email_hash", sha256("email"))
    return measure(fans, "fans", {
        "bad_hash": checks.bad_format("email_hash", checks.HASH_FORMAT),
        "bad_plain": checks.bad_format("email", checks.HASH_FORMAT),
    })


@query(
    "d3_code_format",
    """SELECT 'nation' AS table_name, 'bad_code' AS metric, CAST(count(*) FILTER (WHERE NOT regexp_matches(country_code, '^[A-Z]{3}$')) AS DOUBLE) AS value FROM places
    UNION ALL SELECT 'nation', 'bad_name', CAST(count(*) FILTER (WHERE NOT regexp_matches(n_name, '^[A-Z]{3}$')) AS DOUBLE) FROM places""",
)
def d3(t):
    return measure(domain.places(t), "nation", {
        "bad_code": checks.bad_format("country_code", checks.CODE_FORMAT),
        "bad_name": checks.bad_format("n_name", checks.CODE_FORMAT),
    })


@query(
    "d4_negative_values",
    "SELECT 'customer' AS table_name, 'negative_balance' AS metric, CAST(count(*) FILTER (WHERE c_acctbal < 0) AS DOUBLE) AS value FROM customer",
)
def d4(t):
    return measure(t.customer, "customer", {"negative_balance": checks.negatives("c_acctbal")})


@query(
    "d5_null_count",
    "SELECT 'fans' AS table_name, 'null_fan_id' AS metric, CAST(count(*) FILTER (WHERE fan_id IS NULL) AS DOUBLE) AS value FROM fans",
)
def d5(t):
    return measure(domain.fan_activity(t), "fans", {"null_fan_id": checks.nulls("fan_id")})


@query(
    "d6_duplicate_count",
    """SELECT 'fans' AS table_name, 'duplicate_fan_id' AS metric, CAST(count(*) - count(DISTINCT fan_id) AS DOUBLE) AS value FROM fans""",
)
def d6(t):
    return measure(domain.fan_activity(t), "fans", {"duplicate_fan_id": checks.duplicates("fan_id")})


@query(
    "d7_unique_rows_freshness",
    f"""SELECT event_type, count(DISTINCT user_id) AS unique_users, count(*) AS rows,
    {r("(epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(ts))) / 60000000.0", 3)} AS minutes_old FROM events GROUP BY 1""",
)
def d7(t):
    newest = F.unix_micros(t.events.agg(F.max("ts").alias("m")).scalar().cast("timestamp"))
    per_type = t.events.groupBy("event_type").agg(
        F.countDistinct("user_id").alias("unique_users"), F.count("*").alias("rows"), F.max("ts").alias("last")
    )
    age = (newest - F.unix_micros(F.col("last").cast("timestamp"))) / F.lit(60_000_000.0)
    return per_type.select("event_type", "unique_users", "rows", rounded(age, 3).alias("minutes_old"))


@query(
    "d8_expectations",
    """WITH m AS (SELECT CAST(count(*) AS DOUBLE) AS rows, CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS DOUBLE) AS pending,
      CAST(count(*) - count(DISTINCT o_orderkey) AS DOUBLE) AS dup, CAST(count(*) FILTER (WHERE o_custkey IS NULL) AS DOUBLE) AS no_customer FROM orders)
    SELECT 'orders' AS table_name, 'no_customer' AS metric, '<' AS comparison, no_customer AS value, no_customer < 100 AS passed FROM m
    UNION ALL SELECT 'orders', 'pending', '<', pending, pending < rows * 0.05 FROM m
    UNION ALL SELECT 'orders', 'rows', 'between', rows, rows BETWEEN 1000 AND 100000 FROM m
    UNION ALL SELECT 'orders', 'dup', '=', dup, dup = 0 FROM m UNION ALL SELECT 'orders', 'rows', '>=', rows, rows >= 10 FROM m""",
)
def d8(t):
    metrics = {
        "rows": F.count("*"),
        "pending": F.count_if(F.col("o_orderstatus") == "P"),
        "dup": checks.duplicates("o_orderkey"),
        "no_customer": checks.nulls("o_custkey"),
    }
    rules = [
        Expectation("no_customer", "<", 100),
        Expectation("pending", "<", 0.05, of="rows"),
        Expectation("rows", "between", 1000, 100000),
        Expectation("dup", "=", 0),
        Expectation("rows", ">=", 10),
    ]
    return checks.expect(t.orders, "orders", metrics, rules)


@query(
    "d9_daily_revenue_in_range",
    f"""SELECT CAST(o_orderdate AS DATE) AS day, {r('sum(CAST(o_totalprice AS DECIMAL(15,2)))', 2)} AS revenue,
    sum(CAST(o_totalprice AS DECIMAL(15,2))) BETWEEN 1000000 AND 10000000 AS in_range FROM orders GROUP BY 1""",
)
def d9(t):
    total = F.sum(money("o_totalprice"))
    return t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        rounded(total, 2).alias("revenue"), total.between(1_000_000, 10_000_000).alias("in_range")
    )


@query(
    "d10_header_equals_lines",
    f"""SELECT o_orderkey, {r('l.line_total', 2)} AS line_total FROM orders LEFT JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS line_total FROM lineitem GROUP BY 1) l
    ON l_orderkey = o_orderkey WHERE abs(CAST(o_totalprice AS DECIMAL(15,2)) - l.line_total) > 1000
    UNION ALL SELECT o_orderkey, 0.0 FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) AND abs(o_totalprice) > 1000""",
)
def d10(t):
    headers = t.orders.select("o_orderkey", money("o_totalprice").alias("total"))
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    bad = checks.header_mismatch(headers, lines, "o_orderkey", "total", money("l_extendedprice"), 1000.0)
    return bad.select("o_orderkey", rounded("line_total", 2).alias("line_total"))


@query(
    "d11_orphan_counts",
    """SELECT 'customer_without_events' AS check_name, count(*) AS orphans FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)
    UNION ALL SELECT 'lines_without_order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'orders_without_lines', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def d11(t):
    parts = [
        ("customer_without_events", checks.orphan_count(t.customer, t.events, "c_custkey", "user_id")),
        ("lines_without_order", checks.orphan_count(t.lineitem, t.orders, "l_orderkey", "o_orderkey")),
        ("orders_without_lines", checks.orphan_count(t.orders, t.lineitem, "o_orderkey", "l_orderkey")),
    ]
    return reduce(
        lambda a, b: a.unionByName(b), [f.select(F.lit(name).alias("check_name"), "orphans") for name, f in parts]
    )


@query(
    "d12_quality_dashboard",
    """SELECT *, CASE WHEN value = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
    SELECT 'dim_titles' AS table_name, 'valid_imdb_score' AS metric, CAST(count(*) FILTER (WHERE imdb_score < 0 OR imdb_score > 10 OR imdb_score IS NULL) AS DOUBLE) AS value FROM titles
    UNION ALL SELECT 'dim_fans', 'valid_country_code', CAST(count(*) FILTER (WHERE country_code IS NULL OR NOT regexp_matches(country_code, '^[A-Z]{3}$')) AS DOUBLE) FROM dim_fans
    UNION ALL SELECT 'dim_fans', 'valid_email_hash', CAST(count(*) FILTER (WHERE email_hash IS NULL OR NOT regexp_matches(email_hash, '^[a-f0-9]{64}$')) AS DOUBLE) FROM dim_fans
    UNION ALL SELECT 'dim_fans', 'null_count', CAST(count(*) FILTER (WHERE fan_id IS NULL) AS DOUBLE) FROM dim_fans
    UNION ALL SELECT 'dim_fans', 'duplicate_count', CAST(count(*) - count(DISTINCT fan_id) AS DOUBLE) FROM dim_fans
    UNION ALL SELECT 'fact_daily', 'positive_revenue', CAST(count(*) FILTER (WHERE total_gross_usd < 0) AS DOUBLE) FROM fact)""",
)
def d12(t):
    parts = [
        measure(domain.titles(t), "dim_titles", {"valid_imdb_score": checks.out_of_range("imdb_score", 0, 10)}),
        measure(layers.dim_fans(t), "dim_fans", {
            "valid_country_code": checks.bad_format("country_code", checks.CODE_FORMAT),
            "valid_email_hash": checks.bad_format("email_hash", checks.HASH_FORMAT),
            "null_count": checks.nulls("fan_id"),
            "duplicate_count": checks.duplicates("fan_id"),
        }),
        measure(layers.fact_daily(t), "fact_daily", {"positive_revenue": checks.negatives("total_gross_usd")}),
    ]
    status = F.when(F.col("value") == 0, "PASS").otherwise("FAIL")
    return reduce(lambda a, b: a.unionByName(b), parts).withColumn("status", status)


@query(
    "d13_generic_tests",
    """SELECT 'unique' AS test, (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)) AS failing
    UNION ALL SELECT 'not_null', (SELECT count(*) FROM fans WHERE fan_id IS NULL)
    UNION ALL SELECT 'accepted_values', (SELECT count(DISTINCT o_orderpriority) FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))
    UNION ALL SELECT 'relationships', (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events))""",
)
def d13(t):
    tests = [
        ("unique", checks.unique(t.lineitem, "l_orderkey")),
        ("not_null", checks.not_null(domain.fan_activity(t), "fan_id")),
        ("accepted_values", checks.accepted_values(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])),
        ("relationships", checks.relationships(t.customer, "c_custkey", t.events, "user_id")),
    ]
    rows = [f.agg(F.count("*").alias("failing")).select(F.lit(n).alias("test"), "failing") for n, f in tests]
    return reduce(lambda a, b: a.unionByName(b), rows)


@query(
    "d14_no_loss_between_layers",
    """SELECT (SELECT count(DISTINCT fan_id) FROM fans) AS raw_count, (SELECT count(*) FROM dim_fans) AS dim_count,
    (SELECT count(*) FROM dim_fans) = 0 OR (SELECT count(*) FROM dim_fans) > (SELECT count(DISTINCT fan_id) FROM fans) AS failed""",
)
def d14(t):
    raw = domain.fan_activity(t).agg(F.countDistinct("fan_id").alias("raw_count"))
    kept = layers.dim_fans(t).agg(F.countDistinct("fan_id").alias("n")).scalar()
    both = raw.select("raw_count", kept.alias("dim_count"))
    return both.withColumn("failed", (F.col("dim_count") == 0) | (F.col("dim_count") > F.col("raw_count")))


@query(
    "d15_routing_complete",
    """WITH n AS (SELECT count(*) AS n, count(*) FILTER (WHERE account_type = 'VERIFIED') AS v, count(*) FILTER (WHERE account_type = 'GUEST') AS g FROM fans)
    SELECT 'routed_equals_input' AS check_name, v + g = n AS passed FROM n UNION ALL SELECT 'verified_populated', v > 0 FROM n UNION ALL SELECT 'guest_populated', g > 0 FROM n""",
)
def d15(t):
    events = domain.fan_activity(t)
    verified, guest = layers.route(events)
    sides = [f.agg(F.count("*").alias("n")).scalar() for f in (verified, guest)]
    counts = events.agg(F.count("*").alias("n")).select("n", sides[0].alias("v"), sides[1].alias("g"))
    rows = [
        ("routed_equals_input", F.col("v") + F.col("g") == F.col("n")),
        ("verified_populated", F.col("v") > 0),
        ("guest_populated", F.col("g") > 0),
    ]
    return counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check_name"), c.alias("passed")) for n, c in rows])))


@query(
    "d16_version_history_valid",
    f"""WITH {VERSIONS_SQL} SELECT (SELECT count(*) FROM (SELECT o_custkey FROM versions WHERE nxt IS NULL GROUP BY 1 HAVING count(*) <> 1)) AS several_current,
    (SELECT count(*) FROM versions WHERE nxt < valid_from) AS reversed""",
)
def d16(t):
    versions = customer_versions(t)
    several = versions.where("is_current").groupBy("o_custkey").agg(F.count("*").alias("n")).where(F.col("n") != 1)
    several_n = several.agg(F.count("*").alias("n")).scalar()
    reversed_rows = versions.agg(F.count_if(F.col("valid_to") < F.col("valid_from")).alias("reversed"))
    return reversed_rows.select(several_n.alias("several_current"), "reversed")


PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_suppkey"]


def profile_sql(where=""):
    part = """SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, min(CAST({c} AS DOUBLE)) + CAST(0 AS DOUBLE) AS min_value, max(CAST({c} AS DOUBLE)) AS max_value,
      (SELECT CAST({c} AS DOUBLE) FROM lineitem {w} GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS most_common FROM lineitem {w}"""
    return " UNION ALL ".join(part.format(c=c, w=where) for c in PROFILED)


@query("d17_column_profile", profile_sql())
def d17(t):
    return checks.profile(t.lineitem, PROFILED)


@query(
    "d18_learned_thresholds",
    f"""WITH p AS ({profile_sql("WHERE l_shipdate < TIMESTAMP '1996-01-01'")}), n AS ({" UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01'" for c in PROFILED)})
    SELECT "column", {r('min_value * 0.9', 4)} AS low, {r('max_value * 0.95', 4)} AS high, count(*) FILTER (WHERE v < CAST(min_value * CAST(0.9 AS DOUBLE) AS DOUBLE) OR v > CAST(max_value * CAST(0.95 AS DOUBLE) AS DOUBLE)) AS violations
    FROM n JOIN p ON col = "column" GROUP BY "column", min_value, max_value""",
)
def d18(t):
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    bounds = checks.learned_bounds(checks.profile(t.lineitem.where(F.col("l_shipdate") < cut), PROFILED), 0.9, 0.95)
    found = checks.bound_violations(t.lineitem.where(F.col("l_shipdate") >= cut), PROFILED, bounds)
    return found.withColumns({"low": rounded("low", 4), "high": rounded("high", 4)})


@query(
    "d19_drift",
    f"""WITH a AS (SELECT avg(value) AS mean, median(value) AS median, stddev_samp(value) AS stddev FROM events WHERE ts < TIMESTAMP '2024-01-08'),
    b AS (SELECT avg(value) AS mean, median(value) AS median, stddev_samp(value) AS stddev FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'),
    u AS (SELECT 'mean' AS statistic, a.mean AS x, b.mean AS y FROM a, b UNION ALL SELECT 'median', a.median, b.median FROM a, b UNION ALL SELECT 'stddev', a.stddev, b.stddev FROM a, b)
    SELECT statistic, {r('abs((y - x) / x)', 4)} AS shift, abs((y - x) / x) > 0.1 AS drifted FROM u""",
)
def d19(t):
    day = lambda text: F.lit(text).cast("timestamp_ntz")
    first = t.events.where(F.col("ts") < day("2024-01-08"))
    second = t.events.where((F.col("ts") >= day("2024-01-08")) & (F.col("ts") < day("2024-01-15")))
    found = checks.drift(first, second, "value")
    return found.select("statistic", rounded("shift", 4).alias("shift"), "drifted")


def check_results(t):
    """Stored check results: each event is one measurement of its type."""
    return t.events.select(
        F.col("ts").alias("record_ts"), F.col("event_type").alias("table_name"),
        F.concat(F.lit("metric_"), (F.col("user_id") % 3).cast("string")).alias("metric_name"),
        "value", (F.col("value") <= 40).alias("passed"),
    )


@query(
    "d20_failing_results",
    "SELECT ts AS record_ts, event_type AS table_name, 'metric_' || (user_id % 3) AS metric_name, value FROM events WHERE NOT (value <= 40)",
)
def d20_failing(t):
    return check_results(t).where(~F.col("passed")).select("record_ts", "table_name", "metric_name", "value").orderBy(F.desc("record_ts"))


@query(
    "d20_result_trend",
    f"""SELECT date_trunc('hour', ts) AS hour, 'metric_' || (user_id % 3) AS metric_name,
    {r('CAST(sum(CAST(value AS DECIMAL(15,2))) AS DOUBLE) / count(*)', 4)} AS avg_value, min(value) AS min_value, max(value) AS max_value FROM events GROUP BY 1, 2""",
)
def d20_trend(t):
    return check_results(t).groupBy(hour_of("record_ts").alias("hour"), "metric_name").agg(
        rounded(ratio(F.sum(money("value")), F.count("*")), 4).alias("avg_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )


@query(
    "d20_failure_rate",
    f"""SELECT event_type AS table_name, count(*) AS total_checks, count(*) FILTER (WHERE NOT (value <= 40)) AS failures,
    {r('count(*) FILTER (WHERE NOT (value <= 40)) * 100.0 / count(*)', 2)} AS failure_rate_pct FROM events GROUP BY 1""",
)
def d20_rate(t):
    failures = F.count_if(~F.col("passed"))
    return check_results(t).groupBy("table_name").agg(
        F.count("*").alias("total_checks"),
        failures.alias("failures"),
        rounded(ratio(failures * 100, F.count("*")), 2).alias("failure_rate_pct"),
    )


@query(
    "d22_checklist",
    """SELECT 'raw populated' AS check_item, (SELECT count(*) FROM fans) + (SELECT count(*) FROM box) AS row_count, CASE WHEN (SELECT count(*) FROM fans) + (SELECT count(*) FROM box) > 100 THEN 'PASS' ELSE 'FAIL' END AS status
    UNION ALL SELECT 'dimension populated', count(*), CASE WHEN count(*) > 25000 THEN 'PASS' ELSE 'FAIL' END FROM dim_fans
    UNION ALL SELECT 'titles populated', count(*), CASE WHEN count(*) > 10 THEN 'PASS' ELSE 'FAIL' END FROM titles""",
)
def d22(t):
    def n(frame):
        return frame.agg(F.count("*").alias("n")).scalar()

    counts = domain.fan_activity(t).agg(F.count("*").alias("e")).select(
        (F.col("e") + n(domain.box_office(t))).alias("raw"), n(layers.dim_fans(t)).alias("fans"), n(domain.titles(t)).alias("titles")
    )
    items = [("raw populated", "raw", 100), ("dimension populated", "fans", 25000), ("titles populated", "titles", 10)]
    rows = [
        F.struct(
            F.lit(label).alias("check_item"), F.col(c).alias("row_count"),
            F.when(F.col(c) > limit, "PASS").otherwise("FAIL").alias("status"),
        )
        for label, c, limit in items
    ]
    return counts.select(F.inline(F.array(*rows)))


@query(
    "d23_inline_metrics",
    "SELECT count(*) AS rows, count(*) FILTER (WHERE value < 0) AS negatives, count(*) FILTER (WHERE event_type IS NULL) AS missing FROM events",
)
def d23(t):
    from tierflow.session import work_path

    seen = Observation("load")
    watched = t.events.observe(
        seen, F.count("*").alias("rows"), checks.negatives("value").alias("negatives"), checks.nulls("event_type").alias("missing")
    )
    watched.write.parquet(work_path(t.spark, "observed"))
    found = seen.get
    return t.spark.range(1).select(*[F.lit(found[k]).cast("bigint").alias(k) for k in ("rows", "negatives", "missing")])


@query(
    "d24_distribution_shift",
    f"""WITH v AS (SELECT value, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-15') AS n1, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15') AS n2 FROM events GROUP BY 1),
    s AS (SELECT sum(n1) OVER (ORDER BY value) AS c1, sum(n2) OVER (ORDER BY value) AS c2 FROM v), n AS (SELECT CAST(sum(n1) AS DOUBLE) AS n1, CAST(sum(n2) AS DOUBLE) AS n2 FROM v),
    d AS (SELECT max(abs(CAST(c1 AS DOUBLE) / n1 - CAST(c2 AS DOUBLE) / n2)) AS statistic FROM s, n)
    SELECT {r('statistic', 6)} AS statistic, {r("least(greatest(CASE WHEN statistic = 0 THEN 1 WHEN x < 1.18 THEN 1 - sqrt(2 * pi()) / x * (SELECT sum(exp(-(2 * k - 1) * (2 * k - 1) * pi() * pi() / (8 * x * x))) FROM generate_series(1, 40) g(k)) ELSE (SELECT sum(CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * x * x)) FROM generate_series(1, 100) g(k)) END, 0), 1)", 6)} AS p_value FROM (SELECT statistic, sqrt(n1 * n2 / (n1 + n2)) * statistic AS x FROM d, n)""",
)
def d24(t):
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    found = checks.two_sample_ks(t.events.where(F.col("ts") < cut), t.events.where(F.col("ts") >= cut), "value")
    return found.select(rounded("statistic", 6).alias("statistic"), rounded("p_value", 6).alias("p_value"))


@query(
    "d25_metric_sanity",
    f"""WITH {MONTHS_SQL}, c AS (SELECT month, orders < 0 AS negative, {change_sql('orders', 1)} AS mom_pct, {change_sql('orders', 12)} AS yoy_pct FROM f)
    SELECT month, negative, coalesce(abs(mom_pct) < 50, TRUE) AS mom_ok, coalesce(yoy_pct BETWEEN -20 AND 100, TRUE) AS yoy_ok FROM c""",
)
def d25(t):
    w = W.orderBy("month")  # one row per calendar month
    orders = F.col("orders")
    changes = monthly_orders(t).select(
        "month", (orders < 0).alias("negative"),
        change_pct(orders, F.lag("orders", 1).over(w)).alias("mom"), change_pct(orders, F.lag("orders", 12).over(w)).alias("yoy"),
    )
    return changes.select(
        "month", "negative",
        F.coalesce(F.abs("mom") < 50, F.lit(True)).alias("mom_ok"),
        F.coalesce(F.col("yoy").between(-20, 100), F.lit(True)).alias("yoy_ok"),
    )


@query(
    "dt_no_negative_revenue",
    "SELECT title_id, report_date FROM fact WHERE total_gross_usd < 0",
)
def no_negative(t):
    return layers.fact_daily(t).where(F.col("total_gross_usd") < 0).select("title_id", "report_date")


@query(
    "dt_fact_title_integrity",
    "SELECT performance_key FROM fact WHERE title_id NOT IN (SELECT title_id FROM titles)",
)
def integrity(t):
    return joining.orphans(
        layers.fact_daily(t), domain.titles(t).select(F.col("title_id").alias("known_id")), "title_id", "known_id"
    ).select("performance_key")
