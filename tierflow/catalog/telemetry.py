"""Telemetry questions on the events and orders tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.catalog import query
from tierflow.catalog.sqltext import r
from tierflow.functions.columns import hour_of, money, newest, ratio, rounded
from tierflow.operators import joining, picking, telemetry

MEAN = "CAST(sum(CAST(value AS DECIMAL(15,2))) AS DOUBLE) / count(*)"


@query(
    "l1_error_rate_by_hour",
    f"""SELECT date_trunc('hour', ts) AS hour, count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) AS total,
    {r("count(*) FILTER (WHERE event_type = 'error') * 100.0 / count(*)", 4)} AS error_rate_percent FROM events GROUP BY 1""",
)
def l1(t):
    errors = F.count_if(F.col("event_type") == "error")
    return t.events.groupBy(hour_of("ts").alias("hour")).agg(
        errors.alias("errors"), F.count("*").alias("total"), rounded(ratio(errors * 100, F.count("*")), 4).alias("error_rate_percent")
    )


@query(
    "l1_errors_with_samples",
    """SELECT date_trunc('hour', ts) AS hour, count(*) AS error_count, array_to_string(list_slice(list_sort(list(DISTINCT props)), 1, 10), '|') AS sample_messages
    FROM events WHERE event_type = 'error' GROUP BY 1""",
)
def l1_samples(t):
    errors = t.events.where(F.col("event_type") == "error").select(hour_of("ts").alias("hour"), "props")
    counts = errors.groupBy("hour").agg(F.count("*").alias("error_count"))
    few = picking.top_n(errors.distinct(), ["hour"], [F.asc("props")], 10)
    samples = few.groupBy("hour").agg(F.array_join(F.array_sort(F.collect_list("props")), "|").alias("sample_messages"))
    return counts.join(samples, "hour")


@query(
    "l2_usage_by_day",
    f"""SELECT CAST(ts AS DATE) AS usage_day, event_type, CAST(props->>'$.k' AS BIGINT) % 10 AS model, count(*) AS invocations,
    CAST(sum(CAST(props->>'$.k' AS BIGINT)) AS BIGINT) AS total_tokens, {r(MEAN, 4)} AS avg_latency FROM events GROUP BY 1, 2, 3""",
)
def l2(t):
    parsed = t.events.select(
        F.col("ts").cast("date").alias("usage_day"), "event_type", F.from_json("props", "k bigint").getField("k").alias("tokens"), "value"
    )
    return parsed.groupBy("usage_day", "event_type", (F.col("tokens") % 10).alias("model")).agg(
        F.count("*").alias("invocations"),
        F.sum("tokens").alias("total_tokens"),
        rounded(ratio(F.sum(money("value")), F.count("*")), 4).alias("avg_latency"),
    )


RUN_SQL = "(SELECT event_id, event_type AS job, CASE WHEN user_id % 2 = 0 THEN 'FULL' ELSE 'FOCUSED' END AS mode, value FROM events)"
STATS_SQL = f"""SELECT job, mode, count(*) AS sample_size, avg(value) AS avg_seconds, min(value) AS min_seconds, max(value) AS max_seconds,
  stddev_pop(value) AS stddev_seconds, list_sort(list(value)) AS sorted FROM {RUN_SQL} GROUP BY 1, 2"""


def runs(t):
    mode = F.when(F.col("user_id") % 2 == 0, "FULL").otherwise("FOCUSED")
    return t.events.select("event_id", F.col("event_type").alias("job"), mode.alias("mode"), "value")


@query(
    "l3_run_statistics",
    f"""SELECT job, mode, sample_size, {r('avg_seconds', 4)} AS avg_seconds, min_seconds, max_seconds, {r('stddev_seconds', 4)} AS stddev_seconds,
    sorted[sample_size // 2 + 1] AS median_seconds, sorted[CAST(floor(sample_size * 0.95) AS INTEGER) + 1] AS p95_seconds FROM ({STATS_SQL})""",
)
def l3(t):
    stats = telemetry.run_statistics(runs(t), ["job", "mode"], "value")
    return stats.withColumns({c: rounded(c, 4) for c in ("avg_seconds", "stddev_seconds")})


@query(
    "l3_recent_baseline",
    f"""WITH x AS (SELECT event_type AS job, user_id, value FROM events WHERE ts >= (SELECT max(ts) - INTERVAL 7 DAY FROM events)),
    s AS (SELECT job, user_id, count(*) AS sample_size, avg(value) AS avg_seconds, list_sort(list(value)) AS sorted FROM x GROUP BY 1, 2)
    SELECT job, user_id, sample_size, {r('avg_seconds', 4)} AS avg_seconds, sorted[sample_size // 2 + 1] AS median_seconds FROM s WHERE sample_size >= 5""",
)
def l3_recent(t):
    runs_ = t.events.select(F.col("event_type").alias("job"), "user_id", "value", "ts")
    since = newest(t.events, "ts", lambda m: m - F.expr("INTERVAL 7 DAYS"))
    stats = telemetry.run_statistics(runs_, ["job", "user_id"], "value", "ts", since, least=5)
    return stats.select("job", "user_id", "sample_size", rounded("avg_seconds", 4).alias("avg_seconds"), "median_seconds")


@query(
    "l4_against_baseline",
    f"""SELECT event_id, job, mode, {r('value - avg_seconds', 2)} AS delta_seconds, {r('(value - avg_seconds) * 100 / avg_seconds', 1)} AS delta_percent,
    CASE WHEN abs(value - avg_seconds) <= stddev_seconds THEN 'within_normal' WHEN abs(value - avg_seconds) <= 2 * stddev_seconds THEN 'slightly_outside' ELSE 'significantly_outside' END AS status
    FROM {RUN_SQL} JOIN (SELECT * EXCLUDE (sorted) FROM ({STATS_SQL})) USING (job, mode)""",
)
def l4(t):
    keys = ["job", "mode"]
    baseline = runs(t).groupBy(*keys).agg(F.avg("value").alias("avg_seconds"), F.stddev_pop("value").alias("stddev_seconds"))
    found = telemetry.against_baseline(runs(t), joining.of_known_size(baseline), keys, "value")
    return found.select(
        "event_id", *keys, rounded("delta_seconds", 2).alias("delta_seconds"), rounded("delta_percent", 1).alias("delta_percent"), "status"
    )


@query(
    "l5_health_class",
    f"""WITH h AS (SELECT user_id, max(ts) AS last_commit, (epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(ts))) / 60000000.0 AS minutes FROM events GROUP BY 1)
    SELECT user_id, last_commit, {r('minutes', 3)} AS minutes, CASE WHEN minutes > 600 THEN 'STALLED' WHEN minutes > 300 THEN 'WARNING' ELSE 'HEALTHY' END AS channel_status FROM h""",
)
def l5(t):
    newest = t.events.agg(F.max("ts").alias("m")).scalar()
    # Event gaps are hours here, so the classes are scaled from minutes.
    return telemetry.health(t.events, "user_id", "ts", newest, 300, 600).withColumn("minutes", rounded("minutes", 3))


@query(
    "l6_unit_costs",
    f"""SELECT o_orderpriority, count(*) AS items, {r('sum(CAST(o_totalprice AS DECIMAL(15,2)))', 2)} AS total_cost, CAST(sum(o_custkey) AS BIGINT) AS total_units,
    {r('CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) / nullif(CAST(sum(o_custkey) AS DOUBLE), 0)', 4)} AS cost_per_unit,
    CASE WHEN CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) / nullif(CAST(sum(o_custkey) AS DOUBLE), 0) > 340 THEN 'WARNING' ELSE 'OK' END AS efficiency_flag
    FROM orders GROUP BY 1""",
)
def l6(t):
    found = telemetry.unit_costs(t.orders, "o_orderpriority", money("o_totalprice"), F.col("o_custkey"), 340.0)
    return found.withColumns({"total_cost": rounded("total_cost", 2), "cost_per_unit": rounded("cost_per_unit", 4)})


@query("l7_slow_items", "SELECT event_id, user_id, event_type, value FROM events WHERE value > 100")
def l7(t):
    return t.events.where(F.col("value") > 100).select("event_id", "user_id", "event_type", "value").orderBy(F.desc("value"))


@query("l7_event_inventory", "SELECT event_type, count(*) AS events, min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY 1")
def l7_inventory(t):
    return t.events.groupBy("event_type").agg(
        F.count("*").alias("events"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen")
    )
