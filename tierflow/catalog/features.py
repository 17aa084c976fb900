"""Features, time series, governance, texts and vectors on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.catalog import query
from tierflow.catalog.joins import event_features, order_spine
from tierflow.catalog.sqltext import r
from tierflow.functions import columns
from tierflow.functions.columns import money, rounded
from tierflow.operators import features, governance, ordered, similarity, texts, timeseries
from tierflow.plans import domain


@query(
    "e1_trailing_windows",
    f"""WITH x AS (SELECT user_id, CAST(value AS DECIMAL(15,2)) AS value, date_diff('day', CAST(ts AS DATE), (SELECT CAST(max(ts) AS DATE) FROM events)) AS age, ts FROM events)
    SELECT user_id, count(*) FILTER (WHERE age < 7) AS count_7d, {r('sum(value) FILTER (WHERE age < 7)', 2)} AS sum_7d, count(*) FILTER (WHERE age < 14) AS count_14d,
    {r('sum(value) FILTER (WHERE age < 14)', 2)} AS sum_14d, count(*) AS count_30d, {r('sum(value)', 2)} AS sum_30d,
    {r('CAST(count(*) FILTER (WHERE age < 7) AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0)', 4)} AS velocity, min(age) AS days_since_last FROM x WHERE age < 30 GROUP BY 1""",
)
def e1(t):
    newest = t.events.agg(F.max("ts").cast("date").alias("d")).scalar()
    # The longest look-back as a bound on the raw time, which the scan receives.
    since = columns.newest(t.events, "ts", lambda m: F.date_sub(m.cast("date"), 29).cast("timestamp_ntz"))
    recent = t.events.where(F.col("ts") >= since)
    events = recent.select("user_id", F.col("ts").cast("date").alias("day"), money("value").alias("value"))
    events = events.withColumn("as_of", newest)
    found = features.trailing_windows(events, "user_id", "day", "value", F.col("as_of"), [7, 14, 30])
    return found.withColumns({c: rounded(c, 2) for c in ("sum_7d", "sum_14d", "sum_30d")} | {
        "velocity": rounded("velocity", 4), "days_since_last": F.col("days_since_last").cast("bigint")
    })


@query(
    "e2_point_in_time_training_set",
    """WITH f AS (SELECT user_id, ts - INTERVAL 9496 DAY AS at, event_type, value FROM events),
    b AS (SELECT * FROM f WHERE event_type = 'purchase'), e AS (SELECT * FROM f WHERE event_type = 'error'),
    s AS (SELECT o_orderkey, o.user_id, o.at, b.value AS bought_value FROM (SELECT o_orderkey, o_custkey AS user_id, o_orderdate AS at FROM orders) o ASOF LEFT JOIN b ON o.user_id = b.user_id AND o.at >= b.at)
    SELECT s.o_orderkey, s.user_id, s.at, bought_value, e.value AS failed_value, e.at AS failed_at FROM (SELECT o_orderkey, o_custkey AS user_id, o_orderdate AS at, bought_value FROM orders JOIN s USING (o_orderkey)) s
    ASOF LEFT JOIN e ON s.user_id = e.user_id AND s.at >= e.at""",
)
def e2(t):
    f = event_features(t)
    bought = f.where(F.col("event_type") == "purchase").select("user_id", F.col("feature_at").alias("at"), "value")
    failed = f.where(F.col("event_type") == "error").select("user_id", F.col("feature_at").alias("at"), "value")
    tables = {"bought": (bought, "at"), "failed": (failed, "at")}
    return features.training_set(order_spine(t), "at", "o_orderkey", ["user_id"], tables).drop("bought_at")


@query(
    "e3_time_and_lag_features",
    f"""SELECT event_id, dayofweek(ts) + 1 AS day_of_week, hour(ts) AS hour, month(ts) AS month, dayofweek(ts) IN (0, 6) AS is_weekend,
    lag(value) OVER w AS last_value, date_diff('day', CAST(lag(ts) OVER w AS DATE), CAST(ts AS DATE)) AS days_since_last,
    CASE WHEN value < 20 THEN 'low' WHEN value < 60 THEN 'middle' ELSE 'high' END AS value_bucket, {r('ln(value + 1)', 6)} AS value_log,
    CASE WHEN value > 100 THEN 1 ELSE 0 END AS high_value_flag FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def e3(t):
    rows = ordered.over_neighbours(
        t.events.select("event_id", "user_id", "ts", "value"), ["user_id"], ["ts", "event_id"], 1, 0,
        lambda w: {"last_value": F.lag("value").over(w), "last_ts": F.lag("ts").over(w)},
    )
    bucket = F.when(F.col("value") < 20, "low").when(F.col("value") < 60, "middle").otherwise("high")
    return rows.select(
        "event_id", *[c.alias(n) for n, c in features.time_parts("ts").items()], "last_value",
        F.datediff("ts", "last_ts").cast("bigint").alias("days_since_last"), bucket.alias("value_bucket"),
        rounded(F.log1p("value"), 6).alias("value_log"), F.when(F.col("value") > 100, 1).otherwise(0).alias("high_value_flag"),
    )


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "e4_feature_correlations",
    " UNION ALL ".join(
        f"SELECT '{a}' AS left_feature, '{b}' AS right_feature, {r(f'corr({a}, {b})', 4)} AS correlation FROM lineitem"
        for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1:]
    ),
)
def e4(t):
    return features.correlations(t.lineitem, NUMBERS).withColumn("correlation", rounded("correlation", 4))


def _kept_sql(names: dict[str, str], limit: float = 0.95) -> str:
    """Names kept from left to right; each is compared with those kept before it."""
    listed, pairs, kept = list(names), [], []
    for j, b in enumerate(listed):
        pairs += [f"abs(corr({names[a]}, {names[b]})) > {limit} AS s{i}_{j}" for i, a in enumerate(listed[:j])]
        kept.append(" AND ".join([f"NOT (k{i} AND s{i}_{j})" for i in range(j)] or ["TRUE"]) + f" AS k{j}")
    steps = "".join(f", c{j} AS (SELECT *, {k} FROM c{j - 1})" if j else f", c0 AS (SELECT *, {k} FROM c)" for j, k in enumerate(kept))
    rows = " UNION ALL ".join(f"SELECT '{n}' AS feature FROM c{len(listed) - 1} WHERE k{j}" for j, n in enumerate(listed))
    return f"WITH c AS (SELECT {', '.join(pairs)} FROM lineitem){steps} {rows}"


@query(
    "e4_drop_correlated",
    _kept_sql({"l_quantity": "l_quantity", "twice_quantity": "l_quantity * 2 + 1", "l_extendedprice": "l_extendedprice", "l_discount": "l_discount"}),
)
def e4_drop(t):
    frame = t.lineitem.withColumn("twice_quantity", F.col("l_quantity") * 2 + 1)
    kept = features.drop_correlated(frame, ["l_quantity", "twice_quantity", "l_extendedprice", "l_discount"])
    return t.spark.createDataFrame([(c,) for c in kept], "feature string")


@query(
    "x1_resample_with_empty_bins",
    f"""WITH b AS (SELECT date_trunc('hour', ts) AS bin, avg(value) AS mean, median(value) AS median, min(value) AS low, max(value) AS high, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1)
    SELECT g.bin, {r('mean', 4)} AS mean, {r('median', 4)} AS median, low, high, coalesce(n, 0) AS n
    FROM (SELECT unnest(generate_series(min(bin), max(bin), INTERVAL 1 HOUR)) AS bin FROM b) g LEFT JOIN b ON b.bin = g.bin""",
)
def x1(t):
    bought = t.events.where(F.col("event_type") == "purchase")
    return timeseries.resample(bought, "ts", "value", 3600).withColumns({"mean": rounded("mean", 4), "median": rounded("median", 4)})


@query(
    "x2_local_time",
    """SELECT event_id, ts - INTERVAL 5 HOUR AS local_ts, ts AS back_to_utc FROM events""",
)
def x2(t):
    # January has no daylight saving in this zone, so the offset is a constant five hours.
    local = t.events.select("event_id", timeseries.to_local("ts", "America/New_York").alias("local_ts"))
    return local.withColumn("back_to_utc", timeseries.to_utc("local_ts", "America/New_York"))


@query(
    "v1_identity_vault",
    """SELECT md5(CAST(c_custkey AS VARCHAR)) AS identity_key, c_name, c_mktsegment, c_nationkey FROM customer""",
)
def v1(t):
    vault, public = governance.split_identity(t.customer.drop("c_acctbal"), "c_custkey", ["c_name"])
    return vault.select("identity_key", "c_name").join(public, "identity_key")


def people(t):
    key = F.lpad(F.col("c_custkey").cast("string"), 4, "0")
    return t.customer.select(
        "c_custkey",
        F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("123-45-"), key).alias("ssn"),
        F.concat(F.lit("card 1111-2222-3333-"), key).alias("note"),
    )


MASK_SQL = """SELECT c_custkey, '***@example.com' AS email, 'XXX-XX-' || right('123-45-' || lpad(CAST(c_custkey AS VARCHAR), 4, '0'), 4) AS ssn,
  regexp_replace('card 1111-2222-3333-' || lpad(CAST(c_custkey AS VARCHAR), 4, '0'), '[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}', 'XXXX-XXXX-XXXX-XXXX') AS note FROM customer"""


@query("v2_mask_by_role", MASK_SQL)
def v2(t):
    return governance.mask(people(t), {"email": "EMAIL", "ssn": "SSN", "note": "CARD"}, "ANALYST")


@query(
    "v3_row_filter",
    """SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_name = 'Supplier#000000001')""",
)
def v3(t):
    assigned = t.supplier.select(F.col("s_name").alias("user"), F.col("s_nationkey").alias("c_nationkey"))
    return governance.restrict_rows(t.customer, assigned, "Supplier#000000001", "c_nationkey").select("c_custkey", "c_nationkey")


@query(
    "v2_mask_levels",
    f"""SELECT c_custkey, 'CLERK' AS role, '*****' AS email, '*****' AS ssn, '*****' AS note FROM customer
    UNION ALL SELECT c_custkey, 'ANALYST', email, ssn, note FROM ({MASK_SQL})
    UNION ALL SELECT c_custkey, 'AUDITOR', 'user' || c_custkey || '@example.com', ssn, note FROM ({MASK_SQL})""",
)
def v2_levels(t):
    policy = {"email": "EMAIL", "ssn": "SSN", "note": "CARD"}
    # Auditors are cleared for addresses only; beyond that they see what analysts see.
    cleared, partial = {"email": ("ADMIN", "AUDITOR"), "*": ("ADMIN",)}, ("ANALYST", "AUDITOR")
    seen = [
        governance.mask_by_level(people(t), policy, role, cleared, partial).select("c_custkey", F.lit(role).alias("role"), "email", "ssn", "note")
        for role in ("CLERK", "ANALYST", "AUDITOR")
    ]
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


@query(
    "v3_rows_by_any_attribute",
    """SELECT 'USER' AS role, c_custkey FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_name = 'Supplier#000000001')
      OR c_mktsegment IN ('BUILDING', 'MACHINERY') UNION ALL SELECT 'ADMIN', c_custkey FROM customer""",
)
def v3_any(t):
    user = "Supplier#000000001"
    nations = t.supplier.select(F.col("s_name").alias("user"), F.col("s_nationkey").alias("c_nationkey"))
    segments = t.supplier.where(F.col("s_name") == user).select(
        F.col("s_name").alias("user"), F.explode(F.array(F.lit("BUILDING"), F.lit("MACHINERY"))).alias("c_mktsegment")
    )
    assigned = {"c_nationkey": nations, "c_mktsegment": segments}
    seen = [
        governance.restrict_rows_by_any(t.customer, assigned, user, role).select(F.lit(role).alias("role"), "c_custkey")
        for role in ("USER", "ADMIN")
    ]
    return seen[0].unionByName(seen[1])


@query("v4_mask_by_tag", MASK_SQL)
def v4(t):
    return governance.mask_tagged(governance.tag(people(t), {"email": "EMAIL", "ssn": "SSN", "note": "CARD"}), "ANALYST")


@query(
    "t1_chunk_text",
    """SELECT doc_id, CAST(n AS INTEGER) AS chunk_number, substr(text, CAST(n AS BIGINT) * 1000 + 1, 1000) AS chunk_text
    FROM (SELECT doc_id, text, unnest(generate_series(0, CAST(ceil(length(text) / 1000.0) AS BIGINT) - 1)) AS n FROM documents)""",
)
def t1(t):
    return texts.chunk(t.documents.select("doc_id", "text"), "text", 1000)


@query(
    "t2_transcript_segments",
    """SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS pos, role AS speaker, round((i - 1) * CAST(2.5 AS DOUBLE), 2) AS start_sec,
    round((i - 1) * CAST(2.5 AS DOUBLE) + length(s) / CAST(10 AS DOUBLE), 2) AS end_sec,
    round(((i - 1) * CAST(2.5 AS DOUBLE) + length(s) / CAST(10 AS DOUBLE)) - (i - 1) * CAST(2.5 AS DOUBLE), 2) AS duration_sec, s AS segment_text
    FROM (SELECT conv_id, turn, role, unnest(string_split(text, '. ')) AS s, generate_subscripts(string_split(text, '. '), 1) AS i FROM conversations)""",
)
def t2(t):
    pieces = F.transform(
        F.split("text", "\\. "),
        lambda s, i: F.struct(
            F.col("role").alias("speaker"), (i * F.lit(2.5)).alias("start"),
            (i * F.lit(2.5) + F.length(s) / F.lit(10.0)).alias("end"), s.alias("text"),
        ),
    )
    packed = t.conversations.select("conv_id", "turn", F.to_json(F.struct(pieces.alias("segments"))).alias("doc"))
    return texts.segments(packed, "doc")


@query(
    "t3_route_by_label",
    """SELECT doc_id, CASE WHEN toxic = 1 THEN 'Escalate' WHEN quality = 0 THEN 'Review' ELSE 'Standard' END AS routing_priority FROM labels""",
)
def t3(t):
    route = F.when(F.col("toxic") == 1, "Escalate").when(F.col("quality") == 0, "Review").otherwise("Standard")
    return t.labels.select("doc_id", route.alias("routing_priority"))


@query(
    "t4_most_similar",
    f"""WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 0)
    SELECT vec_id, {r('list_cosine_similarity(CAST(embedding AS DOUBLE[]), v)', 6)} AS similarity FROM embeddings, q
    ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), v) DESC, vec_id LIMIT 10""",
)
def t4(t):
    wanted = t.embeddings.where(F.col("vec_id") == 0).first()["embedding"]
    found = texts.most_similar(t.embeddings, "embedding", wanted, 10, "vec_id")
    return found.select("vec_id", rounded("similarity", 6).alias("similarity"))


@query(
    "t4_most_similar_to_each",
    f"""WITH s AS (SELECT q.vec_id AS query_id, e.vec_id AS id, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS c
      FROM embeddings q JOIN embeddings e ON q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0)
    SELECT query_id, id, {r('c', 6)} AS similarity, CAST(row_number() OVER (PARTITION BY query_id ORDER BY c DESC, id) AS INTEGER) AS rank FROM s
    QUALIFY rank <= 10""",
)
def t4_each(t):
    queries = t.embeddings.where(F.col("vec_id") % 50 == 0)
    found = similarity.most_similar_to_each(t.embeddings, queries, 10, "vec_id", "embedding", but_itself=True)
    return found.withColumn("similarity", rounded("similarity", 6))


@query(
    "v2_mask_cleared_role",
    "SELECT interaction_id, email FROM fans",
)
def v2_cleared(t):
    return governance.mask(domain.fan_activity(t).select("interaction_id", "email"), {"email": "EMAIL"}, "ADMIN")
