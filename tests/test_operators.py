"""Null, tie and rerun cases on hand-made frames."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from tierflow.functions import columns as C
from tierflow.operators import checks, features, governance, history, joining, merging, texts, timeseries
from tierflow.operators.checks import Expectation
from tierflow.plans import domain, layers
from tierflow.plans.domain import Tables
from tierflow.plans.semantic import query as ask
from tierflow.session import work_path
from tierflow.sources import landing
from tierflow.streaming import feeds


def ts(day, hour=0):
    return datetime(2024, 1, day, hour)


def test_keys_and_rounding(spark):
    df = spark.createDataFrame([("a", "bc", None), ("ab", "c", None)], "x string, y string, z string")
    plain = [r[0] for r in df.select(C.concat_key("x", "y")).collect()]
    separated = [r[0] for r in df.select(C.surrogate_key("x", "y", "z")).collect()]
    assert plain[0] == plain[1] and separated[0] != separated[1]
    assert [r[0] for r in df.select(C.concat_key("x", "z")).collect()] == [None, None]
    one = spark.range(1).select(C.rounded(F.lit(1.005), 2), C.ratio(F.lit(1), F.lit(0)), C.sha256(F.lit(None).cast("string")))
    assert rows(one) == [(1.01, None, None)]


def test_variant_paths(spark):
    df = spark.createDataFrame([('{"a": 1, "b": null, "c": "x"}',), ('{"a": "no"}',), ("[1]",)], "j string")
    raw = df.select(F.parse_json("j").alias("raw"))
    got = C.parse_variant(raw, "raw", {"a": "int", "b": "string", "c": "string"})
    assert rows(got) == sorted([(1, None, "x"), (None, None, None), (None, None, None)], key=repr)


def test_routing_loses_nothing(spark):
    data = [(1, None), (2, "VERIFIED"), (3, "VERIFIED_LINKED"), (4, "GUEST")]
    df = spark.createDataFrame(data, "interaction_id int, account_type string").select("*", *layers.empty_identity())
    verified, guest = layers.route(df)
    assert [r.interaction_id for r in verified.collect()] == [2]
    assert sorted(r.interaction_id for r in guest.collect()) == [1, 3, 4]
    both, _ = layers.route(df, ("VERIFIED", "VERIFIED_LINKED"))
    assert both.count() == 2


def test_latest_attributes_tie(spark):
    data = [("f", 1, ts(1), "old"), ("f", 2, ts(1), "new")]
    df = spark.createDataFrame(data, "fan_id string, interaction_id int, event_ts timestamp_ntz, email string")
    df = df.select(
        "*", *[F.lit(None).cast("string").alias(c) for c in ("device_type", "region", "country_code", "account_type")],
        *[F.lit(None).cast("string").alias(c) for c in ("first_name", "last_name", "title_id")],
    )
    assert layers.fan_stats(df).first()["email"] == "new"


def test_null_regions_do_not_match(spark):
    left = spark.createDataFrame([(1, date(2024, 1, 1), None, 5)], "title_id int, report_date date, region string, total_tickets_sold int")
    left = left.select("*", *[F.lit(1).alias(m) for m in layers.MEASURES[1:5]])
    right = spark.createDataFrame([(1, date(2024, 1, 1), None, 2, 1)], "title_id int, report_date date, region string, stream_count int, unique_fans int")
    out = layers.daily_performance(left, right)
    assert sorted((r.total_tickets_sold, r.stream_count) for r in out.collect()) == [(0, 2), (5, 0)]


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", 10, ts(1)), (2, "b", 20, ts(1))], "k int, name string, n int, at timestamp_ntz")
    data = [(1, "x", 11, ts(2)), (1, "y", 12, ts(3)), (3, "z", None, ts(1))]
    source = spark.createDataFrame(data, "k int, name string, n int, at timestamp_ntz")
    once = merging.upsert(target, source, ["k"], ["at"], ["name", "at"])
    assert rows(once) == sorted([(1, "y", 10, ts(3)), (2, "b", 20, ts(1)), (3, "z", None, ts(1))], key=repr)
    assert rows(merging.upsert(once, source, ["k"], ["at"], ["name", "at"])) == rows(once)
    full = {r.k: r.n for r in merging.upsert(target, source, ["k"], ["at"]).collect()}
    assert full == {1: 12, 2: 20, 3: None}


def test_upsert_can_set_null(spark):
    target = spark.createDataFrame([(1, "a", ts(1))], "k int, name string, at timestamp_ntz")
    source = spark.createDataFrame([(1, None, ts(2))], "k int, name string, at timestamp_ntz")
    assert merging.upsert(target, source, ["k"], ["at"]).first()["name"] is None


def test_high_water(spark):
    source = spark.createDataFrame([(1, ts(1)), (2, ts(2)), (3, ts(2))], "k int, at timestamp_ntz")
    target = source.where("k <= 2")
    assert merging.high_water(source, target, "at").count() == 2
    assert merging.high_water(source, target, "at", inclusive=False).count() == 0
    assert merging.high_water(source, target.where("k < 0"), "at").count() == 3


def test_changes_and_feed(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (3, "c"), (4, "d")], "k int, v string")
    feed = merging.change_feed(old, new, ["k"])
    assert sorted((r.k, r._action) for r in feed.collect()) == [(2, "DELETE"), (3, "UPDATE"), (4, "INSERT")]
    applied = merging.apply_changes(old, feed.withColumn("at", F.lit(1)), ["k"], ["at"])
    assert rows(applied) == rows(new)


def test_additive_kinds(spark):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    with pytest.raises(ValueError):
        merging.add_increment(df, df, ["k"], {"n": "count_distinct"})


def test_snapshot_runs(spark):
    def people(*data):
        return spark.createDataFrame(list(data), "id int, v string, note string")

    def at(day):
        return F.lit(ts(day)).cast("timestamp_ntz")

    one = history.snapshot(None, people((1, "a", "x"), (2, None, "x"), (3, "c", "x")), "id", ["v"], at(1))
    two = history.snapshot(one, people((1, "a", "other"), (2, "b", "x"), (4, "d", "x")), "id", ["v"], at(2))
    three = history.snapshot(two, people((1, "a", "x"), (2, "b", "x"), (3, "c", "x"), (4, "d", "x")), "id", ["v"], at(3))
    found = sorted((r.id, r.valid_from.day, r.valid_to.day if r.valid_to else None) for r in three.collect())
    assert found == [(1, 1, None), (2, 1, 2), (2, 2, None), (3, 1, 2), (3, 3, None), (4, 2, None)]
    again = history.snapshot(three, people((1, "a", "x"), (2, "b", "x"), (3, "c", "x"), (4, "d", "x")), "id", ["v"], at(4))
    assert rows(again) == rows(three)
    assert history.current_rows(three).count() == 4
    assert sorted(r.id for r in history.rows_at(three, at(2)).collect()) == [1, 2, 4]


def test_quality_nulls(spark):
    hashes = ["a" * 64, "a" * 63, "A" * 64, None]
    codes = ["USA", "usa", "US", None]
    scores = [0.0, 10.0, 10.1, None]
    df = spark.createDataFrame(list(zip(hashes, codes, scores)), "h string, c string, s double")
    out = checks.measure(df, "t", {
        "hash": checks.bad_format("h", checks.HASH_FORMAT), "code": checks.bad_format("c", checks.CODE_FORMAT),
        "score": checks.out_of_range("s", 0, 10), "score_known": checks.out_of_range("s", 0, 10, False),
        "dup": checks.duplicates("s"), "nulls": checks.nulls("s"),
    })
    assert {r.metric: r.value for r in out.collect()} == {
        "hash": 3.0, "code": 3.0, "score": 2.0, "score_known": 1.0, "dup": 1.0, "nulls": 1.0,
    }


def test_expectations(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    rules = [Expectation("nulls", "<", 0.6, of="rows"), Expectation("nulls", "=", 0), Expectation("rows", "between", 1, 2)]
    out = checks.expect(df, "t", {"nulls": checks.nulls("v"), "rows": F.count("*")}, rules)
    assert [r.passed for r in out.collect()] == [True, False, True]


def test_ks_of_equal_samples(spark):
    df = spark.range(100).withColumn("v", F.col("id").cast("double"))
    got = checks.two_sample_ks(df, df, "v").first()
    assert got.statistic == 0.0


def test_join_validation(spark):
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    many = spark.createDataFrame([(1, 1), (1, 2)], "k int, n int")
    assert joining.join_validated(one, many, ["k"], "left", "1:m").count() == 2
    with pytest.raises(ValueError):
        joining.join_validated(one, many, ["k"], "left", "1:1")


def test_distance_against_brute_force(spark):
    sites = spark.range(20).select(F.col("id").alias("s"), (F.rand(1) * 2 + 40).alias("site_lat"), (F.rand(2) * 2).alias("site_lon"))
    points = spark.range(200).select(F.col("id").alias("p"), (F.rand(3) * 2 + 40).alias("point_lat"), (F.rand(4) * 2).alias("point_lon"))
    sites, points = (spark.createDataFrame(x.collect(), x.schema) for x in (sites, points))
    got = joining.within_distance(sites, points, 20_000.0).select("s", "p")
    both = sites.join(points, F.lit(True))
    want = both.where(C.haversine_m("site_lat", "site_lon", "point_lat", "point_lon") <= 20_000.0).select("s", "p")
    assert rows(got) == rows(want) and got.count() > 10


def test_near_in_time_borders(spark):
    a = spark.createDataFrame([(1, ts(1, 1))], "k int, x timestamp_ntz")
    b = spark.createDataFrame([(1, datetime(2024, 1, 1, 1, 0, s), s) for s in (0, 9, 10, 19)], "k int, y timestamp_ntz, s int")
    assert sorted(r.s for r in joining.near_in_time(a, b, ["k"], "x", "y", 10).collect()) == [0, 9]


def test_masks_and_tags(spark):
    df = spark.createDataFrame([("ann@x.org", "1111-2222-3333-4444"), (None, None)], "email string, note string")
    tagged = governance.tag(df, {"email": "EMAIL", "note": "CARD"})
    assert rows(governance.mask_tagged(tagged, "ANALYST")) == sorted([("***@x.org", "XXXX-XXXX-XXXX-XXXX"), (None, None)], key=repr)
    assert rows(governance.mask_tagged(tagged, "ADMIN")) == rows(df)


def test_chunks_rebuild_the_text(spark):
    df = spark.createDataFrame([(1, "é" * 25), (2, ""), (3, "x" * 20)], "id int, text string")
    pieces = texts.chunk(df, "text", 10).collect()
    assert [len([p for p in pieces if p.id == i]) for i in (1, 2, 3)] == [3, 0, 2]
    assert "".join(p.chunk_text for p in sorted(pieces, key=lambda p: p.chunk_number) if p.id == 1) == "é" * 25


def test_resample_keeps_empty_bins(spark):
    df = spark.createDataFrame([(ts(1, 0), 1.0), (ts(1, 0), 3.0), (ts(1, 2), 5.0)], "at timestamp_ntz, v double")
    got = timeseries.resample(df, "at", "v", 3600).orderBy("bin").collect()
    assert [(r.n, r.median) for r in got] == [(2, 2.0), (0, None), (1, 5.0)]


def test_correlated_columns(spark):
    df = spark.range(50).select(F.col("id").alias("a"), (F.col("id") * 2).alias("b"), (F.col("id") % 7).alias("c"))
    assert features.drop_correlated(df, ["a", "b", "c"]) == ["a", "c"]


def test_files_good_bad_and_empty(spark):
    path = work_path(spark, "mixed")
    for text in ['{"a": 1}', '{"a": "x"}', ""]:
        spark.createDataFrame([(text,)] if text else [], "value string").coalesce(1).write.mode("append").text(path)
    counts = {p: landing.load_with_policy(spark, path, "a int", p).count() for p in ("CONTINUE", "SKIP_FILE")}
    assert counts == {"CONTINUE": 1, "SKIP_FILE": 1}
    assert landing.bad_rows(spark, path, "a int").count() == 1
    with pytest.raises(Exception):
        landing.load_with_policy(spark, path, "a int", "ABORT").collect()


def test_schema_evolution_keeps_old_columns(spark):
    old = spark.createDataFrame([(1, "x")], "id int, status string")
    new = spark.createDataFrame([(2, "y")], "id int, order_status string")
    got = landing.evolve(old, new, {"order_status": F.col("status")})
    assert rows(got.select("id", "status", "order_status")) == [(1, "x", "x"), (2, None, "y")]


def test_stream_batches_are_not_doubled(spark):
    folder, target, checkpoint = (work_path(spark, n) for n in ("in", "out", "cp"))
    spark.range(5).write.parquet(folder)
    feeds.append_once(feeds.file_stream(spark, folder, "id bigint"), target, checkpoint).awaitTermination()
    feeds.write_batch(spark.range(5), 0, target)  # the same batch again, as after a failure
    spark.range(5, 8).write.mode("append").parquet(folder)
    feeds.append_once(feeds.file_stream(spark, folder, "id bigint"), target, checkpoint).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == list(range(8))


def test_semantic_rules(spark):
    from tierflow.catalog.metrics import MODEL

    t = Tables(spark, SMALL)
    with pytest.raises(ValueError):
        ask(MODEL, t)
    with pytest.raises(ValueError):
        ask(MODEL, t, ["brand"], ["revenue"], facts=["quantity"])
    with pytest.raises(ValueError):
        ask(MODEL, t, ["ship_day"], ["avg_7_days"])
    with pytest.raises(ValueError):
        ask(MODEL, t, ["brand"], ["order_total"])
    assert ask(MODEL, t, ["market", "franchise"], ["total revenue"]).columns == ["region", "brand", "revenue"]
    plan = ask(MODEL, t, ["line_status"], ["revenue"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_filters_reach_the_scan(spark):
    from __spark_entry__ import queries

    plan = queries()["f4_half_open_range"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


def test_dedup_limits_before_the_shuffle(spark):
    from __spark_entry__ import queries

    plan = queries()["w1_keep_latest_lines"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_period_bound_reaches_both_scans(spark):
    from __spark_entry__ import queries

    plan = queries()["sq4_revenue_last_30_days"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "GreaterThanOrEqual(ts" in plan


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_stream_parts_do_not_depend_on_files(spark, files_per_batch):
    import random

    from tierflow.operators.sessions import sessionize

    schema = "id bigint, user bigint, at timestamp_ntz, value double"
    r = random.Random(4)
    start = datetime(2024, 1, 1)
    events = [(k, r.randint(0, 4), start + timedelta(minutes=r.randint(0, 60 * 24 * 3)), 1.5) for k in range(400)]
    r.shuffle(events)
    folder = work_path(spark, "shuffled")
    for k in range(8):  # every file spans all times
        spark.createDataFrame(events[k * 50 : k * 50 + 50], schema).coalesce(1).write.mode("append").parquet(folder)
    whole = spark.read.parquet(folder)

    def parts(partial):
        target = work_path(spark, "parts")
        stream = feeds.file_stream(spark, folder, schema, files_per_batch=files_per_batch)
        feeds.maintain(stream, partial, target, work_path(spark, "checkpoint")).awaitTermination()
        return spark.read.parquet(target)

    hours = feeds.merged_windows(parts(lambda b: feeds.window_partials(b, "at", ["user"], "value", "1 hour")), ["user"])
    want = feeds.window_partials(whole, "at", ["user"], "value", "1 hour")
    assert rows(hours.select(want.columns).withColumn("total", F.col("total").cast("double"))) == rows(
        want.withColumn("total", F.col("total").cast("double"))
    )
    gap = 2 * 3600
    sessions = feeds.merged_sessions(parts(lambda b: feeds.session_partials(b, "user", "at", "id", gap)), "user", gap)
    plain = sessionize(whole, "user", "at", "id", gap).groupBy("user", "session_number").agg(
        F.min("at").alias("session_start"), F.count("*").alias("events")
    )
    assert rows(sessions) == rows(plain.drop("session_number"))
    assert sessions.agg(F.sum("events")).first()[0] == 400
    firsts = feeds.merged_firsts(parts(lambda b: feeds.first_partials(b, ["user"], ["at", "id"])), ["user"], ["at", "id"])
    assert rows(firsts.select("user", "id")) == rows(whole.groupBy("user").agg(F.min(F.struct("at", "id"))["id"].alias("id")))


def test_ks_p_value_of_equal_and_close_samples(spark):
    same = spark.range(500).selectExpr("double(id) as v")
    assert checks.two_sample_ks(same, same, "v").first().p_value == 1.0
    close = checks.two_sample_ks(same, same.where("v <> 7"), "v").first()
    assert close.p_value > 0.9999
    apart = checks.two_sample_ks(same, same.selectExpr("v + 300 as v"), "v").first()
    assert apart.p_value < 1e-6


def test_fan_activity_reads_no_dimension(spark):
    t = domain.Tables(spark, SMALL)
    for frame in (domain.fan_activity(t).select("fan_id"), domain.fan_activity(t)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "customer" not in plan and "Join" not in plan


def test_distance_over_date_line_and_poles(spark):
    import math
    import random

    r = random.Random(6)

    def spread(count):
        found = [(r.uniform(-90, 90), r.uniform(-180, 180)) for _ in range(count)]
        found += [(r.uniform(-60, 60), r.choice([-1, 1]) * r.uniform(179.9, 180)) for _ in range(count)]
        found += [(r.choice([-1, 1]) * r.uniform(89.5, 90), r.uniform(-180, 180)) for _ in range(count)]
        return [*found, (90.0, 0.0), (-90.0, 10.0), (0.0, 180.0), (0.0, -180.0), (45.0, -0.0)]

    sites, points = list(enumerate(spread(60))), list(enumerate(spread(120)))

    def metres(a, b):
        p1, p2 = math.radians(a[0]), math.radians(b[0])
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return 2 * 6371008.8 * math.asin(math.sqrt(min(1, h)))

    frame = lambda rows_, name: spark.createDataFrame([(k, *x) for k, x in rows_], f"{name} int, {name}_lat double, {name}_lon double")
    for limit in (500.0, 30_000.0, 3_000_000.0):
        found = joining.within_distance(frame(sites, "site"), frame(points, "point"), limit)
        assert sorted((x.site, x.point) for x in found.collect()) == sorted(
            (s, p) for s, a in sites for p, b in points if metres(a, b) <= limit
        )


def test_snapshot_keeps_a_null_key(spark):
    from tierflow.operators.history import snapshot

    now = lambda d: F.lit(ts(d)).cast("timestamp_ntz")
    first = spark.createDataFrame([(None, 1), (1, 1), (2, 1)], "k int, v int")
    second = spark.createDataFrame([(None, 1), (1, 2)], "k int, v int")
    runs = snapshot(None, first, "k", ["v"], now(1))
    for day in (2, 3):
        runs = snapshot(runs, second, "k", ["v"], now(day))
    assert rows(runs.select("k", "v", F.dayofmonth("valid_from"), F.dayofmonth("valid_to"))) == sorted(
        [(None, 1, 1, None), (1, 1, 1, 2), (1, 2, 2, None), (2, 1, 1, 2)], key=repr
    )


def test_masks_by_level(spark):
    df = spark.createDataFrame([("ann@x.org", "123-45-6789"), (None, None)], "email string, ssn string")
    policy, cleared = {"email": "EMAIL", "ssn": "SSN"}, {"email": ["AUDITOR"], "*": ["ADMIN"]}
    seen = lambda role: rows(governance.mask_by_level(df, policy, role, cleared, ["ANALYST", "AUDITOR"]))
    assert ("***@x.org", "XXX-XX-6789") in seen("ANALYST") and ("ann@x.org", "XXX-XX-6789") in seen("AUDITOR")
    assert ("*****", "*****") in seen("CLERK") and ("*****", "123-45-6789") in seen("ADMIN")
    assert all((None, None) in seen(role) for role in ("ANALYST", "AUDITOR", "CLERK", "ADMIN"))


def test_small_derived_sides_are_broadcast_and_large_ones_not(spark):
    fact = spark.range(100_000).selectExpr("id", "id % 5 as k")
    means = fact.groupBy("k").agg(F.avg("id").alias("m"))
    wide = fact.groupBy("id").agg(F.max("k").alias("m"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan(fact.join(joining.of_known_size(means), "k"))
        assert "BroadcastHashJoin" not in plan(fact.join(joining.of_known_size(wide), "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_top_n_beyond_the_usual_group_limit(spark):
    from tierflow.operators import picking

    top = picking.top_n(spark.range(9000).selectExpr("id", "id % 2 as k"), ["k"], [F.asc("id")], 3000)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert top.count() == 6000 and top.agg(F.max("id")).first()[0] == 5999


def test_upsert_reads_touched_partitions_only(spark):
    path = work_path(spark, "parts")
    rows_ = spark.range(100).selectExpr("id", "id % 10 as p", "0 as v")
    merging.replace_partitions(rows_, path, ["p"])
    source = spark.createDataFrame([(3, 3, 1), (103, 3, 1), (7, 7, 1)], "id bigint, p bigint, v int")
    merging.upsert_touched_partitions(spark, path, source, ["id", "p"], ["v"], ["p"])
    stored = spark.read.parquet(path)
    assert stored.count() == 101 and stored.where("v = 1").count() == 3


def test_resampling_grid_of_many_bins(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), 1.0), (datetime(2024, 1, 3), 2.0)], "at timestamp_ntz, value double")
    grid = timeseries.resample(df, "at", "value", 10)
    assert grid.count() == 2 * 8640 + 1 and grid.where("n > 0").count() == 2
    assert timeseries.resample(df.limit(0), "at", "value", 10).count() == 0
