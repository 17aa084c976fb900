"""Sketches kept per period, keyed RANGE frames, facts at the version of their time, metrics of two grains, seeded samples."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierflow.operators import intervals, ordered, picking, sketches
from tierflow.plans.semantic import Dimension, Metric, Model, Relationship, RepeatedKey, Table
from tierflow.plans.semantic import query as ask

# --- sketches ---


def test_any_period_lies_within_the_stated_error(spark):
    """30,000 users over ten days, each day with late rows, read back over every pair of days."""
    events = spark.range(400_000).select(
        (F.col("id") % 10).alias("day"), (F.xxhash64("id") % 30_000).alias("user"), (F.abs(F.xxhash64(F.col("id") * 7)) % 1_000_000).alias("spend")
    )
    stored = None
    for part in range(2):
        some = sketches.sketched(events.where(F.abs(F.xxhash64("user", "day")) % 2 == part), ["day"], {"users": "user"}, {"spend": "spend"})
        stored = some if stored is None else sketches.merged(stored.unionByName(some), ["day"], ["users"], ["spend"])
    stored = stored.checkpoint()
    for first, last in ((0, 0), (2, 5), (0, 9)):
        inside = F.col("day").between(first, last)
        whole = sketches.merged(stored.where(inside), [], ["users"], ["spend"])
        got = sketches.estimates(whole, [], ["users"], {"p10": ("spend", 0.1), "p50": ("spend", 0.5), "p99": ("spend", 0.99)}).first()
        exact = events.where(inside).agg(F.count("*").alias("n"), F.countDistinct("user").alias("users")).first()
        assert got.n_rows == exact.n and got.users_low <= exact.users <= got.users_high
        assert abs(got.users - exact.users) <= 3 * sketches.distinct_error() * exact.users
        values = np.sort([r.spend for r in events.where(inside).select("spend").collect()])
        for name, share in (("p10", 0.1), ("p50", 0.5), ("p99", 0.99)):
            rank = np.searchsorted(values, got[name]) / len(values)
            assert abs(rank - share) <= 2 * sketches.RANK_ERROR


def test_small_sets_are_exact_and_nulls_are_not_sketched(spark):
    data = spark.createDataFrame([("a", k % 40, float(k)) for k in range(200)] + [("b", None, None)], "g string, u long, v double")
    got = sketches.estimates(sketches.sketched(data, ["g"], {"u": "u"}, {"v": "v"}), ["g"], ["u"], {"m": ("v", 0.5)})
    found = {r.g: (r.n_rows, r.u) for r in got.where("g = 'a'").collect()} | {r.g: (r.n_rows, r.u) for r in got.drop("m").where("g = 'b'").collect()}
    assert found == {"a": (200, 40), "b": (1, 0)}


# --- keyed RANGE frames ---


@pytest.mark.parametrize("before, after", [(5, 0), (0, 0), (3, 4), (1000, 1000)])
def test_range_frames_hot_and_plain(hot, before, after):
    r = random.Random(before)
    data = [(n, r.choice(["hot", "hot", "hot", "b", None]), r.choice([None, *range(60)]), r.choice([None, 1, 2, 30])) for n in range(300)]
    frame = hot.createDataFrame(data, "id long, g string, at long, v long").repartition(5)
    totals = {"n": F.lit(1).cast("bigint"), "total": F.col("v")}
    split = ordered.over_range(frame, ["g"], "at", before, after, totals, hot=True)
    plain = ordered.over_range(frame, ["g"], "at", before, after, totals, hot=False)
    assert split.columns == plain.columns and rows(split) == rows(plain)
    for i, g, at, _ in data[:50]:
        near = [v for _, h, b, v in data if h == g and (b is None if at is None else b is not None and at - before <= b <= at + after)]
        known = [v for v in near if v is not None]
        row = plain.where(F.col("id") == i).select("n", "total").first() if i < 5 else None
        assert row is None or tuple(row) == (len(near), sum(known) if known else None)


# --- intervals ---


@pytest.mark.parametrize("how", ["left", "inner"])
def test_facts_meet_every_span_that_holds_them(spark, how):
    r = random.Random(1)
    facts = [(n, r.choice(["hot", "hot", "hot", "b", "c", None]), r.choice([None, *range(-50, 400)])) for n in range(400)]
    spans = []
    for n in range(150):
        begin = r.randrange(-80, 380)
        spans.append((n, r.choice(["hot", "hot", "b", None]), r.choice([begin, begin, None]), r.choice([begin + r.randrange(0, 9), begin + 300, begin - 5, None])))
    spans += [(1000 + k, "hot", k, k + 1) for k in range(400)] + [(2000, "hot", -(10**15), 10**15)]
    left = spark.createDataFrame(facts, "f long, k string, at long").repartition(3)
    right = spark.createDataFrame(spans, "s long, k string, start long, end long").repartition(3)
    found = intervals.join_valid(left, right, ["k"], "at", "start", "end", how)
    assert found.columns == ["f", "k", "at", "s", "start", "end"]
    want = []
    for f, k, at in facts:
        hits = [s for s, h, a, b in spans if k is not None and h == k and at is not None and a is not None and a <= at and (b is None or at < b)]
        want += [(f, s) for s in hits] or ([(f, None)] if how == "left" else [])
    assert sorted(((x.f, x.s) for x in found.collect()), key=repr) == sorted(want, key=repr)


def test_dates_times_and_empty_sides(spark):
    facts = spark.sql("SELECT 1 AS f, 'a' AS k, TIMESTAMP_NTZ'2024-01-02 10:00:00' AS at UNION ALL SELECT 2, 'a', TIMESTAMP_NTZ'2024-01-03 00:00:00'")
    spans = spark.sql("SELECT 'x' AS s, 'a' AS k, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS start, TIMESTAMP_NTZ'2024-01-03 00:00:00' AS end")
    assert rows(intervals.join_valid(facts, spans, ["k"], "at", "start", "end").select("f", "s")) == [(1, "x"), (2, None)]
    assert intervals.join_valid(facts, spans.limit(0), ["k"], "at", "start", "end").count() == 2
    assert intervals.join_valid(facts.limit(0), spans, ["k"], "at", "start", "end").count() == 0


# --- metrics of two grains ---


def model(repeat: bool) -> Model:
    def frame(name, data, schema):
        return lambda spark: spark.createDataFrame(data, schema)

    shops = [(1, "north"), (2, "south"), (3, None)] + ([(1, "north")] if repeat else [])
    return Model(
        tables={
            "sales": Table(frame("sales", [(1, 10), (1, 20), (2, 5), (9, 7), (3, 1)], "shop long, amount long"), ()),
            "budgets": Table(frame("budgets", [(1, 100), (2, 40), (2, 50), (None, 3)], "b_shop long, planned long"), ()),
            "shops": Table(frame("shops", shops, "shop_id long, region string"), ("shop_id",)),
        },
        relationships=[Relationship("sales", "shop", "shops", "shop_id"), Relationship("budgets", "b_shop", "shops", "shop_id")],
        dimensions={"region": Dimension("shops", lambda: F.col("region")), "amount_class": Dimension("sales", lambda: F.col("amount") > 9)},
        facts={},
        metrics={"sold": Metric("sales", lambda: F.sum("amount")), "planned": Metric("budgets", lambda: F.sum("planned")), "sales": Metric("sales", lambda: F.count("*"))},
    )


def test_each_metric_keeps_its_own_grain(spark):
    found = ask(model(False), spark, ["region"], ["sold", "planned", "sales"])
    assert {r.region: (r.sold, r.planned, r["sales"]) for r in found.collect()} == {"north": (30, 100, 2), "south": (5, 90, 1), None: (8, 3, 2)}
    assert rows(ask(model(False), spark, [], ["sold", "planned"])) == [(43, 193)]
    with pytest.raises(ValueError, match="cannot be reached"):
        ask(model(False), spark, ["amount_class"], ["planned"])


def test_a_repeated_parent_is_refused_or_taken_once(spark):
    with pytest.raises(RepeatedKey):
        ask(model(True), spark, ["region"], ["sold"])
    found = ask(model(True), spark, ["region"], ["sold", "planned"], repeated="first")
    assert {r.region: (r.sold, r.planned) for r in found.collect()} == {"north": (30, 100), "south": (5, 90), None: (8, 3)}
    assert ask(model(True), spark, ["region"], ["sold"], repeated="trust").where("region = 'north'").first().sold == 60


# --- samples ---


def test_seeded_sample_repeats_and_keeps_its_share(spark):
    frame = spark.range(20_000)
    first = {r.id for r in picking.seeded_sample(frame, "id", 0.1, 42).collect()}
    assert first == {r.id for r in picking.seeded_sample(frame.repartition(7), "id", 0.1, 42).collect()}
    assert first != {r.id for r in picking.seeded_sample(frame, "id", 0.1, 43).collect()} and abs(len(first) - 2000) < 200
