"""The split path of the ordered operators gives what a plain window or brute force gives."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from conftest import rows
from tierflow.operators import joining, ordered, picking
from tierflow.operators.history import versions_from_log
from tierflow.operators.sessions import sessionize

START = datetime(2024, 1, 1)


def skewed(spark, n=400, seed=7):
    """A third and more of the rows belong to one key; some keys and values are null."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "c", None])
        value = None if rng.random() < 0.3 else rng.randint(0, 9)
        data.append((i, key, START + timedelta(minutes=rng.randint(0, 300)), value))
    return spark.createDataFrame(data, "id bigint, k string, at timestamp_ntz, v bigint")


def window(*keys):
    return W.partitionBy(*keys).orderBy("at", "id")


def test_hot_is_found(hot):
    assert ordered.is_hot(skewed(hot), ["k"])


def test_running_totals(hot):
    df = skewed(hot)
    got = ordered.running_totals(df, ["k"], ["at", "id"], {"s": F.col("v"), "n": F.lit(1).cast("bigint")})
    w = window("k").rowsBetween(W.unboundedPreceding, 0)
    want = df.withColumn("s", F.sum("v").over(w)).withColumn("n", F.count("*").over(w))
    assert rows(got) == rows(want)


def test_running_totals_without_keys(hot):
    df = skewed(hot)
    got = ordered.row_numbers(df, [], ["at", "id"])
    want = df.withColumn("row_number", F.row_number().over(W.orderBy("at", "id")).cast("bigint"))
    assert rows(got) == rows(want)


def test_last_known(hot):
    df = skewed(hot)
    got = ordered.last_known(df, ["k"], ["at", "id"], ["v"])
    w = window("k").rowsBetween(W.unboundedPreceding, 0)
    assert rows(got) == rows(df.withColumn("v", F.last("v", ignorenulls=True).over(w)))


def test_neighbours(hot):
    df = skewed(hot)

    def build(w):
        return {
            "before": F.lag("id", 2).over(w), "after": F.lead("id").over(w),
            "near": F.sum("v").over(w.rowsBetween(-2, 1)), "n": F.count("*").over(w.rowsBetween(-2, 1)),
        }

    got = ordered.over_neighbours(df, ["k"], ["at", "id"], 2, 1, build)
    assert rows(got) == rows(df.withColumns(build(window("k"))))


def test_quantiles_match_sorting(hot):
    df = skewed(hot)
    got = {r["k"]: r for r in ordered.quantiles(df, ["k"], "v", {"p": ("cont", 0.9), "m": ("index", 0.5)}).collect()}
    for key in ["hot", "a", "b", "c", None]:
        values = sorted(r["v"] for r in df.collect() if r["k"] == key and r["v"] is not None)
        place = (len(values) - 1) * 0.9
        low, high = values[int(place)], values[min(int(place) + 1, len(values) - 1)]
        assert abs(got[key]["p"] - (low + (high - low) * (place - int(place)))) < 1e-9
        assert got[key]["m"] == values[len(values) // 2]


def test_mode_takes_smallest_on_tie(spark):
    df = spark.createDataFrame([("x", 2), ("x", 1), ("x", 2), ("x", 1), ("x", 3), ("y", None)], "k string, v int")
    assert rows(ordered.mode_of(df, ["k"], "v", "m")) == [("x", 1)]


def test_global_rank(hot):
    df = hot.createDataFrame([(i, i // 3) for i in range(30)], "id int, v int")
    got = picking.global_rank(df, "v", "id", "rn", "rk").select("id", "rn", "rk")
    w = W.orderBy(F.desc("v"))
    want = df.select(
        "id", F.row_number().over(W.orderBy(F.desc("v"), "id")).cast("bigint"), F.rank().over(w).cast("bigint")
    )
    assert rows(got) == rows(want)


def test_asof_sees_no_future(hot):
    features = skewed(hot, 200, 1).where("k is not null").select("k", F.col("at").alias("f_at"), "v")
    spine = skewed(hot, 200, 2).where("k is not null").select("id", "k", "at")
    got = {r["id"]: r for r in joining.asof_join(spine, features, ["k"], "at", "f_at", "id").collect()}
    all_features = [tuple(r) for r in features.collect()]
    assert len(got) == spine.count()
    for r in spine.collect():
        past = [f for f in all_features if f[0] == r["k"] and f[1] <= r["at"]]
        newest = max((f[1] for f in past), default=None)
        assert got[r["id"]]["f_at"] == newest
        if past:
            assert got[r["id"]]["v"] in [f[2] for f in past if f[1] == newest]


def test_sessions(hot):
    df = skewed(hot).where("k is not null").select("id", "k", "at")
    got = {r["id"]: r["session_number"] for r in sessionize(df, "k", "at", "id", 240).collect()}
    last, number = {}, {}
    for r in sorted(df.collect(), key=lambda r: (r["k"], r["at"], r["id"])):
        k = r["k"]
        if k not in last or (r["at"] - last[k]).total_seconds() >= 240:
            number[k] = number.get(k, 0) + 1
        last[k] = r["at"]
        assert got[r["id"]] == number[k]


def test_versions_from_log(hot):
    data = [(1, START + timedelta(days=i), i, s) for i, s in enumerate("aabbbacc")]
    log = hot.createDataFrame(data, "k int, at timestamp_ntz, id int, s string")
    found = versions_from_log(log, "k", "at", "id", ["s"]).orderBy("valid_from").collect()
    assert [(r["s"], r["valid_from"].day, r["is_current"]) for r in found] == [
        ("a", 1, False), ("b", 3, False), ("a", 6, False), ("c", 7, True),
    ]
    assert [r["valid_to"] for r in found[:-1]] == [r["valid_from"] for r in found[1:]]


def test_top_n_and_samples(spark):
    df = skewed(spark)
    top = picking.top_n(df, ["k"], [F.desc("at"), F.desc("id")], 2)
    assert top.groupBy("k").count().where("count != 2").count() == 0
    assert rows(df.where(picking.hash_bucket("id", 4) == 1)) == rows(df.where(picking.hash_bucket("id", 4) == 1))


def test_hot_key_is_spread_over_slices(hot):
    rows_n, key = 4000, F.lit("hot")
    df = hot.range(rows_n).select("id", key.alias("k"))
    sizes = [r["count"] for r in ordered._sliced(df, ["k"], ["id"]).groupBy("_slice").count().collect()]
    assert len(sizes) == 8 and max(sizes) < rows_n / 4
