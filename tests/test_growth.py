"""Plans whose work must not grow faster than the input."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tierflow.operators import ordered


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_range_frames_are_two_running_sums(spark):
    r = random.Random(3)
    data = [(n, r.choice(["a", "b", None]), r.choice([None, -(2**53) - 1, *range(-40, 40)]), r.choice([None, 1, 5])) for n in range(200)]
    frame = spark.createDataFrame(data, "id long, g string, at long, v long")
    found = ordered.over_range(frame, ["g"], "at", 7, 2, {"n": F.lit(1).cast("bigint"), "total": F.col("v")}, hot=False)
    assert "RangeFrame, -7" not in plan(found)  # such a frame is added up anew for every row
    assert found.columns == ["id", "g", "at", "v", "n", "total"]
    got = {x.id: (x.n, x.total) for x in found.collect()}
    for i, g, at, _ in data:
        near = [v for _, h, b, v in data if h == g and (b is None if at is None else b is not None and at - 7 <= b <= at + 2)]
        known = [v for v in near if v is not None]
        assert got[i] == (len(near), sum(known) if known else None)
