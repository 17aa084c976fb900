"""Streams merged into tables with a version log, and segmented snapshot histories."""

from __future__ import annotations

import datetime
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierflow.operators import history
from tierflow.operators.sessions import sessionize
from tierflow.session import work_path
from tierflow.sources import landing
from tierflow.sources.versions import VersionedTable
from tierflow.streaming import feeds

SCHEMA = "id long, u string, ts timestamp_ntz, v double"
START = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def batches():
    """Three batches whose rows overlap in time: late rows, new rows, and rows that join two sessions."""
    r = random.Random(3)
    every = [(k, r.choice(["a", "b", None]), START + datetime.timedelta(minutes=r.randrange(4000)), float(r.randrange(9))) for k in range(150)]
    return [every[:60], every[60:90], every[90:]]


def kept_up(spark, batches, keys, change):
    folder, table = work_path(spark, "stream"), VersionedTable(spark, work_path(spark, "kept"), keys)
    checkpoint = work_path(spark, "checkpoint")
    for batch in batches:
        landing.append(spark.createDataFrame(batch, SCHEMA).coalesce(1), folder)
        feeds.keep_up(feeds.file_stream(spark, folder, SCHEMA), table, change, checkpoint).awaitTermination()
    return table


def test_windows_firsts_and_sessions_equal_the_batch_answer(spark, batches):
    whole = spark.createDataFrame(sum(batches, []), SCHEMA)
    table = kept_up(spark, batches, ["window_start", "u"], feeds.fold_windows("ts", ["u"], "v", "1 hour"))
    want = feeds.window_partials(whole, "ts", ["u"], "v", "1 hour")
    assert rows(table.read().select("window_start", "u", "_rows", F.col("total").cast("double"))) == rows(want.withColumn("total", F.col("total").cast("double")))
    again = VersionedTable(spark, table.root, table.keys, "batch 2")
    assert again.before() == (table.version() - 1, True)

    table = kept_up(spark, batches, ["u"], feeds.fold_firsts(["ts", "id"]))
    assert rows(table.read()) == rows(feeds.first_partials(whole, ["u"], ["ts", "id"]))

    table = kept_up(spark, batches, ["u", "first"], feeds.fold_sessions("u", "ts", "id", 3600))
    numbered = sessionize(whole.select("u", "ts", "id"), "u", "ts", "id", 3600)
    plain = numbered.groupBy("u", "session_number").agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("events"))
    assert rows(table.read().select("u", "first", "last", "events")) == rows(plain.drop("session_number"))


def test_segmented_history_equals_the_snapshot_and_prunes(spark):
    r = random.Random(5)
    kept = history.SegmentedHistory(spark, work_path(spark, "segments"), "k", ["x", "y"])
    plain, states = None, {}
    held = {k: (r.choice([None, 1, 2]), "a") for k in [None, *range(12)]}
    for day in range(1, 6):
        at = datetime.datetime(2024, 1, day)
        current = spark.createDataFrame([(k, *v) for k, v in held.items()], "k long, x long, y string")
        kept.run(current, F.lit(at).cast("timestamp_ntz"))
        if day == 3:
            kept.run(current, F.lit(at).cast("timestamp_ntz"))  # repeated
        plain = history.snapshot(plain, current, "k", ["x", "y"], F.lit(at).cast("timestamp_ntz")).checkpoint()
        for k in r.sample([*range(16)], 5):
            held[k] = (r.choice([None, 1, 2]), r.choice("ab"))
        held.pop(r.choice([k for k in held]), None)
    columns = ["k", "x", "y", "scd_id", "valid_from", "valid_to"]
    assert rows(kept.read().select(columns)) == rows(plain.select(columns))
    for day in range(1, 7):
        at = datetime.datetime(2024, 1, day)
        assert rows(kept.rows_at(at).select(columns)) == rows(history.rows_at(plain, F.lit(at).cast("timestamp_ntz")).select(columns))
    opened, closed = kept._tables()
    assert len(closed.read_after(datetime.datetime(2024, 1, 4)).inputFiles()) < len(closed.read().inputFiles())
    assert all(h["kind"] == "append" for h in closed.history())
