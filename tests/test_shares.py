"""Tables written share by share, and the files that a refresh leaves behind."""

from __future__ import annotations

import os
import random
import time

from conftest import SMALL, rows
from pyspark.sql import functions as F
from tierflow.catalog.versioned import changed_sources
from tierflow.operators import deltas
from tierflow.plans import domain, incremental, layers
from tierflow.plans.domain import Tables
from tierflow.session import shared_dir, shuffles_removed, work_path
from tierflow.sources.versions import VersionedTable, shares_of


def shuffle_files(spark):
    names = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {names.apply(n).getName() for n in range(names.size()) if names.apply(n).getName().startswith("shuffle_")}


def test_a_share_holds_all_rows_of_a_key(spark):
    values = [None, None, *range(40), *range(40)]
    frame = spark.createDataFrame([(v,) for v in values], "k long")
    found = [[r.k for r in frame.where(share("k")).collect()] for share in shares_of(4)]
    assert sorted(sum(found, []), key=repr) == sorted(values, key=repr) and all(found)
    assert all(not set(a) & set(b) for n, a in enumerate(found) for b in found[:n])


def test_shares_give_the_rows_of_the_whole(spark):
    """Upserts, deletes, null keys, keys that come twice, sums and replaced keys: versions and feeds as without shares."""
    r, schema = random.Random(9), "k long, g string, v long"
    keys = [(k, g) for k in [None, *range(9)] for g in ("a", None)]
    tables = [VersionedTable(spark, work_path(spark, "shared"), ["k", "g"], shares=n) for n in (1, 3)]
    pick = lambda n: [(*k, r.randrange(4)) for k in r.sample(keys, n)]
    frame = lambda data, more="": spark.createDataFrame(data, schema + more)
    first, batch = pick(9), [(*x, r.choice(["DELETE", "UPSERT"])) for x in pick(8)]
    touched, new = r.sample(keys, 7), frame([(3, "a", 5), (3, "a", 5), (None, None, 2), (77, "z", 1)])
    for table in tables:
        table.append(frame(first))
        table.upsert(frame(batch, ", a string"), action="a")
        deltas.replaced(table, spark.createDataFrame([*touched, (3, "a"), (None, None)], "k long, g string"), new)
        assert table.upsert(new) == table.version()
    whole, shared = tables
    assert whole.versions() == shared.versions()
    for v in whole.versions():
        assert rows(whole.read(v)) == rows(shared.read(v))
        assert rows(whole.signed_changes(v - 1, v)) == rows(shared.signed_changes(v - 1, v))
    sums = [VersionedTable(spark, work_path(spark, "sums"), ["k"], shares=n) for n in (1, 3)]
    for table in sums:
        for came, went in ((first, None), (pick(0) or [(1, "a", 4)], first[:5])):
            change = deltas.signed(frame(came), frame(went) if went else None)
            deltas.fold(table, deltas.group_changes(change, ["k"], {"v": (F.col("v"), "long")}))
    assert rows(sums[0].read()) == rows(sums[1].read())


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    before = shuffle_files(spark)
    with shuffles_removed(spark):
        spark.range(1000).groupBy(F.col("id") % 50).count().write.parquet(str(tmp_path / "out"))
        until = time.time() + 20
        while shuffle_files(spark) - before and time.time() < until:
            time.sleep(0.2)
        assert not shuffle_files(spark) - before  # before: until the driver collected its garbage
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50


def test_a_refresh_in_shares_leaves_its_tables_only(spark, monkeypatch):
    monkeypatch.setattr(incremental, "SHARE_BYTES", 1)
    monkeypatch.setattr(incremental, "MOST_SHARES", 2)
    t, root = Tables(spark, SMALL), work_path(spark, "graph")
    before, changes, after = changed_sources(t)
    assert incremental.share_count(after) == 2
    there = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    incremental.refresh_changes(spark, root, before, batch="1")
    incremental.refresh_changes(spark, root, after, changes, batch="2")
    folder = root.removeprefix("file:")
    left = {x.split("-")[0] for x in set(os.listdir(os.path.dirname(folder))) - there}
    assert left == {"graph"}  # before: each frame that was written out for its size
    assert not [x for name in incremental.KEYS for x in (os.listdir(f"{folder}/{name}/work") if os.path.isdir(f"{folder}/{name}/work") else [])]
    found = incremental.read_tables(spark, root)
    columns = found["box_office_dedup"].columns
    assert rows(found["box_office_dedup"]) == rows(domain.box_office_dedup(t).select(columns))
    events = found["fans_unified"].columns
    assert rows(found["fans_unified"]) == rows(layers.fans_unified(t).select(events))
