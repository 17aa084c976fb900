"""Tasks are dealt by what they do, not by the bytes they read."""

from __future__ import annotations

import math

from conftest import SMALL
from tierflow.catalog import versioned
from tierflow.operators import joining
from tierflow.plans.domain import Tables
from tierflow.sources.versions import VersionedTable


def test_a_crowded_cell_is_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(joining, "PAIRS_A_TASK", 100)
    sites = [(n, 40.0 + n * 1e-5, -75.0) for n in range(30)] + [(30, None, 0.0)]
    points = [(n, 40.0, -75.0 + n * 1e-4) for n in range(90)] * 2 + [(90, 40.0, None)]
    left = spark.createDataFrame(sites, "s long, site_lat double, site_lon double").coalesce(1)
    right = spark.createDataFrame(points, "p long, point_lat double, point_lon double").coalesce(1)
    found = joining.within_distance(left, right, 300.0)
    assert found.rdd.getNumPartitions() > 20  # before: one task for the cell
    got = sorted((r.s, r.p) for r in found.collect())

    def metres(s, p):
        a, b, c, d = map(math.radians, (s[1], s[2], p[1], p[2]))
        return 2 * 6371008.8 * math.asin(math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2))

    assert got == sorted((s[0], p[0]) for s in sites[:30] for p in points[:-1] if metres(s, p) <= 300)


def test_compacted_files_hold_few_rows(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"])
    for part in range(8):
        table.append(spark.range(part * 1000, part * 1000 + 1000).selectExpr("id AS k", "1 AS same"), files=4)
    version = table.compact(file_rows=2000)  # by their bytes alone all rows would go to one file
    sizes = [r.rows for r in table._listed(version)]
    assert len(sizes) == 4 and sum(sizes) == 8000 and max(sizes) < 4000
    assert table.compact(small_rows=500, file_rows=2000) == version  # files of enough rows are not small
    assert sorted(r.k for r in table.read().collect()) == list(range(8000))


def test_changed_sources_read_each_table_once(spark):
    before, changes, _ = versioned.changed_sources(Tables(spark, SMALL))
    for feeds in (before, changes):
        assert feeds.box._jdf.queryExecution().analyzed().toString().count("Relation [l_orderkey") == 1  # once a variant before
