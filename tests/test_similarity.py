"""The most similar rows of many queries against all pairs."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import rows

from tierflow.operators import similarity


def all_pairs(data, queries, k, but_itself=False):
    """(query, id, rank) and similarities by comparing every pair in one fixed order."""
    usable = lambda v: v is not None and len(v) == 6 and all(x is not None and np.isfinite(x) for x in v) and any(v)
    out = {}
    for q, wanted in queries:
        if not usable(wanted):
            continue
        found = []
        for i, v in data:
            if usable(v) and not (but_itself and i is not None and i == q):
                a, b = (np.array(x, dtype=float) / np.abs(np.array(x, dtype=float)).max() for x in (wanted, v))
                found.append(((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())), i))
        found.sort(key=lambda s: (-s[0], s[1] is None, s[1] if s[1] is not None else 0))
        out.update({(q, n): (i, s) for n, (s, i) in enumerate(found[:k], 1)})
    return out


def vectors(seed, count):
    r = np.random.default_rng(seed)
    made = r.standard_normal((count, 6)).tolist()
    made[5] = made[3]
    for k in range(40, 90):
        made[k] = made[7]  # a large group of equal vectors
    made[10:16] = [None, [0.0] * 6, [1.0] * 5, [1.0, None, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 6, [1e300] * 6]
    made[16] = [1e-300 * (k + 1) for k in range(6)]
    return made


@pytest.mark.parametrize("k, tile, parts, block, itself", [(10, 512, 4, 1 << 20, False), (3, 7, 9, 300, True), (60, 33, 2, 2000, True), (1, 5, 1, 1 << 20, False)])
def test_equal_to_all_pairs(spark, monkeypatch, k, tile, parts, block, itself):
    monkeypatch.setattr(similarity, "_TILE", tile)
    data = list(enumerate(vectors(1, 230))) + [(None, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])]
    queries = [(i, v) for i, v in data if i is not None and i % 9 == 7 or i in (40, 15, 16)]
    schema = "vec_id long, embedding array<double>"
    frame, asked = spark.createDataFrame(data, schema).repartition(parts), spark.createDataFrame(queries, schema)
    found = similarity.most_similar_to_each(frame, asked, k, "vec_id", "embedding", but_itself=itself, block_bytes=block)
    want = all_pairs(data, queries, k, itself)
    got = {(r.query_id, r["rank"]): (r.id, r.similarity) for r in found.collect()}
    assert {x: i for x, (i, _) in got.items()} == {x: i for x, (i, _) in want.items()}
    assert max(abs(got[x][1] - want[x][1]) for x in want) < 1e-12


def test_other_types_and_empty_sides(spark):
    data = [("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [0.0, 1.0])]
    frame = spark.createDataFrame(data, "name string, v array<float>")
    asked = spark.createDataFrame([("q", [2.0, 0.0])], "ask string, w array<double>")
    found = similarity.most_similar_to_each(frame, asked, 2, "name", "v", "ask", "w")
    assert rows(found) == [("q", "a", 1.0, 1), ("q", "b", 1.0, 2)]
    for left, right in ((frame.limit(0), asked), (frame, asked.limit(0)), (frame.limit(0), asked.limit(0))):
        assert similarity.most_similar_to_each(left, right, 2, "name", "v", "ask", "w").count() == 0
    uneven = spark.createDataFrame([("q", [1.0]), ("r", [1.0, 2.0])], "ask string, w array<double>")
    with pytest.raises(ValueError):
        similarity.most_similar_to_each(frame, uneven, 2, "name", "v", "ask", "w")


def test_a_thousand_queries(spark):
    r = np.random.default_rng(9)
    made = np.round(r.standard_normal((4000, 16)), 3)
    schema = "vec_id long, embedding array<double>"
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(made.tolist())], schema).repartition(6)
    found = similarity.most_similar_to_each(frame, frame.where("vec_id < 1000"), 10, "vec_id", "embedding", but_itself=True)
    units = made / np.linalg.norm(made, axis=1)[:, None]
    products = units[:1000] @ units.T
    products[np.arange(1000), np.arange(1000)] = -2
    best = np.sort(products, axis=1)[:, :-11:-1]
    got = np.zeros((1000, 10))
    for row in found.collect():
        got[row.query_id, row["rank"] - 1] = row.similarity
    assert np.abs(got - best).max() < 1e-12
