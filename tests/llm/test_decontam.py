"""Decontamination against five-word overlap, with paraphrases, odd rows and a reference of several slices."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from tierflow.llm import decontam, queries
from test_documents import prose


def overlap(item: str, text: str) -> float:
    """Share of the item's five-word stretches that the text holds."""
    words = lambda t: re.findall(r"\w+", t.lower())
    grams = lambda w: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    own = grams(words(item))
    return len(own & grams(words(text))) / len(own)


def test_given_benchmark(spark):
    docs = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    items = pq.read_table(f"{SMALL}/benchmark.parquet").to_pylist()
    want = {(d["doc_id"], i["item_id"]) for d in docs for i in items if overlap(i["text"], d["text"]) >= 0.8}
    got = queries.QUERIES["op4_benchmark_decontamination"](spark, SMALL)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and want


@pytest.fixture(scope="module")
def planted(spark):
    r = random.Random(3)
    items = [(k, prose(1000 + k, r.randint(12, 150))) for k in range(40)]
    docs, want = [], set()
    for k in range(120):
        words = prose(5000 + k, r.choice([0, 5, 40, 300, 2000])).split()
        if k % 2:
            n, text = items[k % 40]
            leaked = text.split()
            if k % 3 == 0:  # every ninth word is another one
                leaked = [w if j % 9 else prose(k * 1000 + j, 1) for j, w in enumerate(leaked)]
            if k % 5 == 0:
                leaked = [w.upper() + "," for w in leaked]
            at = r.randint(0, len(words))
            words[at:at] = leaked
            want.add((k, n))
        docs.append((k, " ".join(words)))
    frame = lambda x, s: spark.createDataFrame(x, s)
    return frame(docs, "doc_id long, text string").repartition(4), frame(items, "item_id long, text string"), want


def test_planted_items_and_paraphrases(planted):
    docs, items, want = planted
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(docs, items).collect()} == want


def test_reference_in_slices(planted, monkeypatch):
    docs, items, want = planted
    monkeypatch.setattr(decontam, "SLICE_WORDS", 1500)
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(docs, items).collect()} == want


def test_answers_decide_on_loose_matches(spark):
    item = prose(77, 60).split()
    cut = item[:20] + prose(78, 18).split() + item[38:]  # 70 % in place, with the closing words
    without = item[:42] + prose(79, 18).split()  # 70 % in place, without them
    docs = spark.createDataFrame([(1, " ".join(cut)), (2, " ".join(without))], "doc_id long, text string")
    items = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    assert [(r.doc_id, r.answered) for r in decontam.leaks(docs, items).collect()] == [(1, True)]
    named = items.withColumn("answer", F.lit(" ".join(item[:4])))
    assert {r.doc_id for r in decontam.leaks(docs, named, answer_col="answer").collect()} == {1, 2}


def test_odd_rows(spark):
    text = prose(5, 30)
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "..."), (None, text), (4, text), (4, text), (5, prose(6, 30)), (6, prose(7, 60_000) + " " + text)],
        "doc_id long, text string",
    ).withColumn("item_id", F.lit("x"))
    items = spark.createDataFrame([(1, text), (2, None), (3, " . "), (1, text)], "item_id long, text string")
    got = rows(decontam.leaks(docs, items).select("doc_id", "item_id"))
    assert got == [(4, 1), (4, 1), (6, 1), (None, 1)]
    left = decontam.without_leaks(docs, items)
    assert left.columns == docs.columns and rows(left.select("doc_id")) == [(1,), (2,), (3,), (5,)]
    assert decontam.leaks(docs, items.limit(0)).count() == 0
    assert decontam.without_leaks(docs, items.limit(0)).count() == docs.count()
    assert decontam.leaks(docs.limit(0), items).count() == 0


def test_common_subsequence():
    r = random.Random(1)
    for _ in range(300):
        a, b = ([bytes([r.randint(0, 4)]) for _ in range(r.randint(1, 30))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert decontam.common_subsequence(tuple(a), b) == table[-1, -1]


def test_svd_matches_numpy(spark):
    r = np.random.default_rng(2)
    dense = (r.random((150, 60)) < 0.2) * r.random((150, 60)) * np.linspace(3, 0.1, 60)
    sparse = [(np.flatnonzero(x).tolist(), x[np.flatnonzero(x)].tolist()) for x in dense]
    found = decontam.truncated_svd(spark, sparse, 60, 5, power=6)
    true = np.linalg.svd(dense, full_matrices=False)[2][:5].T
    assert np.linalg.norm(true.T @ found) ** 2 > 4.9  # the same space
