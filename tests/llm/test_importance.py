"""Importance resampling against a plain version; the quickselect against sorting."""

from __future__ import annotations

import hashlib
import math
import random
import re
from zlib import crc32

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_documents import DOCS, ODD, clashing, prose

from tierflow.llm import base, importance, words


def plain_words(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_buckets(text: str | None, longest: int, buckets: int) -> list[int]:
    w = plain_words(text)
    return [crc32(" ".join(w[k : k + n]).encode()) % buckets for n in range(1, longest + 1) for k in range(len(w) - n + 1)]


def plain_rows(docs, target, percent=10, least=20, longest=1, buckets=10_000) -> list[tuple]:
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for b in plain_buckets(text, longest, buckets):
                counts[b] += 1
    big_s, big_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log(((y + 1) * (big_s + buckets)) / ((x + 1) * (big_t + buckets)))) for x, y in zip(s, t)]
    out = []
    for i, text in docs:
        found = plain_buckets(text, longest, buckets)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(plain_words(text)), len(found), weight, score))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = able[: percent * len(able) // 100]
    others = [r for r in out if r[1] < least] + able[len(drawn) :]
    return sorted([(*r, n) for n, r in enumerate(drawn, 1)] + [(*r, None) for r in others], key=repr)


def corpus() -> list[tuple]:
    r = random.Random(8)
    docs = [(k, prose(k, r.choice([0, 5, 19, 20, 21, 60, 300]))) for k in range(150)]
    copied = prose(501, 40)
    return docs + [(7000, copied)] * 40 + [(7001, copied + " more"), (7001, copied), (None, copied)] + ODD


@pytest.mark.parametrize("percent, slice_rows, longest", [(10, 1 << 18, 1), (60, 16, 1), (35, 9, 3), (100, 50, 2), (0, 50, 1)])
def test_draw_equals_a_sort(spark, monkeypatch, percent, slice_rows, longest):
    whole, again = base.sliced, base.repeated
    monkeypatch.setattr(importance, "sliced", lambda *a: whole(*a, rows=slice_rows))
    monkeypatch.setattr(importance, "repeated", lambda *a: again(*a, block=3))
    target = [prose(k, 30) for k in range(0, 40, 4)] + [None, ""]
    docs = clashing(spark.createDataFrame(corpus(), DOCS).repartition(4))
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    found = importance.resampled(docs, frame, percent=percent, longest=longest)
    assert rows(found.select("doc_id", "n_words", "n_features", "weight", "score", "rank")) == plain_rows(corpus(), target, percent, longest=longest)


def test_empty_tables(spark):
    docs, none = spark.createDataFrame(corpus()[:30], DOCS), spark.createDataFrame([], "text string")
    got = importance.resampled(docs, none).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
    assert rows(got) == plain_rows(corpus()[:30], [])
    assert importance.resampled(docs.limit(0), none).count() == 0


def test_long_text_in_blocks(monkeypatch):
    text = prose(1, 5000)
    monkeypatch.setattr(words, "_BLOCK", 100)
    blocks = [list(words.blocks(text, words.WORDS, size)) for size in (1, 100, 1 << 20)]
    assert [w.decode() for b in blocks[1] for w in b] == plain_words(text) == [w.decode() for b in blocks[0] for w in b]
    for longest in (1, 2, 4):
        got = np.concatenate([f for _, f in importance.feature_buckets(text, longest, 999)])
        assert sorted(got.tolist()) == sorted(plain_buckets(text, longest, 999))


@pytest.mark.parametrize("pivots", [1, 4, 15])
def test_quickselect_with_ties_and_weights(spark, monkeypatch, pivots):
    monkeypatch.setattr(importance, "PIVOTS", pivots)
    r = random.Random(pivots)
    keyed = sorted({(r.randrange(12), r.choice([None, *range(6)])) for _ in range(60)}, key=lambda k: (k[0], k[1] is not None, k[1] or 0))
    weighed = [(*k, r.choice([1, 1, 2, 50])) for k in keyed]
    frame = base.stored(spark.createDataFrame(weighed, "a long, b long, n long"), "test-select")
    listed = [((a, b), c) for a, b, n in weighed for c in range(1, n + 1)]
    for k in {1, 2, len(listed) // 2, len(listed) - 1, len(listed)}:
        assert importance.quickselect(frame, ["a", "b"], "n", k) == listed[k - 1]


def test_ranks_over_slices(spark):
    frame = base.stored(spark.range(100).select((F.col("id") * 37 % 100).alias("a"), F.lit(2).cast("long").alias("n")), "test-ranks")
    assert sorted((r.a, r["rank"]) for r in importance.ranked(frame, ["a"], "n").collect()) == [(k // 2, k + 1) for k in range(200)]
