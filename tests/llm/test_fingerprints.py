"""Threshold-scaled fingerprints against a plain version."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
import xxhash
from conftest import rows
from pyspark.sql import functions as F
from test_documents import DOCS, ODD, clashing, prose

from tierflow.llm import base, fingerprints


def plain_sketch(text: str | None, width: int = 5, one_in: int = 8) -> list[int]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    grams = [" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))] if words else []
    hashes = sorted({int(hashlib.md5(g.encode()).hexdigest()[:15], 16) for g in grams})
    return [h for h in hashes if h < 16**15 // one_in] or hashes[:1]


def share(a: list, b: list) -> float:
    smaller = min(len(a), len(b))
    return len(set(a) & set(b)) / smaller if smaller else float(a == b)


def plain_rows(docs: list[tuple], one_in: int = 8) -> list[tuple]:
    body = lambda t: (xxhash.xxh64_intdigest((t or "").encode(), 42) + 2**63) % 2**64 - 2**63
    order = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, body(r[1])), reverse=True)
    out = []
    for k, (i, text) in enumerate(order):
        text, other = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(text)
        edited = text[: n - n // 2] + other[: n // 2]
        own, changed, ahead = (plain_sketch(t, one_in=one_in) for t in (text, edited, other))
        shown = ["".join(f"{h:015x}" for h in s) for s in (own, changed)]
        out.append((i, n, hashlib.sha256(edited.encode()).hexdigest(), *shown, share(own, changed), share(own, ahead)))
    return sorted(out, key=repr)


def many() -> list[tuple]:
    r = random.Random(3)
    texts = [prose(k, r.choice([1, 4, 5, 6, 30, 200])) for k in range(60)]
    texts += [texts[k] for k in (3, 9, 9)] + [texts[20] + " " + texts[21], prose(77, 9000)]
    return [(k * 7 - 50, t) for k, t in enumerate(texts)] + [(6, texts[5])] * 9 + ODD


@pytest.mark.parametrize("slice_rows, copies", [(1 << 18, 4096), (7, 4)])
def test_edits_and_neighbours(spark, monkeypatch, slice_rows, copies):
    whole = base.sliced
    monkeypatch.setattr(fingerprints, "sliced", lambda *a: whole(*a, rows=slice_rows))
    docs = clashing(spark.createDataFrame(many(), DOCS).repartition(4))
    found = fingerprints.compared_with_edits(docs, copies=copies)
    assert rows(found) == plain_rows(many())


def test_one_row_and_no_row(spark):
    one = spark.createDataFrame([(1, "a b c")], DOCS)
    assert rows(fingerprints.compared_with_edits(one)) == plain_rows([(1, "a b c")])
    assert fingerprints.compared_with_edits(one.limit(0)).count() == 0


def test_sketches_merge_and_estimate_containment(spark):
    long, part = prose(1, 20000), " ".join(prose(1, 20000).split()[5000:5600])
    docs = spark.createDataFrame([(1, long), (2, part), (3, prose(2, 400)), (4, "two words"), (5, "")], DOCS)
    sketches = docs.select("doc_id", fingerprints.sketch_column(F.coalesce("text", F.lit(""))).alias("sketch"))
    held = {r.doc_id: r.sketch for r in sketches.collect()}
    assert held == {i: plain_sketch(t) for i, t in [(1, long), (2, part), (3, prose(2, 400)), (4, "two words"), (5, "")]}
    assert len(held[1]) > 30 * len(held[2]) / 2
    grouped = sketches.withColumn("half", F.when(F.col("doc_id") <= 2, "a").otherwise("b"))
    unions = fingerprints.merged(grouped, ["half"])
    want = {("a", h) for h in held[1] + held[2]} | {("b", h) for h in held[3]}
    assert {tuple(r) for r in unions.collect()} >= want
    inside = {(r.doc_id, r.half): r.containment for r in fingerprints.contained(sketches, "doc_id", unions, ["half"]).collect()}
    assert inside[(2, "a")] == 1.0 and inside[(1, "a")] == 1.0 and (2, "b") not in inside
    pair = spark.createDataFrame([(held[1], held[2])], "a array<long>, b array<long>")
    assert pair.select(fingerprints.containment(F.col("a"), F.col("b"))).first()[0] == 1.0


def test_union_of_fingerprints_is_the_fingerprint_of_the_union(spark):
    texts = [prose(40 + k, n) for k, n in enumerate((300, 40, 5, 2))]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    sketches = docs.select("doc_id", fingerprints.sketch_column(F.col("text")).alias("sketch")).withColumn("g", F.lit(1))
    union = sorted(r.hash for r in fingerprints.merged(sketches, ["g"]).collect())
    every = sorted({h for t in texts for h in plain_sketch(t)})
    limit = 16**15 // 8
    assert union == ([h for h in every if h < limit] or every[:1])


def test_native_plan(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    plan = fingerprints.compared_with_edits(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
