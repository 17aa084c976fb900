"""The corpus pipeline against a brute-force version of its stages."""

from __future__ import annotations

import re

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from conftest import SMALL
from test_decontam import overlap
from test_documents import linked_classes, plain_fingerprint, plain_spans

from tierflow.llm import queries
from tierflow.llm.base import stored, table


def masked(text: str) -> str:
    out, at = "", 0
    for start, _, end, _ in plain_spans(text):
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def test_stages_one_by_one(spark):
    docs = table(spark, SMALL, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), f"test-{name}")
        if name != "packing":
            assert docs.columns == columns
        seen[name] = {r.doc_id: r.asDict() for r in docs.collect()} if name != "packing" else docs.collect()
    given = {r["doc_id"]: r for r in pq.read_table(f"{SMALL}/documents.parquet").to_pylist()}

    lettered = {i: r for i, r in given.items() if re.search(r"[^\W\d_]", r["text"])}
    assert seen["language_id"] == lettered
    ids = sorted(lettered)
    classes = linked_classes([plain_fingerprint(lettered[i]["text"]) for i in ids], ids)
    unique = {i: lettered[i] for i, k in zip(ids, classes) if i == k}
    assert seen["simhash_near_dedup"] == unique and len(unique) < len(lettered)
    items = pq.read_table(f"{SMALL}/benchmark.parquet")["text"].to_pylist()
    clean = {i: r for i, r in unique.items() if max(overlap(t, r["text"]) for t in items) < 0.8}
    assert seen["benchmark_decontamination"] == clean and len(clean) < len(unique)
    hidden = {i: r | {"text": masked(r["text"]), "n_chars": len(masked(r["text"]))} for i, r in clean.items()}
    assert seen["secret_scan"] == hidden

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces: dict = {}
    for r in sorted(seen["packing"], key=lambda r: r.start):
        pieces[r.doc_id] = pieces.get(r.doc_id, b"") + bytes(r.ids)
    want = {i: tokenizer.encode(r["text"], add_special_tokens=False).ids + [2] for i, r in hidden.items()}
    assert pieces == {i: np.array(x, dtype="<u4").tobytes() for i, x in want.items()}


def test_run_and_empty_table(spark):
    assert queries.QUERIES["pipeline"](spark, SMALL).columns[:1] == ["doc_id"]
    docs = table(spark, SMALL, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), f"empty-{name}")
    assert docs.count() == 0
