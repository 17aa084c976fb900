"""Near-duplicates by similarity against all pairs of five-word sets."""

from __future__ import annotations

import random

import pytest
from conftest import SMALL
from test_documents import prose

from tierflow.llm import shingles, simhash
from tierflow.llm.base import table


def grams(text: str | None) -> frozenset:
    words = (text or "").lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def kept_ids(texts: dict, least: float = 0.8) -> set:
    sets, label = {i: grams(t) for i, t in texts.items()}, {i: i for i in texts}
    for i in sorted(texts):
        for j in sorted(texts):
            if i < j and label[i] != label[j] and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = {k: low if x == high else x for k, x in label.items()}
    return set(label.values())


@pytest.fixture(scope="module")
def near():
    """Copies with a growing share of words replaced, a chain, short and empty texts."""
    r, texts = random.Random(5), {}
    for k in range(60):
        words = prose(300 + k, r.randint(100, 400)).split()
        for share in (0, 0.002, 0.01, 0.02, 0.03):
            changed = [w if r.random() >= share else prose(r.randrange(1 << 30), 1) + "x" for w in words]
            texts[len(texts)] = " ".join(changed)
    chain = prose(999, 200).split()
    for k in range(12):
        texts[len(texts)] = " ".join(chain[k * 15 : k * 15 + 200] + prose(2000, 300).split()[: k * 15])
    for text in (None, "", " ", "a b", "A  b", "a b c"):
        texts[len(texts)] = text
    return texts


@pytest.mark.parametrize("cell", [1 << 20, 500])
def test_every_pair_of_the_similarity_is_joined(spark, near, monkeypatch, cell):
    whole = shingles.near_edges
    monkeypatch.setattr(shingles, "near_edges", lambda *a: whole(*a, cell_shingles=cell))
    docs = spark.createDataFrame([*near.items()], "doc_id long, text string").repartition(4)
    kept = simhash.one_of_each(docs, words_per_shingle=5, similarity=0.8)
    assert {r.doc_id for r in kept.collect()} == kept_ids(near)


def test_similarity_on_documents(spark):
    docs = table(spark, SMALL, "documents")
    kept = simhash.one_of_each(docs, words_per_shingle=5, similarity=0.8)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == kept_ids({r.doc_id: r.text for r in docs.collect()})
