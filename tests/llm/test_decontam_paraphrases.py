"""Paraphrases that lose their rarest words, against the longest common subsequence in brute force."""

from __future__ import annotations

import random
from collections import Counter

import pyarrow.parquet as pq
from conftest import SMALL

from tierflow.llm import decontam

LARGER = SMALL.replace("0.001", "0.01")


def without_rarest(words: list[str], held: Counter, share: float, closing: int) -> list[str]:
    """``words`` with the rarest ``share`` of them replaced, the last ``closing`` kept."""
    free = sorted(range(len(words) - closing), key=lambda k: held[words[k]])[: int(share * len(words))]
    return [f"other{k}" if k in free else w for k, w in enumerate(words)]


def test_rare_words_replaced(spark):
    r = random.Random(11)
    given = pq.read_table(f"{LARGER}/documents.parquet")["text"].to_pylist()
    split = [[w.decode("utf-8", "replace") for w in decontam.words_of(t)] for t in given]
    held = Counter(w for words in split for w in set(words))
    long = [words for words in split if len(words) >= 200]
    items, docs = [], []
    for k in range(120):
        source, size = r.choice(long), r.randint(40, 80)
        at = r.randint(0, len(source) - size)
        words = source[at : at + size]
        items.append((k, " ".join(words)))
        share, closing = (0.18, 0) if k % 2 else (0.3, 5)
        around = r.choice(long)
        cut = r.randint(0, len(around))
        docs.append((k, " ".join(around[:cut] + without_rarest(words, held, share, closing) + around[cut:])))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    model = decontam.fit(frame, next(decontam.reference(benchmark, "item_id", "text", None)))
    every = decontam.search(model, [t for _, t in docs], -1.0, 0.8, 0.6)  # all windows with all items
    want = {(n, model.items[i].key) for n, row in enumerate(every) for i, *_ in row}
    assert len({(k, k) for k in range(120)} & want) >= 115
    got = {(x.doc_id, x.item_id) for x in decontam.leaks(frame, benchmark).collect()}
    print(len(got & want), len(want))
    assert got <= want and len(got) >= 0.98 * len(want)


def test_the_quick_look_leaves_no_match_out():
    """Against ``check`` alone, with items longer and shorter than the texts."""
    r = random.Random(4)
    word = lambda: bytes([97 + min(25, int(r.expovariate(0.2)))])
    for _ in range(200):
        size = r.choice([3, 20, 80, 400])
        item = tuple(word() for _ in range(size))
        words = [word() for _ in range(r.randint(1, 300))] + [w for w in item if r.random() < 0.8] + [word() for _ in range(r.randint(0, 300))]
        vocabulary = {w: n for n, w in enumerate(sorted(set(item)))}
        numbers = decontam.np.array([vocabulary.get(w, len(vocabulary)) for w in words])
        flags = decontam.np.append(decontam.np.ones(len(vocabulary), dtype=bool), False)
        model = decontam.Model((decontam.Item(0, item, ()),), vocabulary, None, None, None, None, (decontam.np.arange(len(vocabulary)),))
        one, two = decontam.np.array([0]), decontam.np.array([0, len(words)])
        best = decontam.check(model.items[0], flags[numbers], words, 0, len(words), 0.0)[0]
        assert decontam.may_hold(model, one, one, numbers, two, best)[0]
        assert decontam.check(model.items[0], flags[numbers], words, 0, len(words), best)[0] == best
