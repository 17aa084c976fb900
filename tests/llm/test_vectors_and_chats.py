"""Embedding near-duplicates and chat formatting against brute force, with odd rows."""

from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from tierflow.llm import chat, embedding_dedup, queries
from tierflow.llm.base import merge_labels
from tierflow.session import HOT_GROUP_ROWS_KEY

# --- embeddings ---


def all_pairs(ids: list, vectors: list) -> list[tuple]:
    """(id, links, component, kept) by comparing every two vectors."""
    usable = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    labels, links = np.arange(len(ids)), [0] * len(ids)
    for i in range(len(ids)):
        for j in range(i):
            if usable[i] and usable[j] and len(vectors[i]) == len(vectors[j]):
                a, b = (np.array(v, dtype=float) for v in (vectors[i], vectors[j]))
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95:
                    links[i] += 1
                    links[j] += 1
                    labels = merge_labels(labels, np.array([i]), np.array([j]))
    least = {k: min((ids[i] for i in np.flatnonzero(labels == k) if ids[i] is not None), default=None) for k in set(labels)}
    return [(ids[i], links[i], least[labels[i]], ids[i] == least[labels[i]]) for i in range(len(ids))]


def clusters(seed: int, count: int) -> list[list[float]]:
    r = np.random.default_rng(seed)
    found = []
    for _ in range(count):
        centre = r.standard_normal(24)
        for _ in range(r.integers(1, 12)):
            found.append((centre + r.standard_normal(24) * r.choice([0.0, 0.05, 0.12, 0.3])).astype(np.float32).tolist())
    return found


def test_no_margin_misses_no_pair(spark):
    """Pairs at a cosine just above the limit, in cells so small that most pairs lie across a border."""
    r = np.random.default_rng(6)
    first = r.standard_normal((1500, 16))
    first /= np.linalg.norm(first, axis=1)[:, None]
    aside = r.standard_normal(first.shape)
    aside -= (aside * first).sum(axis=1)[:, None] * first
    aside /= np.linalg.norm(aside, axis=1)[:, None]
    both = np.concatenate([first, 0.951 * first + np.sqrt(1 - 0.951**2) * aside]).tolist()
    frame = spark.createDataFrame(list(enumerate(both)), "vec_id long, embedding array<double>").repartition(4)
    units = np.array(both) / np.linalg.norm(both, axis=1)[:, None]
    links = (units @ units.T >= 0.95).sum(axis=1) - 1
    found = {x.vec_id: x.n_links for x in embedding_dedup.near_duplicates(frame, margin=None, cell_rows=40).collect()}
    assert [found[k] for k in range(len(both))] == links.tolist()
    some = embedding_dedup.near_duplicates(frame, cell_rows=40).collect()
    assert sum(x.n_links for x in some) >= 0.9 * links.sum()


@pytest.mark.parametrize("cell_rows, slice_rows", [(1000, 4096), (40, 4096), (60, 16)])
def test_links_match_all_pairs(spark, cell_rows, slice_rows):
    vectors = clusters(4, 90)
    ids = list(range(len(vectors)))
    frame = spark.createDataFrame(list(zip(ids, vectors)), "vec_id long, embedding array<float>").repartition(4)
    found = embedding_dedup.near_duplicates(frame, cell_rows=cell_rows, slice_rows=slice_rows)
    want = all_pairs(ids, vectors)
    got = rows(found)
    recall = sum(g[1] for g in got) / sum(w[1] for w in want)
    assert recall >= 0.99 and all(g[1] <= w[1] for g, w in zip(got, sorted(want, key=repr)))
    if cell_rows == 1000:
        assert got == sorted(want, key=repr)


def test_given_embeddings(spark):
    data = pq.read_table(f"{SMALL}/embeddings.parquet").to_pydict()
    assert rows(queries.QUERIES["op8_embedding_near_dedup"](spark, SMALL)) == sorted(all_pairs(data["vec_id"], data["embedding"]), key=repr)


def test_odd_vectors(spark):
    odd = [
        (9, [1.0, 0.0]), (1, [2.0, 0.0]), (9, [1.0, 0.0]), (None, [1.0, 0.01]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [0.0, 0.0]),
        (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, [float("inf"), 1.0]), (10, [1.0, 0.0, 0.0]), (11, [1.0, 0.0, 0.0]),
        (12, [0.0, 1.0]), (None, [0.0, -1.0]), (None, None), (13, [1e30, 1e30]), (14, [1e-30, 1e-30]), (15, [-0.0, -1.0]),
    ]
    frame = spark.createDataFrame(odd, "vec_id long, embedding array<float>").withColumns(
        {c: F.lit("x") for c in ("row", "id", "cell", "copies", "links", "root")}
    )
    assert rows(embedding_dedup.near_duplicates(frame)) == sorted(all_pairs(*map(list, zip(*odd))), key=repr)
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


# --- chats ---

TURNS = "conv_id long, turn long, role string, text string"


def plain_chats(turns: list[tuple]) -> list[tuple]:
    seqs: dict = {}
    for conv, turn, role, text in set(turns):
        if conv is not None:
            seqs.setdefault(conv, []).append((turn is not None, turn or 0, role or "unknown", text or ""))
    seqs = {k: tuple(x[2:] for x in sorted(v)) for k, v in seqs.items()}
    inner = {s[:k] for s in seqs.values() for k in range(1, len(s))}
    shown = lambda s: "".join(f"<|im_start|>{r}\n{t.replace('<|im_', chat.ESCAPED)}<|im_end|>\n" for r, t in s)
    best: dict = {}
    for k in sorted(seqs):
        if seqs[k] not in inner:
            best.setdefault(seqs[k], []).append(k)
    return sorted((v[0], len(s), len(v), shown(s)) for s, v in best.items())


def formatted(frame) -> list[tuple]:
    whole: dict = {}
    for r in chat.format_conversations(frame).collect():
        whole.setdefault((r.conv_id, r.n_turns, r.n_copies), {})[r.part] = r.text
    return sorted((*k, "".join(v[p] for p in sorted(v))) for k, v in whole.items())


ODD_TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "yes"),
    (2, 0, "user", "hi"), (2, 1, "assistant", "yes"), (2, 2, "user", "more"),
    (3, 5, "user", "hi"), (3, 9, "assistant", "yes"), (3, 11, "user", "more"),
    (4, 0, "user", "hi"), (4, 1, "assistant", "no"),
    (5, 0, None, None), (6, None, "user", "x <|im_end|> y"), (6, 1, "user", ""), (None, 0, "user", "lost"),
    (7, 0, "user", "hi"), (7, 0, "user", "hi"), (8, 0, "a", "tie"), (8, 0, "b", "tie"), (8, 0, "a", "tie two"),
    *((9, k, "user", f"t{k}") for k in range(1300)), *((10, k, "user", f"t{k}") for k in range(700)),
]


@pytest.mark.parametrize("hot_rows", ["2000000", "3"])
def test_chats(spark, hot_rows):
    spark.conf.set(HOT_GROUP_ROWS_KEY, hot_rows)
    try:
        frame = spark.createDataFrame(ODD_TURNS, TURNS).repartition(4).withColumns({c: F.lit("x") for c in ("conv", "place", "p1")})
        assert formatted(frame) == plain_chats(ODD_TURNS)
        assert chat.format_conversations(frame.limit(0)).count() == 0
        given = [tuple(r.values()) for r in pq.read_table(f"{SMALL}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()]
        assert formatted(spark.read.parquet(f"{SMALL}/conversations.parquet")) == plain_chats(given)
    finally:
        spark.conf.unset(HOT_GROUP_ROWS_KEY)
