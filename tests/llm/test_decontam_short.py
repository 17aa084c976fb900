"""Short items planted word for word in the given texts: all must be found."""

from __future__ import annotations

import random

import pyarrow.parquet as pq
from conftest import SMALL
from test_documents import prose

from tierflow.llm import decontam


def test_every_short_item_is_found(spark):
    """Items made of the texts' own words, so that windows hold many words of other items."""
    texts = [t for t in pq.read_table(f"{SMALL}/documents.parquet")["text"].to_pylist() if len(t.split()) > 80]
    r = random.Random(12)
    pool = [w for t in texts for w in t.split()]
    items, docs, want = [], [], set()
    for n in range(300):
        size = (6, 10, 16, 24, 40)[n % 5]
        items.append((n, " ".join(r.choice(pool) for _ in range(size))))
        words = r.choice(texts).split()
        at = r.randrange(len(words))
        docs.append((n, " ".join([*words[:at], *items[-1][1].split(), *words[at:]])))
        want.add((n, n))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    found = decontam.leaks(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert want <= {(x.doc_id, x.item_id) for x in found.collect()}


def test_windows_cover_every_start(spark):
    item = prose(9, 12).split()
    docs = [(k, " ".join(prose(50 + k, k).split() + item + prose(90 + k, 100).split())) for k in range(70)]
    items = spark.createDataFrame([(1, " ".join(item)), (2, prose(10, 6)), (3, prose(11, 30))], "item_id long, text string")
    found = decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), items)
    assert {x.doc_id for x in found.collect() if x.item_id == 1 and x.lcs_share == 1} == set(range(70))
