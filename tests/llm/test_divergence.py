"""The divergence audit against a plain version that prices every cell of the matrix."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import rows
from test_documents import prose

from tierflow.llm import divergence

SCHEMA = "doc_id long, lang string, source string, text string, stripe string, g string, p string, value string"


def plain(docs: list[tuple], least: int, top: int = 10) -> list[tuple]:
    counts, inside = {}, {}
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        found = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered))
        counts.setdefault(lang, {}).setdefault(source, Counter()).update(found)
        inside.setdefault(lang, Counter()).update(found.keys())
    out = []
    for lang, groups in counts.items():
        kept = sorted(t for t, n in inside[lang].items() if n >= least)
        every = sum(groups.values(), Counter())

        def price(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q = {g: price(c) for g, c in groups.items()}, price(every)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for g in groups:
            pairs = [(sum(f(p[g][t], p[h][t]) for t in kept), h) for h in groups if h != g]
            terms = [(f(p[g][t], q[t]), t) for t in kept if groups[g][t] > 0 and p[g][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ordered = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, g, part, item, value, n) for n, (value, item) in enumerate(ordered, 1)]
    return sorted(out, key=repr)


def corpus() -> list[tuple]:
    r, out = random.Random(11), []
    for k in range(400):
        lang = r.choice(["en", "en", "en", "de", None, ""])
        source = r.choice([f"s{r.randrange(9)}", "hot", "hot", "é", None])
        text = prose(r.randrange(60), r.choice([0, 3, 40])) + r.choice(["", " Ünï日本 x1y2 Z", " É É", " ", " kelvin K"])
        out.append((lang, source, text))
    out += [("fr", f"lone{k}", None) for k in range(3)]  # no kept term at all
    out += [("es", "only", "uno dos tres")] * 12  # one source, repeated rows
    out += [("en", "mute", "123 !?")] * 2  # a source without terms
    return out


@pytest.mark.parametrize("side, columns, least", [(64, 4096, 10), (4, 16, 3), (2, 5, 1)])
def test_audit_equals_every_cell_priced(spark, monkeypatch, side, columns, least):
    monkeypatch.setattr(divergence, "_HELD", 50)
    docs = [(k, *r, "x", "x", "x", "x") for k, r in enumerate(corpus())]
    frame = spark.createDataFrame(docs, SCHEMA).repartition(5)
    found = divergence.audit(frame, side=side, columns=columns, least_docs=least)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert rows(found) == plain(corpus(), least)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_walk_prices_empty_quadrants_by_width():
    r = np.random.default_rng(2)
    for side in (1, 2, 8, 32):
        for density in (0, 0.02, 0.5, 1):
            p0, q0 = r.integers(1, 9, side), r.integers(1, 9, side)
            left, right = (np.where(r.random((side, side)) < density, r.integers(1, 999, (side, side)), 0) for _ in range(2))
            width = int(r.integers(1, side + 1))
            left[:, width:] = right[:, width:] = 0
            p, q = np.where(left > 0, left, p0[:, None])[:, None, :width], np.where(right > 0, right, q0[:, None])[None, :, :width]
            want = ((p - q) ** 2 // (p + q)).sum(axis=2)
            assert (divergence.walk(left, right, p0, q0, width) == want).all()
            rows, columns = (int(r.integers(1, side + 1)) for _ in range(2))  # the rest is padding
            left[rows:], p0[rows:], right[columns:], q0[columns:] = 0, 0, 0, 0
            for upper in (False, True):
                got = divergence.walk(left, right, p0, q0, width, upper)[:rows, :columns]
                assert (np.triu(got - want[:rows, :columns]) == 0).all() if upper else (got == want[:rows, :columns]).all()


def test_quadtree_levels():
    filled = np.zeros((4, 4), bool)
    filled[3, 0] = True
    assert [level.astype(int).tolist() for level in divergence.quadtree(filled)[:2]] == [[[1]], [[0, 0], [1, 0]]]


def test_large_counts_stay_exact(spark):
    row = spark.createDataFrame([(10**13, 3 * 10**15 + 7, 10**6)], "n long, total long, kept long")
    assert row.select(divergence.probability("n", "total", "kept")).first()[0] == 1 + 10**9 * (10**13 + 2) // (3 * 10**15 + 7 + 2 * 10**6)
