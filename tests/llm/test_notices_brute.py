"""Labels and scores of the licence scan against a plain search for every place of every template."""

from __future__ import annotations

import math
import random
import re

from test_documents import prose

from tierflow.llm import license_scan


def words_of(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(texts: list[str | None]) -> list[tuple]:
    """(labels, score) by trying every template at every place."""
    split = [words_of(t) for t in texts]
    held = {w: sum(w in s for s in map(set, split)) for w in license_scan.vocabulary()}
    weight = {w: 1 + math.floor(1000 * math.log((len(texts) + 1) / (n + 1))) for w, n in held.items()}
    out = []
    for words in split:
        at = lambda k: words[k] if 0 <= k < len(words) else None  # noqa: B023, E731
        labels, score = set(), 0.0
        for phrase, label in license_scan.PHRASES:
            if any(words[k : k + len(phrase.split())] == phrase.split() for k in range(len(words))):
                labels.add(label)
                score = 1.0
        for t in license_scan.TEMPLATES:
            whole = t.text.split()
            for start in range(-len(whole), len(words)):
                if all(at(start + k) == w for w, k in license_scan.key_places(t)):
                    labels.add(t.label)
                    got = sum(weight[w] for k, w in enumerate(whole) if at(start + k) == w)
                    score = max(score, got / sum(weight[w] for w in whole))
        out.append((",".join(sorted(labels)), score))
    return out


def test_labels_and_scores(spark):
    r, texts = random.Random(4), [None, "", "MIT", "the mit", "license mit license"]
    for n in range(120):
        t = license_scan.TEMPLATES[n % len(license_scan.TEMPLATES)]
        words = t.text.split()
        for _ in range(r.choice([0, 0, 1, 3])):
            words[r.randrange(len(words))] = r.choice(["x", "the", "license", "software"])
        if n % 7 == 3:
            del words[r.randrange(len(words))]
        if n % 5 == 0:
            words = words[r.randrange(3) :]
        texts.append(prose(n, r.choice([0, 4])) + " " + ", ".join(words).upper() + " " + prose(n + 1, r.choice([0, 4])))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {x.doc_id: (x.labels, x.score) for x in license_scan.report(frame).collect()}
    want = plain(texts)
    assert [found[k][0] for k in range(len(texts))] == [labels for labels, _ in want]
    assert max(abs(found[k][1] - score) for k, (_, score) in enumerate(want)) < 1e-12
    assert {s for _, s in want} - {0.0, 1.0}
