"""Large alphabets, letters beyond the basic plane, pieces of a text, and many labels."""

from __future__ import annotations

import random

import pytest
from test_documents import plain_phrases, prose

from tierflow.llm import langid


@pytest.mark.parametrize("piece, common", [(1, 64), (3, 2), (7, 5), (50, 64), (1024, 3)])
def test_pieces_and_rare_letters_give_the_phrases_of_the_whole_text(monkeypatch, piece, common):
    monkeypatch.setattr(langid, "PIECE", piece)
    r = random.Random(piece)
    draw = lambda letters, n: "".join(r.choice(letters) for _ in range(n)).strip() or "a"
    clean = lambda t: " ".join(t.split())
    samples = {"a": clean(draw("abc ", 400)), "b": clean(draw("abcde漢字語 ", 300)), "c": clean(draw("𐐨𐐩ab ", 200))}
    model = langid.build(samples, common)
    texts = [clean(draw("abcdex漢字𐐨 ", n)) for n in (1, 2, 5, 40, 333)] + [samples["a"], samples["b"] * 3, "x" * 90, samples["c"]]
    found, lengths = langid.phrases(model, langid._lookup(model), texts)
    for k, text in enumerate(texts):
        assert lengths[k] == len(text)
        assert [found[n, k] for n in range(3)] == [plain_phrases(samples[lang], text) for lang in model.langs]


def test_labels_of_large_alphabets_are_told_apart():
    r = random.Random(1)
    shared = [chr(0x4E00 + k) for k in range(400)]
    own = {"x": [chr(0x4E00 + 400 + k) for k in range(800)], "y": [chr(0x4E00 + 1200 + k) for k in range(800)]}
    word = lambda lang: "".join(r.choice(shared + own[lang]) for _ in range(2))
    words = {lang: [word(lang) for _ in range(600)] for lang in own}
    text = lambda lang: " ".join(r.choice(words[lang]) for _ in range(80))
    samples = {lang: " ".join(text(lang) for _ in range(50)) for lang in own} | {"en": prose(1, 2000)}
    model = langid.build(samples)
    asked = [(lang, text(lang)) for lang in own for _ in range(50)] + [("en", prose(k, 60)) for k in range(20)]
    langs, _ = langid.predict(model, langid._lookup(model), [t for _, t in asked])
    assert langs == [lang for lang, _ in asked]


def test_labels_beyond_the_bound_and_a_hot_label(spark):
    docs = [(k, prose(k, 30), "hot") for k in range(900)] + [(k, f"word{k} und der", f"l{k % 40}") for k in range(1000, 1100)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(7)
    assert langid.fit(frame, max_labels=3).langs == ("hot", "l0", "l1")
    assert len(langid.fit(frame).langs) == 41


def test_wrong_labels_are_replaced_where_the_text_is_clear(spark):
    learn = spark.createDataFrame(
        [(k, prose(k, 80), "aa") for k in range(20)] + [(k, "die mit der und das von zur auf ein nicht", "bb") for k in range(20, 40)],
        "doc_id long, text string, lang string",
    )
    docs = spark.createDataFrame([(1, prose(500, 60), "bb"), (2, prose(501, 60), "aa"), (3, "und der die das", None), (4, "", "aa")], learn.schema)
    assert {r.doc_id: r.lang for r in langid.accepted(docs, langid.fit(learn)).collect()} == {1: "aa", 2: "aa", 3: "bb"}
