"""The language sample of repeated ids."""

from __future__ import annotations

from test_documents import prose

from tierflow.llm import langid


def test_language_sample_of_one_id_with_many_texts(spark, monkeypatch):
    docs = [(7, prose(k, 60), "aa") for k in range(3000)] + [(k, f"zur {k} und der die das mit von", "bb") for k in range(3000, 3100)]
    frame = spark.createDataFrame(docs + docs[:500], "doc_id long, text string, lang string").repartition(6)
    seen: dict = {}
    build = langid.build
    monkeypatch.setattr(langid, "build", lambda samples: seen.update(samples) or build(samples))
    fetched = []
    collect = type(frame).collect
    monkeypatch.setattr(type(frame), "collect", lambda self: fetched.append(collect(self)) or fetched[-1])
    model = langid.fit(frame)
    assert max(len(rows) for rows in fetched) <= 128
    assert len(seen["aa"]) <= 12_000 + 64 and any(seen["aa"].startswith(text[:187]) for _, text, lang in docs if lang == "aa")
    langs, _ = langid.predict(model, langid._lookup(model), [prose(9999, 60), "die mit der und das von zur"])
    assert langs == ["aa", "bb"]
