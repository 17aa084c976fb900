"""Licence scanning with a positional index of rare words, in DataFrame functions only.

Licence notices are templates: a wording, and key words that must all stand at their places in it. The document frequency
of the templates' words over the whole corpus gives their IDF. Of each template the RAREST key words of highest IDF are looked
up in a text; places where their postings agree on "position in the text minus position in the template" are candidates,
and a candidate is confirmed by all key words at their distances. Since a confirmed place holds every key word, looking
up the rarest ones loses none. All of it happens within the row of a text; only the frequencies are gathered.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.fingerprints import LOWER, UPPER

#: Key words of a template that are looked up.
RAREST = 2


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: Words of ``text`` that must all stand at their places.
    key: str


# Opening words of the licences and their notices, short mentions, and the plain phrases with their labels.
TEMPLATES = (
    Template("agpl", "gnu affero general public license", "gnu affero general public license"),
    Template(
        "agpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version",
        "program redistribute modify gnu affero general public license published foundation",
    ),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
        "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed "
        "to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of "
        "any kind either express or implied see the license for the specific language governing permissions and limitations under "
        "the license",
        "licensed apache license version 2 0 compliance obtain",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        "redistribution source binary forms permitted provided",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met redistributions of source code must retain the above copyright notice this list of conditions "
        "and the following disclaimer",
        "redistribution source binary forms permitted provided redistributions retain copyright notice",
    ),
    Template("bsl", "boost software license version 1 0", "boost software license"),
    Template(
        "bsl",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying "
        "documentation covered by this license the software to use reproduce display distribute execute and transmit the software",
        "permission hereby granted organization obtaining accompanying documentation covered license",
    ),
    Template("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    Template(
        "cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
        "licensed creative commons attribution noncommercial",
    ),
    Template("cc-by-nd", "licensed under cc by nd", "cc by nd"),
    Template(
        "cc-by-nd", "this work is licensed under a creative commons attribution noderivatives 4 0 international license",
        "licensed creative commons attribution noderivatives",
    ),
    Template("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    Template(
        "cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license",
        "licensed creative commons attribution sharealike",
    ),
    Template("epl", "eclipse public license", "eclipse public license"),
    Template(
        "epl",
        "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0 which is "
        "available at https www eclipse org legal epl 2 0",
        "program accompanying materials eclipse public license",
    ),
    Template("gpl-2.0", "gnu general public license version 2", "gnu general public license version 2"),
    Template(
        "gpl-2.0",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
        "as published by the free software foundation either version 2 of the license or at your option any later version",
        "program redistribute modify gnu general public license published foundation version 2",
    ),
    Template("gpl-3.0", "gnu general public license version 3", "gnu general public license version 3"),
    Template(
        "gpl-3.0",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
        "as published by the free software foundation either version 3 of the license or at your option any later version",
        "program redistribute modify gnu general public license published foundation version 3",
    ),
    Template(
        "isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        "permission copy modify distribute software purpose granted",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided "
        "that the above copyright notice and this permission notice appear in all copies",
        "permission copy modify distribute software purpose granted provided copyright notice appear copies",
    ),
    Template("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    Template(
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public "
        "license as published by the free software foundation either version 2 1 of the license or at your option any later version",
        "library redistribute modify gnu lesser general public license published foundation",
    ),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files",
        "permission hereby granted charge obtaining software",
    ),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
        "files the software to deal in the software without restriction including without limitation the rights to use copy modify "
        "merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
        "furnished to do so subject to the following conditions",
        "permission hereby granted charge obtaining software deal restriction rights merge publish sublicense sell permit furnished",
    ),
    Template("mpl-2.0", "mozilla public license v 2 0", "mozilla public license"),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed "
        "with this file you can obtain one at http mozilla org mpl 2 0",
        "source code form mozilla public license mpl distributed",
    ),
    Template(
        "unlicense", "this is free and unencumbered software released into the public domain",
        "unencumbered software released public domain",
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell "
        "or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial "
        "and by any means",
        "unencumbered software released public domain anyone compile sell compiled binary commercial",
    ),
)
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Counts the texts among the counts of words; no word holds it.
_TEXTS = "\x01"


def key_places(t: Template) -> list[tuple[str, int]]:
    """(word, position) of the key words, each at its first place after the one before."""
    words, at, found = t.text.split(), 0, []
    for word in t.key.split():
        at = words.index(word, at)
        found.append((word, at))
        at += 1
    return found


def vocabulary() -> list[str]:
    return sorted({w for t in TEMPLATES for w in t.text.split()} | {w for p, _ in PHRASES for w in p.split()})


def words_column(text: Column) -> Column:
    """Runs of ASCII letters (A-Z in lower case), digits and characters outside ASCII, in order."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), _SEPARATORS), "")


def weights(docs: DataFrame, text_col: str) -> dict[str, int]:
    """1 + floor(1000 idf) of every word of the templates, from the number of texts that hold it; one count a word is gathered."""
    held = F.array_intersect(F.array(*map(F.lit, vocabulary())), words_column(F.col(text_col)))
    counted = docs.select(F.explode(F.concat(F.array(F.lit(_TEXTS)), held)).alias("word")).groupBy("word").count()
    seen = {r["word"]: r["count"] for r in counted.collect()}
    return {w: 1 + math.floor(1000 * math.log((seen.get(_TEXTS, 0) + 1) / (seen.get(w, 0) + 1))) for w in vocabulary()}


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rarest: int = RAREST) -> DataFrame:
    """One row a text: n_words, the places of the plain phrases, their labels, all labels, and a score.

    The score is 1 where a plain phrase stands, else the largest share of a confirmed template's words that stand in their places,
    weighted by ``weights``, else 0. A null text counts as empty (no words, no labels, score 0). Repeated rows and null ids
    give a row each; an empty table gives none. Only the two columns are read.
    """
    weight = weights(docs, text_col)
    plain = [(label, phrase, key_places(Template(label, phrase, phrase))) for phrase, label in PHRASES]
    wordings = [(t.label, t.text, key_places(t)) for t in TEMPLATES]
    rare = lambda keys: sorted(keys, key=lambda k: (-weight[k[0]], k[1]))[:rarest]
    looked_up = sorted({word for _, _, keys in plain + wordings for word, _ in rare(keys)})
    words, hits = F.col("words"), F.col("hits")

    def places(keys: list[tuple[str, int]]) -> Column:
        """Where all ``keys`` stand: the postings of the rarest agree, and the others confirm."""
        postings = [F.transform(F.filter(hits, lambda p: F.get(words, p) == w), lambda p: p - at) for w, at in rare(keys)]
        agreed = postings[0]
        for other in postings[1:]:
            agreed = F.array_intersect(agreed, other)

        def stand(o: Column) -> Column:
            found = F.lit(True)
            for word, at in keys:
                found = found & (F.get(words, o + at) == word)
            return F.coalesce(found, F.lit(False))

        return F.filter(agreed, stand)

    def cover(found: Column, text: str) -> Column:
        """The largest weighted share of the wording's words in place; null where it is not found."""
        wording = text.split()
        expected, worth = F.array(*map(F.lit, wording)), F.array(*[F.lit(weight[w]) for w in wording])

        def in_place(o: Column) -> Column:
            steps = F.sequence(F.lit(0), F.lit(len(wording) - 1))
            add = lambda n, k: n + F.when(F.get(words, o + k) == F.get(expected, k), F.get(worth, k)).otherwise(0)
            return F.aggregate(steps, F.lit(0), add)

        return F.array_max(F.transform(found, in_place)) / F.lit(sum(weight[w] for w in wording))

    cut = docs.select(F.col(id_col).alias("id"), words_column(F.col(text_col)).alias("words"))
    known = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(*looked_up))
    none = F.array().cast("array<int>")
    looked = cut.select("id", "words", F.when(F.size(words) > 0, known).otherwise(none).alias("hits"))
    placed = looked.select(
        "id", "words", F.size(words).alias("n_words"),
        *[F.when(F.size(hits) > 0, places(keys)).otherwise(none).alias(f"p{n}") for n, (_, _, keys) in enumerate(plain)],
        *[F.when(F.size(hits) > 0, places(keys)).otherwise(none).alias(f"t{n}") for n, (_, _, keys) in enumerate(wordings)],
    )
    base_labels = F.array_compact(F.array(*[F.when(F.size(f"p{n}") > 0, label) for n, (label, _, _) in enumerate(plain)]))
    own_labels = F.array_compact(F.array(*[F.when(F.size(f"t{n}") > 0, label) for n, (label, _, _) in enumerate(wordings)]))
    starts = F.concat(*[F.col(f"p{n}") for n in range(len(plain))])
    covers = F.array(*[F.when(F.size(f"t{n}") > 0, cover(F.col(f"t{n}"), text)) for n, (_, text, _) in enumerate(wordings)])
    named = placed.select("id", "n_words", starts.alias("starts"), base_labels.alias("base"), own_labels.alias("own"), F.array_max(covers).alias("cover"))
    return named.select(
        F.col("id").alias(id_col),
        F.col("n_words").cast("long").alias("n_words"),
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "own")), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
    )
