"""Language identification by cross-parsing entropy.

For every language a suffix automaton is built over a sample of its labelled text. A text is parsed against it from the
left: each phrase is the longest stretch from the current position that occurs somewhere in the sample, then the next
phrase begins. Few phrases mean that the text is made of the language's own pieces. Phrases are normalised to bits a
character, ``phrases * log2(sample length) / length``, and the smallest value wins.

With "no transition: count a phrase, go on from the start state" folded in, an automaton is a complete transition table over
the most frequent characters; edges by any other letter are kept in one sorted list, so that no alphabet is cut. Tasks walk
all texts of a batch side by side, one look-up per character and language. Long texts are walked in pieces at once, each
from the start state, and what the piece before carries over is then followed until both parses agree: the phrases are those
of the whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.base import fresh, prepare

_LETTER = re.compile(r"[^\W\d_]")
_WORD = re.compile(r"[^\W\d_]+")
#: Characters walked in one go; a longer text is walked in pieces of this length side by side.
PIECE = 1024
#: Symbols with columns of their own in the table, the one of all other letters included.
SYMBOLS = 64
#: Characters worked on together, which bounds the memory of a task.
_TOGETHER = 1 << 20
_PREDICTION = "lang_pred string, score double"


@dataclass(frozen=True)
class Model:
    """The parsing tables of all languages in one array.

    ``table[state + symbol]`` is four times the next state, plus the phrases that end with this step; ``starts`` are
    the start states by language, ``sizes`` the lengths of the samples. Symbol 0 stands for letters not in ``symbols``; their
    edges are in ``edges`` (ascending ``state << 21 | code point``), with the next states in ``ends``.
    """

    langs: tuple[str, ...]
    symbols: dict[str, int]
    table: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    edges: np.ndarray
    ends: np.ndarray


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions by state of the smallest automaton that knows every substring of ``codes``; state 0 is the start."""
    follow: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for code in codes:
        current = len(follow)
        follow.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at != -1 and code not in follow[at]:
            follow[at][code] = current
            at = link[at]
        if at != -1:
            old = follow[at][code]
            if length[at] + 1 == length[old]:
                link[current] = old
            else:
                clone = len(follow)
                follow.append(dict(follow[old]))
                link.append(link[old])
                length.append(length[at] + 1)
                while at != -1 and follow[at].get(code) == old:
                    follow[at][code] = clone
                    at = link[at]
                link[old] = link[current] = clone
        last = current
    return follow


def build(samples: dict[str, str], common_symbols: int = SYMBOLS) -> Model:
    """One automaton per language over its sample text; the most frequent characters get columns of their own."""
    plain = {lang: " ".join(_WORD.findall(text.lower())) for lang, text in samples.items()}
    counts = Counter(c for text in plain.values() for c in text)
    common = sorted(counts, key=lambda c: (-counts[c], c))[: common_symbols - 1]
    symbols = {c: k for k, c in enumerate(common, 1)}
    width, tables, starts, sizes, offset = len(symbols) + 1, [], [], [], 0
    rare: list[tuple[int, int]] = []
    for lang in sorted(plain):
        follow = suffix_automaton([ord(c) for c in plain[lang]])
        columns = {ord(c): k for c, k in symbols.items()}
        # Without a transition the phrase ends and the next one begins with the symbol; one that the sample lacks is a
        # phrase of its own.
        begin = np.full(width, offset * 4 + 2, dtype=np.int64)
        for code, state in follow[0].items():
            if code in columns:
                begin[columns[code]] = (offset + state * width) * 4 + 1
        table = np.tile(begin, (len(follow), 1))
        table[0] = offset * 4 + 1
        for state, edges in enumerate(follow):
            for code, then in edges.items():
                if code in columns:
                    table[state, columns[code]] = (offset + then * width) * 4
                else:
                    rare.append(((offset + state * width) << 21 | code, offset + then * width))
        tables.append(table.ravel())
        starts.append(offset)
        sizes.append(max(2, len(plain[lang])))
        offset += table.size
    rare.sort()
    whole = np.concatenate(tables) if tables else np.zeros(0, np.int64)
    return Model(
        tuple(sorted(plain)), symbols, whole.astype(np.int32) if offset < 1 << 29 else whole, np.array(starts, dtype=np.int64),
        np.array(sizes, dtype=float), np.array([e for e, _ in rare], np.int64), np.array([n for _, n in rare], np.int64),
    )


#: Parts of a label's rows that are ranked on their own before the label's first rows are.
_PARTS = 64


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample_docs: int = 64, sample_chars: int = 12_000, max_labels: int = 500,
) -> Model:
    """Learns one automaton per label from at most ``sample_docs`` documents and ``sample_chars`` characters a label.

    That sample is the documented bound of the classifier: documents come first by a hash of their id, then by their
    text, equal ones count once, and each gives an equal share of the characters. Rows without a text or a label teach
    nothing. Of more than ``max_labels`` labels, those of the most rows are learnt (ties: the ones that sort first), so that a
    column full of stray labels cannot outgrow a task.
    """
    labelled = docs.where(F.col(lang_col).isNotNull())
    counted = labelled.groupBy(F.col(lang_col).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(max_labels).select("lang")
    filled = labelled.where((F.length(text_col) > 0) & F.col(id_col).isNotNull())
    cut = F.substring(text_col, 1, sample_chars)
    known = filled.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.xxhash64(cut).alias("key"), cut.alias("text"))
    known = known.join(F.broadcast(counted), "lang", "left_semi")  # at most max_labels rows
    drawn = F.xxhash64(F.col("id").cast("string"))
    order = [drawn, F.col("id"), F.col("key")]
    first = F.row_number().over(Window.partitionBy("lang", F.pmod(drawn, F.lit(_PARTS))).orderBy(*order))
    near = known.select("lang", "id", "key").distinct().withColumn("place", first).where(F.col("place") <= sample_docs)
    ranked = near.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    # at most sample_docs rows a label
    chosen = F.broadcast(ranked.where(F.col("place") <= sample_docs).drop("place"))
    rows = known.join(chosen, ["lang", "id", "key"], "left_semi").groupBy("lang", "id", "key").agg(F.first("text").alias("text"))
    texts: dict[str, list[str]] = {}
    for row in sorted(rows.collect(), key=lambda r: (r["lang"], r["id"], r["text"])):
        texts.setdefault(row["lang"], []).append(row["text"])
    return build({lang: " ".join(t[: max(1, sample_chars // len(x))] for t in x) for lang, x in texts.items()})


def _lookup(model: Model) -> np.ndarray:
    """Symbol by code point: known characters, 0 for other letters, the space's symbol for all that is no letter."""
    gap = model.symbols.get(" ", 0)
    found = np.array([0 if chr(k).isalpha() else gap for k in range(0x110000)], dtype=np.uint8)
    for c, k in model.symbols.items():
        found[ord(c)] = k
    return found


def _step(model: Model, starts: np.ndarray, state: np.ndarray, codes: np.ndarray, points: np.ndarray | None) -> np.ndarray:
    """Four times the next states plus ended phrases, for states of one row a language or of one row in all.

    ``starts`` are the start states in the shape of ``state`` or one a row. ``points`` are the code points, None where no code is 0.
    """
    value = model.table[state + codes]
    if points is None:
        return value
    rare = np.flatnonzero(codes == 0)
    if not len(rare) or not len(model.edges):
        return value
    value = value.astype(np.int64)
    own, point = state[..., rare], points[rare].astype(np.int64)
    begin = np.broadcast_to(starts, state.shape)[..., rare]

    def edge(at: np.ndarray) -> np.ndarray:
        """The state behind the edge from ``at``, or -1."""
        key = at << 21 | point
        place = np.minimum(np.searchsorted(model.edges, key), len(model.edges) - 1)
        return np.where(model.edges[place] == key, model.ends[place], -1)

    on, anew = edge(own), edge(begin)
    fresh_start = np.where(anew >= 0, anew * 4 + np.where(own == begin, 0, 1), begin * 4 + np.where(own == begin, 1, 2))
    value[..., rare] = np.where(on >= 0, on * 4, fresh_start)
    return value


def phrases(model: Model, lookup: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each text: phrases by language, and the symbols parsed (runs of other characters than letters count once)."""
    points = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(p) for p in points])
    joined = np.concatenate(points) if points else np.zeros(0, np.uint32)
    codes = lookup[joined]
    gap = model.symbols.get(" ", 0)
    if gap:
        again = (codes[1:] == gap) & (codes[:-1] == gap) & (owner[1:] == owner[:-1])
        keep = np.concatenate([[True], ~again]) if len(codes) else np.zeros(0, bool)
        codes, owner, joined = codes[keep], owner[keep], joined[keep]
    lengths = np.bincount(owner, minlength=len(texts))
    pieces = -(-lengths // PIECE)
    doc = np.repeat(np.arange(len(texts)), pieces)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.repeat(np.cumsum(lengths) - lengths, pieces) + nth * PIECE
    size = np.minimum(PIECE, lengths[doc] - nth * PIECE)

    # Every piece from the start state, side by side; with its states and phrases so far where a text has several pieces.
    order = np.argsort(-size, kind="stable")
    steps = int(size.max()) if len(size) else 0
    active = np.searchsorted(-size[order], -np.arange(steps), side="left")
    state = np.repeat(model.starts[:, None], len(doc), axis=1)
    count = np.zeros(state.shape, dtype=np.int32)
    several = bool((pieces > 1).any())
    trail = np.zeros((2 if several else 0, steps, *state.shape), dtype=np.int32)
    known = joined if len(codes) and not codes.all() else None
    at = begin[order]
    for t, n in enumerate(active):
        here = at[:n] + t
        value = _step(model, model.starts[:, None], state[:, :n], codes[here], known if known is None else known[here])
        count[:, :n] += (value & 3).astype(np.int32)
        state[:, :n] = value >> 2
        if several:
            trail[0, t, :, :n] = state[:, :n]
            trail[1, t, :, :n] = count[:, :n]
    exit_state, total = np.empty_like(state), np.empty(state.shape, np.int64)
    exit_state[:, order], total[:, order] = state, count
    if several:
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        _carry(model, codes, known, begin, size, np.flatnonzero(nth > 0), pieces[doc] > nth + 1, (trail, place), exit_state, total)
    last = np.flatnonzero(pieces[doc] == nth + 1)
    total[:, last] += exit_state[:, last] != model.starts[:, None]
    found = np.stack([np.bincount(doc, weights=row, minlength=len(texts)).astype(np.int64) for row in total])
    return found, lengths


def _carry(model, codes, points, begin, size, later, has_next, cold, exit_state, total) -> None:
    """Corrects exit states and phrases of the pieces ``later`` for the state that the piece before them hands on.

    A corrected parse is followed until it meets the one from the start state, which mostly takes a phrase or two; where it does
    not meet it before the end of the piece, the next piece is corrected again. ``cold`` are the states and phrases of the parses from
    the start by step, language and place, and the place of each piece there.
    """
    (states, counts), place = cold
    cold_exit, cold_total = exit_state.copy(), total.copy()
    lang, piece = (x.ravel() for x in np.meshgrid(np.arange(len(model.starts)), later, indexing="ij"))
    while len(piece):
        state, n = exit_state[lang, piece - 1].copy(), np.zeros(len(piece), np.int64)
        before = exit_state[lang, piece].copy()
        # Equal to the start state: nothing is carried over, and the parse from the start stands.
        same = state == model.starts[lang]
        exit_state[lang[same], piece[same]], total[lang[same], piece[same]] = cold_exit[lang[same], piece[same]], cold_total[lang[same], piece[same]]
        going, t = np.flatnonzero(~same), 0
        while len(going):
            k, p = lang[going], piece[going]
            here = begin[p] + t
            value = _step(model, model.starts[k], state[going], codes[here], points if points is None else points[here])
            n[going] += value & 3
            state[going] = value >> 2
            met, ended = states[t, k, place[p]] == state[going], t + 1 == size[p]
            done = met | ended
            if done.any():
                ks, ps, ns, ms = k[done], p[done], n[going][done], met[done]
                total[ks, ps] = np.where(ms, ns + cold_total[ks, ps] - counts[t, ks, place[ps]], ns)
                exit_state[ks, ps] = np.where(ms, cold_exit[ks, ps], state[going][done])
                going = going[~done]
            t += 1
        moved = (exit_state[lang, piece] != before) & has_next[piece]
        lang, piece = lang[moved], piece[moved] + 1


def predict(model: Model, lookup: np.ndarray, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """The language of each text and a score: the runner-up's share of the two smallest entropies, 0 for ``und``."""
    with_letters = [k for k, t in enumerate(texts) if t and _LETTER.search(t)] if model.langs else []
    langs, scores = ["und"] * len(texts), [0.0] * len(texts)
    at = 0
    while at < len(with_letters):
        end, chars = at, 0
        while end < len(with_letters) and (end == at or chars + len(texts[with_letters[end]]) <= _TOGETHER):
            chars += len(texts[with_letters[end]])
            end += 1
        some = with_letters[at:end]
        found, lengths = phrases(model, lookup, [texts[k] for k in some])
        bits = found * np.log2(model.sizes)[:, None] / np.maximum(1, lengths)
        best = bits.argmin(axis=0)
        two = np.sort(bits, axis=0)[:2]
        for n, k in enumerate(some):
            langs[k] = model.langs[best[n]]
            scores[k] = float(two[1, n] / (two[0, n] + two[1, n])) if len(two) > 1 else 1.0
        at = end
    return langs, scores


def language_column(model: Model, text: Column, docs: DataFrame) -> Column:
    """A struct (lang_pred, score) of each text, ``und`` with score 0 for null and for texts without a letter.

    Ties go to the label that sorts first. A model without labels calls everything ``und``.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(_PREDICTION)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lookup = _lookup(shared.value)
        for texts in batches:
            langs, scores = predict(shared.value, lookup, texts.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    # Not to be run again for a filter on its result.
    return of.asNondeterministic()(text)


def with_language(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (an older column of such a name is replaced); rows and other columns stay."""
    docs = docs.drop("lang_pred", "score")
    (both,) = fresh(docs, "language")
    named = docs.withColumn(both, language_column(model, F.col(text_col), docs))
    return named.select("*", f"{both}.*").drop(both)


def accepted(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang", sure: float = 0.6) -> DataFrame:
    """The rows of ``docs`` that have a language: those called ``und`` go; missing labels are filled in, wrong ones replaced.

    A label is wrong where the prediction differs with a score of ``sure`` or more (at 0.6 the runner-up needs half as many
    phrases again). A model without labels cannot tell languages apart and only rejects texts without a letter. Null and empty
    texts are ``und``.
    """
    if not model.langs:
        return docs.where(F.col(text_col).rlike(r"\p{L}"))
    (both,) = fresh(docs, "language")
    named = docs.withColumn(both, language_column(model, F.col(text_col), docs)).where(F.col(f"{both}.lang_pred") != "und")
    label = F.when(F.col(lang_col).isNull() | (F.col(f"{both}.score") >= sure), F.col(f"{both}.lang_pred")).otherwise(F.col(lang_col))
    return named.withColumn(lang_col, label).drop(both)
