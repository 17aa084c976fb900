"""Token counts of a sentencepiece BPE model by rank-synchronous merging of arrays.

A text is prepared as the library does it (a space is put before it and spaces become U+2581) and cut into pre-tokens
where no piece of the vocabulary can reach across. The new pre-tokens of a batch are held as one ragged numpy array of
symbols; in every round each of them merges its pair of lowest rank, the leftmost of equals, all of them at once. When
nothing merges any more, the symbols left are counted. Characters outside the vocabulary count one token a byte.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.base import prepare

SPACE = "▁"
#: Pre-tokens whose counts a worker remembers at a time.
_REMEMBERED = 500_000
#: Pre-tokens of more symbols are merged one by one with a heap, since rounds would be too many.
_LONG = 64


_NONE = np.int64(1) << 62


class Merger:
    """Counts by pre-token for one model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
        plain = [k for k in range(model.vocab_size()) if not any(f(k) for f in special)]
        scores = {model.id_to_piece(k): model.get_score(k) for k in plain}
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in scores):
            raise ValueError("a piece of this vocabulary reaches across the start of a word")
        letters = sorted({c for piece in scores for c in piece})
        ids = {piece: k for k, piece in enumerate([*letters, *sorted(p for p in scores if len(p) > 1)])}
        #: Tokens a symbol counts: one, or the bytes of a character that is no piece by itself.
        self.weight = np.array([1 if p in scores else len(p.encode()) for p in ids] + [0], dtype=np.int64)
        self.ids, self.outside = ids, len(ids)
        order = {score: k for k, score in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs: dict[int, tuple[int, int]] = {}
        for piece, score in scores.items():
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[self._key(left, right)] = (order[score], ids[piece])
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks, self.made = (np.array([pairs[k][n] for k in self.keys.tolist()], dtype=np.int64) for n in (0, 1))
        self.counts: dict[str, int] = {}

    def _key(self, left, right):
        return left * (self.outside + 1) + right

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = self._key(left, right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE >> 32)

    def _symbols(self, word: str) -> list[int]:
        get = self.ids.get
        return [get(c, self.outside) for c in word]

    def _outside_bytes(self, word: str) -> int:
        return sum(len(c.encode("utf-8", "surrogatepass")) for c in word if c not in self.ids)

    def merge_batch(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token: rounds in which every sequence merges its leftmost pair of lowest rank."""
        lists = [self._symbols(w) for w in words]
        total = np.array([self._outside_bytes(w) if self.outside in x else 0 for w, x in zip(words, lists)], dtype=np.int64)
        sizes = np.array([len(x) for x in lists], dtype=np.int64)
        symbols = np.array([k for x in lists for k in x], dtype=np.int64)
        sequence = np.repeat(np.arange(len(words)), sizes)
        last = np.append(sequence[1:] != sequence[:-1], True)
        rank = np.full(len(symbols), _NONE >> 32, dtype=np.int64)
        inner = np.flatnonzero(~last)
        rank[inner] = self._rank(symbols[inner], symbols[inner + 1])
        while len(symbols):
            starts = np.flatnonzero(np.append(True, sequence[1:] != sequence[:-1]))
            best = np.minimum.reduceat((rank << 32) | np.arange(len(rank)), starts)
            going = best < _NONE
            spans = np.diff(np.append(starts, len(symbols)))
            if not going.all():
                done = np.repeat(~going, spans)
                np.add.at(total, sequence[done], self.weight[symbols[done]])
                moved = np.cumsum(~done) - 1
                symbols, sequence, rank = symbols[~done], sequence[~done], rank[~done]
                best = moved[best[going] & 0xFFFFFFFF]
            else:
                best = best & 0xFFFFFFFF
            if not len(best):
                break
            key = self._key(symbols[best], symbols[best + 1])
            symbols[best] = self.made[np.searchsorted(self.keys, key)]
            keep = np.ones(len(symbols), dtype=bool)
            keep[best + 1] = False
            best = (np.cumsum(keep) - 1)[best]
            symbols, sequence, rank = symbols[keep], sequence[keep], rank[keep]
            for at in (best, best[best > 0] - 1):
                within = at[(at + 1 < len(symbols))]
                within = within[sequence[within] == sequence[within + 1]]
                rank[at] = _NONE >> 32
                rank[within] = self._rank(symbols[within], symbols[within + 1])
        return total

    def merge_long(self, word: str) -> int:
        """The same count for one long pre-token, with a heap of pairs."""
        symbols = self._symbols(word)
        count, after, before = len(symbols), list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        heap = []

        def add(at: int) -> None:
            then = after[at]
            if then < count and (found := self.pairs.get(self._key(symbols[at], symbols[then]))):
                heapq.heappush(heap, (found[0], at, symbols[at], symbols[then], found[1]))

        for k in range(count - 1):
            add(k)
        while heap:
            _, at, left, right, made = heapq.heappop(heap)
            then = after[at] if symbols[at] == left else count
            if then >= count or symbols[then] != right:
                continue
            symbols[at], symbols[then] = made, -1
            after[at] = after[then]
            if after[at] < count:
                before[after[at]] = at
            add(at)
            if before[at] >= 0:
                add(before[at])
        return self._outside_bytes(word) + sum(int(self.weight[k]) for k in symbols if k >= 0)

    def pretokens(self, text: str) -> list[str]:
        """Pieces of a text between which no pair can merge, without the U+2581 that each begins with.

        A run of several spaces stays together with the word after it, as a pre-token that begins with U+2581.
        """
        if not text:
            return []
        if "  " not in text and SPACE not in text and text[0] != " ":
            return text.split(" ")
        prepared = SPACE + text.replace(" ", SPACE)
        return [w[1:] for w in re.findall(f"{SPACE}+[^{SPACE}]*", prepared)]

    def learn(self, words: set[str]) -> None:
        short = sorted(w for w in words if len(w) < _LONG)
        for at in range(0, len(short), 1 << 16):
            some = short[at : at + (1 << 16)]
            self.counts.update(zip(some, self.merge_batch([SPACE + w for w in some]).tolist()))
        for w in words:
            if len(w) >= _LONG:
                self.counts[w] = self.merge_long(SPACE + w)

    def count(self, texts: list[str]) -> list[int]:
        found: list[int] = []
        at = 0
        while at < len(texts):
            end, chars, split = at, 0, []
            while end < len(texts) and (end == at or chars < 1 << 20):
                chars += len(texts[end])
                split.append(self.pretokens(texts[end]))
                end += 1
            if len(self.counts) > _REMEMBERED:
                self.counts.clear()
            self.learn(set().union(*split).difference(self.counts))
            known = self.counts.__getitem__
            found.extend(sum(map(known, words)) for words in split)
            at = end
        return found


_CACHED: dict[str, Merger] = {}


def merger(path: str) -> Merger:
    """One instance a worker and file."""
    if path not in _CACHED:
        _CACHED[path] = Merger(path)
    return _CACHED[path]


def with_token_counts(docs: DataFrame, model: str, text_col: str = "text", limit: int = 4096) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit (n_tokens above ``limit``).

    ``model`` is the path of a sentencepiece BPE model with byte fallback whose normaliser changes nothing but spaces.
    Nothing is added to the text (no begin or end token) and nothing cut. A null text counts as empty: no bytes, no
    tokens. Rows and other columns stay; older columns of the three names are replaced.
    """

    prepare(docs.sparkSession)

    @F.arrow_udf("long")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = merger(model)
        for texts in batches:
            yield pa.array(counter.count([t or "" for t in texts.to_pylist()]), pa.int64())
        counter.counts.clear()  # the worker lives on

    text = F.coalesce(F.col(text_col), F.lit(""))
    made = docs.drop("n_bytes", "n_tokens", "over_limit").withColumns(
        {"n_bytes": F.octet_length(text).cast("long"), "n_tokens": tokens(F.col(text_col))}
    )
    return made.withColumn("over_limit", F.col("n_tokens") > limit)
