"""Packing into training sequences by powers of two.

The tokens of a document are cut into pieces whose lengths are the powers of two of their number: as many of the largest
length as fit, then the binary digits of the rest, longest first. A piece is a sequence of its own, so that none holds
tokens of two documents and none needs padding; batches are drawn from ``bucket``, the pieces of one length.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.base import prepare

_PIECES = "piece_start long, piece_length long, piece_ids binary, document_tokens long"
#: Words whose ids a worker remembers at a time.
_REMEMBERED = 800_000
#: Fixed forms: a run of Latin letters and the ASCII punctuation after it. Neither is changed by the words around it.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


class WordIds:
    """Token ids of whole texts through a tokenizers file whose words do not depend on the words around them.

    Texts are split at ASCII spaces and line ends, which such a tokenizer drops; each distinct word is encoded once and
    remembered. The common form, Latin letters and then punctuation, is two pre-tokens, and ends of words are seen from
    the tokens, so that thousands of new words go through the library in one call. Every other word is encoded alone.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, k in vocabulary.items():
            self.ends[k] = token.endswith("</w>")
        self.words: dict[str, bytes] = {}  # runs of letters and marks too, which are words as well

    def _alone(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn_parts(self, parts: list[str]) -> None:
        # The fast form leaves out where tokens stand in the text.
        encoded = self.tokenizer.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0]
        ids = np.array(encoded.ids, dtype="<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(parts):
            self.words.update((part, self._alone(part)) for part in parts)
            return
        data, last = ids.tobytes(), 0
        for part, end in zip(parts, (4 * ends).tolist()):
            self.words[part] = data[last:end]
            last = end

    def learn(self, words: set[str]) -> None:
        split, new = {}, set()
        for word in words:
            if simple := _SIMPLE.fullmatch(word):
                split[word] = pair = (simple[1].lower(), simple[2])
                new.update(part for part in pair if part and part not in self.words)
            else:
                self.words[word] = self._alone(word)
        ordered = sorted(new)
        for at in range(0, len(ordered), 2000):
            self._learn_parts(ordered[at : at + 2000])
        known = self.words
        for word, (letters, marks) in split.items():
            known[word] = known[letters] + known[marks] if marks else known[letters]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        at = 0
        while at < len(texts):
            end, chars, split = at, 0, []
            while end < len(texts) and (end == at or chars < 1 << 21):
                chars += len(texts[end])
                split.append([w for w in texts[end].replace("\n", " ").split(" ") if w])
                end += 1
            if len(self.words) > _REMEMBERED:
                self.words.clear()
            self.learn(set().union(*split).difference(self.words))
            known = self.words.__getitem__
            for words in split:
                yield b"".join(map(known, words))
            at = end


_CACHED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One instance a worker and file."""
    if path not in _CACHED:
        _CACHED[path] = WordIds(path)
    return _CACHED[path]


def piece_lengths(total: int, longest: int) -> list[int]:
    """Powers of two, none above ``longest``, that add up to ``total``, in falling order."""
    lengths = [longest] * (total // longest)
    rest, power = total % longest, longest // 2
    while rest:
        if rest >= power:
            lengths.append(power)
            rest -= power
        power //= 2
    return lengths


def _cut(encoded: Iterator[bytes], end: bytes, longest: int) -> pa.Array:
    """The pieces of each document as an Arrow list of structs."""
    starts, lengths, parts, totals, offsets = [], [], [], [], [0]
    for ids in encoded:
        ids += end
        total, at = len(ids) // 4, 0
        for length in piece_lengths(total, longest):
            starts.append(at)
            lengths.append(length)
            parts.append(ids[4 * at : 4 * (at + length)])
            at += length
            totals.append(total)
        offsets.append(len(starts))
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64())
    fields = [pa.array(x, k) for x, k in zip((starts, lengths, parts, totals), kinds)]
    names = [x.split()[0] for x in _PIECES.split(", ")]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, names))


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, longest: int = 4096, text_col: str = "text") -> DataFrame:
    """One row a piece: the columns of ``docs`` without the text, then start, length, ids, doc_tokens, bucket,
    sequence_id, offset.

    A document is its token ids followed by ``end_id``; a null text counts as empty and so is one piece of that one id.
    ``ids`` holds little-endian unsigned 32-bit numbers. ``bucket`` is the power of two, ``sequence_id`` a number of the
    piece that is unique in the result. ``longest`` must be a power of two. Repeated rows are packed each for itself;
    columns of the names above are replaced. Ids of any kind, null too, are handed through.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    prepare(docs.sparkSession)
    end = int(end_id).to_bytes(4, "little")

    @F.arrow_udf(f"array<struct<{_PIECES.replace(' ', ':').replace(',:', ',')}>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = word_ids(tokenizer)
        for texts in batches:
            yield _cut(encoder.encode([t or "" for t in texts.to_pylist()]), end, longest)
        encoder.words.clear()  # the worker lives on

    made = ("start", "length", "ids", "doc_tokens", "bucket", "sequence_id", "offset")
    kept = [c for c in docs.columns if c not in made and c != text_col]
    cut_up = docs.select(*kept, F.inline(cut(F.col(text_col))))
    return cut_up.select(
        *kept,
        F.col("piece_start").alias("start"),
        F.col("piece_length").alias("length"),
        F.col("piece_ids").alias("ids"),
        F.col("document_tokens").alias("doc_tokens"),
        F.log2("piece_length").cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
