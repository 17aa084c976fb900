"""Benchmark decontamination by latent semantic retrieval.

Reference passages (stretches of the benchmark items) become TF-IDF vectors, with document frequencies counted over the
whole corpus. A randomised SVD, whose products with the passages are computed by Spark tasks and summed, gives a space of
few dimensions that tells the passages apart. Every text is read in overlapping windows, and for items shorter than such a
window in shorter ones too, which do not dilute them; a window whose projection lies close to that of a passage (cosine) is a
candidate. Candidates are checked on the words themselves: the longest common
subsequence with the item inside a stretch little longer than the item, and, for looser matches, whether the item's
answer stands there too.

All texts take part with all their windows; the reference is worked on in slices of bounded size.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from tierflow.llm.base import prepare

#: Words of a block; a window is two blocks and begins with each of them.
BLOCK = 32
#: Words of a reference passage, and words from one to the next.
PASSAGE, STRIDE = 64, 32
#: Words of a part; windows for short items begin with every part. Items of up to so many words have windows of so many parts,
#: the fewest that hold them wherever they begin.
PART = 8
SHORT = {8: 2, 16: 3, 32: 5}
#: Reference words worked on in one pass over the corpus; a larger reference takes several passes.
SLICE_WORDS = 100_000
#: Share of a short passage's length that a window must reach in its direction.
REACH = 0.7
#: Blocks whose words are projected, and windows that are compared, at a time.
_TOGETHER, _WINDOWS = 64, 8192

#: By byte: ASCII letters, digits and bytes of other characters stay, all else is a space.
_WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and characters outside ASCII."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_WORDS).split()


@dataclass(frozen=True)
class Item:
    """A benchmark item; ``answer`` are the words that give it away."""

    key: object
    words: tuple[bytes, ...]
    answer: tuple[bytes, ...]


@dataclass(frozen=True)
class Model:
    """What tasks need to find one slice of the reference.

    ``vocabulary`` numbers the reference words; ``basis`` has a row for each, weighted by idf, and a row of zeros for all
    other words. ``passages`` are the unit projections, ``norms`` their lengths before, ``owner`` the item of each. ``ids`` numbers the words of each item.
    """

    items: tuple[Item, ...]
    vocabulary: dict[bytes, int]
    basis: np.ndarray
    passages: np.ndarray
    norms: np.ndarray
    owner: np.ndarray
    ids: tuple[np.ndarray, ...]

    def marks(self, item: int, numbers: np.ndarray, scratch: np.ndarray) -> np.ndarray:
        """Whether each word is one of the item's; ``scratch`` is a row of False over the vocabulary, left as it was."""
        scratch[self.ids[item]] = True
        found = scratch[numbers]
        scratch[self.ids[item]] = False
        return found


def document_frequencies(docs: DataFrame, text_col: str, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, int]:
    """In how many texts each word of the reference stands, and how many texts there are: over every row."""
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found, texts = shared.value, Counter(), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update(known.intersection(words_of(text)))
                texts += 1
        keys = [*found, b""]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([*(found[k] for k in keys[:-1]), texts], pa.int64())], ["word", "n"])

    counted = docs.select(text_col).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    held, texts = np.zeros(len(vocabulary)), 0
    for row in counted.collect():  # at most one row for each word of the slice
        if row["word"] == b"":
            texts = row["n"]
        else:
            held[vocabulary[bytes(row["word"])]] = row["n"]
    return held, texts


def _passages(items: list[Item]) -> list[tuple[int, tuple[bytes, ...]]]:
    """(item, words) of the overlapping stretches of every item; the last one ends with the item."""
    found = []
    for n, item in enumerate(items):
        last = max(0, len(item.words) - PASSAGE)
        for at in sorted({*range(0, last, STRIDE), last}):
            found.append((n, item.words[at : at + PASSAGE]))
    return found


def truncated_svd(spark, rows: list[tuple[list[int], list[float]]], width: int, rank: int, power: int = 2) -> np.ndarray:
    """The right singular vectors (width x rank) of a sparse matrix, by a randomised range finder.

    Rows are dealt out to tasks. Each round a task multiplies its rows with the current basis and returns its share of
    A'(A B); the shares are summed in Spark by blocks of columns, and the driver only orthonormalises a width x rank
    matrix, whose size the slice of the reference bounds.
    """
    extra = min(width, len(rows), rank + 8)
    table = spark.createDataFrame([(i, v) for i, v in rows], "ids array<int>, weights array<double>").repartition(
        max(1, min(64, len(rows) // 64))
    )
    chunk = 4096

    def product(basis: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast(basis)

        def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(shared.value)
            for batch in batches:
                for ids, weights in zip(batch.column("ids").to_pylist(), batch.column("weights").to_pylist()):
                    w = np.array(weights)
                    np.add.at(total, ids, np.outer(w, w @ shared.value[ids]))
            for at in range(0, len(total), chunk):
                yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([total[at : at + chunk].tobytes()], pa.binary())], ["at", "part"])

        def add(key: tuple, parts: pa.Table) -> pa.Table:
            summed = sum(np.frombuffer(p) for p in parts.column("part").to_pylist())
            return pa.table({"at": pa.array([key[0].as_py()]), "part": pa.array([summed.tobytes()], pa.binary())})

        parts = table.mapInArrow(share, "at long, part binary").groupBy("at").applyInArrow(add, "at long, part binary").collect()
        whole = np.concatenate([np.frombuffer(r["part"]) for r in sorted(parts, key=lambda r: r["at"])])
        shared.destroy()
        return whole.reshape(basis.shape)

    basis = np.linalg.qr(np.random.default_rng(7).standard_normal((width, extra)))[0]
    for _ in range(power):
        basis = np.linalg.qr(product(basis))[0]
    values, vectors = np.linalg.eigh(basis.T @ product(basis))
    best = np.argsort(-values)[:rank]
    return basis @ vectors[:, best]


def fit(docs: DataFrame, items: list[Item], text_col: str = "text", rank: int = 128) -> Model:
    vocabulary = {w: n for n, w in enumerate(sorted({w for item in items for w in item.words}))}
    held, texts = document_frequencies(docs, text_col, vocabulary)
    idf = np.log((texts + 1) / (held + 1)) + 1e-3
    passages = _passages(items)
    rows = []
    for _, words in passages:
        counts = Counter(vocabulary[w] for w in words)
        weights = np.array([n * idf[k] for k, n in counts.items()])
        rows.append((list(counts), (weights / np.linalg.norm(weights)).tolist()))
    vectors = truncated_svd(docs.sparkSession, rows, len(vocabulary), min(rank, len(vocabulary), len(rows)))
    basis = np.vstack([vectors * idf[:, None], np.zeros((1, vectors.shape[1]))]).astype(np.float32)
    projected = np.array([basis[[vocabulary[w] for w in words]].sum(axis=0) for _, words in passages], dtype=np.float32)
    norms = np.linalg.norm(projected, axis=1)
    unit = projected / np.where(norms > 0, norms, 1)[:, None]
    ids = tuple(np.array(sorted({vocabulary[w] for w in item.words}), dtype=np.int32) for item in items)
    return Model(tuple(items), vocabulary, basis, unit, norms, np.array([n for n, _ in passages]), ids)


def common_subsequence(item: tuple[bytes, ...], region: list[bytes]) -> int:
    """Length of the longest common subsequence, with a bit for every word of the item (Hyyro, 2004)."""
    where: dict[bytes, int] = {}
    for k, word in enumerate(item):
        where[word] = where.get(word, 0) | 1 << k
    full = (1 << len(item)) - 1
    row = full
    for word in region:
        if match := where.get(word, 0) & row:
            row = (row + match | row & ~match) & full
        # a word that is not in the item leaves the row as it is
    return len(item) - row.bit_count()


def check(item: Item, marks: np.ndarray, words: list[bytes], low: int, high: int, least: float) -> tuple[float, int, bool]:
    """The best share of the item in a stretch of 1.25 times its length between ``low`` and ``high``, where that
    begins, and whether the answer stands there word for word.

    ``marks`` tells the item's words between the two. A stretch that holds too few of them for ``least`` is not compared.
    """
    size = len(item.words)
    length, step = size + size // 4 + 1, max(1, size // 8)
    if common_subsequence(item.words, words[low : max(high + step, low + length)]) < least * size:
        return 0.0, low, False  # no stretch of it shares more
    upto = np.concatenate([[0], np.cumsum(marks)])
    begin = np.arange(0, max(1, high - low - length + step), step)
    held = upto[np.minimum(len(upto) - 1, begin + length)] - upto[begin]
    best, start, answered = 0.0, low, False
    for at in begin[held >= least * size][np.argsort(-held[held >= least * size], kind="stable")].tolist():
        if best == 1 or upto[min(len(upto) - 1, at + length)] - upto[at] <= best * size:
            break  # cannot share more words than it holds
        region = words[low + at : low + at + length]
        share = common_subsequence(item.words, region) / size
        if share > best:
            best, start, answered = share, low + at, _stands(item.answer, region)
    return best, start, answered


def _stands(answer: tuple[bytes, ...], region: list[bytes]) -> bool:
    n = len(answer)
    return n > 0 and any(tuple(region[k : k + n]) == answer for k in range(len(region) - n + 1))


@dataclass(frozen=True)
class Windows:
    """Projections of windows, the text of each, the word where it begins, and the words and passages it is meant for."""

    projections: np.ndarray
    text: np.ndarray
    begin: np.ndarray
    words: int
    passages: np.ndarray


def _spans(parts: np.ndarray, first: np.ndarray, counts: np.ndarray, span: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of ``span`` parts from every ``step``-th part of each text: (sums, text, part); a text has one at least."""
    per_text = np.where(counts > 0, np.maximum(1, -(-(counts - span) // step) + 1), 0)
    text = np.repeat(np.arange(len(counts)), per_text)
    nth = (np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)) * step
    low = first[text] + nth
    sums = parts[low].copy()
    for k in range(1, span):
        within = nth + k < counts[text]
        sums[within] += parts[low[within] + k]
    return sums, text, nth


def _windows(model: Model, numbers: list[np.ndarray]) -> Iterator[Windows]:
    """All windows of some texts: those of two blocks for every passage, and shorter ones for the passages of short items."""
    each = BLOCK // PART
    counts = np.array([-(-len(x) // BLOCK) for x in numbers]) * each
    first = np.cumsum(counts) - counts
    padded = np.full(int(counts.sum()) * PART, len(model.vocabulary), dtype=np.int32)
    for x, at in zip(numbers, (first * PART).tolist()):
        padded[at : at + len(x)] = x
    padded = padded.reshape(-1, PART)
    parts = np.empty((len(padded), model.basis.shape[1]), dtype=np.float32)
    for at in range(0, len(padded), _TOGETHER * each):
        model.basis[padded[at : at + _TOGETHER * each]].sum(axis=1, out=parts[at : at + _TOGETHER * each])
    blocks = parts.reshape(-1, each, parts.shape[1]).sum(axis=1)
    sums, text, nth = _spans(blocks, first // each, counts // each, 2, 1)
    yield Windows(sums, text, nth * BLOCK, 2 * BLOCK, np.arange(len(model.owner)))
    sizes, least = np.array([len(item.words) for item in model.items])[model.owner], 0
    for most, span in SHORT.items():
        chosen = np.flatnonzero((sizes > least) & (sizes <= most))
        least = most
        if len(chosen):
            sums, text, nth = _spans(parts, first, counts, span, 1)
            yield Windows(sums, text, nth * PART, span * PART, chosen)


def candidates(model: Model, windows: Windows, low: int, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, passage, cosine) of the windows from ``low`` on near a passage, however little of its weight they hold.

    A window that holds a short passage whole may point elsewhere for its other words, above all where the space is too small for
    all passages; it still reaches about as far in the passage's direction as the passage itself, and is a candidate by that.
    """
    some, passages = windows.projections[low : low + _WINDOWS], model.passages[windows.passages]
    product = some @ passages.T
    norms = np.linalg.norm(some, axis=1, keepdims=True)
    near = product >= cosine * norms
    if windows.words < 2 * BLOCK:
        near |= product >= REACH * model.norms[windows.passages][None, :]
    window, passage = np.nonzero(near & (norms > 1e-6))
    return low + window, windows.passages[passage], product[window, passage] / norms[window, 0]


def may_hold(model: Model, item: np.ndarray, text: np.ndarray, numbers: np.ndarray, starts: np.ndarray, least: float) -> np.ndarray:
    """Whether any stretch of the text, as long as ``check`` compares, holds ``least`` of the item's words in any order.

    ``item`` and ``text`` are pairs; a text is ``numbers`` from its place in ``starts`` to the next. All pairs of an item
    are looked at together. No pair is left out that ``check`` would accept.
    """
    held, scratch = np.zeros(len(item), dtype=bool), np.zeros(len(model.vocabulary) + 1, dtype=bool)
    for i in np.unique(item).tolist():
        at = np.flatnonzero(item == i)
        size = len(model.items[i].words)
        length = size + size // 4 + 1
        low, high = starts[text[at]], starts[text[at] + 1]
        sizes = high - low
        first = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(first, sizes) + np.repeat(low, sizes)
        upto = np.concatenate([[0], np.cumsum(model.marks(i, numbers[place], scratch))])
        begin = np.arange(len(place))
        end = np.minimum(begin + length, np.repeat(first + sizes, sizes))
        held[at] = np.maximum.reduceat(upto[end] - upto[begin], first) >= least * size
    return held


def search(model: Model, texts: list[str | None], cosine: float, share: float, loose: float) -> list[list[tuple]]:
    """For each text the items found in it: (item number, cosine, share in common, answered, first word)."""
    found: list[dict[int, tuple]] = [{} for _ in texts]
    get, other = model.vocabulary.get, len(model.vocabulary)
    least = min(share, loose)
    scratch = np.zeros(len(model.vocabulary) + 1, dtype=bool)
    at = 0
    while at < len(texts):
        split, total, end = [], 0, at
        while end < len(texts) and total < 1 << 18:
            split.append(words_of(texts[end]))
            total += len(split[-1])
            end += 1
        numbers = [np.fromiter(map(get, words, repeat(other)), dtype=np.int32, count=len(words)) for words in split]
        joined, starts = np.concatenate(numbers), np.cumsum([0, *map(len, numbers)])
        for windows, k in ((w, k) for w in _windows(model, numbers) for k in range(0, len(w.projections), _WINDOWS)):
            window, passage, cosines = candidates(model, windows, k, cosine)
            owner, of, begin = model.owner[passage], windows.text[window], windows.begin[window]
            pairs, which = np.unique(of * len(model.items) + owner, return_inverse=True)
            held = may_hold(model, pairs % len(model.items), pairs // len(model.items), joined, starts, least)[which]
            for n, i, first, value in zip(*(x[held].tolist() for x in (of, owner, begin, cosines))):
                if i in found[at + n] and found[at + n][i][2] == 1:
                    continue
                item, words = model.items[i], split[n]
                low = max(0, first - len(item.words))
                high = min(len(words), first + windows.words + len(item.words))
                common, start, answered = check(item, model.marks(i, numbers[n][low:high], scratch), words, low, high, least)
                if common >= share or (common >= loose and answered):
                    old = found[at + n].get(i)
                    if old is None or (common, -start) > (old[2], -old[4]):
                        found[at + n][i] = (i, value, common, answered, start)
        at = end
    return [[row for _, row in sorted(rows.items())] for rows in found]


def reference(benchmark: DataFrame, id_col: str, text_col: str, answer_col: str | None, closing: int = 5) -> Iterator[list[Item]]:
    """The items in slices of at most SLICE_WORDS words (a longer item is a slice of its own).

    The answer is ``answer_col`` where there is one, else the closing words of the item. Items without words are left
    out, since no text can hold them.
    """
    columns = [F.col(id_col), F.col(text_col), *([F.col(answer_col)] if answer_col else [])]
    some, size = [], 0
    for row in benchmark.select(*columns).distinct().orderBy(id_col, text_col).toLocalIterator():
        words = tuple(words_of(row[1]))
        if not words:
            continue
        if some and size + len(words) > SLICE_WORDS:
            yield some
            some, size = [], 0
        some.append(Item(row[0], words, tuple(words_of(row[2])) if answer_col else words[-closing:]))
        size += len(words)
    if some:
        yield some


def leaks_column(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    answer_col: str | None = None, rank: int = 128, cosine: float = 0.45, share: float = 0.8, loose: float = 0.6,
) -> Column:
    """array<struct<item_id, cosine, lcs_share, answered, start_word>> of the benchmark items found in each text.

    An item is found where at least ``share`` of its words stand in order within a stretch a quarter longer than itself,
    or ``loose`` of them if its answer stands there word for word. Windows are compared with an item where the cosine with
    one of its passages is at least ``cosine``. A null or empty text holds none; an empty benchmark is found nowhere.
    """
    prepare(docs.sparkSession)
    kind = benchmark.schema[item_col].dataType
    result = f"array<struct<item_id:{kind.simpleString()},cosine:double,lcs_share:double,answered:boolean,start_word:long>>"
    parts = []
    for items in reference(benchmark, item_col, item_text, answer_col):
        shared = docs.sparkSession.sparkContext.broadcast(fit(docs, items, text_col, rank))

        parts.append(_search_udf(shared, kind, result, (cosine, share, loose))(F.col(text_col)))
    return F.concat(*parts) if parts else F.array().cast(result)


def _search_udf(shared, kind: DataType, result: str, limits: tuple[float, ...]):
    names = ("item_id", "cosine", "lcs_share", "answered", "start_word")

    @F.arrow_udf(result)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for texts in batches:
            found = search(model, texts.to_pylist(), *limits)
            rows = [[dict(zip(names, (model.items[i].key, *rest))) for i, *rest in row] for row in found]
            yield pa.array(rows, _arrow(kind))

    return of


def _arrow(kind: DataType) -> pa.DataType:
    return pa.list_(
        pa.struct(
            [("item_id", to_arrow_type(kind)), ("cosine", pa.float64()), ("lcs_share", pa.float64()),
             ("answered", pa.bool_()), ("start_word", pa.int64())]
        )
    )


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row for each text and benchmark item found in it: id, item_id, cosine, lcs_share, answered, start_word.

    Repeated rows and null ids of ``docs`` give rows of their own; other columns are not read.
    """
    some = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return some.select(F.col("id").alias(id_col), F.inline(leaks_column(some, benchmark, "text", **options)))


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item; rows with a null text stay."""
    return docs.where(F.size(leaks_column(docs, benchmark, text_col, **options)) == 0)
