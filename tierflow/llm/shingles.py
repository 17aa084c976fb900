"""Classes of texts by the exact Jaccard similarity of their word shingles.

SimHash cannot serve a similarity of 0.8: such texts differ in some ten of 64 bits, a radius at which no vantage-point
tree prunes. Candidates come from the shingle sets themselves: the smallest values of BANDS * ROWS permutations are taken
in bands of ROWS, and texts that agree in a band share a bucket (at a similarity of 0.8 two texts share none in 3 of a
million cases, less often above). In a bucket the whole sets are compared, so that every link is exact.

Equal sets are one class before any comparison, buckets of the same members are compared once, and large ones are cut
into cells. A cell compares only what it has not joined yet and returns at most one edge a member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.base import components, merge_labels, prepare, stored

#: Bands of a text, and permutations of a band.
BANDS, ROWS = 24, 4
#: Shingles permuted at a time.
_BLOCK = 1 << 12
_FACTORS = np.array([xxhash.xxh64_intdigest(f"factor/{k}") | 1 for k in range(BANDS * ROWS)], dtype=np.uint64)
_TERMS = np.array([xxhash.xxh64_intdigest(f"term/{k}") for k in range(BANDS * ROWS)], dtype=np.uint64)


def shingles(text: str | None, words_per_shingle: int = 5) -> np.ndarray:
    """The distinct XXH64 of the word shingles of a text in order; words and short texts as in ``simhash.fingerprint``."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    width, digest = min(words_per_shingle, len(words)), xxhash.xxh64_intdigest
    grams = map(b" ".join, zip(*(words[k:] for k in range(width))))
    return np.unique(np.fromiter((digest(g, 42) for g in grams), np.uint64, len(words) - width + 1))


def bands_of(values: np.ndarray) -> np.ndarray:
    """A signed 64-bit number for each band of a set; none for the empty set."""
    if not len(values):
        return np.zeros(0, np.int64)
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), _BLOCK):
        some = values[None, at : at + _BLOCK] * _FACTORS[:, None] + _TERMS[:, None]
        np.minimum(least, some.min(axis=1), out=least)
    parts = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(p.tobytes(), k) for k, p in enumerate(parts)], np.uint64).view(np.int64)


def signature_column(text: Column, words_per_shingle: int = 5) -> Column:
    """struct<fp, n, bands>: a hash of the whole shingle set, its size, and its bands."""

    @F.arrow_udf("fp long, n long, bands array<long>")
    def of(texts: pa.Array) -> pa.Array:
        sets = [shingles(x, words_per_shingle) for x in texts.to_pylist()]
        prints = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
        bands = pa.array([bands_of(s) for s in sets], pa.list_(pa.int64()))
        return pa.StructArray.from_arrays([pa.array(prints), pa.array([len(s) for s in sets], pa.int64()), bands], ["fp", "n", "bands"])

    return of(text)


def set_column(text: Column, words_per_shingle: int = 5) -> Column:
    @F.arrow_udf("binary")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([shingles(x, words_per_shingle).tobytes() for x in texts.to_pylist()], pa.binary())

    return of(text)


def _link(least: float):
    def link(group: pa.Table) -> pa.Table:
        """Edges (a, b) from each member of a cell to the smallest print it is joined with there."""
        every, first, position = np.unique(group.column("fp").to_numpy(), return_index=True, return_inverse=True)
        raw, owner = group.column("values"), group.column("owner").to_numpy()
        sets = [np.frombuffer(raw[int(k)].as_py(), np.uint64) for k in first]
        sizes = np.array([len(s) for s in sets])
        labels, visitors = np.arange(len(every)), np.unique(position[~owner])
        for i in np.unique(position[owner]).tolist():
            apart = labels[visitors] != labels[i]
            low, high = np.minimum(sizes[visitors], sizes[i]), np.maximum(sizes[visitors], sizes[i])
            some = visitors[apart & (low >= least * high)]
            if not len(some):
                continue
            joined = np.concatenate([sets[j] for j in some])
            at = np.minimum(np.searchsorted(sets[i], joined), sizes[i] - 1)
            ends = np.cumsum(sizes[some])
            common = np.add.reduceat((sets[i][at] == joined).astype(np.int64), ends - sizes[some])
            near = some[common >= least * (sizes[some] + sizes[i] - common)]
            labels = merge_labels(labels, np.full(len(near), i), near)
        moved = labels != np.arange(len(labels))
        return pa.table({"a": every[moved], "b": every[labels[moved]]})

    return link


def _cell(i: Column, j: Column, owner: bool) -> Column:
    return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(owner).alias("owner"))


def near_edges(classes: DataFrame, texts: DataFrame, words_per_shingle: int, least: float, cell_shingles: int = 1 << 20) -> DataFrame:
    """Edges (a, b) that join every class of the sets ``classes(fp, n, bands, text_key)`` at a similarity of ``least``.

    ``texts(text_key, text)`` may repeat. A slice of a bucket holds about ``cell_shingles`` shingles, and a slice of
    owners meets a slice of visitors in a cell of its own.
    """
    rows = classes.select("fp", "n", "text_key", F.explode("bands").alias("bucket"))
    members = [F.bit_xor(F.xxhash64("fp", F.lit(k))).alias(f"m{k}") for k in (1, 2)]
    heads = rows.groupBy("bucket").agg(F.count("*").alias("members"), F.sum("n").alias("weight"), *members).where("members > 1")
    heads = heads.groupBy("members", "weight", "m1", "m2").agg(F.min("bucket").alias("head"))
    heads = stored(heads.select("head", F.ceil(F.col("weight") / cell_shingles).cast("int").alias("s")), "shingle-buckets")
    paired = stored(rows.join(heads, F.col("bucket") == F.col("head")).select("bucket", "s", "fp", "text_key"), "shingle-pairs")
    wanted = stored(paired.select(F.col("text_key").alias("wanted")).distinct(), "shingle-wanted")
    once = texts.join(wanted, F.col("text_key") == F.col("wanted")).groupBy("wanted").agg(F.first("text").alias("text"))
    sets = stored(once.select("wanted", set_column(F.col("text"), words_per_shingle).alias("values")), "shingle-sets")
    at, parts = F.pmod(F.xxhash64("fp"), F.col("s")), F.sequence(F.lit(0), F.col("s") - 1)
    both = F.concat(F.transform(parts, lambda j: _cell(at, j, True)), F.transform(parts, lambda i: _cell(i, at, False)))
    cells = paired.join(sets, F.col("text_key") == F.col("wanted")).select("bucket", "fp", "values", F.inline(both))
    return cells.groupBy("bucket", "i", "j").applyInArrow(_link(least), "a long, b long")


def classified(docs: DataFrame, id_col: str, text_col: str, words_per_shingle: int, least: float) -> DataFrame:
    """Rows (id, text_key, root): root is the smallest set print of the class of a text.

    Texts of equal sets are one class, those without words too.
    """
    prepare(docs.sparkSession)
    text_key = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key")
    raw = docs.select(F.col(id_col).alias("id"), text_key, signature_column(F.col(text_col), words_per_shingle).alias("of"))
    known = stored(raw.select("id", "text_key", "of.*"), "shingle-prints")
    own = F.min(F.struct("text_key", "n", "bands")).alias("own")
    classes = stored(known.groupBy("fp").agg(own).select("fp", "own.*"), "shingle-classes")
    texts = docs.select(text_key, F.col(text_col).alias("text"))
    roots = components(near_edges(classes, texts, words_per_shingle, least))
    found = known.select("id", "text_key", "fp").join(roots, F.col("fp") == F.col("node"), "left")
    return found.select("id", "text_key", F.coalesce("root", "fp").alias("root"))
