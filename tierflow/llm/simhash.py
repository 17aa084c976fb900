"""Near-duplicates by SimHash fingerprints, found through vantage-point trees.

A fingerprint has 64 bits; two link when at most ``max_bits`` (3) differ. Distances from any vantage point to unrelated
64-bit fingerprints all lie near 32, so that a tree over whole fingerprints can prune next to nothing at radius 3. The
trees are therefore built over the two 32-bit halves: fingerprints that differ in at most 3 bits differ in at most
1 bit in one of the halves, so that one tree per half, queried with radius 1, finds every pair.

Level ``l`` of a tree has one vantage point, drawn from a fixed hash, and splits by "Hamming distance at most ``MU``".
A leaf is the list of those answers. By the triangle inequality a query of radius 1 needs the other side of a level
only when its own distance is ``MU`` or ``MU + 1``; it then visits the leaves on both sides. Visitors meet the owners
of a leaf, whole fingerprints are compared there, and each leaf returns at most one edge per member, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm import shingles
from tierflow.llm.base import components, fresh, merge_labels, prepare, stored

#: Median distance of a vantage point to a random 32-bit half.
MU = 16
#: Shingles hashed at a time, so that a very long text needs no more memory than a short one.
_BLOCK = 1 << 16


def fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """The SimHash of one text as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    width = min(words_per_shingle, len(words))
    total = len(words) - width + 1
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, total, _BLOCK):
        part = words[at : at + min(_BLOCK, total - at) + width - 1]
        grams = map(b" ".join, zip(*(part[k:] for k in range(width))))
        hashes = np.frombuffer(b"".join([digest(g, 42) for g in grams]), dtype=np.uint8)
        bits = np.unpackbits(hashes).reshape(-1, 64)
        for k in range(0, len(bits), 255):
            counts += np.add.reduce(bits[k : k + 255], axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big", signed=True)


def fingerprint_column(text: str | Column, words_per_shingle: int = 3) -> Column:
    """SimHash over word shingles: A-Z lower-cased, words split at ASCII white space, XXH64 with seed 42.

    A text with fewer words than a shingle is one shingle; a text without words, or null, has fingerprint 0.
    """

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(x, words_per_shingle) for x in texts.to_pylist()], pa.int64())

    return of(F.col(text) if isinstance(text, str) else text)


def hex_fingerprint(value: str) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def vantage_points(tree: int, depth: int) -> np.ndarray:
    """The vantage point of each level of a tree: fixed, and the same for any data."""
    return np.array([xxhash.xxh32_intdigest(f"{tree}/{level}") for level in range(depth)], dtype=np.uint32)


def leaves(halves: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a query of radius 1 around each half: (position, leaf, whether it is the leaf that owns the half)."""
    position = np.arange(len(halves))
    leaf = np.zeros(len(halves), dtype=np.int64)
    home = np.ones(len(halves), dtype=bool)
    for point in points:
        distance = np.bitwise_count(halves ^ point)[position]
        inside = distance <= MU
        leaf = leaf * 2 + inside
        both = (distance == MU) | (distance == MU + 1)
        position = np.concatenate([position, position[both]])
        leaf = np.concatenate([leaf, leaf[both] ^ 1])
        home = np.concatenate([home, np.zeros(int(both.sum()), dtype=bool)])
    return position, leaf, home


def _route(depth: int):
    points = [vantage_points(tree, depth) for tree in (0, 1)]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column("fp").to_numpy(zero_copy_only=False)
            for at in range(0, len(every), 4096):
                prints = every[at : at + 4096]
                pair = prints.view(np.uint32).reshape(-1, 2)
                for tree in (0, 1):
                    position, leaf, home = leaves(np.ascontiguousarray(pair[:, tree]), points[tree])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(leaf * 2 + tree), pa.array(prints[position]), pa.array(home)], ["leaf", "fp", "home"]
                    )

    return route


def _link(max_bits: int):
    def link(group: pa.Table) -> pa.Table:
        """Edges (a, b) from each member of a cell to the smallest fingerprint it is joined with there."""
        prints, position = np.unique(group.column("fp").to_numpy(), return_inverse=True)
        owner = group.column("owner").to_numpy()
        owners, visitors = position[owner], position[~owner]
        labels, bits = np.arange(len(prints)), prints.view(np.uint64)  # bits of signed numbers are not counted as such
        step = max(1, (1 << 21) // max(1, len(visitors)))
        for at in range(0, len(owners), step):
            some = owners[at : at + step]
            near = np.bitwise_count(bits[some][:, None] ^ bits[visitors][None, :]) <= max_bits
            i, j = np.nonzero(near)
            labels = merge_labels(labels, some[i], visitors[j])
        moved = labels != np.arange(len(labels))
        return pa.table({"a": prints[moved], "b": prints[labels[moved]]})

    return link


def near_edges(prints: DataFrame, max_bits: int = 3, leaf_rows: int = 512, cell_rows: int = 32768) -> DataFrame:
    """Edges (a, b) that join every class of the distinct fingerprints ``fp`` linked at ``max_bits`` or fewer bits.

    ``leaf_rows`` is the mean number of owners a leaf is made for; the depth follows from the number of fingerprints.
    Owners and members of a leaf are cut into slices of about ``cell_rows``, and a slice of owners meets a slice of
    members in a cell of its own, so that no task holds more than two slices, whatever the data.
    """
    if max_bits > 3:
        raise ValueError("two halves searched at radius 1 find pairs of at most 3 differing bits")
    count = prints.count()
    depth = max(0, int(np.ceil(np.log2(max(1, count) / leaf_rows))))
    routed = prints.select("fp").mapInArrow(_route(depth), "leaf long, fp long, home boolean")
    sizes = routed.groupBy("leaf").agg(F.count_if("home").alias("owners"), F.count("*").alias("members"))
    sizes = sizes.where(F.col("members") > cell_rows).select(
        "leaf",
        F.ceil(F.col("owners") / cell_rows).cast("int").alias("o"),
        F.ceil(F.col("members") / cell_rows).cast("int").alias("v"),
    )
    o, v, at = F.greatest(F.lit(1), F.coalesce("o", F.lit(1))), F.coalesce("v", F.lit(1)), F.xxhash64("fp")
    as_owner = F.transform(F.sequence(F.lit(0), v - 1), lambda j: _cell(F.pmod(at, o), j, True))
    as_visitor = F.transform(F.sequence(F.lit(0), o - 1), lambda i: _cell(i, F.pmod(at, v), False))
    cells = routed.join(sizes, "leaf", "left").select(
        "leaf", "fp", F.inline(F.when(F.col("home"), F.concat(as_owner, as_visitor)).otherwise(as_visitor))
    )
    return cells.groupBy("leaf", "i", "j").applyInArrow(_link(max_bits), "a long, b long")


def _cell(i: Column, j: Column, owner: bool) -> Column:
    return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(owner).alias("owner"))


def _classified(docs: DataFrame, id_col: str, text_col: str, max_bits: int, words_per_shingle: int = 3) -> DataFrame:
    """Rows (id, text_key, fp, root, component_id): root is the smallest fingerprint of the class."""
    prepare(docs.sparkSession)
    text_key = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key")
    raw = docs.select(F.col(id_col).alias("id"), text_key, fingerprint_column(F.col(text_col), words_per_shingle).alias("fp"))
    known = stored(raw, "simhash-prints")
    classes = stored(known.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")
    roots = components(near_edges(classes, max_bits))
    joined = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        F.col("fp").alias("known"), "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = joined.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "own")
    mapped = joined.join(smallest, F.col("root") == F.col("own")).select("known", "root", "component_id")
    return known.join(mapped, F.col("fp") == F.col("known")).drop("known")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 3) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits) and component_id, the smallest id reachable by links.

    Only the id and text columns are read, so other columns of any name do no harm. Null texts count as empty; empty
    texts share fingerprint 0 and link like any other. Repeated rows and ids give a row each. A null id takes no part in
    the minimum (a class of null ids alone has a null component_id). An empty table gives no rows.
    """
    found = _classified(docs, id_col, text_col, max_bits)
    return found.select(F.col("id").alias(id_col), hex_fingerprint("fp").alias("fingerprint"), "component_id")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 3,
    words_per_shingle: int = 3, similarity: float | None = None,
) -> DataFrame:
    """``docs`` with one row of each class of near-duplicates: the one of the smallest id (null ids last).

    Texts link where the fingerprints of their shingles of ``words_per_shingle`` words differ in ``max_bits`` bits or fewer or,
    where ``similarity`` is given, at that Jaccard similarity of the shingles (see ``shingles``). Rows are told apart by id and text; of rows equal
    in both, any one is kept. All columns are handed through.
    """
    if similarity is None:
        classes = _classified(docs, id_col, text_col, max_bits, words_per_shingle)
    else:
        classes = shingles.classified(docs, id_col, text_col, words_per_shingle, similarity)
    found = stored(classes, "simhash-found")
    rank = F.struct(F.col("id").isNull().alias("last"), "id", "text_key")
    first = found.groupBy("root").agg(F.min(rank).alias("first"), F.count("*").alias("rows"))
    first = first.select(F.col("root").alias("own"), "rows", F.col("first.id").alias("id_"), F.col("first.text_key").alias("key_"))
    several = found.join(first.where("rows > 1"), F.col("root") == F.col("own"))
    kept = F.col("id").eqNullSafe(F.col("id_")) & (F.col("text_key") == F.col("key_"))
    id_, key = fresh(docs, "gone_id", "gone_key")
    gone = several.where(~kept).select("id", "text_key").distinct().toDF(id_, key)
    same = F.col(id_col).eqNullSafe(F.col(id_)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(key))
    left = docs.join(gone, same, "left_anti")
    repeated = several.where(kept).groupBy("id", "text_key").count().where("count > 1").select("id", "text_key").toDF(id_, key)
    if repeated.isEmpty():
        return left
    once = left.join(repeated, same, "left_semi").dropDuplicates([id_col, text_col])
    return left.join(repeated, same, "left_anti").unionByName(once)
