"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products within them, one vector of each group kept.

Equal vectors are one class from the start. Centroids are fitted on a bounded sample; then every class joins the cell of
its nearest centroid and each cell whose centroid lies at most ``margin`` degrees further away. Two classes meet in the
cells they share and are counted in the first of them only, so that the number of links is exact for the pairs found. Without
a margin a class joins every cell whose border with its own lies within half the chord of the threshold: of two vectors at the
threshold, one lies that near to the border between their cells, so that no pair is missed, at the price of many more cells a
vector where the vectors form no groups. A large cell is cut into slices, and each pair of slices is a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.base import components, merge_labels, prepare, stored

#: Rows of a product of blocks.
_ROWS = 512


def unit_vectors(lists, size: int) -> np.ndarray:
    """Arrow lists of ``size`` numbers as unit vectors in double precision."""
    rows = np.asarray(lists.flatten(), dtype=np.float64).reshape(-1, size)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit_centroids(sample: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means of unit vectors."""
    centroids = sample[np.random.default_rng(11).permutation(len(sample))[:cells]].copy()
    for _ in range(rounds):
        nearest = np.concatenate([(sample[k : k + 4096] @ centroids.T).argmax(axis=1) for k in range(0, len(sample), 4096)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 1e-12, sums / np.where(norms > 1e-12, norms, 1), centroids)
    return centroids


def _members(vectors: np.ndarray, centroids: np.ndarray, margin: float | None, threshold: float) -> np.ndarray:
    """Whether each vector belongs to each cell."""
    products = vectors @ centroids.T
    if margin is not None:
        angles = np.degrees(np.arccos(np.clip(products, -1, 1)))
        return angles <= angles.min(axis=1, keepdims=True) + margin
    nearest = products.argmax(axis=1)
    between = np.linalg.norm(centroids[nearest][:, None, :] - centroids[None, :, :], axis=2)
    half_chord = np.sqrt(max(0.0, (1 - threshold) / 2))
    return products.max(axis=1, keepdims=True) - products <= half_chord * between + 1e-9


def _assign(shared, margin: float | None, threshold: float):
    names = ["size", "cell", "cid", "copies", "earlier", "embedding"]

    def cells_of(ids: np.ndarray, copies: np.ndarray, lists, size: int) -> pa.RecordBatch:
        centroids = shared.value.get(size)
        if centroids is None:  # a length too rare for the sample has one cell
            row, cell = np.arange(len(ids)), np.zeros(len(ids), dtype=np.int64)
        else:
            units = unit_vectors(lists, size)
            parts = [_members(units[k : k + 64], centroids, margin, threshold) for k in range(0, len(units), 64)]
            row, cell = np.nonzero(np.concatenate(parts))
        own = np.split(cell, np.searchsorted(row, np.arange(1, len(ids))))
        earlier = pa.array([own[r][own[r] < c] for r, c in zip(row, cell)], pa.list_(pa.int64()))
        sizes = np.full(len(row), size, dtype=np.int64)
        columns = [pa.array(x) for x in (sizes, cell, ids[row], copies[row])]
        return pa.RecordBatch.from_arrays([*columns, earlier, lists.take(pa.array(row))], names)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids, copies, lists = (part.column(n) for n in ("cid", "copies", "embedding"))
                sizes = lists.value_lengths().to_numpy()
                for size in np.unique(sizes):
                    chosen = np.flatnonzero(sizes == size)
                    yield cells_of(ids.to_numpy()[chosen], copies.to_numpy()[chosen], lists.take(pa.array(chosen)), int(size))

    return assign


def _apart(earlier: list[list[int]], others: list[list[int]]) -> np.ndarray | None:
    """Whether two rows share none of their earlier cells; None where no row has any."""
    cells = sorted({c for x in earlier for c in x} & {c for x in others for c in x})
    if not cells:
        return None
    number = {c: k for k, c in enumerate(cells)}

    def flags(lists: list[list[int]]) -> np.ndarray:
        made = np.zeros((len(lists), len(cells)), dtype=np.float32)
        for r, x in enumerate(lists):
            made[r, [number[c] for c in x if c in number]] = 1
        return made

    return flags(earlier) @ flags(others).T == 0


def _compare(threshold: float):
    def compare(key: tuple, group: pa.Table) -> pa.Table:
        """For each class of two slices of a cell: linked vectors counted here, and the class it is joined with."""
        size, i, j = key[0].as_py(), key[2].as_py(), key[3].as_py()
        group = group.combine_chunks()
        vectors = unit_vectors(group.column("embedding").combine_chunks(), size)
        ids, copies, side = (group.column(n).to_numpy() for n in ("cid", "copies", "slice"))
        earlier = group.column("earlier").to_pylist()
        left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
        links, labels = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
        for at in range(0, len(left), _ROWS):
            some = left[at : at + _ROWS]
            for to in range(0, len(right), _ROWS):
                others = right[to : to + _ROWS]
                near = vectors[some] @ vectors[others].T >= threshold
                near &= some[:, None] != others[None, :]
                if not near.any():
                    continue
                first_here = _apart([earlier[k] for k in some], [earlier[k] for k in others])
                if first_here is not None:
                    near &= first_here
                links[some] += near @ copies[others]
                if i != j:
                    links[others] += copies[some] @ near
                a, b = np.nonzero(near)
                labels = merge_labels(labels, some[a], others[b])
        found = links > 0
        return pa.table({"cid": ids[found], "links": links[found], "root": ids[labels[found]]})

    return compare


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95,
    margin: float | None = 3.0, sample_rows: int = 20_000, cell_rows: int = 250, slice_rows: int = 4096,
) -> DataFrame:
    """One row a vector: id, n_links (other vectors linked directly), component_id (smallest id reachable), kept.

    ``sample_rows`` is the expected size of the sample, taken by hash, that the centroids are fitted on; ``cell_rows`` is the mean number of classes a cell
    is made for. Pairs that share no cell are missed: ``margin`` (degrees) sets how rarely, and None misses none. Vectors that are null, empty or zero,
    or hold null or non-finite numbers, link with nothing, equal ones neither; vectors of different lengths never link.
    Repeated rows are vectors of their own. A null id takes no part in the minimum; alone, it has a null component_id
    and is kept.
    """
    spark = vectors.sparkSession
    prepare(spark)
    value = F.col("embedding")
    numbered = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(vector_col).alias("embedding")
    )
    finite = ~F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = value.isNotNull() & finite & F.exists(value, lambda x: x != 0)
    keyed = numbered.select(
        "row", "id", "embedding", F.coalesce(usable, F.lit(False)).alias("usable"),
        F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2"),
    )
    rows = stored(keyed, "embedding-rows")
    merged = rows.where("usable").groupBy("h1", "h2").agg(
        F.count("*").alias("copies"), F.min("id").alias("least"), F.any_value("embedding").alias("embedding")
    )
    classes = stored(merged.withColumn("cid", F.monotonically_increasing_id()), "embedding-classes")

    # The sample is a share of the hashes, so that no task or driver sorts or gathers more than the sample.
    count, centroids, spread = classes.count(), {}, 1 << 30
    share = F.pmod(F.xxhash64("h1", F.lit(3)), F.lit(spread)) < int(spread * min(1.0, sample_rows / max(1, count)))
    lists = classes.where(share).select("embedding").toArrow().column("embedding").combine_chunks()
    sizes = lists.value_lengths().to_numpy() if len(lists) else np.zeros(0, dtype=np.int64)
    for size in np.unique(sizes):
        own = unit_vectors(lists.take(pa.array(np.flatnonzero(sizes == size))), int(size))
        cells = int(np.ceil(count * len(own) / max(1, len(sizes)) / cell_rows))
        centroids[int(size)] = fit_centroids(own, max(1, min(cells, len(own) // 8)))
    shared = spark.sparkContext.broadcast(centroids)

    kind = f"array<{classes.schema['embedding'].dataType.elementType.simpleString()}>"
    schema = f"size long, cell long, cid long, copies long, earlier array<long>, embedding {kind}"
    placed = classes.select("cid", "copies", "embedding").mapInArrow(_assign(shared, margin, threshold), schema)
    large = placed.groupBy("size", "cell").count().where(F.col("count") > slice_rows)
    large = large.select("size", "cell", F.ceil(F.col("count") / slice_rows).cast("int").alias("slices"))
    sliced = placed.join(large, ["size", "cell"], "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    sliced = sliced.withColumn("slice", F.pmod(F.xxhash64("cid"), "slices").cast("int"))
    spread = sliced.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    tasks = spread.select(
        "size", "cell", F.least("slice", "other").alias("i"), F.greatest("slice", "other").alias("j"),
        "slice", "cid", "copies", "earlier", "embedding",
    )
    compared = tasks.groupBy("size", "cell", "i", "j").applyInArrow(_compare(threshold), "cid long, links long, root long")
    found = stored(compared, "embedding-links")

    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    roots = roots.select(F.col("node").alias("cid"), "root")
    joined = classes.select("cid", "h1", "h2", "copies", "least").join(links, "cid", "left").join(roots, "cid", "left")
    joined = joined.withColumn("root", F.coalesce("root", "cid"))
    smallest = joined.groupBy("root").agg(F.min("least").alias("component"))
    per_class = joined.join(smallest, "root").select(
        F.col("h1").alias("c1"), F.col("h2").alias("c2"), "component",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
    )
    on = F.col("usable") & (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2"))
    component = F.when(F.col("usable"), F.col("component")).otherwise(F.col("id"))
    return rows.join(per_class, on, "left").select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
