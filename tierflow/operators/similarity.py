"""The most similar rows for many query vectors at once.

Queries are taken in blocks of bounded size. A block goes to every task, which multiplies it with one Arrow batch of rows
after the other and keeps the best ``k`` rows of each query so far; what a task hands on is ``k`` rows a query, however many rows
it read. These are merged in two levels, within groups of tasks and then over all, each with a limit before its shuffle. Pairs
are never written out. Rows are not shuffled.

A matrix product only nominates rows; the similarity of a nominated row is summed in one fixed order, so that equal vectors
tie exactly, wherever they lie, and ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.operators.picking import top_n
from tierflow.session import share_library, work_path

#: Bytes of query vectors that travel to the tasks at a time.
BLOCK_BYTES = 32 * 1024 * 1024
#: Query rows and batch rows of one product.
_TILE = 512
#: How far a product may lie from the exact similarity.
_SLACK = 1e-9
#: Groups of tasks in the first level of the merge.
_GROUPS = 64


def _dense(column: pa.Array, width: int | None) -> tuple[np.ndarray, np.ndarray, int]:
    """(positions, unit vectors, width) of the usable vectors: finite, not zero, without nulls, of ``width`` numbers."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    if width is None:
        width = int(lengths.max()) if len(lengths) else 0
    fit = np.flatnonzero(lengths == width) if width else np.zeros(0, np.int64)
    if not len(fit):
        return fit, np.zeros((0, width)), width
    flat = column.take(pa.array(fit)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width)
    sizes = np.abs(flat).max(axis=1)
    usable = np.isfinite(sizes) & (sizes > 0)
    flat = flat[usable] / sizes[usable, None]  # neither squares of large numbers nor of small ones leave the range
    return fit[usable], flat, width


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row pair, summed in one order whatever the position of the rows."""
    dot, aa, bb = ((x * y).sum(axis=1) for x, y in ((a, b), (a, a), (b, b)))
    return dot / (np.sqrt(aa) * np.sqrt(bb))


def _searcher(queries: pa.Table, k: int, but_itself: bool):
    """A function over Arrow batches (id, vector) that yields the best ``k`` rows (query, similarity, id) of the task."""
    at, wanted, width = _dense(queries.column("vector").combine_chunks(), None)
    names = queries.column("id").combine_chunks().take(pa.array(at))
    units = wanted / np.sqrt((wanted * wanted).sum(axis=1))[:, None]

    def best(found: pa.Table) -> tuple[pa.Table, np.ndarray]:
        """The first ``k`` rows of each query, and the similarity a new row has to reach."""
        order = pc.sort_indices(found, [("query", "ascending"), ("similarity", "descending"), ("id", "ascending")], null_placement="at_end")
        found = found.take(order)
        query = found.column("query").to_numpy()
        starts = np.searchsorted(query, np.arange(len(units)))
        place = np.arange(len(query)) - starts[query]
        found = found.filter(pa.array(place < k))
        query, similarity = found.column("query").to_numpy(), found.column("similarity").to_numpy()
        full = np.bincount(query, minlength=len(units)) >= k
        floor = np.full(len(units), -np.inf)
        np.minimum.at(least := np.full(len(units), np.inf), query, similarity)
        floor[full] = least[full]
        return found, floor

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, floor = None, np.full(len(units), -np.inf)
        for batch in batches:
            here, rows, _ = _dense(batch.column("vector"), width)
            ids = batch.column("id")
            for low in range(0, len(rows), _TILE):
                some = rows[low : low + _TILE]
                scaled = some / np.sqrt((some * some).sum(axis=1))[:, None]
                parts = []
                for first in range(0, len(units), _TILE):
                    products = units[first : first + _TILE] @ scaled.T
                    bar = floor[first : first + _TILE]
                    if products.shape[1] > k + 1:
                        # One more than k: the row itself may not count.
                        bar = np.maximum(bar, np.partition(products, -(k + 1), axis=1)[:, -(k + 1)])
                    q, r = np.nonzero(products >= (bar - _SLACK)[:, None])
                    parts.append((q + first, r))
                q, r = (np.concatenate(p) for p in zip(*parts))
                named = ids.take(pa.array(here[low : low + _TILE][r]))
                new = pa.table({"query": q.astype(np.int32), "similarity": _cosines(wanted[q], some[r]), "id": named})
                if but_itself:
                    new = new.filter(pc.fill_null(pc.not_equal(names.take(pa.array(q)), named), True))
                found, floor = best(new if found is None else pa.concat_tables([found, new]))
        if found is not None and len(found):
            shown = pa.table({"query": names.take(found.column("query")), "similarity": found.column("similarity"), "id": found.column("id")})
            yield from shown.combine_chunks().to_batches()

    return search


def most_similar_to_each(
    df: DataFrame, queries: DataFrame, k: int, id_col: str, vector_col: str, query_id: str | None = None,
    query_vector: str | None = None, but_itself: bool = False, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Rows (query_id, id, similarity, rank): the ``k`` rows of largest cosine for each query, exact.

    Ids of rows and queries are of one type. Vectors that are null, zero, of another length, or hold nulls or non-finite numbers
    match nothing; a query without a match gives no row. Ties go to the smaller id, null ids last. ``but_itself`` leaves out the row
    with the query's own id. Of a query id that occurs more than once with different vectors, each vector is a query of its own,
    and their rows share the ranks. Queries beyond ``block_bytes`` are taken in several passes over ``df``.
    """
    spark = df.sparkSession
    share_library(spark)
    asked = queries.select(F.col(query_id or id_col).alias("id"), F.col(query_vector or vector_col).cast("array<double>").alias("vector"))
    asked = asked.where(F.size("vector") > 0)
    path = work_path(spark, "queries")
    asked.withColumn("part", F.xxhash64("vector")).write.parquet(path)
    asked = spark.read.parquet(path)
    size = asked.agg(F.sum(F.size("vector") * 8 + 16), F.max(F.size("vector")), F.min(F.size("vector"))).first()
    if size[0] is None:
        kind = df.schema[id_col].dataType.simpleString()
        return spark.createDataFrame([], f"query_id {asked.schema['id'].dataType.simpleString()}, id {kind}, similarity double, rank int")
    if size[1] != size[2]:
        raise ValueError(f"query vectors of {size[2]} to {size[1]} numbers")
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    kinds = {n: d.schema["id"].dataType.simpleString() for n, d in (("query", asked), ("id", rows))}
    shape = f"query {kinds['query']}, similarity double, id {kinds['id']}"
    blocks = -(-size[0] // block_bytes)
    found = []
    for block in range(blocks):  # each is bounded by ``block_bytes``, give or take the evenness of the hash
        held = asked.where(F.pmod("part", F.lit(blocks)) == block).select("id", "vector").toArrow()
        if len(held):
            found.append(rows.mapInArrow(_searcher(held, k, but_itself), shape))
    every = reduce(DataFrame.unionByName, found).withColumn("group", F.spark_partition_id() % _GROUPS)
    order = [F.desc("similarity"), F.col("id").asc_nulls_last()]
    near = top_n(every, ["query", "group"], order, k).drop("group")
    best = top_n(near, ["query"], order, k, "rank")
    return best.select(F.col("query").alias("query_id"), "id", "similarity", F.col("rank").cast("int").alias("rank"))
