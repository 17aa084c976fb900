"""How far the sources of a language differ in their use of terms: a K-squared quadtree over the group-term matrix.

The matrix of a language has a row for each source and a column for each kept term. It is cut into cells of SIDE rows by
COLUMNS columns; a cell pair of row tiles is worked on as a stack of squares. Over each square stands a quadtree whose
nodes say whether a quadrant holds any count. Two trees are walked together: a quadrant pair that is all zero on both
sides has one price for each row pair, whatever its width, so that it is priced by multiplication; only leaves with a count on
one side or both are visited. All prices are whole numbers, so that sums do not depend on the order of work.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm import words
from tierflow.llm.base import prepare, stored

#: Rows of a tile, which is also the side of a square (a power of two), and columns of a cell (about, by hash).
SIDE, COLUMNS = 64, 4096
#: Different terms a task counts before it hands them on.
_HELD = 1 << 19
#: Probabilities are whole numbers of this unit.
UNIT = 1_000_000_000


def group_term_counts(docs: DataFrame, group: str, source: str, text: str) -> DataFrame:
    """Rows (lang, source, term, n, docs), summed within tasks: occurrences, and documents that hold the term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, tuple[Counter, Counter]] = {}
        kinds = [pa.string()] * 3 + [pa.int64()] * 2

        def drained() -> pa.RecordBatch:
            parts: list[list[pa.Array]] = [[pa.array([], k)] for k in kinds]
            for (g, s), (total, inside) in found.items():
                terms = [*total]
                columns = (
                    pa.repeat(pa.scalar(g, pa.string()), len(terms)), pa.repeat(pa.scalar(s, pa.string()), len(terms)),
                    pa.array(terms, pa.binary()).cast(pa.string()), pa.array([*total.values()], pa.int64()),
                    pa.array([inside[t] for t in terms], pa.int64()),
                )
                for part, column in zip(parts, columns):
                    part.append(column)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.concat_arrays(p) for p in parts], ["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for g, s, t in zip(*(c.to_pylist() for c in batch.columns)):
                total, inside = found.setdefault((g, s), (Counter(), Counter()))
                held: set[bytes] = set()
                for some in words.blocks(t, words.LETTERS):
                    total.update(some)
                    held.update(some)
                inside.update(held)
            if sum(len(c) for c, _ in found.values()) > _HELD:
                yield drained()
        yield drained()

    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((group, "lang"), (source, "source"), (text, "text"))])
    counted = named.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(n: str, total: str, kept: str) -> Column:
    """1 + floor(UNIT (n + 2) / (total + 2 kept)), exact for any counts."""
    return F.expr(f"1 + (CAST({UNIT} AS DECIMAL(12,0)) * CAST({n} + 2 AS DECIMAL(20,0))) div CAST({total} + 2 * {kept} AS DECIMAL(20,0))")


def quadtree(filled: np.ndarray) -> list[np.ndarray]:
    """Levels of the tree over a square of booleans, root first: whether each quadrant holds anything."""
    levels = [filled]
    while len(levels[0]) > 1:
        n = len(levels[0]) // 2
        levels.insert(0, levels[0].reshape(n, 2, n, 2).any(axis=(1, 3)))
    return levels


def walk(left: np.ndarray, right: np.ndarray, p0: np.ndarray, q0: np.ndarray, width: int, upper: bool = False) -> np.ndarray:
    """Summed prices of all row pairs of two squares (0: no count, priced at p0 and q0) over the first ``width`` columns.

    Rows from the first with a price of 0 on are padding and are not visited; with ``upper`` only pairs with the smaller row on
    the left are sure to be complete.
    """
    side, rows = len(left), [int((x > 0).sum()) for x in (p0, q0)]
    trees = quadtree(left > 0), quadtree(right > 0)
    empty = np.zeros((side, side), np.int64)  # columns of each row pair that are zero on both sides
    a, b, c = (np.zeros(1, np.int64) for _ in range(3))
    for level, (x, y) in enumerate(zip(*trees)):
        size = side >> level
        filled = x[a, c] | y[b, c]
        some = ~filled
        if some.any():
            covered = np.clip(width - c[some] * size, 0, size)
            priced = np.bincount(a[some] * (1 << level) + b[some], covered, minlength=1 << 2 * level)  # far below 2**53
            empty += np.kron(priced.astype(np.int64).reshape(1 << level, -1), np.ones((size, size), np.int64))
        a, b, c = a[filled], b[filled], c[filled]
        if level + 1 < len(trees[0]):
            parts = [(a * 2 + i, b * 2 + j, c * 2 + k) for i in (0, 1) for j in (0, 1) for k in (0, 1)]
            a, b, c = (np.concatenate(p) for p in zip(*parts))
            real = (a * (size // 2) < rows[0]) & (b * (size // 2) < rows[1])
            if upper:
                real &= a <= b
            a, b, c = a[real], b[real], c[real]
    p, q = left[a, c], right[b, c]
    p, q = np.where(p > 0, p, p0[a]), np.where(q > 0, q, q0[b])
    value = np.zeros(side * side, np.int64)
    np.add.at(value, a * side + b, (p - q) ** 2 // (p + q))
    flat = (p0[:, None] - q0[None, :]) ** 2 // np.maximum(p0[:, None] + q0[None, :], 1)
    return value.reshape(side, side) + empty * flat


def _price(side: int):
    def price(key: tuple, cell: pa.Table) -> pa.Table:
        """Prices of the row pairs (a < b) of a cell; rows with column -1 are its sources, with the price of no count."""
        lang, _, i, j = (k.as_py() for k in key)
        g, col, p = (cell.column(c).to_numpy() for c in ("g", "col", "p"))
        width = int(pc.max(cell.column("width")).as_py())
        heads = {}
        for tile in {i, j}:
            mine = (g // side == tile) & (col < 0)
            zero = np.zeros(side, np.int64)
            zero[g[mine] % side] = p[mine]
            heads[tile] = zero
        order = np.argsort(col, kind="stable")
        g, col, p = g[order], col[order], p[order]
        total = np.zeros((side, side), np.int64)
        for at in range(0, width, side):
            low, high = np.searchsorted(col, (at, at + side))
            squares = {}
            for tile in {i, j}:
                mine = g[low:high] // side == tile
                square = np.zeros((side, side), np.int64)
                square[g[low:high][mine] % side, col[low:high][mine] - at] = p[low:high][mine]
                squares[tile] = square
            total += walk(squares[i], squares[j], heads[i], heads[j], min(side, width - at), upper=i == j)
        a, b = np.nonzero((heads[i] > 0)[:, None] & (heads[j] > 0)[None, :])
        first, second = a + i * side, b + j * side
        ahead = first < second
        columns = [pa.array([lang] * int(ahead.sum()), pa.string()), pa.array(first[ahead]), pa.array(second[ahead]), pa.array(total[a, b][ahead])]
        return pa.table(columns, names=["lang", "a", "b", "value"])

    return price


def audit(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
    least_docs: int = 10, top: int = 10, side: int = SIDE, columns: int = COLUMNS,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): how far each source lies from the others of its language, and why.

    Terms are runs of ASCII letters (A-Z in lower case) and characters outside ASCII; a language keeps those of
    ``least_docs`` documents or more. Part ``pair`` has a row for every other source of the language, with the divergence
    summed over all kept terms; part ``term`` the ``top`` terms that the source uses more than its language. Ranks start at 1
    by descending value, then ascending item. Null text, language and source count as empty; a source without terms is a row of zeros, and
    without kept terms all pairs have value 0. Repeated rows count each; an empty table gives no rows. Other columns
    are not read. The result holds a row for every pair of sources of a language, as the audit asks.
    """
    prepare(docs.sparkSession)
    counts = stored(group_term_counts(docs, lang_col, source_col, text_col), "divergence-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    kept = stored(kept, "divergence-kept")
    # One row a language.
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all_n").alias("all_total"))
    langs = stored(langs, "divergence-langs")
    stripe = F.pmod(F.xxhash64("term"), F.ceil(F.col("kept") / columns)).cast("int").alias("stripe")
    dealt = kept.join(langs, "lang").select("lang", "term", "docs", "kept", probability("all_n", "all_total", "kept").alias("q"), stripe)
    # Common terms come first, so that counts lie together and the rest of a stripe is empty quadrants.
    place = Window.partitionBy("lang", "stripe").orderBy(F.desc("docs"), "term")
    places = stored(dealt.withColumn("col", F.row_number().over(place) - 1), "divergence-places")
    widths = places.groupBy("lang", "stripe").agg(F.count("*").alias("width"))

    used = counts.join(places.select("lang", "term", "kept", "q", "stripe", "col"), ["lang", "term"])
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))]
    groups = docs.select(*names).distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    tiles = F.count("*").over(Window.partitionBy("lang"))
    none = F.when(F.col("kept") > 0, probability("0", "total", "nullif(kept, 0)")).otherwise(1).alias("p0")
    groups = stored(groups.select("*", number.alias("g"), F.ceil(tiles / side).cast("int").alias("tiles"), none), "divergence-groups")

    priced = used.join(groups.select("lang", "source", "total", "g", "tiles"), ["lang", "source"])
    priced = stored(priced.withColumn("p", probability("n", "total", "kept")), "divergence-entries")
    sources = groups.join(widths, "lang", "left").select(
        "lang", F.coalesce("stripe", F.lit(0)).alias("stripe"), "g", "tiles", F.lit(-1).alias("col"),
        F.col("p0").alias("p"), F.coalesce("width", F.lit(0)).cast("long").alias("width"),
    )
    entries = priced.select("lang", "stripe", "g", "tiles", "col", "p", F.lit(None).cast("long").alias("width"))
    own = F.floor(F.col("g") / side).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda x: F.struct(F.least(own, x).alias("i"), F.greatest(own, x).alias("j")))
    cells = sources.unionByName(entries).select("lang", "stripe", "g", "col", "p", "width", F.inline(meets))
    cells = cells.withColumn("g", F.col("g").cast("long")).withColumn("col", F.col("col").cast("long"))
    found = cells.groupBy("lang", "stripe", "i", "j").applyInArrow(_price(side), "lang string, a long, b long, value long")
    pairs = found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = pairs.select("lang", F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))), "value")
    left = groups.select("lang", F.col("g").alias("a"), "source")
    right = groups.select("lang", F.col("g").alias("b"), F.col("source").alias("item"))
    each = both.join(left, ["lang", "a"]).join(right, ["lang", "b"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    terms = priced.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value")
    )
    return each.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).where(F.col("rank") <= top))
