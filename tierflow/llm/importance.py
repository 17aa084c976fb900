"""Resampling towards a target distribution: hashed n-gram weights, then a distributed quickselect of the best scores.

Features are hashed into a fixed number of buckets, so that the whole model is one array of gains: how much likelier a
bucket is in the target than in the corpus. A document's weight is the sum of that array over its features. With a
Gumbel term added, the highest scores are a draw without replacement in proportion to exp(weight / 1000).

The k-th best is found without sorting the corpus: every round takes a few random candidates as pivots, counts exactly
how many rows lie before and at each of them, and keeps the interval that holds the k-th. Only the winners are sorted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm import words
from tierflow.llm.base import prepare, repeated, sliced, stored

#: Pivots of a round of the quickselect.
PIVOTS = 15


def feature_buckets(text: str | None, longest: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(words, bucket of every feature) of a text, block by block."""
    held: list[bytes] = []  # the last words of the block before
    for some in words.blocks(text, words.WORDS):
        codes = [crc32(w) for w in some]
        joined = held + some
        for n in range(2, longest + 1):
            first = max(0, len(held) - n + 1)
            runs = zip(*(joined[first + k :] for k in range(n)))
            codes.extend(crc32(b" ".join(run)) for run in runs)
        held = joined[len(joined) - longest + 1 :] if longest > 1 else []
        yield len(some), np.array(codes, np.uint32) % np.uint32(buckets)


def bucket_counts(docs: DataFrame, text_col: str, longest: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall in each bucket; a task hands on one row a bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, found in feature_buckets(text.as_py(), longest, buckets):
                    total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], ["bucket", "n"])

    counted = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, object)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[row.bucket] = row.n
    return out


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed ratio of target to corpus frequency, for each bucket."""
    buckets = len(corpus)
    above, below = float(corpus.sum() + buckets), float(target.sum() + buckets)
    ratio = [((float(t) + 1) * above) / ((float(s) + 1) * below) for s, t in zip(corpus, target)]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def weight_column(text: Column, gains: np.ndarray, longest: int = 1) -> Column:
    """struct<n_words, n_features, weight>: the gains array summed over the features of each text."""
    buckets = len(gains)

    @F.arrow_udf("n_words long, n_features long, weight long")
    def of(texts: pa.Array) -> pa.Array:
        out = np.zeros((len(texts), 3), np.int64)
        for k, text in enumerate(texts):
            for n, found in feature_buckets(text.as_py(), longest, buckets):
                out[k] += (n, len(found), gains[found].sum())
        return pa.StructArray.from_arrays([pa.array(c) for c in out.T.copy()], ["n_words", "n_features", "weight"])

    return of(text)


def gumbel(id_col: Column, seed: int) -> Column:
    """A whole-numbered Gumbel term drawn from the SHA-256 of seed and id; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def quickselect(rows: DataFrame, keys: list[str], weight: str, k: int, seed: int = 0) -> tuple[tuple, int]:
    """(key, n): the key at which the k-th row in ascending key order stands, and how many rows of that key are needed.

    ``rows`` holds each key once and ``weight`` says how often it counts; 1 <= k <= the sum of weights. Nulls in keys come
    first. Each round reads the rows of the remaining interval twice, once for the pivots and once for the counts, and
    leaves about one of PIVOTS parts of it.
    """
    types = {f.name: f.dataType for f in rows.schema.fields}
    key = F.struct(*keys)

    def point(values: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(keys, values)])

    low = high = None
    for turn in range(10_000):
        some = rows
        if low is not None:  # the first column alone can be pushed into the scan
            some = some.where((F.col(keys[0]) >= F.lit(low[0])) & (key > point(low)))
        if high is not None:
            some = some.where((F.col(keys[0]) <= F.lit(high[0])) & (key < point(high)))
        drawn = some.orderBy(F.xxhash64(F.lit(seed + turn), *keys), *keys).limit(PIVOTS).select(*keys).collect()
        ordered = F.sort_array(F.array(*[point(tuple(r)) for r in drawn]))
        pivots = [tuple(p) for p in rows.sparkSession.range(1).select(ordered.alias("p")).first().p]
        parts = [
            F.coalesce(F.sum(F.when(test, F.col(weight))), F.lit(0))
            for p in pivots for test in (key < point(p), key == point(p))
        ]
        counted = list(some.agg(*[x.alias(f"c{n}") for n, x in enumerate(parts)]).first())
        for p, before, at in zip(pivots, counted[::2], counted[1::2]):
            if before < k <= before + at:
                return p, k - before
        left = [(p, before + at) for p, before, at in zip(pivots, counted[::2], counted[1::2]) if before + at < k]
        right = [p for p, before in zip(pivots, counted[::2]) if before >= k]
        if left:
            low = left[-1][0]
            k -= left[-1][1]
        if right:
            high = right[0]
    raise RuntimeError("the interval does not shrink")


def resampled(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    percent: int = 10, least_words: int = 20, longest: int = 1, buckets: int = 10_000, seed: int = 2024,
) -> DataFrame:
    """Every row's id, n_words, n_features, weight, score and rank; rank is null for the rows that are not drawn.

    Of the N rows with ``least_words`` words or more, the ``percent * N // 100`` highest scores are drawn; ties go to the
    smaller id (null ids last), then to fewer features. Rows equal in all of these are drawn one by one and take ranks
    next to each other. Null texts count as empty: no features, weight 0. An empty corpus gives no rows, and an empty
    target is uniform over the buckets. Only the id and text columns are read.
    """
    prepare(docs.sparkSession)
    target_rows = target.select(F.col(target_col).alias("text"))
    gains = gains_of(bucket_counts(docs, text_col, longest, buckets), bucket_counts(target_rows, "text", longest, buckets))
    weighed = docs.select(F.col(id_col).alias("id"), weight_column(F.col(text_col).cast("string"), gains, longest).alias("w"))
    scored = weighed.select("id", "w.*").withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    columns = ["id", "n_words", "n_features", "weight", "score"]
    classes = scored.groupBy(*columns).agg(F.count("*").alias("copies"))
    keys = ["down", "unnamed", "id", "n_features"]
    named = classes.select("*", (-F.col("score")).alias("down"), F.col("id").isNull().alias("unnamed"))
    known = stored(named.withColumn("able", F.col("n_words") >= least_words), "importance-scores")

    total = known.where("able").agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    k = percent * total // 100
    won = F.lit(0).cast("long")
    if k:
        at, needed = quickselect(known.where("able"), keys, "copies", k, seed)
        last = F.struct(*[F.lit(v).cast(known.schema[c].dataType).alias(c) for c, v in zip(keys, at)])
        key = F.struct(*keys)
        won = F.when(~F.col("able") | (key > last), 0).when(key == last, needed).otherwise(F.col("copies")).cast("long")
    split = known.withColumn("won", won)
    winners = ranked(split.where("won > 0"), keys, "won")
    lost = repeated(split.withColumn("lost", F.col("copies") - F.col("won")).where("lost > 0"), "lost", "n")
    shown = [F.col("id").alias(id_col), *columns[1:]]
    return winners.select(*shown, "rank").unionByName(lost.select(*shown, F.lit(None).cast("long").alias("rank")))


def ranked(rows: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Each row as often as ``weight`` says, with its rank from 1 in ascending key order over all rows."""
    parts = sliced(rows, *keys)
    inside = Window.partitionBy("slice").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy("slice").agg(F.sum(weight).alias("size"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # one row a slice
    offsets = sizes.select(F.col("slice").alias("of"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    own = parts.withColumn("ahead", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    numbered = stored(own.join(offsets, F.col("slice") == F.col("of")), "importance-ranks")
    return repeated(numbered, weight, "n").withColumn("rank", F.col("before") + F.col("ahead") + F.col("n") + 1)
