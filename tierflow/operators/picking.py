"""Keep-latest, top-n per group, global ranking, samples.

``row_number() <= n`` filters are planned with a group limit before the shuffle: each map task sends at
most n rows of a key, so a hot key costs no more than a cold one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierflow.operators.ordered import running_totals


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each key. Groups are limited before the shuffle for any ``n`` up to the session's limit (``session.tune``)."""
    name = rank or "_rn"
    w = W.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order``."""
    return top_n(df, keys, order, 1)


def global_rank(df: DataFrame, value: str, tie: str, row_number: str, rank: str) -> DataFrame:
    """Descending row number and rank over all rows, without gathering them in one task when they are many."""
    keyed = df.withColumn("_neg", -F.col(value))
    counts = keyed.groupBy("_neg").agg(F.count("*").alias("_n"))
    starts = running_totals(counts, [], ["_neg"], {"_upto": F.col("_n")}).select(
        F.col("_neg").alias("_v"), (F.col("_upto") - F.col("_n") + 1).alias(rank)
    )
    numbered = running_totals(keyed, [], ["_neg", tie], {row_number: F.lit(1).cast("bigint")})
    return numbered.join(starts, F.col("_neg") == F.col("_v")).drop("_neg", "_v")


def hash_bucket(key: str, buckets: int) -> Column:
    """Stable bucket number of a key: the same rows are sampled on every run and engine."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint") % buckets


def seeded_sample(df: DataFrame, key: str, share: float, seed: int) -> DataFrame:
    """Rows drawn by a hash of seed and key: the same ones on every run and partitioning, and other ones for another seed."""
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("bigint")
    return df.where(drawn < int(share * 2**32))


def hash_order(key: str) -> Column:
    return F.md5(F.col(key).cast("string"))
