"""Stored sketches of distinct values and quantiles, kept per period and merged on reading.

A day is sketched once; any period is the union of its days, so that distinct users of a week are not the sum of seven daily
counts and no event is read again. Late rows are merged into the sketch of their day. The error is known beforehand: with
``DISTINCT_BITS`` the standard error of a distinct count is ``distinct_error()`` of it (small sets are counted exactly), and with
``QUANTILE_SIZE`` the rank of a quantile is off by ``RANK_ERROR`` of the rows with a confidence of 99 %.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base-two logarithm of the registers of a distinct sketch; size of a quantile sketch and its error of ranks.
DISTINCT_BITS, QUANTILE_SIZE, RANK_ERROR = 14, 400, 0.0068


def distinct_error(bits: int = DISTINCT_BITS) -> float:
    return 1.04 / 2 ** (bits / 2)


def sketched(df: DataFrame, keys: Sequence[str], distinct: Mapping[str, str], quantiles: Mapping[str, str]) -> DataFrame:
    """One row a group: ``n_rows``, a distinct sketch for each name of ``distinct``, a quantile sketch for each of ``quantiles``.

    Both map the name of a sketch to a column; nulls are not sketched. Sketches are built per task and merged, so that a hot
    group sends one small row a task.
    """
    parts = [F.count("*").alias("n_rows")]
    parts += [F.hll_sketch_agg(F.col(c), F.lit(DISTINCT_BITS)).alias(n) for n, c in distinct.items()]
    parts += [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(QUANTILE_SIZE)).alias(n) for n, c in quantiles.items()]
    return df.groupBy(*keys).agg(*parts)


def merged(sketches: DataFrame, keys: Sequence[str], distinct: Sequence[str], quantiles: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups, or of the same groups in two stored parts, from finer ones."""
    parts = [F.sum("n_rows").alias("n_rows")]
    parts += [F.hll_union_agg(c).alias(c) for c in distinct]
    parts += [F.kll_merge_agg_double(c).alias(c) for c in quantiles]
    return sketches.groupBy(*keys).agg(*parts)


def estimates(sketches: DataFrame, keys: Sequence[str], distinct: Sequence[str], quantiles: Mapping[str, tuple[str, float]]) -> DataFrame:
    """Distinct counts under their sketch's name with ``_low`` and ``_high`` bounds (three standard errors), and quantiles.

    ``quantiles`` maps an output name to (sketch, share).
    """
    error = 3 * distinct_error()
    parts = []
    for c in distinct:
        found = F.hll_sketch_estimate(c)
        parts += [found.alias(c), F.floor(found * (1 - error)).alias(f"{c}_low"), F.ceil(found * (1 + error)).alias(f"{c}_high")]
    parts += [F.kll_sketch_get_quantile_double(F.col(c), F.lit(q)).alias(n) for n, (c, q) in quantiles.items()]
    return sketches.select(*keys, "n_rows", *parts)
