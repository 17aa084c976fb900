"""Features per entity: trailing windows, point-in-time training sets, time parts, correlated columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.columns import ratio
from tierflow.operators.joining import asof_join_all


def trailing_windows(df: DataFrame, key: str, at: str, value: str, as_of: Column, days: Sequence[int]) -> DataFrame:
    """Counts and sums over several look-back windows in one pass, with the share of the shortest in the longest."""
    age = F.datediff(as_of, F.col(at))
    longest = max(days)
    recent = df.where((age >= 0) & (age < longest))
    measures = []
    for d in days:
        inside = age < d
        measures.append(F.count_if(inside).alias(f"count_{d}d"))
        measures.append(F.sum(F.when(inside, F.col(value))).alias(f"sum_{d}d"))
    out = recent.groupBy(key).agg(*measures, F.min(age).alias("days_since_last"))
    return out.withColumn("velocity", ratio(f"count_{min(days)}d", f"count_{longest}d"))


def training_set(
    spine: DataFrame, spine_at: str, spine_id: str, keys: Sequence[str], features: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """The spine with the newest row of each feature table at its time, found in one pass over all of them.

    Feature columns carry the table's name.
    """
    named = [
        (frame.select(*keys, *[F.col(c).alias(f"{name}_{c}") for c in frame.columns if c not in keys]), f"{name}_{at}")
        for name, (frame, at) in features.items()
    ]
    return asof_join_all(spine, named, keys, spine_at, spine_id)


def time_parts(at: str) -> dict[str, Column]:
    c = F.col(at)
    return {
        "day_of_week": F.dayofweek(c).cast("bigint"),
        "hour": F.hour(c).cast("bigint"),
        "month": F.month(c).cast("bigint"),
        "is_weekend": F.dayofweek(c).isin(1, 7),
    }


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairwise correlations from one aggregation, as rows."""
    pairs = list(combinations(columns, 2))
    found = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    rows = [
        F.struct(F.lit(a).alias("left_feature"), F.lit(b).alias("right_feature"), F.col(f"`{a}|{b}`").alias("correlation"))
        for a, b in pairs
    ]
    return found.select(F.inline(F.array(*rows)))


def drop_correlated(df: DataFrame, columns: Sequence[str], limit: float = 0.95) -> list[str]:
    """Columns kept when, going left to right, a column too close to a kept one is dropped."""
    strong = {
        (x["left_feature"], x["right_feature"])
        for x in correlations(df, columns).where(F.abs("correlation") > limit).collect()  # at most one row per column pair
    }
    kept: list[str] = []
    for c in columns:
        if not any((k, c) in strong for k in kept):
            kept.append(c)
    return kept
