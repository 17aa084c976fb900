"""Run statistics, baselines, health classes and unit costs over run logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.columns import minutes_between, ratio
from tierflow.operators.ordered import quantiles

# Minutes without a commit, and the default spread as a share of the mean.
STALLED_MINUTES, WARNING_MINUTES = 10, 5
DEFAULT_SPREAD = 0.2


def run_statistics(
    runs: DataFrame, keys: Sequence[str], duration: str, at: str | None = None, since: Column | None = None, least: int = 1
) -> DataFrame:
    """Count, mean, extremes, population deviation, upper median and 95th element per key.

    A baseline of recent runs takes those with ``at`` from ``since`` on, and keys with fewer than ``least`` of them have
    none.
    """
    runs = runs if since is None else runs.where(F.col(at) >= since)
    base = runs.groupBy(*keys).agg(
        F.count(duration).alias("sample_size"),
        F.avg(duration).alias("avg_seconds"),
        F.min(duration).alias("min_seconds"),
        F.max(duration).alias("max_seconds"),
        F.stddev_pop(duration).alias("stddev_seconds"),
    )
    places = quantiles(runs, keys, duration, {"median_seconds": ("index", 0.5), "p95_seconds": ("index", 0.95)})
    return base.where(F.col("sample_size") >= least).join(places, list(keys))


def against_baseline(runs: DataFrame, baseline: DataFrame, keys: Sequence[str], duration: str) -> DataFrame:
    """Each run's distance from its baseline and its class by one and two deviations."""
    spread = F.coalesce(F.col("stddev_seconds"), F.col("avg_seconds") * DEFAULT_SPREAD)
    delta = F.col(duration) - F.col("avg_seconds")
    status = (
        F.when(F.abs(delta) <= spread, "within_normal")
        .when(F.abs(delta) <= 2 * spread, "slightly_outside")
        .otherwise("significantly_outside")
    )
    joined = runs.join(baseline.select(*keys, "avg_seconds", "stddev_seconds"), list(keys))
    return joined.withColumns(
        {"delta_seconds": delta, "delta_percent": ratio(delta * 100, "avg_seconds"), "status": status}
    ).drop("avg_seconds", "stddev_seconds")


def health(log: DataFrame, key: str, at: str, as_of: Column, warning: int = WARNING_MINUTES, stalled: int = STALLED_MINUTES):
    """Minutes since the last commit of each key and its health class."""
    last = log.groupBy(key).agg(F.max(at).alias("last_commit")).withColumn("minutes", minutes_between("last_commit", as_of))
    status = F.when(F.col("minutes") > stalled, "STALLED").when(F.col("minutes") > warning, "WARNING").otherwise("HEALTHY")
    return last.withColumn("channel_status", status)


def unit_costs(log: DataFrame, key: str, cost: Column, units: Column, limit: float) -> DataFrame:
    """Cost per unit by key with a flag above ``limit``."""
    out = log.groupBy(key).agg(F.count("*").alias("items"), F.sum(cost).alias("total_cost"), F.sum(units).alias("total_units"))
    out = out.withColumn("cost_per_unit", ratio("total_cost", "total_units"))
    return out.withColumn("efficiency_flag", F.when(F.col("cost_per_unit") > limit, "WARNING").otherwise("OK"))
