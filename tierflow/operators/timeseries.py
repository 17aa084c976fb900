"""Resampling to a fixed interval and time zone conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.operators.ordered import quantiles


#: Bins of one block of a resampling grid.
GRID_BLOCK = 4096


def bin_start(at: str, seconds: int) -> Column:
    """Start of the interval a time falls in, counted from the epoch, as timestamp without zone."""
    whole = F.floor(F.unix_micros(F.col(at).cast("timestamp")) / F.lit(seconds * 1_000_000))
    return F.timestamp_seconds(whole * seconds).cast("timestamp_ntz")


def resample(df: DataFrame, at: str, value: str, seconds: int) -> DataFrame:
    """Mean, median, minimum and maximum per interval; intervals without rows are kept with nulls."""
    binned = df.select(bin_start(at, seconds).alias("bin"), F.col(value).alias("value"))
    stats = binned.groupBy("bin").agg(
        F.avg("value").alias("mean"), F.min("value").alias("low"), F.max("value").alias("high"), F.count("value").alias("n")
    )
    stats = stats.join(quantiles(binned, ["bin"], "value", {"median": ("cont", 0.5)}), "bin", "left")
    span = stats.agg(F.min("bin").alias("a"), F.max("bin").alias("b"))
    # The grid is built in two steps, so that no row holds more than a block of bins and the blocks are shared out.
    whole = span.select(F.unix_seconds(F.col("a").cast("timestamp")).alias("a"), F.unix_seconds(F.col("b").cast("timestamp")).alias("b"))
    steps = F.floor((F.col("b") - F.col("a")) / F.lit(seconds))
    blocks = whole.withColumn("n", steps).withColumn("block", F.explode(F.sequence(F.lit(0), F.floor(F.col("n") / GRID_BLOCK))))
    first = F.col("block") * GRID_BLOCK
    numbers = F.sequence(first, F.least(F.col("n"), first + (GRID_BLOCK - 1)))
    grid = blocks.where(F.col("n").isNotNull()).repartition("block").select("a", F.explode(numbers).alias("i"))
    grid = grid.select(F.timestamp_seconds(F.col("a") + F.col("i") * seconds).cast("timestamp_ntz").alias("bin"))
    return grid.join(stats, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def to_local(at: str, zone: str) -> Column:
    """A UTC time as local wall-clock time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(at))


def to_utc(at: str, zone: str) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col(at))
