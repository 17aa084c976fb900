"""Data quality: metrics, expectations, failing-row tests, profiles, drift.

Metrics of one table are one aggregation. Tests return the failing rows; none means passed.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.columns import ratio
from tierflow.operators.ordered import quantiles, running_totals

# Fixed formats.
HASH_FORMAT = "^[a-f0-9]{64}$"
CODE_FORMAT = "^[A-Z]{3}$"


def out_of_range(c: str, low: float, high: float, null_is_violation: bool = True) -> Column:
    bad = (F.col(c) < low) | (F.col(c) > high)
    return F.count_if(F.coalesce(bad, F.lit(null_is_violation)))


def bad_format(c: str, pattern: str, null_is_violation: bool = True) -> Column:
    return F.count_if(F.coalesce(~F.col(c).rlike(pattern), F.lit(null_is_violation)))


def negatives(c: str) -> Column:
    return F.count_if(F.col(c) < 0)


def nulls(c: str) -> Column:
    return F.count_if(F.col(c).isNull())


def duplicates(c: str) -> Column:
    """Rows minus distinct values, so repeated nulls count as well."""
    return F.count("*") - F.countDistinct(c)


def measure(df: DataFrame, table: str, metrics: Mapping[str, Column]) -> DataFrame:
    """One row per metric of a table, from one pass over it."""
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), c.cast("double").alias("value")) for m, c in metrics.items()])
    return df.agg(rows.alias("m")).select(F.lit(table).alias("table_name"), F.inline("m"))


@dataclass(frozen=True)
class Expectation:
    """``metric op threshold``; with ``of`` the threshold is a share of that metric's value."""

    metric: str
    op: str
    threshold: float
    upper: float | None = None
    of: str | None = None


def _holds(value: Column, e: Expectation, base: Column | None) -> Column:
    limit = F.lit(float(e.threshold)) if base is None else base * F.lit(float(e.threshold))
    tests = {
        "=": lambda: value == limit, "!=": lambda: value != limit, "<": lambda: value < limit, "<=": lambda: value <= limit,
        ">": lambda: value > limit, ">=": lambda: value >= limit,
        "between": lambda: value.between(limit, F.lit(float(e.upper if e.upper is not None else e.threshold))),
    }
    return tests[e.op]()


def expect(df: DataFrame, table: str, metrics: Mapping[str, Column], expectations: Sequence[Expectation]) -> DataFrame:
    """One row per expectation with the measured value and whether it passed."""
    values = df.agg(*[c.cast("double").alias(m) for m, c in metrics.items()])
    rows = []
    for e in expectations:
        base = F.col(e.of) if e.of else None
        rows.append(
            F.struct(
                F.lit(e.metric).alias("metric"), F.lit(e.op).alias("comparison"), F.col(e.metric).alias("value"),
                F.coalesce(_holds(F.col(e.metric), e, base), F.lit(False)).alias("passed"),
            )
        )
    return values.select(F.lit(table).alias("table_name"), F.inline(F.array(*rows)))


def not_null(df: DataFrame, c: str) -> DataFrame:
    return df.where(F.col(c).isNull())


def unique(df: DataFrame, c: str) -> DataFrame:
    return df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def accepted_values(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    """Values outside the list with their row counts."""
    return df.where(~F.col(c).isin(list(values))).groupBy(c).agg(F.count("*").alias("row_count"))


def relationships(child: DataFrame, c: str, parent: DataFrame, key: str) -> DataFrame:
    """Non-null child values without a parent row."""
    return child.where(F.col(c).isNotNull()).join(parent, F.col(c) == F.col(key), "left_anti")


def orphan_count(fact: DataFrame, dim: DataFrame, foreign_key: str, primary_key: str) -> DataFrame:
    """Fact rows without a dimension row; a null key counts."""
    missing = fact.join(dim, F.col(foreign_key) == F.col(primary_key), "left_anti")
    return missing.agg(F.count("*").alias("orphans"))


def header_mismatch(headers: DataFrame, lines: DataFrame, key: str, total: str, amount: Column, tolerance: float) -> DataFrame:
    """Headers whose total differs from the sum of their lines by more than the tolerance."""
    sums = lines.groupBy(key).agg(F.sum(amount).alias("line_total"))
    joined = headers.select(key, total).join(sums, key, "left")
    joined = joined.withColumn("line_total", F.coalesce("line_total", F.lit(0)))
    return joined.where(F.abs(F.col(total) - F.col("line_total")) > F.lit(tolerance))


def _unpivot(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*keys, F.inline(pairs))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, nulls, minimum, maximum and most common value of numeric columns.

    Values are counted per column first, so the map side does most of the work and no column is one task.
    """
    counts = _unpivot(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))
    common = F.struct(F.when(F.col("value").isNotNull(), -F.col("n")).otherwise(F.lit(1)), F.col("value"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        (F.min("value") + 0.0).alias("min_value"),  # turns -0.0 into 0.0
        F.max("value").alias("max_value"),
        F.min_by("value", common).alias("most_common"),
    )


def learned_bounds(profiled: DataFrame, low: float = 0.9, high: float = 1.1) -> DataFrame:
    return profiled.select(
        "column", (F.col("min_value") * low).alias("low"), (F.col("max_value") * high).alias("high")
    )


def bound_violations(df: DataFrame, columns: Sequence[str], bounds: DataFrame) -> DataFrame:
    """Values of the next batch outside the learned bounds, counted per column."""
    counts = _unpivot(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))
    bad = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))
    return counts.join(bounds, "column").groupBy("column", "low", "high").agg(
        F.sum(F.when(bad, F.col("n")).otherwise(0)).alias("violations")
    )


def drift(old: DataFrame, new: DataFrame, value: str, limit: float = 0.1) -> DataFrame:
    """Relative shift of mean, median and standard deviation between two samples."""

    def stats(df, side):
        base = df.agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("stddev"))
        median = quantiles(df.select(value), [], value, {"median": ("cont", 0.5)}).scalar()
        row = base.select("mean", "stddev", median.alias("median"))
        pairs = [F.struct(F.lit(s).alias("statistic"), F.col(s).alias(side)) for s in ("mean", "median", "stddev")]
        return row.select(F.inline(F.array(*pairs)))

    both = stats(old, "before").join(stats(new, "after"), "statistic")
    shift = F.abs(ratio(F.col("after") - F.col("before"), F.col("before")))
    return both.withColumn("shift", shift).withColumn("drifted", F.col("shift") > limit)


#: Scaled distance below which the p-value comes from the series for small distances.
KS_TURN = 1.18


def two_sample_ks(first: DataFrame, second: DataFrame, value: str) -> DataFrame:
    """Kolmogorov-Smirnov distance of two samples with its asymptotic p-value.

    Both samples shrink to counts per distinct value; the cumulative counts are a distributed running total.
    """

    def side(df, n):
        flags = [F.lit(1 if i == n else 0).cast("bigint").alias(f"n{i}") for i in (1, 2)]
        return df.where(F.col(value).isNotNull()).select(F.col(value).alias("v"), *flags)

    counts = side(first, 1).unionByName(side(second, 2)).groupBy("v").agg(F.sum("n1").alias("n1"), F.sum("n2").alias("n2"))
    steps = running_totals(counts, [], ["v"], {"c1": F.col("n1"), "c2": F.col("n2")})
    sizes = counts.agg(F.sum("n1").alias("s1"), F.sum("n2").alias("s2"))
    size1, size2 = sizes.select("s1").scalar(), sizes.select("s2").scalar()
    rows = steps.select(F.abs(ratio("c1", size1) - ratio("c2", size2)).alias("gap"), size1.alias("s1"), size2.alias("s2"))
    out = rows.groupBy("s1", "s2").agg(F.max("gap").alias("statistic"))
    scale = F.sqrt(F.col("s1").cast("double") * F.col("s2") / (F.col("s1") + F.col("s2")))
    x = scale * F.col("statistic")
    ks = F.sequence(F.lit(1), F.lit(20))
    large = lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(F.lit(-2.0) * k * k * x * x)
    # The alternating series does not settle near zero, where the other form of the theta function does.
    odd = lambda k: (2 * k - 1) * (2 * k - 1)
    small = lambda k: F.exp(-odd(k) * F.lit(math.pi**2 / 8) / (x * x))
    below = F.lit(math.sqrt(2 * math.pi)) / x * F.aggregate(ks, F.lit(0.0), lambda acc, k: acc + small(k))
    above = F.aggregate(ks, F.lit(0.0), lambda acc, k: acc + large(k))
    p = F.when(x <= 0, F.lit(1.0)).when(x < KS_TURN, 1 - below).otherwise(above)
    return out.select("statistic", F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)).alias("p_value"))
