"""Facts joined to the interval that holds their time.

Time is cut into bins whose width follows from the intervals, so that an interval lies in about PIECES bins on average and a long
one in as many as it reaches; the number of pieces is bounded by the number of intervals however unequal their lengths.
Facts and pieces meet on key and bin, and a fact lies in one bin, so no fact is repeated and a key with many facts is dealt over its
bins; one bin of a key that is still hot is split by AQE, as any join key is. Intervals may overlap, and have gaps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.columns import as_col

#: Bins an interval reaches on average, beside the one it begins in.
PIECES = 3


def whole(df: DataFrame, c: Column | str) -> Column:
    """A time as microseconds, a date as days, a number as a whole number."""
    kind = df.select(as_col(c).alias("c")).schema["c"].dataType.typeName()
    if kind.startswith("timestamp"):
        return F.unix_micros(as_col(c).cast("timestamp"))
    return F.unix_date(as_col(c)).cast("long") if kind == "date" else as_col(c).cast("long")


def join_valid(facts: DataFrame, spans: DataFrame, keys: Sequence[str], at: str, start: str, end: str, how: str = "left") -> DataFrame:
    """Facts with the columns of each span of their key that holds ``at``: from ``start`` inclusive to ``end`` exclusive.

    A null ``end`` is open, a null ``start`` or ``at`` or key matches nothing, and a span that ends before it begins holds nothing.
    ``how`` is left (facts without a span stay, with nulls) or inner. Column names other than the keys must differ.
    """
    times = facts.agg(F.min(whole(facts, at)), F.max(whole(facts, at))).first()
    low, high = times if times[0] is not None else (0, 0)
    first = F.greatest(whole(spans, start), F.lit(low))
    last = F.least(F.coalesce(whole(spans, end) - 1, F.lit(high)), F.lit(high))
    holds = F.col(start).isNotNull() & (whole(spans, start) <= last) & (first <= last)
    useful = spans.where(holds)
    count, length = useful.agg(F.count("*"), F.sum((last - first).cast("decimal(38,0)"))).first()
    width = max(1, int(length or 0) // max(1, PIECES * count))
    # The condition stands here too: Spark may look at the bins before it filters.
    bins = F.when(holds, F.sequence(F.floor(first / width), F.floor(last / width)))
    pieces = useful.select("*", F.explode(bins).alias("_bin"))
    named = pieces.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in pieces.columns if c not in keys])
    placed = facts.withColumn("_of", F.floor(whole(facts, at) / width))
    open_end = F.col(end).isNull() | (F.col(at) < F.col(end))
    on = (F.col("_of") == F.col("_bin")) & (F.col(at) >= F.col(start)) & open_end
    for k in keys:
        on = on & (F.col(k) == F.col(f"_k_{k}"))
    return placed.join(named, on, how).drop("_of", "_bin", *[f"_k_{k}" for k in keys])
