"""Ordered calculations per key that stay distributed when one key holds a large share of the rows.

Spark's window functions put a whole key into one task. Each function here counts the largest group
first. Below ``spark.tierflow.hotGroupRows`` it is a plain window. Above it, rows are range-partitioned
by (keys, order) into even slices, a window runs inside each slice, and what a slice inherits from the
slices before it is joined on. At most one key crosses each slice border, so that carried frame has
fewer rows than there are slices and is safe to broadcast.

``order`` must be a total order (end it with an id): equal rows cannot be split.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierflow.session import hot_group_rows, shared_dir

_BLOCK = 100_000


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the biggest key; counted with map-side combine on the key columns only."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.max("n")).first()[0] or 0


def is_hot(df: DataFrame, keys: Sequence[str]) -> bool:
    return largest_group(df, keys) > hot_group_rows(df.sparkSession)


def _is_hot(df: DataFrame, keys: Sequence[str], known: bool | None) -> bool:
    # A caller that runs several ordered steps over the same rows counts once and passes the answer on.
    return is_hot(df, keys) if known is None else known


def _sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    # The slice number must be the same for every reader, also after a lost executor: write it out once.
    spark = df.sparkSession
    shared_dir(spark)
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(slices, *keys, *order)
    return ranged.withColumn("_slice", F.spark_partition_id()).checkpoint()


def _join_carry(rows: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = carry.select(
        F.col("_slice").alias("_c_slice"),
        *[F.col(k).alias(f"_c_{k}") for k in keys],
        *[c for c in carry.columns if c.startswith("_carry_")],
    )
    on = F.col("_slice") == F.col("_c_slice")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    return rows.join(F.broadcast(renamed), on, "left").drop("_c_slice", *[f"_c_{k}" for k in keys])


def running_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], totals: Mapping[str, Column], hot: bool | None = None
) -> DataFrame:
    """Adds inclusive running sums over ``order`` within ``keys``."""
    keys, order = list(keys), list(order)
    inputs = {name: f"_in_{name}" for name in totals}
    df = df.withColumns({inputs[n]: c for n, c in totals.items()})
    frame = (W.unboundedPreceding, W.currentRow)
    if not _is_hot(df, keys, hot):
        w = W.partitionBy(*keys).orderBy(*order).rowsBetween(*frame)
        return df.withColumns({n: F.sum(inputs[n]).over(w) for n in totals}).drop(*inputs.values())
    rows = _sliced(df, keys, order)
    local = W.partitionBy("_slice", *keys).orderBy(*order).rowsBetween(*frame)
    before = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    per_slice = rows.groupBy("_slice", *keys).agg(*[F.sum(inputs[n]).alias(f"_t_{n}") for n in totals])
    carry = per_slice.withColumns(
        {
            "_earlier": F.count("*").over(before),
            **{f"_carry_{n}": F.sum(f"_t_{n}").over(before) for n in totals},
        }
    ).where(F.col("_earlier") > 0)
    out = _join_carry(rows.withColumns({n: F.sum(inputs[n]).over(local) for n in totals}), carry, keys)
    for n in totals:
        both = F.coalesce(F.col(n) + F.col(f"_carry_{n}"), F.col(n), F.col(f"_carry_{n}"))
        out = out.withColumn(n, both)
    return out.drop("_slice", *inputs.values(), *[f"_carry_{n}" for n in totals])


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "row_number", hot: bool | None = None
) -> DataFrame:
    return running_totals(df, keys, order, {name: F.lit(1).cast("bigint")}, hot)


def last_known(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Replaces each value column by its latest non-null value so far within ``keys``."""
    keys, order = list(keys), list(order)
    frame = (W.unboundedPreceding, W.currentRow)
    if not is_hot(df, keys):
        w = W.partitionBy(*keys).orderBy(*order).rowsBetween(*frame)
        return df.withColumns({v: F.last(v, ignorenulls=True).over(w) for v in values})
    rows = _sliced(df, keys, order)
    at = F.struct(*order)
    per_slice = rows.groupBy("_slice", *keys).agg(
        *[F.max_by(v, F.when(F.col(v).isNotNull(), at)).alias(f"_t_{v}") for v in values]
    )
    before = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carry = per_slice.withColumns(
        {
            "_earlier": F.count("*").over(before),
            **{f"_carry_{v}": F.last(f"_t_{v}", ignorenulls=True).over(before) for v in values},
        }
    ).where(F.col("_earlier") > 0)
    local = W.partitionBy("_slice", *keys).orderBy(*order).rowsBetween(*frame)
    out = rows.withColumns({v: F.last(v, ignorenulls=True).over(local) for v in values})
    out = _join_carry(out, carry, keys)
    out = out.withColumns({v: F.coalesce(F.col(v), F.col(f"_carry_{v}")) for v in values})
    return out.drop("_slice", *[f"_carry_{v}" for v in values])


def over_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    before: int,
    after: int,
    build: Callable[[WindowSpec], Mapping[str, Column]],
    hot: bool | None = None,
) -> DataFrame:
    """Window columns that look at most ``before`` rows back and ``after`` rows ahead (lag, lead, ROWS frames).

    A hot key is numbered, cut into blocks, and each block borrows the few rows it needs from its neighbours.
    """
    keys, order = list(keys), list(order)
    if not _is_hot(df, keys, hot):
        return df.withColumns(dict(build(W.partitionBy(*keys).orderBy(*order))))
    size = max(min(_BLOCK, hot_group_rows(df.sparkSession)), before + after + 1)
    numbered = row_numbers(df, keys, order, "_rn", hot=True)
    pos = (F.col("_rn") - 1) % size
    home = F.floor((F.col("_rn") - 1) / size)
    blocks = F.array_compact(
        F.array(home, F.when(pos >= size - before, home + 1), F.when(pos < after, home - 1))
    )
    spread = numbered.withColumn("_home", home).withColumn("_block", F.explode(blocks))
    w = W.partitionBy(*keys, "_block").orderBy("_rn")
    return (
        spread.withColumns(dict(build(w)))
        .where(F.col("_home") == F.col("_block"))
        .drop("_rn", "_home", "_block")
    )


def over_range(
    df: DataFrame, keys: Sequence[str], at: str, before: int, after: int, totals: Mapping[str, Column], hot: bool | None = None
) -> DataFrame:
    """Adds sums over the rows of the key whose whole-numbered ``at`` lies from ``before`` back to ``after`` ahead.

    The keyed RANGE frame of SQL: rows of equal ``at`` share their frame, and a null ``at`` sees the other nulls of its key. Any sum
    is null where the frame holds no value.

    Time is cut into blocks as long as the frame. A frame then ends in one block and begins in the one before it, so that its sum
    is that of the end block up to the frame's end and that of the block before from the frame's start on: two running sums,
    whose work does not grow with the rows of a frame. Each row goes to the block of its frame's end and lends its values to
    its own block and the next. A block that is hot is summed per position first, and its running sums are split over tasks.
    """
    keys = list(keys)
    inputs = {n: f"_in_{n}" for n in totals}
    width = before + after
    df = df.withColumns({inputs[n]: c for n, c in totals.items()})
    kinds = {n: df.select(F.sum(inputs[n]).alias(n)).schema[n].dataType for n in totals}
    time = F.col(at).cast("long")
    # A row asks (0) and lends to its own block (1) and the next (2); where frames end with their row, 0 stands for 1 too.
    own = 0 if after == 0 else 1
    roles = [0, 2] if after == 0 else [0, 1, 2]
    here = F.array(*map(F.lit, roles[:-1]))
    role = F.when(time.isNull(), here).otherwise(F.array(*map(F.lit, roles)))
    rows = df.withColumn("_role", F.explode(role))
    asked, lent = F.col("_role") == 0, F.col("_role") == 2
    size, end = F.lit(width + 1).cast("long"), time + F.lit(after).cast("long")
    begun = lambda x: x - F.pmod(x, size)
    rows = rows.withColumn("_block", F.when(asked, begun(end)).when(lent, begun(time) + size).otherwise(begun(time)))
    rows = rows.withColumn("_place", F.when(asked, end).when(lent, time + F.lit(width).cast("long")).otherwise(time))
    for n in totals:
        rows = rows.withColumn(f"_up_{n}", F.when(F.col("_role") == own, F.col(inputs[n])))
        rows = rows.withColumn(f"_down_{n}", F.when(lent, F.col(inputs[n])))
    rows = rows.drop(*inputs.values())
    group = [*keys, "_block"]
    if not _is_hot(rows, group, hot):
        reach = lambda order: W.partitionBy(*group).orderBy(order).rangeBetween(W.unboundedPreceding, W.currentRow)
        up, down = reach(F.col("_place").asc()), reach(F.col("_place").desc())
        summed = rows.withColumns(
            {f"_{side}_{n}": F.sum(f"_{side}_{n}").over(w) for side, w in (("up", up), ("down", down)) for n in totals}
        ).where(asked)
    else:
        sides = [f"_{side}_{n}" for side in ("up", "down") for n in totals]
        points = rows.groupBy(*group, "_place").agg(*[F.sum(c).alias(c) for c in sides])
        points = running_totals(points, group, ["_place"], {f"_sum_up_{n}": F.col(f"_up_{n}") for n in totals}, hot=True)
        points = points.withColumn("_back", -F.col("_place"))
        points = running_totals(points, group, ["_back"], {f"_sum_down_{n}": F.col(f"_down_{n}") for n in totals}, hot=True)
        found = points.select(*group, "_place", *[F.col(f"_sum{c}").alias(c) for c in sides])
        summed = _null_safe(rows.where(asked).drop(*sides), found, [*group, "_place"], "left")
    for n in totals:
        up, down = F.col(f"_up_{n}"), F.col(f"_down_{n}")
        summed = summed.withColumn(n, F.coalesce(up + down, up, down).cast(kinds[n]))
    return summed.drop("_role", "_block", "_place", *[f"_{side}_{n}" for side in ("up", "down") for n in totals])


def _null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """A join on columns of one name that takes null as a value; the left side's columns stay."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    joined = left.join(renamed, same, how)
    return joined.drop(*[f"_r_{c}" for c in on])


def quantiles(
    df: DataFrame, keys: Sequence[str], value: str, wanted: Mapping[str, tuple[str, float]]
) -> DataFrame:
    """Exact order statistics per key: ``("cont", q)`` interpolates, ``("index", q)`` takes element int(q * n).

    Values are counted first (map-side combine), then located by their running count.
    """
    keys = list(keys)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    ranked = running_totals(counts, keys, [value], {"_upto": F.col("_n")})
    sizes = counts.groupBy(*keys).agg(F.sum("_n").alias("_size"))
    if keys:
        renamed = sizes.select(*[F.col(k).alias(f"_g_{k}") for k in keys], "_size")
        on = [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys]
        ranked = ranked.join(renamed, on, "inner")
    else:
        ranked = ranked.withColumn("_size", sizes.scalar())

    def element(index: Column) -> Column:
        return F.max(F.when((index >= F.col("_upto") - F.col("_n")) & (index < F.col("_upto")), F.col(value)))

    picks, final = [], []
    for name, (kind, q) in wanted.items():
        if kind == "index":
            picks.append(element(F.least(F.floor(F.col("_size") * F.lit(q)), F.col("_size") - 1)).alias(name))
            final.append(F.col(name))
            continue
        place = (F.col("_size") - 1) * F.lit(q)
        picks += [element(F.floor(place)).alias(f"_lo_{name}"), element(F.ceil(place)).alias(f"_hi_{name}")]
        lo, hi = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        where = (F.col("_total") - 1) * F.lit(q)
        final.append((lo + (hi - lo) * (where - F.floor(where))).alias(name))
    found = ranked.groupBy(*keys).agg(F.max("_size").alias("_total"), *picks)
    return found.select(*keys, *final)


def mode_of(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Most frequent non-null value per key, the smallest on a tie; counts first, so no key is gathered whole."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(name))
