"""Join patterns beyond a plain equi-join.

No broadcast hints on tables: Spark broadcasts a side when its size allows and AQE splits skewed join keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.columns import haversine_m
from tierflow.operators.ordered import last_known
from tierflow.session import remove, work_path

METRES_PER_DEGREE = 111_195.0
#: Pairs of a cell, near or not, that ``within_distance`` leaves to one task.
PAIRS_A_TASK = 10_000_000


def of_known_size(df: DataFrame) -> DataFrame:
    """A derived frame written once to the shared folder and read back.

    Spark knows the size of files, not that of an aggregate: it broadcasts a small one without first shuffling the large
    side of the join, and shuffles for one that turns out large.
    """
    path = work_path(df.sparkSession, "derived")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def while_known(*frames: DataFrame) -> Iterator[list[DataFrame]]:
    """``of_known_size`` for the length of a block: the frames are written one after another, and go with its end."""
    spark, path = frames[0].sparkSession, work_path(frames[0].sparkSession, "derived")
    try:
        for n, df in enumerate(frames):
            df.write.option("compression", "zstd").parquet(f"{path}/{n}")
        yield [spark.read.schema(df.schema).parquet(f"{path}/{n}") for n, df in enumerate(frames)]
    finally:
        remove(spark, path)


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose key is absent from the dimension; a null key is an orphan too."""
    return fact.join(dim, F.col(fact_key) == F.col(dim_key), "left_anti")


def match_indicator(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join with ``_merge`` telling left_only, right_only or both."""
    joined = left.withColumn("_l", F.lit(True)).join(right.withColumn("_r", F.lit(True)), list(keys), "full_outer")
    merge = (
        F.when(F.col("_l").isNull(), F.lit("right_only"))
        .when(F.col("_r").isNull(), F.lit("left_only"))
        .otherwise(F.lit("both"))
    )
    return joined.withColumn("_merge", merge).drop("_l", "_r")


def cardinality_breaches(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once on a side declared as "1"."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def join_validated(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, validate: str) -> DataFrame:
    """Join that first checks the declared cardinality: 1:1, 1:m, m:1 or m:m."""
    one_left, one_right = (side == "1" for side in validate.split(":"))
    for name, side, is_one in (("left", left, one_left), ("right", right, one_right)):
        if is_one and not cardinality_breaches(side, keys).isEmpty():
            raise ValueError(f"{name} keys {list(keys)} are not unique, declared {validate}")
    return left.join(right, list(keys), how)


def missing_combinations(
    entities: DataFrame, required: Sequence[str], name: str, present: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Entities times a short required list, minus what is present; the list is exploded per row."""
    wanted = entities.withColumn(name, F.explode(F.array(*[F.lit(v) for v in required])))
    return wanted.join(present, [*keys, name], "left_anti")


def asof_join(
    spine: DataFrame, features: DataFrame, keys: Sequence[str], spine_at: str, feature_at: str, spine_id: str
) -> DataFrame:
    """Each spine row with the newest feature row at or before its time; no later value is ever seen."""
    return asof_join_all(spine, [(features, feature_at)], keys, spine_at, spine_id)


def asof_join_all(
    spine: DataFrame, features: Sequence[tuple[DataFrame, str]], keys: Sequence[str], spine_at: str, spine_id: str
) -> DataFrame:
    """Each spine row with the newest row of every feature table at or before its time.

    Spine and feature tables are stacked and the last known row of each table is carried forward: one ordered pass
    whatever the number of tables and of rows in them, and hot keys are split. Of rows of one time the largest counts.
    """
    keys = list(keys)
    names = [f"_feature_{n}" for n in range(len(features))]
    kept = [c for c in spine.columns if c not in keys]
    stacked = spine.select(
        *keys, F.col(spine_at).alias("_at"), F.lit(1).alias("_side"), F.col(spine_id).alias("_id"), F.struct(*kept).alias("_row")
    )
    for name, (frame, at) in zip(names, features):
        packed = F.struct(*[c for c in frame.columns if c not in keys])
        rows = frame.select(*keys, F.col(at).alias("_at"), F.lit(0).alias("_side"), packed.alias(f"{name}_tie"), packed.alias(name))
        stacked = stacked.unionByName(rows, allowMissingColumns=True)
    order = ["_at", "_side", "_id", *[f"{name}_tie" for name in names]]
    known = last_known(stacked, keys, order, names)
    return known.where(F.col("_side") == 1).select(*keys, "_row.*", *[f"{name}.*" for name in names])


def near_in_time(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, seconds: int
) -> DataFrame:
    """Pairs with equal keys whose times differ by less than ``seconds``.

    The join also uses a time bucket; the right side is repeated in the two neighbour buckets.
    """

    def bucket(c: str) -> Column:
        return F.floor(F.unix_micros(F.col(c).cast("timestamp")) / F.lit(seconds * 1_000_000))

    r = right.withColumn("_bucket", bucket(right_at))
    r = r.withColumn("_bucket", F.explode(F.array(F.col("_bucket") - 1, F.col("_bucket"), F.col("_bucket") + 1)))
    pairs = left.withColumn("_bucket", bucket(left_at)).join(r, [*keys, "_bucket"]).drop("_bucket")
    gap = F.unix_micros(F.col(left_at).cast("timestamp")) - F.unix_micros(F.col(right_at).cast("timestamp"))
    return pairs.where(F.abs(gap) < seconds * 1_000_000)


def within_distance(sites: DataFrame, points: DataFrame, metres: float) -> DataFrame:
    """Pairs of ``site_lat/site_lon`` and ``point_lat/point_lon`` at most ``metres`` apart, in degrees.

    The globe is cut into bands of latitude as high as the distance, and each band into as many cells as its shorter edge
    has room for, so that cells are no narrower than the distance anywhere and the circle of longitudes is closed. A
    point lies in one cell; a site is repeated in the cells its reach touches, which are few near a pole too.

    Points and sites take few bytes for the pairs they make, so that tasks are dealt by pairs: those of each cell are counted
    first, and the points of a cell with many are dealt over parts, which each hold all its sites.
    """
    step = metres / METRES_PER_DEGREE * 1.0001
    bands = math.ceil(90 / step)

    def band(lat: Column) -> Column:
        return F.least(F.greatest(F.floor(lat / F.lit(step)), F.lit(-bands)), F.lit(bands - 1))

    def cells(y: Column) -> Column:
        edge = F.least(F.greatest(F.abs(y), F.abs(y + 1)) * F.lit(step), F.lit(90.0))
        return F.greatest(F.lit(1), F.floor(F.lit(360 / step) * F.cos(F.radians(edge))))

    def turned(lon: Column) -> Column:
        return lon - F.floor(lon / 360) * 360

    lat, lon, y = F.col("site_lat"), turned(F.col("site_lon")), F.col("_y")
    # Beyond this latitude the reach holds a pole and with it every longitude.
    ratio_ = F.lit(math.sin(math.radians(min(step, 90)))) / F.cos(F.radians(lat))
    open_reach = F.degrees(F.asin(F.least(F.lit(1.0), F.abs(ratio_)))) * 1.0001
    reach = F.when(F.abs(lat) + step >= 90, F.lit(180.0)).otherwise(open_reach)
    spread = sites.withColumn("_reach", reach).withColumn("_y", F.explode(F.sequence(band(lat - step), band(lat + step))))
    width = F.lit(360.0) / cells(y)
    low, high = F.floor((lon - F.col("_reach")) / width), F.floor((lon + F.col("_reach")) / width)
    all_around = F.col("_reach") * 2 + width >= 360
    first, last = F.when(all_around, F.lit(0)).otherwise(low), F.when(all_around, cells(y) - 1).otherwise(high)
    touched = F.array_distinct(F.transform(F.sequence(first, last), lambda x: F.pmod(x, cells(y))))
    spread = spread.withColumn("_x", F.explode(touched)).drop("_reach")
    placed = points.withColumn("_y", band(F.col("point_lat")))
    placed = placed.withColumn("_x", F.least(F.floor(turned(F.col("point_lon")) / (F.lit(360.0) / cells(y))), cells(y) - 1))
    distance = haversine_m("site_lat", "site_lon", "point_lat", "point_lon")
    cell = ["_y", "_x"]
    met = placed.groupBy(*cell).agg(F.count("*").alias("_n")).join(spread.groupBy(*cell).agg(F.count("*").alias("_m")), cell)
    share = F.col("_n").cast("double") * F.col("_m") / PAIRS_A_TASK
    met = of_known_size(met.select(*cell, F.ceil(share).cast("int").alias("_parts"), share.alias("_share")))
    tasks = max(1, math.ceil(met.agg(F.sum("_share")).first()[0] or 0))
    dealt = F.pmod(F.xxhash64(*points.columns), F.col("_parts")).cast("int")
    placed = placed.join(met, cell).withColumn("_part", dealt).drop("_parts", "_share")
    parts = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    spread = spread.join(met, cell).withColumn("_part", parts).drop("_parts", "_share")
    placed, spread = (d.repartition(tasks, *cell, "_part") for d in (placed, spread))
    # Both sides lie by cell and part already; the hint keeps sites, many once repeated, from a broadcast by the size of their table.
    pairs = placed.join(spread.hint("merge"), [*cell, "_part"]).where(F.abs(F.col("point_lat") - lat) <= step)
    return pairs.withColumn("distance_m", distance).where(F.col("distance_m") <= metres).drop(*cell, "_part")


def calendar(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Calendar dimension between two dates of a one-row frame."""
    day = F.col("day")
    return bounds.select(F.explode(F.sequence(first, last)).alias("day")).select(
        "day",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "yyyy-MM").alias("month_label"),
        F.dayofweek(day).alias("day_of_week"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )
