"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tierflow
from tierflow.session import work_path


#: Rows of an Arrow batch. Texts are long: batches of Spark's usual size would fill a task's memory.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Settings that operators with Python tasks rely on.

    Arrow batches are kept small, and the library is put on the path of workers started from now on, for drivers that
    only extended sys.path. Executors on other machines need the library installed or sent along (``--py-files``), as any
    Spark job does.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = str(Path(tierflow.__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    inherited = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths and root not in inherited:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that later steps do not repeat its work."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a slice of ``sliced``, and copies of a row that ``repeated`` writes in one task.
SLICE_ROWS, COPIES = 1 << 18, 1 << 12


def sliced(df: DataFrame, *order: str, rows: int = SLICE_ROWS) -> DataFrame:
    """``df`` in even slices by ascending order, numbered in ``slice``: all of a slice comes before all of the next.

    Slices are stored, so that their borders, which Spark draws from a sample, stay the same for all later steps. Rows equal
    in ``order`` share a slice; make it unique where a group of equal rows may be large.
    """
    known = stored(df, "unsliced")
    count = max(1, -(-known.count() // rows))
    return stored(known.repartitionByRange(count, *order).withColumn("slice", F.spark_partition_id()), "sliced")


def repeated(df: DataFrame, copies: str, number: str, block: int = COPIES) -> DataFrame:
    """Each row of a stored frame ``copies`` (1 or more) times, numbered from 0; many copies are dealt over tasks."""
    end = F.col(copies) - 1
    few = df.where(F.col(copies) <= block).withColumn(number, F.explode(F.sequence(F.lit(0).cast("long"), end)))
    starts = F.explode(F.sequence(F.lit(0).cast("long"), end, F.lit(block).cast("long")))
    dealt = df.where(F.col(copies) > block).withColumn(number, starts).repartition(number)
    many = dealt.withColumn(number, F.explode(F.sequence(F.col(number), F.least(end, F.col(number) + block - 1))))
    return few.unionByName(many)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not use: the given ones, lengthened where taken."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def merge_labels(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Joins the classes of linked positions; ``labels[i]`` stays the smallest position of the class of ``i``."""
    while len(left):
        a, b = labels[left], labels[right]
        apart = a != b
        if not apart.any():
            break
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels = jumped
    return labels


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows (node, root), where root is the smallest node reachable.

    Large-star and small-star steps (Kiveris et al., 2014) in turn until no edge changes. Every step is a grouped
    minimum and an equi-join, so a node with many neighbours is pre-aggregated and, as a join key, split by AQE; no
    neighbour list is ever gathered. Nodes without an edge are not returned.
    """
    edges = _oriented(edges.select("a", "b")).distinct().checkpoint()
    before = None
    while True:
        edges = _star(edges, large=True)
        edges = _star(edges, large=False).checkpoint()
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before or now[0] == 0:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _oriented(edges: DataFrame) -> DataFrame:
    """Larger node first, loops removed."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links the larger (or the smaller-or-equal) neighbours of every node to the smallest one around it."""
    if large:
        around = edges.union(edges.select("b", "a"))
        nearest = around.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        linked = around.join(nearest, around["a"] == nearest["u"]).where("b > u").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        nearest = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        moved = edges.join(nearest, edges["a"] == nearest["u"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        linked = moved.union(nearest.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return _oriented(linked).distinct()
