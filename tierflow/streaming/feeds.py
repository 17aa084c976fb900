"""Append-only change capture, continuous loading and routing as Structured Streaming jobs.

Offsets live in the checkpoint. Batch writers overwrite the folder of their own batch id, so a batch that
is run again after a failure leaves the same files.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierflow.operators.deltas import fold, group_changes, replaced, signed
from tierflow.operators.merging import add_increment
from tierflow.operators.picking import top_n
from tierflow.operators.sessions import sessionize
from tierflow.sources.landing import file_sizes
from tierflow.sources.versions import VersionedTable


def file_stream(
    spark: SparkSession, folder: str, schema, fmt: str = "parquet", pattern: str | None = None, files_per_batch: int = 1000
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", str(files_per_batch))
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def ingest(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Loads everything unread into parquet files, then stops."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).outputMode("append").start(target)


def write_batch(batch: DataFrame, batch_id: int, target: str) -> None:
    batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")


def append_once(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Exactly-once append: the batch id is the token that names the output folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, target)

    return _each_batch(stream, checkpoint, write)


def skip_existing(stream: DataFrame, checkpoint: str) -> StreamingQuery:
    """Moves the offset past everything present, so that the next run sees only what arrives later."""
    return _each_batch(stream, checkpoint, lambda batch, batch_id: None)


def fan_out(
    stream: DataFrame, split: Callable[[DataFrame], Mapping[str, DataFrame]], target: str, checkpoint: str
) -> StreamingQuery:
    """One read, several typed targets below ``target``; the batch is read once and kept for all of them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, part in split(batch).items():
                write_batch(part, batch_id, f"{target}/{name}")
        finally:
            batch.unpersist()

    return _each_batch(stream, checkpoint, write)


def _each_batch(stream: DataFrame, checkpoint: str, write) -> StreamingQuery:
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def maintain(
    stream: DataFrame, partial: Callable[[DataFrame], DataFrame], target: str, checkpoint: str
) -> StreamingQuery:
    """Stores what ``partial`` makes of each batch; readers merge the stored parts.

    Nothing is late: there is no watermark, so rows may arrive in any order and any number of batches, and windows that
    are still open are part of every reading. A batch that runs again overwrites its own part.
    """
    return _each_batch(stream, checkpoint, lambda batch, batch_id: write_batch(partial(batch), batch_id, target))


def window_partials(batch: DataFrame, at: str, keys: list[str], value: str, width: str, slide: str | None = None) -> DataFrame:
    """Counts and sums of the tumbling or sliding windows that a batch has rows in."""
    window = F.window(F.col(at).cast("timestamp"), width, slide or width).alias("w")
    grouped = batch.groupBy(window, *keys).agg(F.count("*").alias("events"), F.sum(F.col(value).cast("decimal(18,2)")).alias("total"))
    return grouped.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), *keys, "events", "total")


def merged_windows(partials: DataFrame, keys: list[str]) -> DataFrame:
    return add_increment(partials, partials.limit(0), ["window_start", *keys], {"events": "sum", "total": "sum"})


def session_partials(batch: DataFrame, key: str, at: str, tie: str, gap_seconds: int) -> DataFrame:
    """First time, last time and size of the sessions within one batch."""
    numbered = sessionize(batch.select(key, at, tie), key, at, tie, gap_seconds)
    parts = numbered.groupBy(key, "session_number").agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("events"))
    return parts.drop("session_number")


def merged_sessions(partials: DataFrame, key: str, gap_seconds: int) -> DataFrame:
    """Sessions of all batches by key and session_start, with their number of events (see ``joined_parts``)."""
    return joined_parts(partials, key, gap_seconds).select(key, F.col("first").alias("session_start"), "events")


def joined_parts(partials: DataFrame, key: str, gap_seconds: int) -> DataFrame:
    """First and last time and events of sessions: parts less than the gap apart belong together, wherever their rows came from.

    A part starts a session when the gap lies between it and the end of all parts before it. A key has at most as many
    parts as its time span has gaps, times the batches; the window runs over these, not over events.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    order = W.partitionBy(key).orderBy("first", "last", "events")
    before = F.max("last").over(order.rowsBetween(W.unboundedPreceding, -1))
    reached = partials.withColumn("_reached", before)
    starts = F.col("_reached").isNull() | (micros("first") - micros("_reached") >= gap_seconds * 1_000_000)
    numbered = reached.withColumn("_n", F.sum(starts.cast("long")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    merged = numbered.groupBy(key, "_n").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("events").alias("events"))
    return merged.drop("_n")


def first_partials(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key within a batch."""
    return top_n(batch, keys, [F.asc(c) for c in order], 1)


def merged_firsts(partials: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Stream deduplication: the first row of each key over all batches."""
    return first_partials(partials.drop("batch_id"), keys, order)


def keep_up(stream: DataFrame, table: VersionedTable, change: Callable[[VersionedTable, DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Puts each batch into a table with a version log through ``change``; readers find every window, session or key once.

    Where ``maintain`` stores a part a batch, here the batch is merged into what is stored: only files of touched keys are read and
    rewritten, and old windows stay as they are. A batch that runs again after its commit is not applied twice. One stream
    writes one table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        named = VersionedTable(table.spark, table.root, table.keys, f"batch {batch_id}")
        if not named.before()[1]:
            change(named, batch)

    return _each_batch(stream, checkpoint, write)


def fold_windows(at: str, keys: list[str], value: str, width: str, slide: str | None = None):
    """A change for ``keep_up``: counts and sums of windows, for a table keyed by window_start and ``keys``."""

    def change(table: VersionedTable, batch: DataFrame) -> None:
        window = F.window(F.col(at).cast("timestamp"), width, slide or width).alias("w")
        rows = batch.select(window, *keys, F.col(value).alias("value")).withColumn("window_start", F.col("w.start").cast("timestamp_ntz"))
        fold(table, group_changes(signed(rows), ["window_start", *keys], {"total": (F.col("value"), "decimal(28,2)")}))

    return change


def fold_firsts(order: list[str]):
    """A change for ``keep_up``: the first row of each key of the table by ``order``."""

    def change(table: VersionedTable, batch: DataFrame) -> None:
        new = first_partials(batch, table.keys, order)
        if not table.version():
            table.append(new)
            return
        stored = table.rows_at(new)
        table.upsert(first_partials(stored.unionByName(new.select(*stored.columns)), table.keys, order))

    return change


def fold_sessions(key: str, at: str, tie: str, gap_seconds: int):
    """A change for ``keep_up``: sessions with first, last and events, for a table keyed by ``key`` and first."""

    def change(table: VersionedTable, batch: DataFrame) -> None:
        new = session_partials(batch, key, at, tie, gap_seconds)
        if not table.version():
            table.append(new)
            return
        # Sessions of the keys in the batch; a new part may join two of them.
        who = new.select(F.col(key).alias("_who")).distinct()
        stored = table.read().join(who, F.col(key).eqNullSafe(F.col("_who")), "left_semi")
        merged = joined_parts(stored.unionByName(new.select(*stored.columns)), key, gap_seconds)
        replaced(table, stored.select(*table.keys).union(merged.select(*table.keys)).distinct(), merged.select(*stored.columns))

    return change


def unread_files(current: DataFrame, processed: DataFrame) -> DataFrame:
    """Files that no load has recorded yet; empty means nothing to do."""
    return file_sizes(current).select("file").join(processed, "file", "left_anti")
