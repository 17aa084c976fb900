"""Slowly changing dimensions: overwrite, validity intervals from a change log, snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.columns import as_col, surrogate_key
from tierflow.operators.ordered import is_hot, over_neighbours
from tierflow.operators.picking import latest
from tierflow.sources.versions import VersionedTable

OPEN_END = "9999-12-31"


def overwrite_latest(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Type 1: the last state of each key."""
    return latest(log, keys, [F.desc(c) for c in order])


def versions_from_log(log: DataFrame, key: str, at: str, tie: str, tracked: Sequence[str]) -> DataFrame:
    """Type 2: equal consecutive states become one version, valid until the next one begins."""
    hot = is_hot(log, [key])
    rows = log.select(key, at, tie, F.struct(*tracked).alias("_state"))
    with_last = over_neighbours(
        rows, [key], [at, tie], 1, 0, lambda w: {"_last": F.lag("_state").over(w), "_first": F.lag(tie).over(w).isNull()}, hot
    )
    changes = with_last.where(F.col("_first") | ~F.col("_state").eqNullSafe(F.col("_last"))).drop("_last", "_first")
    ended = over_neighbours(changes, [key], [at, tie], 0, 1, lambda w: {"_next": F.lead(at).over(w)}, hot)
    end = F.lit(OPEN_END).cast("timestamp_ntz")
    return ended.select(
        key, tie, "_state.*",
        F.col(at).alias("valid_from"), F.coalesce("_next", end).alias("valid_to"), F.col("_next").isNull().alias("is_current"),
    )


def snapshot(history: DataFrame | None, current: DataFrame, key: str, check: Sequence[str], at: Column) -> DataFrame:
    """One snapshot run: changed keys get a new version, vanished keys are closed, closed rows stay.

    Keys and ``check`` columns are compared null-safe: a null key is one key like any other.
    """
    columns = list(current.columns)
    fresh = [*columns, surrogate_key(key, at).alias("scd_id"), at.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to")]
    if history is None:
        return current.select(*fresh)
    full = [*columns, "scd_id", "valid_from", "valid_to"]
    # Closed rows go through the same join without a partner, so that the history is read once.
    stored = history.select(F.col(key).alias("_k"), F.col("valid_to").isNull().alias("_open"), F.struct(*full).alias("_o"))
    incoming = current.select(*fresh).select(F.col(key).alias("_key"), F.struct(*full).alias("_c"))
    joined = stored.join(incoming, F.col("_open") & F.col("_k").eqNullSafe(F.col("_key")), "full_outer")
    same = F.lit(True)
    for c in check:
        same = same & F.col(f"_o.{c}").eqNullSafe(F.col(f"_c.{c}"))
    kept = F.col("_o").isNotNull() & F.col("_c").isNotNull() & same
    ended = F.col("_o").withField("valid_to", at)
    old_row = F.when(F.col("_o").isNotNull(), F.when(kept | ~F.col("_open"), F.col("_o")).otherwise(ended))
    new_row = F.when(F.col("_c").isNotNull() & ~kept, F.col("_c"))
    return joined.select(F.explode(F.array_compact(F.array(old_row, new_row))).alias("r")).select("r.*")


def current_rows(history: DataFrame) -> DataFrame:
    return history.where(F.col("valid_to").isNull())


def rows_at(history: DataFrame, at: Column | str) -> DataFrame:
    """Versions valid at a time: from is inclusive, to is exclusive."""
    when = as_col(at)
    return history.where((F.col("valid_from") <= when) & (F.col("valid_to").isNull() | (F.col("valid_to") > when)))


def version_chain(history: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Each version beside the one it replaced, as ``new_`` and ``old_`` columns."""
    new = history.select(key, F.col("valid_from").alias("_at"), *[F.col(c).alias(f"new_{c}") for c in columns])
    old = history.select(key, F.col("valid_to").alias("_at"), *[F.col(c).alias(f"old_{c}") for c in columns])
    return new.join(old, [key, "_at"]).drop("_at")


class SegmentedHistory:
    """A snapshot history below ``root`` in two tables: open versions by key, and closed ones in segments by the time they ended.

    A run reads the open versions only, writes the keys that changed, and appends what it closes as a segment that is never
    rewritten. A reading as of a time leaves out the segments that ended before it, by the ranges in the version log, and reads
    few columns of none. A run that failed half-way is repeated with the same ``at`` and is not applied twice.
    """

    def __init__(self, spark, root: str, key: str, check: Sequence[str]):
        self.spark, self.root, self.key, self.check = spark, root, key, list(check)

    def _tables(self, batch: str | None = None) -> tuple[VersionedTable, VersionedTable]:
        return (
            VersionedTable(self.spark, f"{self.root}/open", [self.key], batch),
            VersionedTable(self.spark, f"{self.root}/closed", ["valid_to", self.key, "valid_from"], batch),
        )

    def run(self, current: DataFrame, at: Column) -> None:
        """One snapshot of ``current``, unique by key: changed keys get a new version, vanished keys are closed."""
        batch = str(self.spark.range(1).select(at.cast("string")).first()[0])
        opened, closed = self._tables(batch)
        new = current.select("*", surrogate_key(self.key, at).alias("scd_id"), at.alias("valid_from"))
        ended = closed.before()[1] or opened.before()[1]  # the segment is written first
        if not opened.version():
            opened.append(new)
            return
        # The open versions before this run, also when it is repeated.
        base = opened.before()[0]
        held = opened.read(base)
        o, n = held.select(F.col(self.key).alias("_k"), F.struct(*held.columns).alias("_o")), new.select(F.struct(*held.columns).alias("_n"))
        joined = o.join(n, F.col("_k").eqNullSafe(F.col(f"_n.{self.key}")), "full_outer")
        same = F.col("_o").isNotNull() & F.col("_n").isNotNull()
        for c in self.check:
            same = same & F.col(f"_o.{c}").eqNullSafe(F.col(f"_n.{c}"))
        changed = joined.where(~same)
        if not ended:
            gone = changed.where(F.col("_o").isNotNull()).select("_o.*", at.alias("valid_to"))
            closed.append(gone)
        row = F.coalesce("_n", "_o")
        action = F.when(F.col("_n").isNull(), "DELETE").otherwise("UPSERT").alias("_action")
        if not opened.before()[1]:
            opened.upsert(changed.select(row.alias("_r"), action).select("_r.*", "_action"), action="_action")

    def read(self) -> DataFrame:
        """All versions, closed and open, as ``snapshot`` gives them."""
        opened, closed = self._tables()
        rows = opened.read().withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
        return rows.unionByName(closed.read()) if closed.version() else rows

    def rows_at(self, at) -> DataFrame:
        """Versions valid at a time (a datetime): from is inclusive, to is exclusive. Segments that ended by then are not read."""
        opened, closed = self._tables()
        when = F.lit(at).cast("timestamp_ntz")
        rows = opened.read().where(F.col("valid_from") <= when).withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
        if not closed.version():
            return rows
        return rows.unionByName(closed.read_after(at).where((F.col("valid_from") <= when) & (F.col("valid_to") > when)))
