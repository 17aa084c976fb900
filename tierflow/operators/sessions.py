"""Gap sessions over ordered events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.operators.ordered import is_hot, over_neighbours, running_totals


def sessionize(df: DataFrame, key: str, at: str, tie: str, gap_seconds: int) -> DataFrame:
    """Numbers the sessions of each key from 1; a session ends once nothing follows for ``gap_seconds``."""
    hot = is_hot(df, [key])
    lagged = over_neighbours(df, [key], [at, tie], 1, 0, lambda w: {"_last": F.lag(at).over(w)}, hot)
    quiet = F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(F.col("_last").cast("timestamp"))
    starts = F.when(F.col("_last").isNull() | (quiet >= gap_seconds * 1_000_000), 1).otherwise(0).cast("bigint")
    return running_totals(lagged, [key], [at, tie], {"session_number": starts}, hot).drop("_last")
