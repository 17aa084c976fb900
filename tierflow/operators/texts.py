"""Text chunks, transcript segments, label routing, vector similarity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.columns import cosine


def chunk(df: DataFrame, text: str, size: int) -> DataFrame:
    """Whole texts cut into pieces of ``size`` characters; empty texts give no piece."""
    last = F.ceil(F.length(text) / F.lit(size)).cast("int") - 1
    numbers = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0))))
    pieces = df.withColumn("chunk_number", F.explode(numbers))
    return pieces.withColumn("chunk_text", F.substring(F.col(text), F.col("chunk_number") * size + 1, F.lit(size))).drop(text)


def segments(df: DataFrame, transcript: str) -> DataFrame:
    """Speaker segments of a JSON transcript, one row each, with rounded times."""
    parsed = df.withColumn("_t", F.try_variant_get(F.parse_json(transcript), "$.segments", "variant"))
    rows = parsed.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_t").outer()))
    start = F.try_variant_get("value", "$.start", "double")
    end = F.try_variant_get("value", "$.end", "double")
    return rows.select(
        *[c for c in df.columns if c != transcript],
        "pos",
        F.try_variant_get("value", "$.speaker", "string").alias("speaker"),
        F.round(start, 2).alias("start_sec"),
        F.round(end, 2).alias("end_sec"),
        F.round(end - start, 2).alias("duration_sec"),
        F.try_variant_get("value", "$.text", "string").alias("segment_text"),
    )


def most_similar(df: DataFrame, vector: str, wanted: Column | Sequence[float], k: int, tie: str) -> DataFrame:
    """The ``k`` rows closest to one query vector; its numbers are folded into the plan where they are given as such."""
    if not isinstance(wanted, Column):
        asked = F.array(*[F.lit(float(x)) for x in wanted])
        scored = df.withColumn("similarity", cosine(vector, asked))
    else:
        scored = df.withColumn("_q", wanted).withColumn("similarity", cosine(vector, "_q")).drop("_q")
    return scored.orderBy(F.desc("similarity"), tie).limit(k)
