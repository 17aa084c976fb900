"""Landing files as raw variant rows, typed loads, bad-record policies and file upkeep."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"
TARGET_FILE_BYTES = 192 * 1024 * 1024  # between 100 and 250 MB


def land_raw(spark: SparkSession, path: str, source_system: str) -> DataFrame:
    """JSON lines as schema-on-read rows with lineage.

    The id is a hash of file and content, so a reload gives the same id; equal lines of a file share it. Where such lines
    are separate facts, the feed must carry a key of its own.
    """
    rows = spark.read.format("json").option("singleVariantColumn", "raw_data").load(path)
    file = F.col("_metadata.file_name")
    return rows.select(
        F.md5(F.concat_ws("|", file, F.to_json("raw_data"))).alias("raw_id"),
        "raw_data",
        F.lit(source_system).alias("source_system"),
        file.alias("source_file"),
        F.current_timestamp().cast("timestamp_ntz").alias("ingestion_ts"),
    )


def explode_array_document(df: DataFrame, document: str, fields: Mapping[str, str]) -> DataFrame:
    """One row per element of a JSON array held in ``document``, with typed fields."""
    parsed = df.withColumn("_doc", F.parse_json(document))
    exploded = parsed.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_doc").outer()))
    typed = [F.try_variant_get("value", f"$.{name}", kind).alias(name) for name, kind in fields.items()]
    return exploded.select(*[c for c in df.columns if c != document], "pos", *typed)


def read_csv(
    spark: SparkSession, path: str, schema: str, pattern: str = "*.csv", null_token: str = "", **options: str
) -> DataFrame:
    """Typed CSV load by file pattern; no inference pass."""
    reader = spark.read.schema(schema).option("header", "true").option("pathGlobFilter", pattern)
    reader = reader.option("nullValue", null_token).option("mode", "FAILFAST")
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: str, mode: str = "PERMISSIVE") -> DataFrame:
    """JSON lines parsed to ``schema`` with the bad text kept in ``_corrupt_record`` and the file in ``source_file``."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    options = {"mode": mode, "columnNameOfCorruptRecord": CORRUPT}
    wanted = schema if mode == "FAILFAST" else f"{schema}, {CORRUPT} string"
    return lines.select(F.from_json("value", wanted, options).alias("r"), "source_file").select("r.*", "source_file")


def load_with_policy(spark: SparkSession, path: str, schema: str, on_error: str) -> DataFrame:
    """CONTINUE drops bad rows, SKIP_FILE drops every file that holds one, ABORT fails the load."""
    if on_error == "ABORT":
        return read_json_lines(spark, path, schema, "FAILFAST")
    rows = read_json_lines(spark, path, schema)
    good = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    if on_error == "CONTINUE":
        return good
    if on_error == "SKIP_FILE":
        bad_files = rows.where(F.col(CORRUPT).isNotNull()).select("source_file").distinct()
        return good.join(bad_files, "source_file", "left_anti")
    raise ValueError(f"unknown policy {on_error}")


def bad_rows(spark: SparkSession, path: str, schema: str, first: int | None = None) -> DataFrame:
    """Validation without loading: the rows that would fail, or the first ``first`` of them."""
    bad = read_json_lines(spark, path, schema).where(F.col(CORRUPT).isNotNull())
    bad = bad.select(F.col(CORRUPT).alias("bad_row"), "source_file")
    return bad.limit(first) if first else bad


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def truncate_and_load(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def materialize(df: DataFrame, name: str, kind: str, path: str | None = None) -> DataFrame:
    """``table`` writes to ``path``, ``view`` registers a temporary view, ``ephemeral`` only returns the plan."""
    if kind == "table":
        truncate_and_load(df, path)
        return df.sparkSession.read.parquet(path)
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if kind == "ephemeral":
        return df
    raise ValueError(f"unknown materialization {kind}")


def file_sizes(df: DataFrame) -> DataFrame:
    """Distinct files behind a file-based frame with their sizes, from the file listing: no row is read."""
    spark = df.sparkSession
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(df.inputFiles())
    return files.select(F.col("path").alias("file"), F.col("length").alias("bytes"))


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = TARGET_FILE_BYTES) -> int:
    """Rewrites small parquet files as files of about ``file_bytes``; returns the number of output files."""
    rows = spark.read.parquet(source)
    total = file_sizes(rows).agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    files = max(1, -(-total // file_bytes))
    rows.repartition(files).write.mode("overwrite").parquet(target)
    return files


def load_audit(loads: DataFrame, at: str, unit: str = "day") -> DataFrame:
    """Per period: loads, files, rows, gigabytes, mean file size, and how many loads succeeded."""
    failed = F.col("status") != F.lit("LOADED")
    return loads.groupBy(F.date_trunc(unit, F.col(at)).cast("date").alias("load_date")).agg(
        F.count("*").alias("num_loads"),
        F.count_if(~failed).alias("successful"),
        F.count_if(failed).alias("failed"),
        F.sum("files").alias("total_files"),
        F.sum("row_count").alias("total_rows"),
        (F.sum("bytes") / F.pow(F.lit(1024.0), F.lit(3.0))).alias("total_gb"),
        F.avg(F.col("bytes") / F.nullif(F.col("files"), F.lit(0))).alias("avg_file_size_bytes"),
    )


def evolve(old: DataFrame, new: DataFrame, backfill: Mapping[str, Column]) -> DataFrame:
    """Old and new batches in one schema: columns missing on either side are null, then backfilled, none is dropped."""
    merged = old.unionByName(new, allowMissingColumns=True)
    return merged.withColumns({name: F.coalesce(F.col(name), value) for name, value in backfill.items()})


def load_batch(feeds: Mapping[str, tuple[DataFrame, str]], refresh: Callable[[], DataFrame]) -> DataFrame:
    """Appends each feed to its table as one set-based write, then rebuilds what is derived from them."""
    for frame, path in feeds.values():
        append(frame, path)
    return refresh()
