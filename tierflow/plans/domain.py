"""Domain frames (fan events, titles, box office) defined over the given tables.

Only references are chosen here; every row of the source tables takes part.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.columns import money
from tierflow.operators.picking import latest
from tierflow.session import tune

# Fixed values of the domain mapping.
DEVICES = ["iOS", "Android", "Web", "SmartTV", "PlayStation"]
RATINGS = ["G", "PG", "PG-13", "R"]
SHIFT_DAYS = 9496
TITLE_COUNT = 100
CURRENCIES = ["USD", "EUR", "GBP", "JPY", "BRL"]
USD_RATES = {"USD": "1.00", "EUR": "1.08", "GBP": "1.27", "JPY": "0.01", "BRL": "0.20"}


class Tables:
    """Lazy access to the source tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        # One reader per table: listing files and reading footers happens once per query.
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self(name)


def country_code(nation_key: str) -> Column:
    """A three-letter code made from the nation number."""
    digits = F.lpad(F.col(nation_key).cast("string"), 2, "0")
    return F.concat(F.lit("N"), F.translate(digits, "0123456789", "ABCDEFGHIJ"))


def places(t: Tables) -> DataFrame:
    """Nation with its region."""
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", F.col("r_name").alias("region"), country_code("n_nationkey").alias("country_code")
    )


def with_place(df: DataFrame, t: Tables, nation_key: str, how: str) -> DataFrame:
    """Adds nation and region one table at a time.

    Joining plain tables keeps their size known, so Spark broadcasts the small ones without first
    shuffling the large side; a joined dimension would look large to it.
    """
    joined = df.join(t.nation, F.col(nation_key) == F.col("n_nationkey"), how)
    joined = joined.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), how)
    return joined.withColumns({"region": F.col("r_name"), "country_code": country_code("n_nationkey")})


def since_date(df: DataFrame, at: str, since: date | None, shift_days: int = 0) -> DataFrame:
    """Rows from a date on, as a literal bound on the raw time column, which the file scan receives."""
    if since is None:
        return df
    return df.where(F.col(at) >= F.lit(since + timedelta(days=shift_days)).cast("timestamp_ntz"))


def spread(df: DataFrame, scan: DataFrame) -> DataFrame:
    """``df`` over all cores where the scan it comes from has fewer splits than there are cores, for work that is heavy by the row.

    A scan of many splits, as any large table is, stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if scan.rdd.getNumPartitions() < cores else df


FAN_COLUMNS = [
    "interaction_id", "account_type", "fan_id", "session_id", "email", "first_name", "last_name", "region", "country_code",
    "event_type", "event_ts", "title_id", "device_type", "value",
]


def fan_events(t: Tables, since: date | None = None) -> DataFrame:
    """Fan events with the names and places of their customers."""
    joined = fan_activity(t, since).join(t.customer, F.col("user_id") == F.col("c_custkey"), "left")
    named = {f: F.when(F.col("fan_id").isNotNull(), F.col(c)) for f, c in (("first_name", "c_mktsegment"), ("last_name", "c_name"))}
    return with_place(joined, t, "c_nationkey", "left").withColumns(named).select(*FAN_COLUMNS)


def fan_activity(t: Tables, since: date | None = None) -> DataFrame:
    """Fan events from their own table alone, for questions that ask for no name or place."""
    verified = F.col("user_id") % 3 == 0
    return since_date(t.events, "ts", since, SHIFT_DAYS).select(
        "user_id",
        F.col("event_id").alias("interaction_id"),
        F.when(verified, F.lit("VERIFIED")).otherwise(F.lit("GUEST")).alias("account_type"),
        F.when(verified, F.col("user_id")).alias("fan_id"),
        F.concat(F.lit("S-"), F.col("user_id").cast("string")).alias("session_id"),
        F.when(verified, F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com"))).alias("email"),
        F.when(F.col("event_type") == "view", F.lit("STREAM")).otherwise(F.upper("event_type")).alias("event_type"),
        (F.col("ts") - F.expr(f"INTERVAL {SHIFT_DAYS} DAYS")).alias("event_ts"),
        F.get_json_object("props", "$.k").cast("bigint").alias("title_id"),
        F.element_at(F.array(*[F.lit(d) for d in DEVICES]), (F.col("event_id") % 5 + 1).cast("int")).alias("device_type"),
        F.col("value").cast("decimal(18,2)").alias("value"),
    )


def titles_raw(t: Tables) -> DataFrame:
    """Title metadata as it arrives: several versions of each title, the later part number is newer."""
    size = F.col("p_size")
    return t.part.select(
        F.col("p_partkey").alias("version"),
        (F.col("p_partkey") % TITLE_COUNT).alias("title_id"),
        F.concat("p_name", F.lit(" #"), (F.col("p_partkey") % TITLE_COUNT).cast("string")).alias("title_name"),
        F.col("p_brand").alias("franchise"),
        F.col("p_type").alias("genre"),
        F.element_at(F.array(*[F.lit(r) for r in RATINGS]), (size % 4 + 1).cast("int")).alias("rating"),
        F.when(size % 2 == 0, F.lit("RELEASED")).otherwise(F.lit("POST_PRODUCTION")).alias("production_status"),
        F.concat(F.lit("Director "), (size % 10).cast("string")).alias("director"),
        (F.lit(1995) + size % 6).alias("release_year"),
        F.make_date(F.lit(1995) + size % 6, (F.col("p_partkey") % 12 + 1).cast("int"), F.lit(1)).alias("release_date"),
        size.alias("runtime_minutes"),
        F.when(size % 7 != 0, size.cast("double") / 5).alias("imdb_score"),
        money("p_retailprice").alias("budget_usd"),
    )


def titles(t: Tables) -> DataFrame:
    """Title dimension source: the newest version of each title (at most ``TITLE_COUNT`` rows)."""
    return latest(titles_raw(t), ["title_id"], [F.desc("version")]).drop("version")


def small_titles(t: Tables) -> DataFrame:
    """The titles as the broadcast side of a join: numbers modulo ``TITLE_COUNT``, one row each, whatever the data."""
    return F.broadcast(titles(t))


def box_office_core(t: Tables, since: date | None = None) -> DataFrame:
    """Box-office records before deduplication, without the theater's attributes."""
    lines = since_date(t.lineitem, "l_shipdate", since)
    net = F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    return lines.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("record_id"),
        (F.col("l_partkey") % TITLE_COUNT).alias("title_id"),
        F.col("l_suppkey").alias("theater_id"),
        F.col("l_shipdate").cast("date").alias("report_date"),
        F.col("l_quantity").cast("int").alias("tickets_sold"),
        F.col("l_linenumber").alias("screen_count"),
        money("l_extendedprice").alias("gross_local"),
        # At most 18 digits: such decimals are fixed-width longs in Spark's rows and cheap to sort.
        (F.col("l_extendedprice").cast("decimal(12,2)") * net).cast("decimal(18,4)").alias("gross_usd"),
        F.col("o_orderdate").alias("ingestion_ts"),
    )


def with_theater(records: DataFrame, t: Tables) -> DataFrame:
    joined = records.join(t.supplier, F.col("theater_id") == F.col("s_suppkey"))
    local = F.element_at(F.array(*[F.lit(c) for c in CURRENCIES]), (F.col("n_nationkey") % 5 + 1).cast("int"))
    return with_place(joined, t, "s_nationkey", "inner").select(
        *records.columns, F.col("s_name").alias("theater_name"), "region", "country_code", local.alias("local_currency")
    )


def box_office(t: Tables, since: date | None = None) -> DataFrame:
    """Box-office records before deduplication."""
    return with_theater(box_office_core(t, since), t)


NEWEST_RECORD = ("ingestion_ts", "record_id", "gross_usd", "tickets_sold")


def box_office_dedup(t: Tables, since: date | None = None, title: Column | None = None) -> DataFrame:
    """Latest record per title, date and theater, from a date on or of one title if asked: both are key columns.

    The theater is part of the key, so its attributes are joined afterwards and the shuffle carries numbers only.
    """
    core = box_office_core(t, since)
    core = core if title is None else core.where(F.col("title_id") == title)
    newest = latest(core, ["title_id", "report_date", "theater_id"], [F.desc(c) for c in NEWEST_RECORD])
    return with_theater(newest, t)
