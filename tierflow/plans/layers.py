"""Staged, dimensional and aggregate tables of the layered model, as functions of domain frames."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.columns import ratio, sha256, surrogate_key
from tierflow.operators.ordered import mode_of
from tierflow.plans import domain
from tierflow.plans.domain import Tables


def route(events: DataFrame, verified_labels=("VERIFIED",)) -> tuple[DataFrame, DataFrame]:
    """Splits events into verified and guest rows; null and unknown labels are guests, so nothing is lost."""
    hit = F.coalesce(F.col("account_type").isin(list(verified_labels)), F.lit(False))
    verified = events.where(hit).drop("session_id", "account_type")
    guest = events.where(~hit).drop("fan_id", "email", "first_name", "last_name", "account_type")
    return verified, guest


def empty_identity() -> list:
    """The identity columns a routed side may carry, as nulls."""
    return [F.lit(None).cast("string").alias(c) for c in ("fan_id", "email", "first_name", "last_name", "session_id")]


def unify(verified: DataFrame, guest: DataFrame) -> DataFrame:
    """Both routed sides in one frame: missing identity columns are null, the side is tagged."""
    left = verified.withColumn("account_type", F.lit("VERIFIED"))
    right = guest.drop("session_id").withColumn("account_type", F.lit("GUEST"))
    return left.unionByName(right, allowMissingColumns=True)


def fans_unified(t: Tables) -> DataFrame:
    return unify(*route(domain.fan_events(t)))


def theatrical_daily(dedup: DataFrame) -> DataFrame:
    """Daily sums per title and region. The input has one row per title, date and theater, and a theater lies
    in one region, so its distinct count is a plain count and needs no second shuffle."""
    return dedup.groupBy("title_id", "report_date", "region").agg(
        F.sum(F.col("tickets_sold").cast("bigint")).alias("total_tickets_sold"),
        F.sum("gross_usd").alias("total_gross_usd"),
        F.count("theater_id").alias("theater_count"),
        F.sum(F.col("screen_count").cast("bigint")).alias("screen_count"),
        F.avg(ratio("gross_usd", "tickets_sold")).alias("avg_ticket_price_usd"),
    )


def fan_daily(events: DataFrame) -> DataFrame:
    return events.groupBy("title_id", F.col("event_ts").cast("date").alias("report_date"), "region").agg(
        F.count_if(F.col("event_type") == "STREAM").alias("stream_count"),
        F.countDistinct("fan_id").alias("unique_fans"),
    )


DAILY_KEYS = ["title_id", "report_date", "region"]
MEASURES = [
    "total_tickets_sold", "total_gross_usd", "theater_count", "screen_count",
    "avg_ticket_price_usd", "stream_count", "unique_fans",
]


def daily_performance(theatrical: DataFrame, fans: DataFrame) -> DataFrame:
    """Both daily aggregates side by side; each is unique per key, so the outer join cannot be skewed."""
    joined = theatrical.join(fans, DAILY_KEYS, "full_outer")
    return joined.select(*DAILY_KEYS, *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in MEASURES])


def fact_daily(t: Tables, since: date | None = None, title: Column | None = None) -> DataFrame:
    """The daily fact. Date and title are keys of every step, so limiting them limits the scans, not the finished fact."""
    events = domain.fan_events(t, since)
    events = events if title is None else events.where(F.col("title_id") == title)
    daily = daily_performance(theatrical_daily(domain.box_office_dedup(t, since, title)), fan_daily(events))
    return daily.select(surrogate_key(*DAILY_KEYS).alias("performance_key"), *DAILY_KEYS, *MEASURES)


def fan_stats(events: DataFrame) -> DataFrame:
    """Per-fan statistics and latest attributes in one aggregation.

    The modes range over device, region and country lists of fixed size, so their buffers are bounded.
    """
    newest = F.struct("event_ts", "interaction_id")
    details = F.struct("account_type", "email", "first_name", "last_name")
    return (
        events.where(F.col("fan_id").isNotNull())
        .groupBy("fan_id")
        .agg(
            F.min("event_ts").alias("first_seen"),
            F.max("event_ts").alias("last_seen"),
            F.count("*").alias("interaction_count"),
            F.countDistinct("title_id").alias("titles_engaged"),
            F.mode("device_type", True).alias("preferred_device"),
            F.mode("region", True).alias("primary_region"),
            F.mode("country_code", True).alias("primary_country"),
            F.max_by(details, newest).alias("_latest"),
        )
        .select("*", "_latest.*")
        .drop("_latest")
    )


def dim_fans(t: Tables) -> DataFrame:
    return dim_fans_of(domain.fan_events(t))


def dim_fans_of(events: DataFrame) -> DataFrame:
    return fan_stats(events).select(
        F.md5(F.col("fan_id").cast("string")).alias("fan_key"),
        "fan_id",
        "account_type",
        "email",
        sha256("email").alias("email_hash"),
        "first_name",
        "last_name",
        F.col("primary_region").alias("region"),
        F.col("primary_country").alias("country_code"),
        F.col("first_seen").cast("date").alias("signup_date"),
        F.col("last_seen").cast("date").alias("last_active_date"),
        F.col("interaction_count").alias("lifetime_interactions"),
        "titles_engaged",
        "preferred_device",
    )


def dim_titles(t: Tables) -> DataFrame:
    return domain.titles(t).select(F.md5(F.col("title_id").cast("string")).alias("title_key"), "*")


def franchise_performance(fact: DataFrame, title_dim: DataFrame) -> DataFrame:
    """Adds the weighted price and keeps the plain average of daily averages beside it."""
    return (
        fact.join(title_dim.select("title_id", "franchise", "genre"), "title_id")
        .groupBy("franchise", "genre")
        .agg(
            F.countDistinct("title_id").alias("title_count"),
            F.sum("total_tickets_sold").alias("total_tickets"),
            F.sum("total_gross_usd").alias("total_gross_usd"),
            F.avg("avg_ticket_price_usd").alias("avg_ticket_price"),
            F.sum("stream_count").alias("total_streams"),
            F.sum("unique_fans").alias("total_unique_fans"),
            F.min("report_date").alias("first_report_date"),
            F.max("report_date").alias("last_report_date"),
        )
        .withColumn("weighted_ticket_price", ratio("total_gross_usd", "total_tickets"))
    )


def agg_franchise(t: Tables) -> DataFrame:
    return franchise_performance(fact_daily(t), dim_titles(t))


def fan_value(fans: DataFrame, as_of) -> DataFrame:
    last = F.col("last_active_date")
    base = fans.groupBy("region", "country_code", "account_type").agg(
        F.countDistinct("fan_id").alias("fan_count"),
        F.avg("lifetime_interactions").alias("avg_interactions"),
        F.avg("titles_engaged").alias("avg_titles_engaged"),
        F.avg(F.datediff(last, "signup_date")).alias("avg_active_days"),
        F.count_if(last >= F.date_sub(as_of, 30)).alias("active_last_30_days"),
        F.count_if(last >= F.date_sub(as_of, 7)).alias("active_last_7_days"),
        F.mode("preferred_device", True).alias("top_device"),
    )
    return base


def last_event_date(t: Tables):
    """Scalar subquery: the newest event date stands in for today."""
    events = t.events.agg(F.max("ts").alias("ts"))
    return events.select((F.col("ts") - F.expr(f"INTERVAL {domain.SHIFT_DAYS} DAYS")).cast("date").alias("d")).scalar()


def last_report_date(t: Tables) -> DataFrame:
    """One row with the newest date ``d`` over ships and events, read from two single columns."""
    ships = t.lineitem.agg(F.max("l_shipdate").cast("date").alias("d"))
    seen = t.events.agg(F.max("ts").cast("date").alias("d")).select(F.date_sub("d", domain.SHIFT_DAYS).alias("d"))
    return ships.unionByName(seen).agg(F.max("d").alias("d"))


def agg_fan_value(t: Tables) -> DataFrame:
    # The date travels as a one-row column: scalar subqueries may not stand inside an aggregate's filter.
    return fan_value(dim_fans(t).withColumn("as_of", last_event_date(t)), F.col("as_of"))


def fan_device_modes(t: Tables) -> DataFrame:
    """Mode over an open value domain (title), counted first."""
    return mode_of(domain.fan_activity(t).where(F.col("fan_id").isNotNull()), ["fan_id"], "title_id", "top_title")
