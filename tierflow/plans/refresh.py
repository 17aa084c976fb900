"""Rebuilds the derived tables in dependency order; each step reads the tables written before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.plans import domain, layers
from tierflow.plans.domain import Tables


def refresh(t: Tables, root: str) -> dict[str, DataFrame]:
    """Writes staged, dimensional and aggregate tables below ``root`` and returns readers for them."""
    done: dict[str, DataFrame] = {}

    def store(name: str, frame: DataFrame) -> None:
        frame.write.mode("overwrite").parquet(f"{root}/{name}")
        done[name] = t.spark.read.parquet(f"{root}/{name}")

    store("fans_unified", layers.fans_unified(t))
    store("titles_parsed", domain.titles(t))
    store("box_office_dedup", domain.box_office_dedup(t))
    daily = layers.daily_performance(
        layers.theatrical_daily(done["box_office_dedup"]), layers.fan_daily(done["fans_unified"])
    )
    store("fact_daily", daily)
    store("dim_fans", layers.dim_fans_of(done["fans_unified"]))
    store("dim_titles", done["titles_parsed"])
    store("agg_franchise", layers.franchise_performance(done["fact_daily"], done["dim_titles"]))
    fans = done["dim_fans"].withColumn("as_of", layers.last_event_date(t))
    store("agg_fan_value", layers.fan_value(fans, F.col("as_of")))
    return done
