"""Per-site activity in event-time windows (language activity, bot vs human).

Both tables group by the same keys, so they are projections of one aggregate
(:func:`domain_minute`); a streaming job keeps a single state store for both.
Physical plan: partial hash aggregate -> exchange on (domain, window) -> final
aggregate, so a hot domain is combined map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _grouped(events: DataFrame, window: str, watermark: str | None):
    if watermark:
        events = events.withWatermark("created_at", watermark)
    return events.groupBy("domain", F.window("created_at", window).alias("window"))


def domain_minute(events: DataFrame, window: str = "1 minute", watermark: str | None = None,
                  exact: bool = False) -> DataFrame:
    """One row per (domain, window) with the columns of both metric tables."""
    distinct = F.count_distinct("user_id") if exact else F.approx_count_distinct("user_id")
    agg = _grouped(events, window, watermark).agg(
        F.count(F.lit(1)).alias("pages_created"),
        distinct.alias("unique_authors"),
        F.avg("title_length").alias("avg_title_length"),
        F.count_if(F.col("is_bot")).alias("bot_pages"),
        F.count_if(~F.col("is_bot")).alias("human_pages"),
    )
    total = F.col("pages_created")
    return agg.select(
        "domain",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        total.cast("int").alias("pages_created"),
        F.col("unique_authors").cast("int").alias("unique_authors"),
        F.col("avg_title_length").cast("double").alias("avg_title_length"),
        F.col("bot_pages").cast("int").alias("bot_pages"),
        F.col("human_pages").cast("int").alias("human_pages"),
        # rows with a null is_bot count in the total only
        F.when(total > 0, F.col("bot_pages") / total * 100).otherwise(F.lit(0.0))
        .cast("double").alias("bot_percent"),
    )


LANGUAGE_COLUMNS = ["domain", "window_start", "window_end", "pages_created", "unique_authors",
                    "avg_title_length", "trend"]
BOT_COLUMNS = ["domain", "window_start", "window_end", "bot_pages", "human_pages", "bot_percent",
               "top_bots", "top_humans"]


def language_rows(dm: DataFrame) -> DataFrame:
    return dm.withColumn("trend", F.lit("stable")).select(*LANGUAGE_COLUMNS)


def bot_rows(dm: DataFrame) -> DataFrame:
    return (dm.withColumn("top_bots", F.lit("[]")).withColumn("top_humans", F.lit("[]"))
            .select(*BOT_COLUMNS))


def language_activity(events: DataFrame, window: str = "1 minute", watermark: str | None = None,
                      exact: bool = False) -> DataFrame:
    """Pages, distinct authors (HLL by default, exact on request) and mean title length."""
    return language_rows(domain_minute(events, window, watermark, exact))


def bot_activity(events: DataFrame, window: str = "1 minute", watermark: str | None = None) -> DataFrame:
    """Bot / human page counts and the bot share in percent per (domain, window)."""
    return bot_rows(domain_minute(events, window, watermark))
