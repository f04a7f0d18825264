"""Rule-based spam alerts on new pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.functions.rules import severity, spam_reason
from pageflow.functions.timefn import alert_timestamp

SPAM_COLUMNS = ["domain", "alert_time", "severity", "user_id", "user_name", "reason",
                "page_title", "page_id", "created_at"]


def spam_alerts(events: DataFrame, alert_time: Column | str | None = None) -> DataFrame:
    """Pages whose title trips a rule, by non-bots only (a null is_bot is not an alert).

    Row-wise (no shuffle); the same function serves the stream.
    """
    flagged = events.withColumn("reason", spam_reason("page_title", "title_length"))
    flagged = flagged.filter(F.col("reason").isNotNull() & (F.col("is_bot") == F.lit(False)))
    return flagged.select(
        "domain", alert_timestamp(alert_time).alias("alert_time"), severity("reason").alias("severity"),
        "user_id", "user_name", "reason", "page_title", "page_id", "created_at")
