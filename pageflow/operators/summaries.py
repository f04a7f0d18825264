"""Dashboard aggregates over the metric and alert tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_AGGS = {"sum": F.sum, "avg": F.avg}


def top_domains_by(metrics: DataFrame, column: str, agg: str = "sum", n: int = 20,
                   digits: int | None = None) -> DataFrame:
    """Sites ranked by sum/avg of ``column`` (ties by site name), first ``n``.

    ``sum(unique_authors)`` adds per-window distinct counts ("author-windows"),
    and ``avg(bot_percent)`` is an unweighted mean of window shares, as on the
    dashboard. ``digits`` rounds a floating result for display.
    """
    value = _AGGS[agg](column)
    if digits is not None:
        value = F.round(value, digits)
    return (metrics.groupBy("domain").agg(value.alias(column))
            .orderBy(F.desc(column), "domain").limit(n))


def bot_human_by_domain(metrics: DataFrame, n: int = 20) -> DataFrame:
    return (metrics.groupBy("domain")
            .agg(F.sum("bot_pages").alias("bot_pages"), F.sum("human_pages").alias("human_pages"))
            .orderBy(F.desc("human_pages"), "domain").limit(n))


def top_keywords(alerts: DataFrame, n: int = 20) -> DataFrame:
    return (alerts.groupBy("keyword").agg(F.sum("pages_count").alias("pages_count"))
            .orderBy(F.desc("pages_count"), "keyword").limit(n))


def reason_counts(alerts: DataFrame) -> DataFrame:
    return (alerts.groupBy("reason").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "reason"))


def overview(language: DataFrame, bursts: DataFrame, spam: DataFrame) -> DataFrame:
    """One row of headline counts over the whole tables.

    Each table contributes a one-row partial aggregate; they are unioned and
    folded by a final global aggregate, so the plan has no cross join.
    """
    zero = F.lit(None).cast("long")
    parts = [
        language.agg(F.count_distinct("domain").alias("tracked_domains"),
                     F.sum("pages_created").cast("long").alias("pages_in_windows"))
        .select("tracked_domains", "pages_in_windows",
                zero.alias("breaking_alerts"), zero.alias("spam_alerts")),
        bursts.agg(F.count(F.lit(1)).alias("breaking_alerts"))
        .select(zero.alias("tracked_domains"), zero.alias("pages_in_windows"),
                "breaking_alerts", zero.alias("spam_alerts")),
        spam.agg(F.count(F.lit(1)).alias("spam_alerts"))
        .select(zero.alias("tracked_domains"), zero.alias("pages_in_windows"),
                zero.alias("breaking_alerts"), "spam_alerts"),
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return union.agg(*[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c)
                       for c in ("tracked_domains", "pages_in_windows", "breaking_alerts",
                                 "spam_alerts")])


def overview_from_events(events: DataFrame, burst_window: str = "10 minutes",
                         burst_threshold: int = 5) -> DataFrame:
    """The same four numbers straight from events, in one scan.

    Every event contributes one marker row (keyword null) plus one row per kept
    keyword. A single aggregation per (site, keyword or marker, window) gives
    page and spam counts on the marker rows and burst candidates on the keyword
    rows; a global fold turns them into the four numbers. Pages in metric
    windows equal all events, since windows partition them.
    """
    from pageflow.functions.rules import spam_reason
    from pageflow.functions.text import keep_keyword, title_words

    spam = spam_reason("page_title", "title_length").isNotNull() & (F.col("is_bot") == F.lit(False))
    kept = F.filter(title_words("page_title"), lambda w: keep_keyword(w))
    marker = F.array(F.lit(None).cast("string"))
    rows = events.select("domain", F.window("created_at", burst_window).alias("w"),
                         F.coalesce(spam, F.lit(False)).alias("spam"),
                         F.explode(F.concat(marker, kept)).alias("keyword"))
    groups = rows.groupBy("domain", "keyword", "w").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("spam").alias("s"))
    is_marker = F.col("keyword").isNull()
    return groups.agg(
        F.count_distinct("domain").cast("long").alias("tracked_domains"),
        F.coalesce(F.sum(F.when(is_marker, F.col("n"))), F.lit(0)).cast("long").alias("pages_in_windows"),
        F.count_if(~is_marker & (F.col("n") >= burst_threshold)).cast("long").alias("breaking_alerts"),
        F.coalesce(F.sum(F.when(is_marker, F.col("s"))), F.lit(0)).cast("long").alias("spam_alerts"),
    )
