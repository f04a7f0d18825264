"""Hourly site report, editor-behaviour report and latest window per site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageflow.functions.timefn import hour_floor, micros_between, minutes_window_start, newest_key
from pageflow.functions.truthy import nonblank
from pageflow.session import materialize


def _ts(value: Column | str | None) -> Column:
    if value is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(value, str):
        return F.lit(value).cast("timestamp_ntz")
    return value


def _report_rows(pages: DataFrame, domain: str | None, hours: int, as_of: Column | str | None) -> DataFrame:
    """Rows of the last ``hours`` hours up to ``as_of`` (both ends inclusive), one site or all; never cut."""
    if not 1 <= hours <= 24:
        raise ValueError("hours must be within 1..24")
    end = _ts(as_of)
    start = F.timestamp_add("HOUR", F.lit(-hours), end)
    rows = pages
    if domain is not None:
        rows = rows.filter(F.col("domain") == domain)
    return rows.filter((F.col("created_at") >= start) & (F.col("created_at") <= end))


def _author_hours(rows: DataFrame) -> DataFrame:
    """Pre-aggregate per (site, hour, user, author name); both report parts start from it.

    The newest row (created_at desc, page_id asc) decides an author's bot flag.
    """
    name = F.coalesce(nonblank(F.col("user_name")), F.lit("unknown"))
    return (rows.withColumn("time_start", hour_floor("created_at"))
            .withColumn("_key", newest_key("created_at", "page_id"))
            .groupBy("domain", "time_start", "user_id", name.alias("name"))
            .agg(F.count(F.lit(1)).alias("pages"),
                 F.count_if(F.col("is_bot")).alias("bots"),
                 F.max("_key").alias("newest"),
                 F.max_by("is_bot", "_key").alias("newest_is_bot")))


def hourly_top_authors(pages: DataFrame, domain: str | None = None, hours: int = 6,
                       as_of: Column | str | None = None, top_n: int = 10) -> DataFrame:
    """Flat top-``top_n`` author names per (site, hour): rank, name, pages, is_bot.

    Ties on pages go to the author seen most recently. ``row_number() <= n``
    plans as a partial WindowGroupLimit before the shuffle, so a busy hour never
    ships more than n rows per map task.
    """
    base = _author_hours(_report_rows(pages, domain, hours, as_of))
    return _rank_authors(base, top_n)


def _rank_authors(base: DataFrame, top_n: int) -> DataFrame:
    per_name = (base.groupBy("domain", "time_start", "name")
                .agg(F.sum("pages").alias("pages"), F.max("newest").alias("newest"),
                     F.max_by("newest_is_bot", "newest").alias("newest_is_bot")))
    rank = F.row_number().over(Window.partitionBy("domain", "time_start")
                               .orderBy(F.desc("pages"), F.desc("newest"), "name"))
    return (per_name.withColumn("rank", rank).filter(F.col("rank") <= top_n)
            .select("domain", "time_start",
                    F.timestamp_add("HOUR", F.lit(1), F.col("time_start")).alias("time_end"),
                    F.col("rank").cast("int").alias("rank"), "name",
                    F.col("pages").cast("long").alias("pages"),
                    F.col("newest_is_bot").alias("is_bot")))


def hourly_report(pages: DataFrame, domain: str | None = None, hours: int = 6,
                  as_of: Column | str | None = None, top_n: int = 10) -> DataFrame:
    """Per UTC hour: pages, exact distinct authors, bot share (half-even, 2 places), top authors.

    ``domain=None`` reports every site. A null is_bot counts as human here.
    ``top_authors`` is array<struct<name, pages, is_bot>> in rank order. Rows come by time and site.
    """
    return _report_of(_author_hours(_report_rows(pages, domain, hours, as_of)), top_n)


def _report_of(author_hours: DataFrame, top_n: int) -> DataFrame:
    # both parts start from the per-author aggregate: write it once, read it twice
    base = materialize(author_hours)
    hourly = base.groupBy("domain", "time_start").agg(
        F.sum("pages").alias("pages_created"),
        F.count_distinct("user_id").alias("unique_authors"),
        F.sum("bots").alias("bot_pages"))
    top = (_rank_authors(base, top_n)
           .groupBy("domain", "time_start")
           .agg(F.sort_array(F.collect_list(F.struct("rank", "name", "pages", "is_bot"))).alias("_t")))
    total = F.col("pages_created")
    return (hourly.join(top, ["domain", "time_start"], "left")
            .select("time_start",
                    F.timestamp_add("HOUR", F.lit(1), F.col("time_start")).alias("time_end"),
                    "domain",
                    total.cast("long").alias("pages_created"),
                    F.col("unique_authors").cast("long").alias("unique_authors"),
                    F.bround(F.when(total > 0, F.col("bot_pages") / total * 100)
                             .otherwise(F.lit(0.0)), 2).alias("bot_percent"),
                    F.transform("_t", lambda x: F.struct(x["name"].alias("name"),
                                                         x["pages"].alias("pages"),
                                                         x["is_bot"].alias("is_bot")))
                    .alias("top_authors"))
            .orderBy("time_start", "domain"))


def author_hours(pages: DataFrame) -> DataFrame:
    """Partial aggregates per (site, hour, user, name) that the reports are answered from; those of any batches merge."""
    return (pages.withColumn("_key", newest_key("created_at", "page_id"))
            .groupBy("domain", hour_floor("created_at").alias("time_start"), "user_id", "user_name")
            .agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.col("is_bot")).alias("bots"),
                 F.min(F.col("created_at").cast("timestamp_ntz")).alias("first"), F.max(F.col("created_at").cast("timestamp_ntz")).alias("last"),
                 F.max("_key").alias("newest"), F.max_by("is_bot", "_key").alias("newest_is_bot")))


def hourly_report_from(rollup: DataFrame, domain: str | None = None, hours: int = 6, as_of: Column | str | None = None,
                       top_n: int = 10) -> DataFrame:
    """:func:`hourly_report` from stored :func:`author_hours`: no raw row is read.

    Covers the hours that begin within the last ``hours`` hours before ``as_of``. With ``as_of`` on the hour these are the
    rows of the direct report; an hour that isn't over counts as far as it is stored.
    """
    if not 1 <= hours <= 24:
        raise ValueError("hours must be within 1..24")
    end = _ts(as_of)
    rows = rollup.filter((F.col("time_start") >= F.timestamp_add("HOUR", F.lit(-hours), end)) & (F.col("time_start") < end))
    if domain is not None:
        rows = rows.filter(F.col("domain") == domain)
    return _report_of(rows.withColumn("name", F.coalesce(nonblank(F.col("user_name")), F.lit("unknown"))), top_n)


def editor_patterns_from(rollup: DataFrame, min_pages: int = 5) -> DataFrame:
    """:func:`editor_patterns` from stored :func:`author_hours`."""
    if not 1 <= min_pages <= 100:
        raise ValueError("min_pages must be within 1..100")
    return _editors(rollup.groupBy("user_id").agg(
        F.sum("pages").alias("pages_created"),
        F.max_by("user_name", "newest").alias("_newest_name"),
        F.max_by("newest_is_bot", "newest").alias("_newest_bot"),
        F.sort_array(F.collect_set("domain")).alias("domains"),
        F.sort_array(F.collect_set(F.hour("time_start"))).alias("active_hours_utc"),
        F.min("first").alias("_first"), F.max("last").alias("_last")), min_pages)


def editor_patterns(pages: DataFrame, min_pages: int = 5) -> DataFrame:
    """Per user: pages, sites (count + sorted list), active UTC hours, mean gap, specialisation.

    The mean gap between consecutive pages telescopes to (last - first) / (n - 1),
    so it needs no sort and no per-user window: one partial + final hash
    aggregate handles a user holding any share of the rows. Name and bot flag
    come from the user's newest row.
    """
    if not 1 <= min_pages <= 100:
        raise ValueError("min_pages must be within 1..100")
    g = pages.withColumn("_key", newest_key("created_at", "page_id")).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("pages_created"),
        F.max_by("user_name", "_key").alias("_newest_name"),
        F.max_by("is_bot", "_key").alias("_newest_bot"),
        F.sort_array(F.collect_set("domain")).alias("domains"),
        F.sort_array(F.collect_set(F.hour("created_at"))).alias("active_hours_utc"),
        F.min("created_at").alias("_first"), F.max("created_at").alias("_last"))
    return _editors(g, min_pages)


def _editors(per_user: DataFrame, min_pages: int) -> DataFrame:
    n = F.col("pages_created")
    return per_user.filter(n >= min_pages).select(
        "user_id",
        F.col("_newest_name").alias("user_name"),
        F.col("_newest_bot").alias("is_bot"),
        n.alias("pages_created"),
        F.size("domains").alias("domains_count"),
        "domains", "active_hours_utc",
        F.when(n > 1, micros_between("_first", "_last") / F.lit(1_000_000.0) / (n - 1))
        .alias("avg_seconds_between_pages"),
        (F.size("domains") == 1).alias("has_domain_specialization"),
    ).orderBy(F.desc("pages_created"), "user_id")


def editor_gaps(pages: DataFrame, bucket_minutes: int = 1) -> DataFrame:
    """The literal form of the mean gap: every consecutive gap computed, then averaged.

    Gaps inside a (user, time bucket) come from ``lag`` over that bucket; gaps
    across buckets from ``lag`` over the per-bucket summaries of a user, whose
    count is bounded by the time span, not by the row count. Sums are kept in
    integer microseconds, so the result equals :func:`editor_patterns` exactly.
    """
    rows = pages.select("user_id", "created_at", "page_id",
                        minutes_window_start("created_at", bucket_minutes).alias("_bucket"))
    inner = Window.partitionBy("user_id", "_bucket").orderBy("created_at", "page_id")
    gaps = rows.withColumn("_gap", micros_between(F.lag("created_at").over(inner), F.col("created_at")))
    buckets = gaps.groupBy("user_id", "_bucket").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_gap").alias("_inner"),
        F.min("created_at").alias("_first"), F.max("created_at").alias("_last"))
    across = Window.partitionBy("user_id").orderBy("_bucket")
    buckets = buckets.withColumn("_edge", micros_between(F.lag("_last").over(across), F.col("_first")))
    per_user = buckets.groupBy("user_id").agg(
        F.sum("_n").alias("pages_created"),
        (F.coalesce(F.sum("_inner"), F.lit(0)) + F.coalesce(F.sum("_edge"), F.lit(0)))
        .alias("gap_micros"))
    n = F.col("pages_created")
    return per_user.select(
        "user_id", n.alias("pages_created"), "gap_micros",
        F.when(n > 1, F.col("gap_micros") / F.lit(1_000_000.0) / (n - 1))
        .alias("avg_seconds_between_pages"))


def latest_per_domain(metrics: DataFrame, limit: int | None = None) -> DataFrame:
    """The newest window row of every site, by name; ``limit`` is a page size, if one is wanted.

    ``max(struct(window_start, ...))`` per site: a hash aggregate with a
    map-side partial step, so no site's history is sorted in one task.
    """
    if limit is not None and limit < 1:
        raise ValueError("limit must be positive")
    latest = metrics.groupBy("domain").agg(F.max(F.struct(
        "window_start", "window_end", "pages_created", "unique_authors", "avg_title_length",
        "trend")).alias("r"))
    rows = latest.select(
        "domain",
        F.col("r.window_start").alias("latest_window_start"),
        F.col("r.window_end").alias("latest_window_end"),
        F.col("r.pages_created").alias("pages_created_last_window"),
        F.col("r.unique_authors").alias("unique_authors_last_window"),
        F.col("r.avg_title_length").alias("avg_title_length"),
        F.col("r.trend").alias("trend"),
    ).orderBy("domain")
    return rows if limit is None else rows.limit(limit)
