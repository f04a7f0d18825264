"""Schemas of the event stream and of the keyed result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Canonical page-create event as it travels on the stream (created_at is ISO text).
EVENT_SCHEMA = T.StructType([
    T.StructField("domain", T.StringType(), True),
    T.StructField("page_id", T.LongType(), True),
    T.StructField("page_title", T.StringType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("user_name", T.StringType(), True),
    T.StructField("is_bot", T.BooleanType(), True),
    T.StructField("created_at", T.StringType(), True),
    T.StructField("title_length", T.IntegerType(), True),
])

# Every path the normaliser probes in a raw upstream event. Numbers that may
# arrive as text (ids, epoch seconds) are read as strings and try_cast later,
# so a wrongly typed field becomes null instead of failing the batch.
RAW_EVENT_SCHEMA = T.StructType([
    T.StructField("meta", T.StructType([
        T.StructField("domain", T.StringType()),
        T.StructField("dt", T.StringType()),
    ])),
    T.StructField("database", T.StringType()),
    T.StructField("page", T.StructType([
        T.StructField("page_id", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("page_title", T.StringType()),
        T.StructField("title", T.StringType()),
    ])),
    T.StructField("performer", T.StructType([
        T.StructField("user_id", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("user_text", T.StringType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("user_is_bot", T.StringType()),
        T.StructField("is_bot", T.StringType()),
    ])),
    T.StructField("page_id", T.StringType()),
    T.StructField("page_title", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("bot", T.StringType()),
    T.StructField("dt", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

# Columns of the event once parsed (created_at is a timestamp from here on).
EVENT_COLUMNS = ["domain", "page_id", "page_title", "user_id", "user_name",
                 "is_bot", "created_at", "title_length"]
REQUIRED_FIELDS = ["domain", "page_id", "created_at", "page_title", "user_id"]


@dataclass(frozen=True)
class TableSpec:
    """A keyed table: inserting a row with an existing key replaces that row."""

    name: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    # clustering order used by reads, as (column, descending) pairs
    order: tuple[tuple[str, bool], ...] = ()
    # layout of the compacted base: a directory partition derived from key
    # columns, as (name, SQL expression), and the order of rows inside files
    partition: tuple[str, str] | None = None
    sort: tuple[str, ...] = ()
    # columns with a Bloom filter per row group of the compacted base, for point lookups
    bloom: tuple[str, ...] = ()
    # an additive table: rows of a key are not replaced but merged, as (column, aggregate) pairs
    merge: tuple[tuple[str, str], ...] = ()


#: Directories of the tables that are looked up by a key: a lookup lists and reads one of them. About a thousandth
#: of the files of the largest base is a good number; a base keeps the number it was written with.
KEY_BUCKETS = 64

# Raw rows are partitioned by day (a bounded number of directories, unlike a
# partition per site or user) and sorted by (site, time) inside each file, so
# a site lookup prunes days by directory and row groups by parquet min/max.
RAW_PAGES = TableSpec(
    "raw_pages",
    ("domain", "created_at", "page_id", "page_title", "user_id", "user_name", "is_bot",
     "title_length"),
    ("domain", "created_at", "page_id"),
    (("created_at", True), ("page_id", False)),
    partition=("date", "to_date(created_at)"),
    sort=("domain", "created_at"),
)
PAGES_BY_USER = TableSpec(
    "pages_by_user",
    ("user_id", "created_at", "page_id", "domain", "page_title", "user_name", "is_bot"),
    ("user_id", "created_at", "page_id"),
    (("created_at", True), ("page_id", False)),
    partition=("bucket", f"pmod(user_id, {KEY_BUCKETS})"),
    sort=("user_id", "created_at"),
    bloom=("user_id",),
)
PAGES_BY_ID = TableSpec(
    "pages_by_id",
    ("page_id", "domain", "created_at", "page_title", "user_id", "user_name", "is_bot",
     "title_length"),
    ("page_id",),
    (("created_at", True),),
    partition=("bucket", f"pmod(page_id, {KEY_BUCKETS})"),
    sort=("page_id",),
    bloom=("page_id",),
)
LANGUAGE_ACTIVITY = TableSpec(
    "language_activity",
    ("domain", "window_start", "window_end", "pages_created", "unique_authors",
     "avg_title_length", "trend"),
    ("domain", "window_start"),
    (("window_start", True),),
)
BOT_ACTIVITY = TableSpec(
    "bot_activity_metrics",
    ("domain", "window_start", "window_end", "bot_pages", "human_pages", "bot_percent",
     "top_bots", "top_humans"),
    ("domain", "window_start"),
    (("window_start", True),),
)
# Keyed by (domain, keyword, window) so several bursts in one batch never collide
# and a retried batch re-writes the same keys.
BREAKING_NEWS_ALERTS = TableSpec(
    "breaking_news_alerts",
    ("domain", "alert_time", "alert_type", "keyword", "spike_ratio", "pages_count",
     "sample_pages", "window_start", "window_end"),
    ("domain", "keyword", "window_start"),
    (("window_start", True), ("keyword", False)),
)
# Keyed by the page, not by the wall clock of the write, so a retry is idempotent.
SPAM_ALERTS = TableSpec(
    "spam_alerts",
    ("domain", "alert_time", "severity", "user_id", "user_name", "reason", "page_title",
     "page_id", "created_at"),
    ("domain", "page_id", "created_at"),
    (("created_at", True), ("page_id", False)),
)

# Closed windows: written once, in append mode, with the fields that need more than one window or a sketch.
CLOSED_ACTIVITY = TableSpec(
    "closed_activity",
    ("domain", "window_start", "window_end", "pages_created", "unique_authors", "avg_title_length", "trend",
     "previous_pages", "bot_pages", "human_pages", "bot_percent", "top_bots", "top_humans", "authors_sketch"),
    ("domain", "window_start"),
    (("window_start", True),),
)
CLOSED_BURSTS = TableSpec(
    "closed_bursts",
    ("domain", "keyword", "window_start", "window_end", "occurrences", "sample_pages"),
    ("domain", "keyword", "window_start"),
    (("window_start", True), ("keyword", False)),
)
KEYWORD_SPIKES = TableSpec(
    "keyword_spikes",
    ("domain", "keyword", "window_start", "window_end", "occurrences", "spike_ratio"),
    ("domain", "keyword", "window_start"),
    (("window_start", True), ("keyword", False)),
)

# Authors' hours, from which the reports are answered: every batch adds its partial sums, reads and compaction merge them.
AUTHOR_HOURS = TableSpec(
    "author_hours",
    ("domain", "time_start", "user_id", "user_name", "pages", "bots", "first", "last", "newest", "newest_is_bot"),
    ("domain", "time_start", "user_id", "user_name"),
    partition=("date", "to_date(time_start)"),
    sort=("domain", "time_start"),
    merge=(("pages", "sum(pages)"), ("bots", "sum(bots)"), ("first", "min(first)"), ("last", "max(last)"),
           ("newest_is_bot", "max_by(newest_is_bot, newest)"), ("newest", "max(newest)")),
)

TABLES = {spec.name: spec for spec in (RAW_PAGES, PAGES_BY_USER, PAGES_BY_ID,
                                       LANGUAGE_ACTIVITY, BOT_ACTIVITY,
                                       BREAKING_NEWS_ALERTS, SPAM_ALERTS,
                                       CLOSED_ACTIVITY, CLOSED_BURSTS, KEYWORD_SPIKES, AUTHOR_HOURS)}
