"""Registered queries that run the streaming job over the driver's tables.

``events.parquet`` is read as a file stream (stream-static join with
``pages``), the job runs with ``availableNow`` into fresh keyed tables below
the session's checkpoint root, and each query returns one resolved table.
Wall-clock columns (alert_time) are left out so results are comparable.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.operators import closed, metrics, summaries
from pageflow.plans.catalog import BOT_CTE, BURSTS_CTE, LANG_CTE, ORACLE_SQL as BATCH_SQL, PAGE_EVENTS_CTE, SPAM_CTE, estimate_checked
from pageflow.schema import (BOT_ACTIVITY, BREAKING_NEWS_ALERTS, CLOSED_ACTIVITY, CLOSED_BURSTS, KEYWORD_SPIKES,
                             LANGUAGE_ACTIVITY, PAGES_BY_ID, PAGES_BY_USER, RAW_PAGES, SPAM_ALERTS, TableSpec)
from pageflow.session import scratch_path
from pageflow.sources.fixtures import input_state, page_events, stream_page_events
from pageflow.sources.tables import read_latest
from pageflow.streaming.runner import METRIC_WINDOW, WATERMARK, run_available_now

#: Events of a micro-batch of the queries of closed windows, and the micro-batches whose state is kept.
BATCH_ROWS, KEEP_BATCHES = 1_000_000, 2

_runs: dict[tuple, str] = {}
_lock = threading.Lock()


def stream_tables_root(spark: SparkSession, sf_dir: str, closed_windows: bool = False) -> str:
    """Run the streaming job (or its queries of closed windows) once per (application, state of the input) and return its
    table root."""
    key = (spark.sparkContext.applicationId, sf_dir, input_state(spark, sf_dir), closed_windows)
    with _lock:
        if key not in _runs:
            base = scratch_path(spark, "stream")
            events = stream_page_events(spark, sf_dir, batch_rows=BATCH_ROWS if closed_windows else None)
            # state partitions are fixed when a query first starts
            run_available_now(events, f"{base}/tables", f"{base}/checkpoints",
                              shuffle_partitions=2 * spark.sparkContext.defaultParallelism,
                              live=not closed_windows, closed_windows=closed_windows, count_state_rows=False,
                              keep_batches=KEEP_BATCHES if closed_windows else None, words_in_state=False)
            _runs[key] = f"{base}/tables"
        return _runs[key]


def _ntz(df: DataFrame) -> DataFrame:
    for name, dtype in df.dtypes:
        if dtype == "timestamp":
            df = df.withColumn(name, F.col(name).cast("timestamp_ntz"))
    return df


def _table(spec: TableSpec, drop: tuple[str, ...] = ()):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = read_latest(spark, spec, stream_tables_root(spark, sf_dir))
        return _ntz(df.drop(*drop))
    return run


def q_overview_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard overview as in production: over the three stored result tables."""
    root = stream_tables_root(spark, sf_dir)
    return summaries.overview(read_latest(spark, LANGUAGE_ACTIVITY, root),
                              read_latest(spark, BREAKING_NEWS_ALERTS, root),
                              read_latest(spark, SPAM_ALERTS, root))


def q_stream_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's windows against exact ones of the batch: counts equal, estimates within their error."""
    stored = _ntz(read_latest(spark, LANGUAGE_ACTIVITY, stream_tables_root(spark, sf_dir)))
    exact = metrics.language_activity(page_events(spark, sf_dir), exact=True)
    checked = estimate_checked(stored, exact.select("domain", "window_start", "unique_authors"))
    return stored.drop("unique_authors").join(checked, ["domain", "window_start"])


def _closed(*columns: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _ntz(read_latest(spark, CLOSED_ACTIVITY, stream_tables_root(spark, sf_dir, True)).select(*columns))
    return run


def q_stream_spike(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored bursts of closed windows with their titles and spike ratio."""
    root = stream_tables_root(spark, sf_dir, True)
    return _ntz(closed.with_spike_ratio(read_latest(spark, CLOSED_BURSTS, root), read_latest(spark, KEYWORD_SPIKES, root)))


def _authors(unit: str | None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Authors per site and stretch from the stored sketches, against the exact numbers of the events."""
        found = _ntz(closed.authors_over(read_latest(spark, CLOSED_ACTIVITY, stream_tables_root(spark, sf_dir, True)), unit))
        events = page_events(spark, sf_dir)
        # the watermark at the end of the stream: windows that end later are open
        last = events.agg(F.max("created_at").alias("t")).first()["t"]
        minute = F.window("created_at", METRIC_WINDOW)["end"]
        start = F.date_trunc(unit, "created_at").cast("timestamp_ntz") if unit else F.lit(None).cast("timestamp_ntz")
        exact = (events.where(minute <= F.lit(last) - F.expr(f"interval {WATERMARK}"))
                 .groupBy("domain", start.alias("start")).agg(F.count_distinct("user_id").alias("exact")))
        near = F.abs(F.col("unique_authors") - F.col("exact")) <= 3 * closed.AUTHORS_ERROR * F.col("exact")
        same = (found["domain"] == exact["domain"]) & found["start"].eqNullSafe(exact["start"])
        return found.join(exact, same, "left").select(
            found["domain"], found["start"].alias("start"), "pages_created", "windows", F.coalesce(near, F.lit(False)).alias("estimate_ok"))
    return run


QUERIES = {
    "overview_stored": q_overview_stored,
    "stream_raw": _table(RAW_PAGES),
    "stream_pages_by_user": _table(PAGES_BY_USER),
    "stream_pages_by_id": _table(PAGES_BY_ID),
    "stream_language": q_stream_language,
    "stream_bots": _table(BOT_ACTIVITY),
    "stream_bursts": _table(BREAKING_NEWS_ALERTS, ("alert_time",)),
    "stream_spam": _table(SPAM_ALERTS, ("alert_time",)),
    "stream_trend": _closed("domain", "window_start", "window_end", "pages_created", "previous_pages", "trend", "avg_title_length",
                            "bot_pages", "human_pages", "bot_percent"),
    "stream_top_actors": _closed("domain", "window_start", "window_end", "top_bots", "top_humans"),
    "stream_spike": q_stream_spike,
    "stored_authors_by_hour": _authors("hour"),
    "stored_authors_by_domain": _authors(None),
}

#: Windows that the watermark has closed when the stream ends.
CLOSED_CTE = f""",
wm as (select max(created_at) - interval '{WATERMARK}' as closed from page_events)"""
_RAW_COLS = ", ".join(RAW_PAGES.columns)
ORACLE_SQL = {
    "overview_stored": PAGE_EVENTS_CTE + LANG_CTE + BURSTS_CTE + SPAM_CTE + """
select (select count(distinct domain) from lang) as tracked_domains,
       (select sum(pages_created) from lang)::bigint as pages_in_windows,
       (select count(*) from bursts) as breaking_alerts,
       (select count(*) from spam) as spam_alerts""",
    "stream_raw": PAGE_EVENTS_CTE + f"\nselect {_RAW_COLS} from page_events",
    "stream_pages_by_user": PAGE_EVENTS_CTE
    + f"\nselect {', '.join(PAGES_BY_USER.columns)} from page_events",
    "stream_pages_by_id": PAGE_EVENTS_CTE
    + f"\nselect {', '.join(PAGES_BY_ID.columns)} from page_events",
    "stream_language": PAGE_EVENTS_CTE + LANG_CTE + "\nselect *, true as estimate_ok from lang",
    "stream_bots": PAGE_EVENTS_CTE + BOT_CTE + "\nselect * from bots",
    "stream_bursts": PAGE_EVENTS_CTE + BURSTS_CTE + "\nselect * exclude (alert_time) from alerts",
    "stream_spam": PAGE_EVENTS_CTE + SPAM_CTE + "\nselect * exclude (alert_time) from spam",
    "stream_trend": f"""
select t.domain, t.window_start, t.window_end, t.pages_created, previous_pages, t.trend, t.avg_title_length, bot_pages, human_pages, bot_percent
from ({BATCH_SQL["trend"]}) t join ({BATCH_SQL["bot_activity"]}) b using (domain, window_start),
     ({PAGE_EVENTS_CTE + CLOSED_CTE} select * from wm)
where t.window_end <= closed""",
    # the stored names have no order of activity: ties go by name alone
    "stream_top_actors": f"""
select t.* from ({BATCH_SQL["top_actors"].replace("last_ts desc, ", "")}) t, ({PAGE_EVENTS_CTE + CLOSED_CTE} select * from wm)
where window_end <= closed""",
    "stream_spike": f"""
select b.*, spike_ratio from ({BATCH_SQL["keyword_bursts"]}) b join ({BATCH_SQL["spike_ratio"]}) s using (domain, keyword, window_start),
     ({PAGE_EVENTS_CTE + CLOSED_CTE} select * from wm)
where b.window_end <= closed""",
    "stored_authors_by_hour": PAGE_EVENTS_CTE + LANG_CTE + CLOSED_CTE + """
select domain, date_trunc('hour', window_start) as start, sum(pages_created)::bigint as pages_created, count(*) as windows, true as estimate_ok
from lang, wm where window_end <= closed group by 1, 2""",
    "stored_authors_by_domain": PAGE_EVENTS_CTE + LANG_CTE + CLOSED_CTE + """
select domain, null::timestamp as start, sum(pages_created)::bigint as pages_created, count(*) as windows, true as estimate_ok
from lang, wm where window_end <= closed group by 1""",
}
