"""The streaming job: canonical events in, keyed tables out.

Three queries share one event stream:

* ``raw``     stateless: the three raw fan-out tables, the spam alerts and the
              batch's part of the report rollup, from one persisted micro-batch
              (one read + parse for all writes);
* ``metrics`` one stateful (site, 1-minute window) aggregate that feeds both
              the language-activity and the bot-activity tables;
* ``bursts``  the (site, keyword, 10-minute window) aggregate with threshold.

On request three more write each window once, when it is closed (see :mod:`pageflow.operators.closed`).

Every sink goes through :func:`upsert_batch`, keyed by (gen, batch_id), so a
micro-batch re-run after a failure rewrites the same files. The watermark
bounds state; rows later than the watermark are dropped by Spark.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pageflow.operators import closed, keywords, metrics, reports, spam
from pageflow.schema import (AUTHOR_HOURS, BOT_ACTIVITY, BREAKING_NEWS_ALERTS, CLOSED_ACTIVITY, CLOSED_BURSTS, KEYWORD_SPIKES,
                             LANGUAGE_ACTIVITY, PAGES_BY_ID, PAGES_BY_USER, RAW_PAGES, SPAM_ALERTS, TableSpec)
from pageflow.sources.export import alerts_to_key_value
from pageflow.sources.tables import upsert_batch

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WATERMARK = "2 minutes"
METRIC_WINDOW = "1 minute"
BURST_WINDOW = "10 minutes"
#: Tables whose rows are aggregated from a micro-batch, not only projected.
AGGREGATED = (AUTHOR_HOURS, CLOSED_ACTIVITY, CLOSED_BURSTS, KEYWORD_SPIKES)


def _guarded(fn: Callable[[DataFrame, int], None], tidy: bool = False) -> Callable[[DataFrame, int], None]:
    """Persist the micro-batch once, skip empty ones, always release it.

    ``tidy`` has the driver collect its garbage after each, upon which Spark deletes the shuffle files of earlier ones.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                fn(batch, batch_id)
        finally:
            batch.unpersist()
            if tidy:
                batch.sparkSession.sparkContext._jvm.System.gc()

    return run


def _write_rows(rows: DataFrame, write: Callable[[DataFrame], None], keep: bool = False) -> None:
    """Write the rows unless there are none; ``keep`` persists them, so that an aggregation is done once for both."""
    if keep:
        rows.persist()
    try:
        if not rows.isEmpty():
            write(rows)
    finally:
        if keep:
            rows.unpersist()


def upsert_writer(specs: list[tuple[TableSpec, Callable[[DataFrame, Column], DataFrame]]], root: str,
                  gen: int, messages: tuple[str, Callable[[DataFrame, Column], DataFrame]] | None = None, tidy: bool = False
                  ) -> Callable[[DataFrame, int], None]:
    """foreachBatch function writing each (spec, projection) of the batch as an upsert; empty projections write nothing.

    ``messages = (folder, projection)`` also writes that projection as key/value
    JSON messages, one directory per batch id (replaced when a batch is retried).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        at = F.lit(datetime.now(timezone.utc)).cast("timestamp")  # one alert time for tables and messages
        for spec, project in specs:
            _write_rows(project(batch, at), lambda rows, spec=spec: upsert_batch(rows, spec, root, gen, batch_id), spec in AGGREGATED)
        if messages is not None:
            folder, project = messages
            _write_rows(project(batch, at), lambda rows: alerts_to_key_value(rows).write.mode("overwrite").json(f"{folder}/batch_id={batch_id}"))

    return _guarded(write, tidy)


def stored_spikes(pages: DataFrame, root: str, gen: int, threshold: int = 5, window_minutes: int = 10, history: int = 6) -> DataFrame:
    """Spikes of the windows a micro-batch of :func:`closed.closed_pages` closes, with the ``history`` windows before.

    The counts of every closed window are stored in a directory of its own, which a retried batch replaces; only those of the
    last windows are read, and older ones deleted. A window's rows all leave in one micro-batch, and later batches close later
    windows, so what is read is whole.
    """
    spark = pages.sparkSession
    folder = f"{root.rstrip('/')}/keyword_counts/gen={int(gen)}"
    at = F.unix_seconds("window_start")
    first, last = pages.agg(F.min(at), F.max(at)).first()
    counts = closed.counts_of_pages(pages).withColumn("window", at)
    counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("window").parquet(folder)
    since = first - 60 * window_minutes * history
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stored = [] if not fs.exists(path) else [int(f.getPath().getName()[len("window="):]) for f in fs.listStatus(path) if f.getPath().getName().startswith("window=")]
    for window in stored:
        if window < since:  # neither a retry of this batch nor a later one needs it
            fs.delete(path.suffix(f"/window={window}"), True)
    needed = [f"{folder}/window={window}" for window in stored if since <= window <= last]
    if needed:  # else no title had a word to count
        counts = spark.read.schema(counts.schema).option("basePath", folder).parquet(*needed)
    return closed.spikes_of_counts(counts.where(F.col("window") >= since).drop("window"), window_minutes, history, threshold).where(at >= first)


def start_all(events: DataFrame, root: str, checkpoint_root: str, trigger: dict | None = None,
              gen: int = 0, watermark: str = WATERMARK, burst_threshold: int = 5,
              dedup: bool = False, rocksdb_state: bool = True,
              alert_messages: str | None = None, shuffle_partitions: int | None = None,
              live: bool = True, closed_windows: bool = False, count_state_rows: bool = True,
              keep_batches: int | None = None, words_in_state: bool = True) -> list[StreamingQuery]:
    """Start the three queries (and those of closed windows); returns them (``spark.streams.awaitAnyTermination()`` to block).

    ``trigger`` is passed to ``DataStreamWriter.trigger``, e.g.
    ``{"processingTime": "30 seconds"}`` in production, ``{"availableNow": True}``
    in tests and back-fills. ``dedup=True`` drops re-sent events (same site and
    page id) within the watermark before they reach the metrics.

    ``rocksdb_state`` keeps aggregation state in RocksDB (off-heap, spills to
    local disk, snapshots to the checkpoint) instead of executor heap: the burst
    query holds a title set per (site, keyword, window). The provider is
    recorded in each query's checkpoint, so a restarted query keeps its own.

    ``count_state_rows=False`` saves RocksDB a look-up for every row written or removed, for progress reports without the
    number of state rows.

    ``keep_batches`` keeps the state of so many micro-batches only (a restart needs the last one), and the shuffle files of
    the last ones, so that the disk in use doesn't grow with the number of micro-batches.

    ``alert_messages`` (a folder) additionally writes every alert batch as
    key/value JSON messages (``spam-alerts`` / ``breaking-news-alerts`` below it,
    one directory per batch id): the shape of the alert topics.

    ``shuffle_partitions`` sets the state partitions, which a query's checkpoint then keeps; by default
    the session's. The settings hold for the queries started here, and the session gets its own back.
    A query that fails to start stops the ones started before it.

    ``closed_windows`` starts three more queries, in append mode: a window's row is written once, when the watermark
    closes it, with its trend, first names and authors sketch (``closed_activity``), its titles (``closed_bursts``) and
    its spike ratio (``keyword_spikes``). ``live=False`` starts these alone. ``words_in_state=False`` keeps a state row per
    title of a window for the titles, not one per keyword and title, and cuts the words when the window closes: less state, and
    more work in the micro-batch that closes many windows.
    """
    trigger = trigger or {"processingTime": "30 seconds"}
    spark = events.sparkSession
    settings = {}
    if rocksdb_state:
        settings["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
        # commit a changelog per batch instead of uploading a full snapshot
        settings["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
        settings["spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"] = str(count_state_rows).lower()
    if keep_batches:
        settings["spark.sql.streaming.minBatchesToRetain"] = str(keep_batches)
        settings["spark.sql.streaming.stateStore.minDeltasForSnapshot"] = str(keep_batches)
        settings["spark.sql.streaming.stateStore.maintenanceInterval"] = "10s"
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    # one watermark for the whole stream (Spark refuses to redefine it downstream)
    events = events.withWatermark("created_at", watermark)
    if dedup:
        events = events.dropDuplicatesWithinWatermark(["domain", "page_id"])

    def spam_rows(b: DataFrame, at: Column) -> DataFrame:
        return spam.spam_alerts(b, at)

    def burst_rows(b: DataFrame, at: Column) -> DataFrame:
        return keywords.burst_alerts(b, at)

    raw_specs = [(RAW_PAGES, lambda b, _: b.select(*RAW_PAGES.columns)),
                 (PAGES_BY_USER, lambda b, _: b.select(*PAGES_BY_USER.columns)),
                 (PAGES_BY_ID, lambda b, _: b.select(*PAGES_BY_ID.columns)),
                 (SPAM_ALERTS, spam_rows),
                 (AUTHOR_HOURS, lambda b, _: reports.author_hours(b))]

    dm = metrics.domain_minute(events, METRIC_WINDOW)
    metric_specs = [(LANGUAGE_ACTIVITY, lambda b, _: metrics.language_rows(b)), (BOT_ACTIVITY, lambda b, _: metrics.bot_rows(b))]

    bursts = keywords.keyword_bursts(events, BURST_WINDOW, burst_threshold)
    burst_specs = [(BREAKING_NEWS_ALERTS, burst_rows)]

    messages = {}
    if alert_messages:
        messages = {"raw": (f"{alert_messages}/spam-alerts/gen={gen}", spam_rows),
                    "bursts": (f"{alert_messages}/breaking-news-alerts/gen={gen}", burst_rows)}

    plans = [("raw", events, raw_specs, "append"),
             ("metrics", dm, metric_specs, "update"),
             ("bursts", bursts, burst_specs, "update")] if live else []
    if closed_windows:
        titles = ((closed.closed_titles(events), [(CLOSED_BURSTS, lambda b, _: closed.closed_bursts(b, burst_threshold))]) if words_in_state else
                  (closed.closed_pages(events), [(CLOSED_BURSTS, lambda b, _: closed.bursts_of_pages(b, burst_threshold))]))
        plans += [("closed", closed.closed_windows(events), [(CLOSED_ACTIVITY, lambda b, _: closed.with_names(b))], "append"),
                  ("titles", *titles, "append"),
                  ("spikes", closed.closed_pages(events), [(KEYWORD_SPIKES, lambda b, _: stored_spikes(b, root, gen, burst_threshold))], "append")]
    started = []
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        for name, frame, specs, mode in plans:
            writer = upsert_writer(specs, root, gen, messages.get(name), bool(keep_batches))
            q = (frame.writeStream.queryName(f"pageflow_{name}_{gen}")
                 .foreachBatch(writer)
                 .outputMode(mode)
                 .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{name}")
                 .trigger(**trigger)
                 .start())
            started.append(q)
    except Exception:
        for q in started:
            q.stop()
        raise
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    return started


def run_available_now(events: DataFrame, root: str, checkpoint_root: str, gen: int = 0,
                      **kwargs) -> list[StreamingQuery]:
    """Process everything available, then stop (tests, back-fills). Raises a query's error."""
    queries = start_all(events, root, checkpoint_root, {"availableNow": True}, gen, **kwargs)
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"streaming query {q.name} failed: {q.exception()}")
    return queries
