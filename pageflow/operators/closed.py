"""Rows of closed windows, with what needs more than one window or more than a counter.

The functions take events with a watermark and run as a stream in append mode, where a row leaves once its window is
closed, or take a batch, where all windows are closed. The windows of a site meet their neighbours in a second event-time
aggregation chained to the first: every closed window falls into the sliding windows that span it and its successor, so the
state of a key ends with the last span it can be needed for. The counts of keywords, many more, meet those of earlier
windows in the stored counts instead. No state row grows with its group: authors are held in sketches
of a fixed size, and distinct names and titles are state rows of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageflow.operators.enrich import spike_ratio
from pageflow.operators.keywords import bursts_of_titles, kept_words, title_tokens
from pageflow.schema import CLOSED_ACTIVITY

TOP_NAMES = 3
#: Authors sketch of 2 ** AUTHORS_LG_K buckets: relative standard error 1.04 / sqrt(4096).
AUTHORS_LG_K = 12
AUTHORS_ERROR = 1.04 / 2 ** (AUTHORS_LG_K / 2)


def closed_windows(events: DataFrame, window_minutes: int = 1, band: float = 0.2) -> DataFrame:
    """A row per (domain, window) with all of a closed window but its first names, and one per name in it, with its ``n`` pages.

    All rows of a window leave in the micro-batch that closes it, so :func:`with_names` may rank the names there. ``named`` tells
    the two kinds apart; columns of the other kind are null.
    """
    names = (events.where("is_bot is not null").groupBy("domain", F.window("created_at", f"{window_minutes} minutes").alias("window"), "is_bot", "user_name")
             .agg(F.count(F.lit(1)).alias("n")))
    names = names.select("domain", F.col("window.start").alias("window_start"), "is_bot", "user_name", "n", F.lit(True).alias("named"))
    rows = _window_rows(events, window_minutes, band).withColumn("named", F.lit(False))
    return rows.unionByName(names, allowMissingColumns=True)


def with_names(rows: DataFrame) -> DataFrame:
    """Closed windows with their first names from :func:`closed_windows` (a batch, or a micro-batch of the stream).

    Every name of a window is counted in a row of its own, and the limit goes before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy("domain", "window_start", "is_bot").orderBy(F.desc("n"), "user_name"))
    first = rows.where("named").select("domain", "window_start", "is_bot", "user_name", "n", rank.alias("rank")).where(F.col("rank") <= TOP_NAMES)

    def as_json(who: str) -> Column:
        ranked = F.sort_array(F.collect_list(F.when(F.expr(who), F.struct("rank", F.col("user_name").alias("name"), F.col("n").alias("pages")))))
        return F.to_json(F.transform(ranked, lambda x: F.struct(x["name"].alias("name"), x["pages"].alias("pages"))))

    lists = first.groupBy("domain", "window_start").agg(as_json("is_bot").alias("top_bots"), as_json("not is_bot").alias("top_humans"))
    lists = lists.select(F.col("domain").alias("of_domain"), F.col("window_start").alias("at"), "top_bots", "top_humans")
    windows = rows.where("not named").select(*[c for c in CLOSED_ACTIVITY.columns if c not in ("top_bots", "top_humans")])
    same = windows["domain"].eqNullSafe(lists["of_domain"]) & (windows["window_start"] == lists["at"])
    return windows.join(lists, same, "left").select(*[F.coalesce(c, F.lit("[]")).alias(c) if c in ("top_bots", "top_humans") else c for c in CLOSED_ACTIVITY.columns])


def closed_activity(events: DataFrame, window_minutes: int = 1, band: float = 0.2) -> DataFrame:
    """One row per (domain, window) of a batch with the columns of both metric tables, none left constant.

    ``trend`` is up / down / stable against the window before, which counts as zero pages if it has no rows;
    ``top_bots`` and ``top_humans`` are the first names by pages (ties by name); ``authors_sketch`` merges over any
    windows (:func:`authors_over`), and ``unique_authors`` is its estimate. A stream stores :func:`closed_windows` by
    way of :func:`with_names`.
    """
    return with_names(closed_windows(events, window_minutes, band))


def _window_rows(events: DataFrame, window_minutes: int, band: float) -> DataFrame:
    minutes = f"{window_minutes} minutes"
    per = events.groupBy("domain", F.window("created_at", minutes).alias("window")).agg(
        F.count(F.lit(1)).alias("pages"), F.avg("title_length").alias("avg_title_length"),
        F.count_if(F.col("is_bot")).alias("bots"), F.count_if(~F.col("is_bot")).alias("humans"),
        F.hll_sketch_agg("user_id", F.lit(AUTHORS_LG_K)).alias("authors_sketch"))
    # the window itself is the later half of one span and the earlier half of the next
    spans = per.withColumn("span", F.window(F.window_time("window"), f"{2 * window_minutes} minutes", minutes))
    later = F.col("window.end") == F.col("span.end")
    row = F.struct(*[c for c in per.columns if c != "domain"])
    both = spans.groupBy("domain", "span").agg(F.max(F.when(later, row)).alias("row"),
                                               F.coalesce(F.sum(F.when(~later, F.col("pages"))), F.lit(0)).alias("previous"))
    closed = both.where("row is not null").select("domain", "row.*", "previous")
    n, p = F.col("pages"), F.col("previous")
    trend = F.when(n > p * (1 + band), "up").when(n < p * (1 - band), "down").otherwise("stable")
    return closed.select(
        "domain", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        n.cast("int").alias("pages_created"), F.hll_sketch_estimate("authors_sketch").cast("int").alias("unique_authors"),
        F.col("avg_title_length").cast("double").alias("avg_title_length"), trend.alias("trend"), p.cast("int").alias("previous_pages"),
        F.col("bots").cast("int").alias("bot_pages"), F.col("humans").cast("int").alias("human_pages"),
        (F.col("bots") / n * 100).cast("double").alias("bot_percent"), "authors_sketch")


def authors_over(closed: DataFrame, unit: str | None = "hour") -> DataFrame:
    """(domain, start, pages_created, windows, unique_authors) of longer stretches, from the stored windows alone.

    A window's authors are merged as sketches, so an author of several windows counts once; ``unit`` as in ``date_trunc``,
    None for all time.
    """
    start = F.date_trunc(unit, "window_start") if unit else F.lit(None).cast("timestamp")
    return closed.groupBy("domain", start.alias("start")).agg(
        F.sum("pages_created").alias("pages_created"), F.count(F.lit(1)).alias("windows"),
        F.hll_sketch_estimate(F.hll_union_agg("authors_sketch")).alias("unique_authors"))


def closed_pages(events: DataFrame, window_minutes: int = 10) -> DataFrame:
    """(domain, window_start, window_end, page_title, n): distinct titles of a window.

    A title's words follow from it: the state holds a row per title, whose words are cut when the window closes.
    """
    per = (events.where("page_title is not null").groupBy("domain", F.window("created_at", f"{window_minutes} minutes").alias("window"), "page_title")
           .agg(F.count(F.lit(1)).alias("n")))
    return per.select("domain", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "page_title", "n")


def counts_of_pages(pages: DataFrame) -> DataFrame:
    """(domain, keyword, window_start, window_end, occurrences) from :func:`closed_pages` (a batch, or a micro-batch of the stream)."""
    return kept_words(pages).groupBy("domain", "keyword", "window_start", "window_end").agg(F.sum("n").alias("occurrences"))


def spikes_of_counts(counts: DataFrame, window_minutes: int = 10, history: int = 6, threshold: int = 5) -> DataFrame:
    """(domain, keyword, window_start, window_end, occurrences, spike_ratio) of windows of at least ``threshold`` occurrences.

    ``spike_ratio``: occurrences by the mean over the ``history`` windows before, null where those have none. All windows
    count as history, whatever their occurrences.
    """
    found = spike_ratio(counts, window_minutes, history, threshold)
    return found.select("domain", "keyword", "window_start", "window_end", F.col("occurrences").cast("int").alias("occurrences"), "spike_ratio")


def closed_spikes(events: DataFrame, window_minutes: int = 10, history: int = 6, threshold: int = 5) -> DataFrame:
    """Spikes of a batch; a stream stores the counts of closed windows and reads the last ones (``streaming.runner``)."""
    return spikes_of_counts(counts_of_pages(closed_pages(events, window_minutes)), window_minutes, history, threshold)


def closed_titles(events: DataFrame, window_minutes: int = 10) -> DataFrame:
    """(domain, keyword, window_start, window_end, page_title, n): distinct titles of a keyword in a window.

    A window's rows all leave in the micro-batch that closes it, so :func:`closed_bursts` may gather them there.
    """
    per = (title_tokens(events).groupBy("domain", "keyword", F.window("created_at", f"{window_minutes} minutes").alias("window"), "page_title")
           .agg(F.count(F.lit(1)).alias("n")))
    return per.select("domain", "keyword", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "page_title", "n")


def closed_bursts(titles: DataFrame, threshold: int = 5) -> DataFrame:
    """Bursts with all their titles from :func:`closed_titles` (a batch, or a micro-batch of the stream)."""
    return bursts_of_titles(titles, threshold)


def bursts_of_pages(pages: DataFrame, threshold: int = 5) -> DataFrame:
    """The same bursts from :func:`closed_pages`, a title's words being cut here and not in the state."""
    return bursts_of_titles(kept_words(pages), threshold, repeated=True)


def with_spike_ratio(bursts: DataFrame, spikes: DataFrame) -> DataFrame:
    """Stored bursts with the stored spike ratio of their window."""
    keys = ["domain", "keyword", "window_start"]
    return bursts.join(spikes.select(*keys, "spike_ratio"), keys, "left")
