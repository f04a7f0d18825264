"""Keyword bursts in page titles."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.functions.text import MIN_KEYWORD_LENGTH, STOP_WORDS, keep_keyword, title_words
from pageflow.functions.timefn import alert_timestamp


def title_tokens(events: DataFrame, stop_words: Iterable[str] = STOP_WORDS,
                 min_len: int = MIN_KEYWORD_LENGTH) -> DataFrame:
    """One row per kept word occurrence (a word twice in a title gives two rows)."""
    return kept_words(events.select("domain", "page_id", "created_at", "page_title"), stop_words, min_len)


def kept_words(titles: DataFrame, stop_words: Iterable[str] = STOP_WORDS, min_len: int = MIN_KEYWORD_LENGTH) -> DataFrame:
    """The rows of ``titles`` with a ``keyword``, once per kept word occurrence of their ``page_title``."""
    words = titles.select(*titles.columns, F.explode(title_words("page_title")).alias("keyword"))
    return words.filter(keep_keyword("keyword", stop_words, min_len))


def keyword_counts(events: DataFrame, window: str = "10 minutes", watermark: str | None = None,
                   stop_words: Iterable[str] = STOP_WORDS, min_len: int = MIN_KEYWORD_LENGTH,
                   titles: bool = True) -> DataFrame:
    """Occurrences (and the distinct titles) per (domain, keyword, window), before any threshold."""
    tokens = title_tokens(events, stop_words, min_len)
    if watermark:
        tokens = tokens.withWatermark("created_at", watermark)
    aggs = [F.count(F.lit(1)).alias("occurrences")]
    if titles:
        # partial collect_set de-duplicates titles map-side before the shuffle
        aggs.append(F.collect_set("page_title").alias("titles"))
    agg = tokens.groupBy("domain", "keyword", F.window("created_at", window).alias("window")).agg(*aggs)
    return agg.select("domain", "keyword",
                      F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"),
                      *[c for c in agg.columns if c not in ("domain", "keyword", "window")])


def _sample_text(titles: Column) -> Column:
    return F.concat_ws(", ", F.sort_array(titles))


def _titles_of(tokens: DataFrame, window: str) -> DataFrame:
    """Occurrences per (domain, keyword, window, title): a hot keyword is counted by many tasks."""
    per = tokens.groupBy("domain", "keyword", F.window("created_at", window).alias("w"), "page_title").agg(F.count(F.lit(1)).alias("n"))
    return per.select("domain", "keyword", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "page_title", "n")


def bursts_of_titles(titles: DataFrame, threshold: int = 5, repeated: bool = False) -> DataFrame:
    """Bursts with their titles from rows (domain, keyword, window_start, window_end, page_title, n), one per distinct title
    unless ``repeated``.

    A group under the threshold has fewer titles than it, so one aggregation gathers the titles of all groups.
    """
    groups = titles.groupBy("domain", "keyword", "window_start", "window_end").agg(
        F.sum("n").alias("occurrences"), (F.collect_set if repeated else F.collect_list)("page_title").alias("titles"))
    return groups.filter(F.col("occurrences") >= threshold).select(
        "domain", "keyword", "window_start", "window_end", F.col("occurrences").cast("int").alias("occurrences"),
        _sample_text(F.col("titles")).alias("sample_pages"))


def keyword_bursts(events: DataFrame, window: str = "10 minutes", threshold: int = 5,
                   watermark: str | None = None, stop_words: Iterable[str] = STOP_WORDS,
                   min_len: int = MIN_KEYWORD_LENGTH) -> DataFrame:
    """Words seen at least ``threshold`` times in one window of one site.

    ``sample_pages`` lists every distinct title (sorted, ", "-joined). A batch counts per title first; a stream, which
    here knows one aggregation, keeps each group's titles in its state (``closed_titles`` keeps them apart).
    """
    if not events.isStreaming:
        return bursts_of_titles(_titles_of(title_tokens(events, stop_words, min_len), window), threshold)
    counts = keyword_counts(events, window, watermark, stop_words, min_len).filter(F.col("occurrences") >= threshold)
    return counts.select("domain", "keyword", "window_start", "window_end",
                         F.col("occurrences").cast("int").alias("occurrences"),
                         _sample_text(F.col("titles")).alias("sample_pages"))


def burst_alerts(bursts: DataFrame, alert_time: Column | str | None = None) -> DataFrame:
    """Alert rows for the breaking-news table."""
    spike = F.col("spike_ratio") if "spike_ratio" in bursts.columns else F.lit(None).cast("double")
    return bursts.select(
        "domain",
        alert_timestamp(alert_time).alias("alert_time"),
        F.lit("keyword_burst").alias("alert_type"),
        "keyword",
        spike.alias("spike_ratio"),
        F.col("occurrences").cast("int").alias("pages_count"),
        "sample_pages", "window_start", "window_end",
    )
