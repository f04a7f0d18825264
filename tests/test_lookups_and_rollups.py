"""Lookups that skip directories and row groups, and reports from merged partial aggregates."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from pageflow.operators import reports
from pageflow.schema import AUTHOR_HOURS, KEY_BUCKETS, PAGES_BY_ID, PAGES_BY_USER, RAW_PAGES
from pageflow.session import scratch_path
from pageflow.sources import tables
from pageflow.sources.tables import compact, read_key, read_latest, upsert_batch
from tests.conftest import make_events


def _pages(spark, ids):
    return spark.range(1).select(F.explode(F.lit(ids)).alias("page_id")).select(
        F.lit("d").alias("domain"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("page_id")).alias("created_at"), "page_id",
        F.concat(F.lit("title "), "page_id").alias("page_title"), (F.col("page_id") % 50).alias("user_id"), F.lit("u").alias("user_name"),
        F.lit(False).alias("is_bot"), F.lit(7).alias("title_length"))


@pytest.fixture(scope="module")
def stored(spark):
    root = scratch_path(spark, "test-lookup")
    # in every bucket only every third id is there
    pages = spark.range(0, 60_000).select((F.col("id") % KEY_BUCKETS + KEY_BUCKETS * 3 * F.floor(F.col("id") / KEY_BUCKETS)).alias("page_id"))
    pages = pages.select(F.lit("d").alias("domain"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("page_id")).alias("created_at"), "page_id",
                         F.lit("t").alias("page_title"), (F.col("page_id") % 500).alias("user_id"), F.lit("u").alias("user_name"),
                         F.lit(False).alias("is_bot"), F.lit(1).alias("title_length"))
    for spec in (PAGES_BY_ID, PAGES_BY_USER):
        upsert_batch(pages, spec, root, 0, 0)
        compact(spark, spec, root)
    return root, pages


def _scan(frame, metric):
    frame.collect()
    leaf = frame._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get(metric).get().value()


def test_a_lookup_reads_one_directory(spark, stored):
    root, _ = stored
    found = read_key(spark, PAGES_BY_ID, root, 3 * KEY_BUCKETS + 5)
    assert [r.page_id for r in found.collect()] == [3 * KEY_BUCKETS + 5]
    assert {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()} == {"5"}


def test_an_id_that_isnt_there_is_skipped_by_the_bloom_filter(spark, stored):
    root, _ = stored
    absent = KEY_BUCKETS + 5  # between the ids of its bucket, so no range excludes it
    found = read_key(spark, PAGES_BY_ID, root, absent)
    assert found.count() == 0 and _scan(found, "numOutputRows") == 0
    assert _scan(read_key(spark, PAGES_BY_ID, root, 5), "numOutputRows") > 0
    spark.conf.set("parquet.filter.bloom.enabled", "false")
    try:
        assert _scan(read_key(spark, PAGES_BY_ID, root, absent), "numOutputRows") > 0  # without it the rows are read
    finally:
        spark.conf.unset("parquet.filter.bloom.enabled")


def test_lookup_by_user_and_of_newer_batches(spark, stored):
    root, pages = stored
    want = {r.page_id for r in pages.where("user_id = 42").collect()}
    assert {r.page_id for r in read_key(spark, PAGES_BY_USER, root, 42).collect()} == want and want
    other = scratch_path(spark, "test-lookup")
    upsert_batch(_pages(spark, [1, 2]), PAGES_BY_ID, other, 0, 0)
    compact(spark, PAGES_BY_ID, other)
    upsert_batch(_pages(spark, [2, 3]).withColumn("page_title", F.lit("new")), PAGES_BY_ID, other, 0, 1)
    assert [[r.page_title for r in read_key(spark, PAGES_BY_ID, other, i).collect()] for i in (1, 2, 3, 4)] == [["title 1"], ["new"], ["new"], []]
    with pytest.raises(ValueError):
        read_key(spark, RAW_PAGES, other, 1)
    with pytest.raises(FileNotFoundError):
        read_key(spark, PAGES_BY_ID, scratch_path(spark, "test-lookup"), 1)


EVENTS = [("a", 1, "x", 1, "ann", False, "2024-01-01 00:00:05"), ("a", 2, "x", 1, "ann", True, "2024-01-01 00:59:59"),
          ("b", 3, "x", 1, "anna", None, "2024-01-01 03:00:00"), ("a", 4, "x", 2, "", False, "2024-01-01 00:10:00"),
          ("a", 5, "x", 3, None, True, "2024-01-01 00:10:00"), ("a", 6, "x", 2, "bob", False, "2024-01-01 05:59:59.999999"),
          ("b", 7, "x", 2, "bob", False, "2024-01-01 03:30:00"), ("a", 8, "x", 1, "ann", False, "2024-01-01 00:00:05")]


def _rows(frame):
    return [tuple(str(x) for x in r) for r in frame.collect()]


@pytest.mark.parametrize("compacted", [None, 0, 1, 2])
def test_reports_from_the_rollup_equal_the_direct_ones(spark, compacted):
    """Events in any order over three batches, the second written twice, compacted after one of them or never."""
    events, root = make_events(spark, EVENTS), scratch_path(spark, "test-rollup")
    for batch, ids in ((0, [6, 3, 5]), (1, [1, 8]), (1, [1, 4, 8]), (2, [2, 7])):  # late rows in the later ones
        upsert_batch(reports.author_hours(events.filter(F.col("page_id").isin(ids))), AUTHOR_HOURS, root, 0, batch)
        if batch == compacted and ids != [1, 8]:
            compact(spark, AUTHOR_HOURS, root)
    rollup = read_latest(spark, AUTHOR_HOURS, root)
    as_of = "2024-01-01 06:00:00"
    assert _rows(reports.hourly_report_from(rollup, None, 6, as_of)) == _rows(reports.hourly_report(events, None, 6, as_of))
    assert _rows(reports.hourly_report_from(rollup, "a", 1, as_of)) == _rows(reports.hourly_report(events, "a", 1, as_of))
    assert _rows(reports.editor_patterns_from(rollup, 1)) == _rows(reports.editor_patterns(events, 1))
    assert rollup.groupBy(*AUTHOR_HOURS.key).count().where("count > 1").count() == 0


def test_rollup_reads_only_its_days(spark):
    events, root = make_events(spark, EVENTS), scratch_path(spark, "test-rollup")
    upsert_batch(reports.author_hours(events), AUTHOR_HOURS, root, 0, 0)
    base = compact(spark, AUTHOR_HOURS, root)
    assert os.path.isdir(f"{base}/date=2024-01-01")
    day = F.col("date") == F.lit("2024-01-02").cast("date")
    assert read_latest(spark, AUTHOR_HOURS, root, partition_filter=day).count() == 0
    assert tables.read_latest(spark, AUTHOR_HOURS, root, F.col("domain") == "b").count() == 2


def test_report_arguments_are_checked(spark):
    rollup = reports.author_hours(make_events(spark, EVENTS))
    for call in (lambda: reports.hourly_report_from(rollup, hours=25), lambda: reports.editor_patterns_from(rollup, 0)):
        with pytest.raises(ValueError):
            call()
