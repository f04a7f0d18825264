"""Keyed tables: replay safety, newest write wins, compaction, generations."""

from __future__ import annotations

from pageflow.schema import TableSpec
from pageflow.session import scratch_path
from pageflow.sources.tables import compact, read_latest, upsert_batch

SPEC = TableSpec("t", ("k", "v", "w"), ("k",))


def _df(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, w long")


def _state(spark, root):
    return sorted(tuple(r) for r in read_latest(spark, SPEC, root).collect())


def test_upsert_replay_and_compaction(spark):
    root = scratch_path(spark, "test-tables")
    upsert_batch(_df(spark, [(1, "a", 1), (2, "b", 1)]), SPEC, root, 0, 0)
    upsert_batch(_df(spark, [(2, "B", 2), (3, "c", 2)]), SPEC, root, 0, 1)
    first = _state(spark, root)
    assert first == [(1, "a", 1), (2, "B", 2), (3, "c", 2)]
    # replaying a batch id with the same rows changes nothing
    upsert_batch(_df(spark, [(2, "B", 2), (3, "c", 2)]), SPEC, root, 0, 1)
    assert _state(spark, root) == first
    # a retried batch that produced other rows replaces its earlier attempt entirely
    upsert_batch(_df(spark, [(3, "c2", 3)]), SPEC, root, 0, 1)
    assert _state(spark, root) == [(1, "a", 1), (2, "b", 1), (3, "c2", 3)]
    # compaction keeps the resolved state; later batches still win over the base
    assert compact(spark, SPEC, root).endswith("upto=0-1")
    assert _state(spark, root) == [(1, "a", 1), (2, "b", 1), (3, "c2", 3)]
    upsert_batch(_df(spark, [(1, "A", 4)]), SPEC, root, 0, 2)
    assert _state(spark, root) == [(1, "A", 4), (2, "b", 1), (3, "c2", 3)]
    # a new generation (checkpoint discarded, batch ids restart) wins over older batches
    upsert_batch(_df(spark, [(2, "g1", 5)]), SPEC, root, 1, 0)
    assert _state(spark, root) == [(1, "A", 4), (2, "g1", 5), (3, "c2", 3)]
    compact(spark, SPEC, root)
    assert _state(spark, root) == [(1, "A", 4), (2, "g1", 5), (3, "c2", 3)]


def test_duplicate_keys_in_one_batch_resolve_deterministically(spark):
    root = scratch_path(spark, "test-tables")
    upsert_batch(_df(spark, [(1, "x", 2), (1, "a", 9), (1, "a", 3)]), SPEC, root, 0, 0)
    assert _state(spark, root) == [(1, "a", 3)]


def test_raw_layout_and_pruned_reads(spark):
    from datetime import datetime

    from pyspark.sql import functions as F

    from pageflow.schema import RAW_PAGES
    from pageflow.sources.fixtures import page_events

    root = scratch_path(spark, "test-layout")
    pe = page_events(spark, "/root/testdata/sf0.001").select(*RAW_PAGES.columns)
    shifted = pe.withColumn("created_at", F.timestamp_add("DAY", F.lit(1), F.col("created_at")))
    upsert_batch(pe, RAW_PAGES, root, 0, 0)
    upsert_batch(shifted, RAW_PAGES, root, 0, 1)
    base = compact(spark, RAW_PAGES, root)
    days = sorted(r.date.isoformat() for r in spark.read.parquet(base).select("date").distinct().collect())
    assert days == ["2024-01-01", "2024-01-02"]
    lo, hi = datetime(2024, 1, 2, 3), datetime(2024, 1, 2, 5)
    key = (F.col("domain") == "example.com/view") & F.col("created_at").between(F.lit(lo), F.lit(hi))
    part = F.col("date") == F.lit("2024-01-02").cast("date")
    got = read_latest(spark, RAW_PAGES, root, key, part)
    expect = shifted.filter(key)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expect.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "EqualTo(domain,example.com/view)" in plan


def test_newest_row_of_a_batch_wins_and_unfinished_batches_stay_unseen(spark):
    import os

    from pageflow.schema import PAGES_BY_ID
    from tests.conftest import make_events

    root = scratch_path(spark, "test-tables")
    rows = make_events(spark, [("a", 1, "old", 1, "u", False, "2024-01-01 00:00:00"),
                               ("b", 1, "new", 1, "u", False, "2024-01-01 00:00:01")])
    upsert_batch(rows, PAGES_BY_ID, root, 0, 0)
    assert [r.page_title for r in read_latest(spark, PAGES_BY_ID, root).collect()] == ["new"]
    upsert_batch(rows.filter("domain = 'a'"), PAGES_BY_ID, root, 0, 1)
    os.remove(f"{root}/{PAGES_BY_ID.name}/log/gen=0/batch_id=1/_SUCCESS")
    assert [r.page_title for r in read_latest(spark, PAGES_BY_ID, root).collect()] == ["new"]
    base = compact(spark, PAGES_BY_ID, root)
    assert base.endswith("upto=0-0") and compact(spark, PAGES_BY_ID, root) == base
    plan = read_latest(spark, PAGES_BY_ID, root)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_compact_of_an_empty_batch(spark):
    root = scratch_path(spark, "test-tables")
    assert compact(spark, SPEC, root) is None
    upsert_batch(_df(spark, []), SPEC, root, 0, 0)
    compact(spark, SPEC, root)
    assert _state(spark, root) == []
