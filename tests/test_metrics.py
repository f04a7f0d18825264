"""Windowed metrics: null is_bot handling, invariants on the driver's tables, HLL accuracy."""

from __future__ import annotations

from conftest import SF_CHECK, SF_SMALL, make_events
from pyspark.sql import functions as F

from pageflow.operators import enrich, keywords, metrics, reports
from pageflow.sources.fixtures import page_events


def test_null_is_bot_counts_in_total_only(spark):
    ev = make_events(spark, [
        ("d", 1, "alpha", 1, "a", True, "2024-01-01 00:00:01"),
        ("d", 2, "beta", 2, "b", False, "2024-01-01 00:00:02"),
        ("d", 3, "gamma", 3, "c", None, "2024-01-01 00:00:59.999999"),
    ])
    r = metrics.bot_activity(ev).first()
    assert (r.bot_pages, r.human_pages) == (1, 1)
    assert abs(r.bot_percent - 100 / 3) < 1e-12
    lang = metrics.language_activity(ev, exact=True).first()
    assert lang.pages_created == 3 and lang.unique_authors == 3 and lang.trend == "stable"
    assert abs(lang.avg_title_length - 14 / 3) < 1e-12


def test_avg_title_length_ignores_null_lengths(spark):
    ev = make_events(spark, [
        ("d", 1, "abcd", 1, "a", False, "2024-01-01 00:00:01", 4),
        ("d", 2, "ab", 2, "b", False, "2024-01-01 00:00:02", None),
    ])
    assert metrics.language_activity(ev, exact=True).first().avg_title_length == 4.0


def test_invariants_on_driver_tables(spark):
    pe = page_events(spark, SF_SMALL)
    dm = metrics.domain_minute(pe, exact=True)
    lang = metrics.language_activity(pe, exact=True)
    bots = metrics.bot_activity(pe)
    # (i) same (domain, window) keys
    k1 = {(r.domain, r.window_start) for r in lang.select("domain", "window_start").collect()}
    k2 = {(r.domain, r.window_start) for r in bots.select("domain", "window_start").collect()}
    assert k1 == k2
    rows = dm.collect()
    for r in rows:
        assert r.pages_created == r.bot_pages + r.human_pages          # (ii)
        assert abs(r.bot_percent - 100 * r.bot_pages / r.pages_created) < 1e-9   # (iii)
        assert r.unique_authors <= r.pages_created                     # (vi)
    # (iv) latest window row per domain = max window_start
    latest = {r.domain: r.latest_window_start for r in reports.latest_per_domain(lang).collect()}
    expect = {r.domain: r.m for r in lang.groupBy("domain").agg(F.max("window_start").alias("m")).collect()}
    assert latest == expect
    # (v) every digits alert has a 7-digit run and no URL
    from pageflow.operators.spam import spam_alerts
    for r in spam_alerts(pe, "2024-01-01 12:00:00").filter("reason = 'title_contains_many_digits'").collect():
        import re
        assert re.search("[0-9]{7,}", r.page_title) and not re.search("(?i)(https?://|www\\.)", r.page_title)


def test_hll_close_to_exact_on_large_groups(spark):
    pe = page_events(spark, SF_CHECK)
    # hour-long windows give groups of >= 20 authors
    approx = metrics.language_activity(pe, window="1 hour").alias("a")
    exact = metrics.language_activity(pe, window="1 hour", exact=True).alias("e")
    joined = approx.join(exact, ["domain", "window_start"]).filter(F.col("e.unique_authors") >= 20)
    rows = joined.select(F.col("a.unique_authors").alias("a"), F.col("e.unique_authors").alias("e")).collect()
    assert rows
    for r in rows:
        assert abs(r.a - r.e) / r.e <= 0.15


def test_trend_against_adjacent_window(spark):
    ev = make_events(spark, [("d", i, "t", i, "u", False, t) for i, t in enumerate([
        "2024-01-01 00:00:01",                                              # 1 page
        "2024-01-01 00:01:01", "2024-01-01 00:01:02", "2024-01-01 00:01:03",  # 3 pages -> up
        "2024-01-01 00:02:01",                                              # 1 page -> down
        "2024-01-01 00:03:01",                                              # 1 page -> stable
        "2024-01-01 00:05:01",                                              # gap: prev 0 -> up
    ])])
    lang = metrics.language_activity(ev, exact=True)
    got = [(r.window_start.minute, r.trend, r.previous_pages)
           for r in enrich.with_trend(lang).orderBy("window_start").collect()]
    assert got == [(0, "up", 0), (1, "up", 1), (2, "down", 3), (3, "stable", 1), (5, "up", 0)]


def test_top_actors_json(spark):
    ev = make_events(spark, [
        ("d", 1, "t", 1, "alice", False, "2024-01-01 00:00:01"),
        ("d", 2, "t", 1, "alice", False, "2024-01-01 00:00:02"),
        ("d", 3, "t", 2, "bob", False, "2024-01-01 00:00:03"),
        ("d", 4, "t", 3, "botty", True, "2024-01-01 00:00:04"),
    ])
    r = enrich.top_actors(ev).first()
    assert r.top_humans == '[{"name":"alice","pages":2},{"name":"bob","pages":1}]'
    assert r.top_bots == '[{"name":"botty","pages":1}]'


def test_spike_ratio_uses_previous_six_windows(spark):
    rows = []
    pid = 0
    for window, n in [(0, 2), (1, 4), (7, 6)]:           # 10-minute windows 0, 1 and 7
        for i in range(n):
            pid += 1
            minute = window * 10
            rows.append(("d", pid, "storm", pid, "u", False,
                         f"2024-01-01 {minute // 60:02d}:{minute % 60:02d}:{i:02d}"))
    counts = keywords.keyword_counts(make_events(spark, rows), titles=False)
    got = {r.window_start.hour * 60 + r.window_start.minute: r.spike_ratio
           for r in enrich.spike_ratio(counts).collect()}
    assert got[0] is None
    assert got[10] == 2 * 6 / 2 * 2          # 4 / (2 / 6)
    assert got[70] == 6 * 6 / 4              # windows 10..60 hold 4 (window 0 is 70 min back)


def test_adapter_join_same_without_broadcast(spark):
    def rows():
        return sorted(tuple(r) for r in metrics.language_activity(page_events(spark, SF_SMALL), exact=True).collect())

    broadcast_rows = rows()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = metrics.language_activity(page_events(spark, SF_SMALL), exact=True)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert rows() == broadcast_rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_overview_one_pass_equals_three_tables(spark):
    from pageflow.operators import summaries
    from pageflow.operators.spam import spam_alerts

    pe = page_events(spark, SF_SMALL)
    three = summaries.overview(metrics.language_activity(pe, exact=True), keywords.keyword_bursts(pe),
                               spam_alerts(pe, "2024-01-01 12:00:00")).first()
    one = summaries.overview_from_events(pe).first()
    assert one.asDict() == three.asDict()
    assert one.breaking_alerts > 0 and one.spam_alerts > 0
