"""Hourly report, editor patterns (both gap forms), lookups and argument checks."""

from __future__ import annotations

import pytest
from conftest import SF_CHECK, make_events
from pyspark.sql import functions as F

from pageflow.operators import lookups, reports
from pageflow.sources.fixtures import page_events


def _report_events(spark):
    return make_events(spark, [
        ("d", 1, "t", 1, "alice", False, "2024-01-01 10:05:00"),
        ("d", 2, "t", 1, "alice", False, "2024-01-01 10:06:00"),
        ("d", 3, "t", 2, "bob", True, "2024-01-01 10:07:00"),
        ("d", 4, "t", 3, "", None, "2024-01-01 10:08:00"),          # empty name -> unknown, null -> human
        ("d", 5, "t", 4, None, False, "2024-01-01 10:09:00"),       # null name -> unknown
        ("d", 6, "t", 5, "carol", False, "2024-01-01 11:00:00"),
        ("d", 7, "t", 5, "carol", False, "2024-01-01 12:00:00"),    # as_of is inclusive
        ("d", 8, "t", 5, "carol", False, "2024-01-01 05:59:59"),    # outside 6 hours
        ("e", 9, "t", 6, "dave", False, "2024-01-01 10:00:00"),
    ])


def test_hourly_report_one_domain(spark):
    rows = reports.hourly_report(_report_events(spark), "d", 6, "2024-01-01 12:00:00") \
        .orderBy("time_start").collect()
    assert [r.time_start.hour for r in rows] == [10, 11, 12]
    h10 = rows[0]
    assert (h10.pages_created, h10.unique_authors) == (5, 4)
    assert h10.bot_percent == 20.0
    names = [(a.name, a.pages, a.is_bot) for a in h10.top_authors]
    # ties on pages go to the author active most recently (unknown: 10:09, alice: 10:06)
    assert names == [("unknown", 2, False), ("alice", 2, False), ("bob", 1, True)]
    assert h10.time_end.hour == 11


def test_hourly_report_bounds_and_rounding(spark):
    with pytest.raises(ValueError):
        reports.hourly_report(_report_events(spark), "d", 25, "2024-01-01 12:00:00")
    ev = make_events(spark, [("d", i, "t", i, f"u{i}", i < 1, "2024-01-01 10:00:00") for i in range(32)])
    r = reports.hourly_report(ev, "d", 6, "2024-01-01 12:00:00").first()
    assert r.bot_percent == 3.12          # 3.125 rounds half to even
    assert len(r.top_authors) == 10


def test_editor_patterns_and_lag_form_agree(spark):
    pe = page_events(spark, SF_CHECK)
    tele = reports.editor_patterns(pe, min_pages=1).select("user_id", "avg_seconds_between_pages")
    lag = reports.editor_gaps(pe).select("user_id", F.col("avg_seconds_between_pages").alias("lag"))
    lag10 = reports.editor_gaps(pe, bucket_minutes=60).select("user_id", F.col("avg_seconds_between_pages").alias("lag60"))
    rows = tele.join(lag, "user_id").join(lag10, "user_id").collect()
    assert len(rows) == pe.select("user_id").distinct().count()
    for r in rows:
        assert r.avg_seconds_between_pages == r.lag == r.lag60


def test_editor_patterns_fields(spark):
    ev = make_events(spark, [
        ("a.org", 1, "t", 7, "old", False, "2024-01-01 01:00:00"),
        ("b.org", 2, "t", 7, "new", True, "2024-01-01 03:00:00"),
        ("a.org", 3, "t", 7, "mid", False, "2024-01-01 02:00:00"),
        ("a.org", 4, "t", 8, "solo", False, "2024-01-01 02:00:00"),
    ])
    rows = {r.user_id: r for r in reports.editor_patterns(ev, min_pages=1).collect()}
    r = rows[7]
    assert (r.user_name, r.is_bot, r.pages_created, r.domains_count) == ("new", True, 3, 2)
    assert r.domains == ["a.org", "b.org"] and r.active_hours_utc == [1, 2, 3]
    assert r.avg_seconds_between_pages == 3600.0 and r.has_domain_specialization is False
    assert rows[8].avg_seconds_between_pages is None and rows[8].has_domain_specialization is True
    assert set(r.user_id for r in reports.editor_patterns(ev, min_pages=2).collect()) == {7}
    with pytest.raises(ValueError):
        reports.editor_patterns(ev, min_pages=0)


def test_pages_by_domain_range_needs_both_ends(spark):
    ev = make_events(spark, [("d", i, "t", 1, "u", False, f"2024-01-01 0{i}:00:00") for i in range(1, 6)])
    ids = lambda df: sorted(r.page_id for r in df.collect())
    both = lookups.pages_by_domain(ev, "d", "2024-01-01T02:00:00Z", "2024-01-01T04:00:00+00:00")
    assert ids(both) == [2, 3, 4]
    assert ids(lookups.pages_by_domain(ev, "d", "2024-01-01T02:00:00Z", None)) == [1, 2, 3, 4, 5]
    assert ids(lookups.pages_by_domain(ev, "d", None, "2024-01-01T02:00:00Z")) == [1, 2, 3, 4, 5]
    assert ids(lookups.pages_by_domain(ev, "d")) == [1, 2, 3, 4, 5]
    # an offset is converted to UTC
    assert ids(lookups.pages_by_domain(ev, "d", "2024-01-01T04:00:00+02:00", "2024-01-01T03:00:00Z")) == [2, 3]
    with pytest.raises(ValueError):
        lookups.pages_by_domain(ev, "d", "yesterday", "today")
    first = lookups.pages_by_domain(ev, "d", limit=2).collect()
    assert [r.page_id for r in first] == [5, 4]


def test_lookup_limits_and_filters(spark):
    ev = make_events(spark, [("d", 1, "t", 1, "u", False, "2024-01-01 00:00:00")])
    for bad in (0, 501):
        with pytest.raises(ValueError):
            lookups.pages_by_user(ev, 1, limit=bad)
    assert lookups.page_by_id(ev, 2).count() == 0
    assert lookups.page_by_id(ev, 1).count() == 1
    spam = spark.createDataFrame(
        [("d", "high"), ("d", "low"), ("e", "low")], "domain string, severity string"
    ).withColumn("alert_time", F.lit("2024-01-01").cast("timestamp_ntz")) \
     .withColumn("created_at", F.col("alert_time")).withColumn("page_id", F.lit(1))
    assert lookups.alert_rows(spam, " d ", severity="low").count() == 1
    assert lookups.alert_rows(spam, "  ", severity="all").count() == 3
    with pytest.raises(ValueError):
        lookups.alert_rows(spam, severity="urgent")


def test_reports_come_in_order(spark):
    ev = _report_events(spark)
    hours = [(r.time_start, r.domain) for r in reports.hourly_report(ev, None, 24, "2024-01-01 12:00:00").collect()]
    assert hours == sorted(hours) and hours
    editors = [(-r.pages_created, r.user_id) for r in reports.editor_patterns(ev, 1).collect()]
    assert editors == sorted(editors) and editors
