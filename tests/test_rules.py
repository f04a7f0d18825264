"""Hand-made rule rows: spam reasons, severity, tokeniser, keyword filters, bursts."""

from __future__ import annotations

from conftest import make_events
from pyspark.sql import functions as F

from pageflow.functions.rules import spam_reason
from pageflow.functions.text import keep_keyword, title_words
from pageflow.operators.keywords import keyword_bursts, title_tokens
from pageflow.operators.spam import spam_alerts


def _reason(spark, title, length="auto"):
    if length == "auto":
        length = len(title)
    df = spark.createDataFrame([(title, length)], "t string, n int")
    return df.select(spam_reason("t", "n").alias("r")).first()["r"]


def test_spam_rule_precedence(spark):
    assert _reason(spark, "see https://x.y/12345678") == "title_contains_url"
    assert _reason(spark, "WWW.site") == "title_contains_url"
    assert _reason(spark, "HTTP://caps") == "title_contains_url"
    assert _reason(spark, "x1234567") == "title_contains_many_digits"
    assert _reason(spark, "x123456") is None
    assert _reason(spark, "ab") == "title_too_short"
    assert _reason(spark, "abc") is None
    assert _reason(spark, "a" * 100) is None
    assert _reason(spark, "a" * 101) == "title_too_long"
    assert _reason(spark, "") == "title_too_short"
    # the supplied length decides; null length fires no length rule
    assert _reason(spark, "ab", None) is None
    # unanchored search also across a newline
    assert _reason(spark, "a\nhttp://x") == "title_contains_url"


def test_spam_alerts_bot_and_null_bot_excluded(spark):
    ev = make_events(spark, [
        ("d", 1, "http://spam", 5, "u5", False, "2024-01-01 00:00:01"),
        ("d", 2, "http://spam", 6, "u6", True, "2024-01-01 00:00:02"),
        ("d", 3, "http://spam", 7, "u7", None, "2024-01-01 00:00:03"),
        ("d", 4, "x1234567", 8, "u8", False, "2024-01-01 00:00:04"),
        ("d", 5, "ok title", 9, "u9", False, "2024-01-01 00:00:05"),
    ])
    rows = {r.page_id: (r.reason, r.severity)
            for r in spam_alerts(ev, "2024-01-01 00:01:00").collect()}
    assert rows == {1: ("title_contains_url", "high"), 4: ("title_contains_many_digits", "medium")}


def test_tokeniser_keeps_ukrainian_and_drops_others(spark):
    df = spark.createDataFrame([("Łódź café Ёлка привіт_світ",)], "t string")
    words = df.select(title_words("t").alias("w")).first()["w"]
    assert words == ["", "d", "caf", "лка", "привіт", "світ"]
    kept = [w for w in words if w and len(w) >= 4 and not w.isdigit()]
    assert kept == ["привіт", "світ"]


def test_tokens_file_name(spark):
    ev = make_events(spark, [("d", 1, "File:LongIslandNY_2002_149-6274498.tif", 1, "u", False,
                              "2024-01-01 00:00:00")])
    assert [r.keyword for r in title_tokens(ev).collect()] == ["file", "longislandny"]


def test_stop_words_only_matter_for_long_words(spark):
    df = spark.createDataFrame([("the",), ("that",), ("1234",), ("word",)], "w string")
    keep = [r.w for r in df.filter(keep_keyword("w")).collect()]
    assert keep == ["that", "word"]
    keep = [r.w for r in df.filter(keep_keyword("w", stop_words=["that"])).collect()]
    assert keep == ["word"]


def _burst_rows(n, title="Storm warning", minute=1):
    return [("d", i, title, i, f"u{i}", False, f"2024-01-01 00:0{minute}:{i:02d}") for i in range(n)]


def test_burst_threshold_inclusive(spark):
    five = keyword_bursts(make_events(spark, _burst_rows(5)))
    four = keyword_bursts(make_events(spark, _burst_rows(4)))
    assert {(r.keyword, r.occurrences) for r in five.collect()} == {("storm", 5), ("warning", 5)}
    assert four.count() == 0


def test_burst_word_twice_counts_twice(spark):
    rows = [("d", i, f"quake quake {i}", i, "u", False, "2024-01-01 00:00:00") for i in range(3)]
    out = keyword_bursts(make_events(spark, rows), threshold=5).collect()
    assert [(r.keyword, r.occurrences) for r in out] == [("quake", 6)]
    assert out[0].sample_pages == "quake quake 0, quake quake 1, quake quake 2"


def test_burst_window_edges(spark):
    rows = _burst_rows(4) + [("d", 99, "Storm warning", 1, "u", False, "2024-01-01 00:09:59.999999")]
    out = keyword_bursts(make_events(spark, rows)).collect()
    assert {r.occurrences for r in out} == {5}
    rows = _burst_rows(4) + [("d", 99, "Storm warning", 1, "u", False, "2024-01-01 00:10:00")]
    assert keyword_bursts(make_events(spark, rows)).count() == 0


def test_burst_lists_every_title(spark):
    rows = [("d", i, f"Flood {i:02d}", i, "u", False, "2024-01-01 00:00:00") for i in range(8)]
    rows.append(("d", 8, "Flood 03", 8, "u", False, "2024-01-01 00:09:59"))
    out = keyword_bursts(make_events(spark, rows)).collect()
    assert [(r.keyword, r.occurrences, r.sample_pages) for r in out] == [("flood", 9, ", ".join(f"Flood {i:02d}" for i in range(8)))]


def test_spam_uses_whole_title(spark):
    long_title = "x" * 5000 + " http://late.example"
    df = spark.createDataFrame([(long_title, len(long_title))], "t string, n int")
    assert df.select(spam_reason("t", "n")).first()[0] == "title_contains_url"
    assert df.select(F.length("t")).first()[0] == 5020


def test_numbers_out_of_range_are_no_time(spark):
    from pageflow.functions.timefn import parse_event_time

    values = ["NaN", "Infinity", "-Infinity", "1e30", "99999999999999", "1715360000000000", "1778440519"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r.t for r in df.select("v", parse_event_time("v").alias("t")).collect()]
    assert got[:6] == [None] * 6 and got[6] is not None
