"""Raw-event normalisation (truthiness chains, time parsing, rejects) and SSE framing."""

from __future__ import annotations

import json
import os
import tempfile
from datetime import datetime, timezone

from pyspark.sql import functions as F

from pageflow.sources.events import parse_events, require_fields, to_key_value
from pageflow.sources.normalize import normalize_events
from pageflow.sources.sse import read_sse_dump

INGEST = "2026-01-01 00:00:00"


def _norm(spark, docs):
    texts = [(d if isinstance(d, str) else json.dumps(d, ensure_ascii=False),) for d in docs]
    raw = spark.createDataFrame(texts, "value string")
    good, bad = normalize_events(raw, ingest_time=INGEST)
    good = good.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
    return good.collect(), bad.collect()


def test_complete_and_flat_fallbacks(spark):
    complete = {"meta": {"domain": "en.example.org", "dt": "2026-05-10T18:55:10Z"},
                "page": {"page_id": 11, "page_title": "Alpha"},
                "performer": {"user_id": 5, "user_text": "Ann", "user_is_bot": True}}
    flat = {"database": "desite", "page_id": 12, "title": "Beta", "user": "Bob", "bot": True,
            "timestamp": "2026-05-10T19:15:19.228+00:00"}
    (a, b), bad = _norm(spark, [complete, flat])
    assert bad == []
    assert (a.domain, a.page_id, a.page_title, a.user_id, a.user_name, a.is_bot, a.title_length) == \
        ("en.example.org", 11, "Alpha", 5, "Ann", True, 5)
    assert a.created_at == datetime(2026, 5, 10, 18, 55, 10)
    assert (b.domain, b.page_id, b.page_title, b.user_id, b.user_name, b.is_bot) == \
        ("desite", 12, "Beta", 0, "Bob", True)
    assert b.created_at == datetime(2026, 5, 10, 19, 15, 19, 228000)


def test_truthiness_fall_through(spark):
    docs = [
        {"meta": {"domain": ""}, "database": "ensite", "page": {"page_id": 1}, "dt": "2026-05-10T00:00:00Z"},
        {"page": {"page_id": 0, "id": 7}, "dt": "2026-05-10T00:00:00Z"},
        {"page": {"page_id": 0}, "dt": "2026-05-10T00:00:00Z"},
        {"page": {"page_id": 3}, "performer": {"user_id": 0, "id": 9, "user_text": "", "name": "Nia"},
         "dt": "2026-05-10T00:00:00Z"},
    ]
    rows, _ = _norm(spark, docs)
    assert rows[0].domain == "ensite"
    assert rows[1].page_id == 7
    assert rows[2].page_id == 0                   # the last operand is kept even when zero
    assert (rows[3].user_id, rows[3].user_name) == (9, "Nia")


def test_empty_object_gets_defaults(spark):
    (r,), _ = _norm(spark, [{}])
    assert (r.domain, r.page_title, r.user_id, r.user_name, r.is_bot) == ("unknown", "", 0, "unknown", False)
    assert r.created_at == datetime(2026, 1, 1)
    assert 0 <= r.page_id < 10_000_000_000
    (again,), _ = _norm(spark, [{}])
    assert again.page_id == r.page_id             # stable, unlike a per-process string hash


def test_time_forms_and_bad_time(spark):
    docs = [{"page": {"page_id": 1}, "timestamp": 1778440519},
            {"page": {"page_id": 2}, "meta": {"dt": "garbage"}},
            {"page": {"page_id": 3}, "meta": None, "dt": "2026-05-10T18:55:10Z"}]
    rows, bad = _norm(spark, docs)
    assert [b.reject_reason for b in bad] == ["bad_time"]
    expect = datetime.fromtimestamp(1778440519, tz=timezone.utc).replace(tzinfo=None)
    assert rows[0].created_at == expect
    assert rows[1].created_at == datetime(2026, 5, 10, 18, 55, 10)   # null meta = absent
    raw = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")
    good, _ = normalize_events(raw, ingest_time=INGEST)
    assert sorted(r.page_id for r in require_fields(good).collect()) == [1, 3]


def test_rejects_and_code_points(spark):
    rows, bad = _norm(spark, ["not json", "[1, 2]", {"page": {"page_id": 5, "title": "Łódź café 😀"}}])
    assert sorted((b.value, b.reject_reason) for b in bad) == [
        ("[1, 2]", "not_a_json_object"), ("not json", "not_json")]
    assert rows[0].title_length == 11


def test_parse_events_permissive(spark):
    raw = spark.createDataFrame([
        ('{"domain":"d","page_id":1,"page_title":"t","user_id":2,"created_at":"2026-05-10T18:55:10Z"}',),
        ('{"domain":"d","page_id":"x","page_title":"t","user_id":2,"created_at":"2026-05-10T18:55:10Z"}',),
        ('{"domain":"d","page_id":3,"page_title":5,"user_id":2,"created_at":"2026-05-10T18:55:10Z"}',),
        ("broken",),
    ], "value string")
    rows = require_fields(parse_events(raw)).collect()
    assert sorted((r.page_id, r.page_title) for r in rows) == [(1, "t"), (3, "5")]


def test_key_value_round_trip(spark):
    raw = spark.createDataFrame([("d", 1, "Ünï", 2, "u", True, "2026-05-10 18:55:10.5", 3)],
                                "domain string, page_id long, page_title string, user_id long, "
                                "user_name string, is_bot boolean, created_at string, title_length int")
    ev = raw.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
    kv = to_key_value(ev).first()
    assert kv.key == "d" and '"page_title":"Ünï"' in kv.value
    back = parse_events(spark.createDataFrame([(kv.value,)], "value string")).first()
    assert back.created_at.replace(tzinfo=None) == datetime(2026, 5, 10, 18, 55, 10, 500000)


def test_sse_frames(spark):
    text = (":ok\n\n"
            "event: message\nid: 1\ndata: {\"meta\": {\"domain\": \"a\"}}\n\n"
            "data: {\"meta\":\ndata:  {\"domain\": \"b\"}}\n\n"
            "event: ping\nid: 2\n\n")
    d = tempfile.mkdtemp(prefix="sse-")
    with open(os.path.join(d, "dump.txt"), "w") as fh:
        fh.write(text)
    values = [r.value for r in read_sse_dump(spark, d).collect()]
    assert values == ['{"meta": {"domain": "a"}}', '{"meta":\n{"domain": "b"}}']
    good, bad = normalize_events(read_sse_dump(spark, d), ingest_time=INGEST)
    assert sorted(r.domain for r in good.collect()) == ["a", "b"] and bad.count() == 0


def test_each_required_field_null_drops_the_row(spark):
    full = {"domain": "d", "page_id": 1, "page_title": "t", "user_id": 2, "user_name": "u",
            "is_bot": False, "created_at": "2026-05-10T18:55:10Z", "title_length": 1}
    docs = [full]
    for field in ("domain", "page_id", "created_at", "page_title", "user_id"):
        doc = dict(full, page_id=full["page_id"] + len(docs))
        doc[field] = None
        docs.append(doc)
    # optional fields may be null
    docs.append(dict(full, page_id=99, user_name=None, is_bot=None, title_length=None))
    raw = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")
    kept = sorted(r.page_id for r in require_fields(parse_events(raw)).collect())
    assert kept == [1, 99]


def test_mixed_types_lose_no_event(spark):
    t = {"dt": "2026-05-10T18:55:10Z"}
    docs = [{"page": {"page_id": 5.0}, "performer": {"user_is_bot": 1}, **t},
            {"page": {"page_id": "6"}, "performer": {"user_is_bot": "true"}, **t},
            {"page": {"page_id": 7}, "performer": {"user_is_bot": 0}, "bot": False, **t},
            {"page": "x", "page_id": 8, **t},
            {"page": {"page_id": "abc"}, **t},
            {"page": {"page_id": 9}, "user_id": "abc", **t},
            '{"page": {"page_id": 10}', "[]",
            {"page": {"page_id": 11}, "timestamp": 1e30}]
    rows, bad = _norm(spark, docs)
    assert sorted((r.page_id, r.is_bot) for r in rows) == [(5, True), (6, True), (7, False), (8, False)]
    assert sorted(b.reject_reason for b in bad) == ["bad_id", "bad_id", "bad_time", "not_a_json_object", "not_json"]


def test_text_time_of_the_event_stream_is_no_epoch(spark):
    docs = [{"domain": "d", "page_id": i, "page_title": "t", "user_id": 1, "created_at": t}
            for i, t in enumerate(["2024", "1715360000000000", "NaN", "2024-05-10T18:55:10Z"])]
    rows = parse_events(spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")).collect()
    assert [r.created_at and r.created_at.year for r in rows] == [2024, None, None, 2024]


def test_sse_line_ends(spark):
    for end in ("\n", "\r\n"):
        for separator in ("\n\n", "\r\n\r\n"):
            d = tempfile.mkdtemp(prefix="sse-")
            with open(os.path.join(d, "dump.txt"), "w", newline="") as fh:
                fh.write(end.join(["data: {}", "", "data: {", "data: }", "  ", "data: [1]", "", ""]))
            assert sorted(r.value for r in read_sse_dump(spark, d, separator=separator).collect()) == ["[1]", "{\n}", "{}"]
