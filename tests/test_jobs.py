"""End-to-end jobs: the SSE ingest stream and the command-line analytics stream."""

from __future__ import annotations

import json
import os
import tempfile

from pageflow.schema import BOT_ACTIVITY, RAW_PAGES, SPAM_ALERTS
from pageflow.session import scratch_path
from pageflow.sources.events import parse_events, require_fields
from pageflow.sources.tables import read_latest
from pageflow.streaming.__main__ import main
from pageflow.streaming.ingest import start_ingest


def _frame(doc: dict) -> str:
    return f"event: message\nid: {doc.get('page', {}).get('page_id', 0)}\ndata: {json.dumps(doc)}\n\n"


def test_ingest_stream_sse_to_messages(spark):
    src = tempfile.mkdtemp(prefix="sse-in-")
    docs = [{"meta": {"domain": "en.example.org", "dt": f"2026-05-10T18:5{i}:10Z"},
             "page": {"page_id": i, "page_title": f"Page {i}"},
             "performer": {"user_id": i, "user_text": f"u{i}", "user_is_bot": i == 2}}
            for i in range(1, 4)]
    with open(os.path.join(src, "a.txt"), "w") as fh:
        fh.write(":ok\n\n" + _frame(docs[0]) + "data: not json\n\n")
    with open(os.path.join(src, "b.txt"), "w") as fh:
        fh.write(_frame(docs[1]) + _frame(docs[2]))
    base = scratch_path(spark, "test-ingest")
    q = start_ingest(spark, src, f"{base}/out", f"{base}/rejects", f"{base}/cp",
                     trigger={"availableNow": True}, max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    messages = spark.read.json(f"{base}/out")
    events = require_fields(parse_events(messages.select("value")))
    got = sorted((r.page_id, r.domain, r.page_title, r.is_bot) for r in events.collect())
    assert got == [(1, "en.example.org", "Page 1", False), (2, "en.example.org", "Page 2", True),
                   (3, "en.example.org", "Page 3", False)]
    rejects = spark.read.json(f"{base}/rejects").collect()
    assert [(r.value, r.reject_reason) for r in rejects] == [("not json", "not_json")]


def test_command_line_stream(spark):
    src = tempfile.mkdtemp(prefix="cli-in-")
    rows = [{"domain": "d", "page_id": i, "page_title": "http://spam" if i == 1 else "Normal title",
             "user_id": i, "user_name": f"u{i}", "is_bot": i == 3,
             "created_at": f"2024-01-01T00:00:0{i}Z", "title_length": 11} for i in range(1, 4)]
    with open(os.path.join(src, "events.json"), "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in rows) + "\n")
    base = scratch_path(spark, "test-cli")
    main(["--format", "text", "--path", src, "--tables", f"{base}/tables",
          "--checkpoints", f"{base}/cp", "--available-now"])
    assert read_latest(spark, RAW_PAGES, f"{base}/tables").count() == 3
    bots = read_latest(spark, BOT_ACTIVITY, f"{base}/tables").first()
    assert (bots.bot_pages, bots.human_pages) == (1, 2)
    spam = read_latest(spark, SPAM_ALERTS, f"{base}/tables").collect()
    assert [(r.page_id, r.reason) for r in spam] == [(1, "title_contains_url")]
