"""Structured Streaming: late data under the watermark, empty batches, dedup, replay safety."""

from __future__ import annotations

import json
import os
import tempfile

from pageflow.schema import LANGUAGE_ACTIVITY, RAW_PAGES
from pageflow.session import scratch_path
from pageflow.sources.events import parse_events, read_event_stream, require_fields
from pageflow.sources.tables import read_latest
from pageflow.streaming.runner import run_available_now


def _event(pid, ts, domain="d"):
    return json.dumps({"domain": domain, "page_id": pid, "page_title": "title", "user_id": pid,
                       "user_name": f"u{pid}", "is_bot": False,
                       "created_at": f"2024-01-01T{ts}Z", "title_length": 5})


def _write_files(batches):
    d = tempfile.mkdtemp(prefix="stream-in-")
    for i, lines in enumerate(batches):
        path = os.path.join(d, f"part-{i:03d}.json")
        with open(path, "w") as fh:
            fh.write("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    return d


def _run(spark, batches, **kwargs):
    src = _write_files(batches)
    raw = read_event_stream(spark, "text", {"maxFilesPerTrigger": 1}, path=src)
    events = require_fields(parse_events(raw))
    base = scratch_path(spark, "test-stream")
    queries = run_available_now(events, f"{base}/tables", f"{base}/cp", **kwargs)
    return f"{base}/tables", {q.name.split("_")[1]: q for q in queries}


def _windows(spark, root):
    rows = read_latest(spark, LANGUAGE_ACTIVITY, root).collect()
    return {r.window_start.strftime("%H:%M"): r.pages_created for r in rows}


def test_late_row_accepted_one_batch_after_watermark_then_dropped(spark):
    root, queries = _run(spark, [
        [_event(1, "00:00:05")],
        [_event(2, "00:05:00")],
        [_event(3, "00:00:55")],                      # watermark 00:03:00 not yet applied: accepted
        [_event(4, "00:00:56"), _event(5, "00:05:01")],  # dropped as late
    ])
    assert _windows(spark, root) == {"00:00": 2, "00:05": 2}
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in queries["metrics"].recentProgress for op in p.get("stateOperators", []))
    assert dropped == 1
    # the stateless raw table keeps every row, late or not
    assert read_latest(spark, RAW_PAGES, root).count() == 5


def test_resent_event_counts_twice_unless_dedup(spark):
    batches = [[_event(1, "00:00:05"), _event(1, "00:00:05")], [_event(2, "00:00:10")]]
    root, _ = _run(spark, batches)
    assert _windows(spark, root) == {"00:00": 3}
    assert read_latest(spark, RAW_PAGES, root).count() == 2     # the raw table is keyed
    root, _ = _run(spark, batches, dedup=True)
    assert _windows(spark, root) == {"00:00": 2}


def test_alert_messages_written_per_batch(spark):
    src = _write_files([[_event(1, "00:00:05").replace('"title"', '"http://spam"')]])
    raw = read_event_stream(spark, "text", {"maxFilesPerTrigger": 1}, path=src)
    base = scratch_path(spark, "test-stream")
    run_available_now(require_fields(parse_events(raw)), f"{base}/tables", f"{base}/cp",
                      alert_messages=f"{base}/messages")
    msgs = spark.read.json(f"{base}/messages/spam-alerts").collect()
    assert len(msgs) == 1 and msgs[0].key == "d"
    doc = json.loads(msgs[0].value)
    assert doc["reason"] == "title_contains_url" and doc["created_at"] == "2024-01-01T00:00:05"
