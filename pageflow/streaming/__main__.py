"""Run the analytics stream: ``python -m pageflow.streaming --help``.

Examples::

    # Kafka topic (connector on the classpath), 30-second micro-batches
    python -m pageflow.streaming --format kafka \\
        --option kafka.bootstrap.servers=broker:9092 --option subscribe=page-create \\
        --option startingOffsets=latest --tables /shared/tables

    # JSON-lines files arriving in a folder
    python -m pageflow.streaming --format text --path /shared/incoming --tables /shared/tables

Checkpoints go below ``--checkpoints`` or, by default, the session's
``spark.checkpoint.dir``. Raise ``--gen`` whenever the checkpoints are discarded.
"""

from __future__ import annotations

import argparse

from pageflow.session import checkpoint_root, get_session
from pageflow.sources.events import parse_events, read_event_stream, require_fields
from pageflow.streaming.runner import start_all


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m pageflow.streaming")
    ap.add_argument("--format", default="kafka")
    ap.add_argument("--option", action="append", default=[], help="source option key=value")
    ap.add_argument("--path", default=None, help="source path for file formats")
    ap.add_argument("--tables", required=True, help="root of the keyed result tables")
    ap.add_argument("--checkpoints", default=None)
    ap.add_argument("--trigger-seconds", type=int, default=30)
    ap.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    ap.add_argument("--gen", type=int, default=0)
    ap.add_argument("--watermark", default="2 minutes")
    ap.add_argument("--burst-threshold", type=int, default=5)
    ap.add_argument("--dedup", action="store_true")
    ap.add_argument("--closed-windows", action="store_true", help="also write each window once, when it is closed")
    args = ap.parse_args(argv)

    spark = get_session(app_name="pageflow-stream")
    options = dict(kv.split("=", 1) for kv in args.option)
    raw = read_event_stream(spark, args.format, options, path=args.path)
    events = require_fields(parse_events(raw))
    checkpoints = args.checkpoints or f"{checkpoint_root(spark)}/pageflow-stream/gen={args.gen}"
    trigger = {"availableNow": True} if args.available_now else {
        "processingTime": f"{args.trigger_seconds} seconds"}
    queries = start_all(events, args.tables, checkpoints, trigger, args.gen, args.watermark,
                        args.burst_threshold, args.dedup, closed_windows=args.closed_windows)
    if args.available_now:
        for q in queries:
            q.awaitTermination()
    else:
        # one failing query ends the process, as with the original job
        spark.streams.awaitAnyTermination()
    failed = [q.name for q in queries if q.exception() is not None]
    if failed:
        raise SystemExit(f"streaming queries failed: {failed}")


if __name__ == "__main__":
    main()
