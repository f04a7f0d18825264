"""The ingest stream: captured SSE dumps -> canonical events as key/value messages.

Replaces a single-process "read HTTP stream, normalise, send one message,
flush" loop with a file-stream query: new dump files are picked up per
trigger, frames are split by the text source (``lineSep``), every frame is
normalised in parallel, and each micro-batch is written once to the event
sink and once (rejects) to a dead-letter sink. Both writes are keyed by the
batch id, so a retried batch replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pageflow.sources.events import to_key_value
from pageflow.sources.normalize import normalize_events
from pageflow.sources.sse import read_sse_dump


def _batch_writer(out_path: str, rejects_path: str, fmt: str, ingest_time):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            good, bad = normalize_events(batch, ingest_time=ingest_time)
            messages = to_key_value(good)
            messages.write.mode("overwrite").format(fmt).save(f"{out_path}/batch_id={batch_id}")
            bad.write.mode("overwrite").format(fmt).save(f"{rejects_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write


def start_ingest(spark: SparkSession, sse_path: str, out_path: str, rejects_path: str,
                 checkpoint: str, trigger: dict | None = None, fmt: str = "json",
                 max_files_per_trigger: int | None = None, ingest_time=None) -> StreamingQuery:
    """Start the SSE -> messages query. ``fmt`` is any batch format ("json", "parquet", ...).

    On a cluster with the Kafka connector, send ``to_key_value`` output to the
    event topic instead; the key is the site and the value the event JSON.
    """
    frames = read_sse_dump(spark, sse_path, streaming=True,
                           max_files_per_trigger=max_files_per_trigger)
    return (frames.writeStream.queryName("pageflow_ingest")
            .foreachBatch(_batch_writer(out_path, rejects_path, fmt, ingest_time))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"}))
            .start())
