"""JSON export with ISO timestamps and alert messages."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from pageflow.session import scratch_path
from pageflow.sources.export import alerts_to_key_value, export_json, iso_text


def test_iso_text_like_isoformat(spark):
    df = spark.createDataFrame([("2024-01-01 05:00:00",), ("2024-01-01 05:00:00.228",), (None,)], "s string")
    got = [r.i for r in df.select(iso_text(F.col("s").cast("timestamp_ntz")).alias("i")).collect()]
    assert got == ["2024-01-01T05:00:00", "2024-01-01T05:00:00.228000", None]


def test_export_and_messages(spark):
    df = spark.createDataFrame([("d", 1, "2024-01-01 05:00:00.5")], "domain string, page_id long, t string") \
        .withColumn("t", F.col("t").cast("timestamp"))
    path = scratch_path(spark, "test-export")
    export_json(df, path)
    back = spark.read.json(path).first()
    assert back.t == "2024-01-01T05:00:00.500000" and back.page_id == 1
    msg = alerts_to_key_value(df).first()
    assert msg.key == "d" and json.loads(msg.value) == {"domain": "d", "page_id": 1,
                                                         "t": "2024-01-01T05:00:00.500000"}
