"""Event stream readers and parsing (canonical JSON events -> typed rows)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageflow.functions.timefn import parse_text_time
from pageflow.schema import EVENT_COLUMNS, EVENT_SCHEMA, REQUIRED_FIELDS


def read_event_stream(spark: SparkSession, fmt: str, options: dict | None = None,
                      schema: T.StructType | None = None, path: str | None = None) -> DataFrame:
    """Streaming source, format-parametrised.

    ``fmt="kafka"`` with ``subscribe`` / ``startingOffsets`` options when the
    connector is on the classpath; ``"text"`` / ``"json"`` file streams (with
    ``maxFilesPerTrigger``) elsewhere. Kafka rows carry a binary ``value``; text
    rows a string ``value``; both feed :func:`parse_events`.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def parse_once(df: DataFrame, fields: list[Column]) -> DataFrame:
    """Evaluate ``fields`` (struct-producing expressions included) exactly once per row.

    Catalyst pushes filters below projections by substituting aliases, and the
    JSON optimizer then splits a pushed ``from_json(...).f IS NOT NULL`` into
    one parse per referenced field. Producing the columns through a generator
    (``inline`` of a one-element array) is a boundary filters cannot cross, so
    every JSON document is parsed once however many fields are tested later.
    """
    return df.select(F.inline(F.array(F.struct(*fields))))


def parse_events(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text (or Kafka bytes) -> typed event rows with ``created_at`` as TIMESTAMP.

    PERMISSIVE ``from_json``: unparsable text gives an all-null row (removed by
    :func:`require_fields`); a wrongly typed field gives null for that field.
    """
    text = F.col(value_col).cast("string")
    parsed = parse_once(raw, [F.from_json(text, EVENT_SCHEMA).alias("data")]).select("data.*")
    return parsed.withColumn("created_at", parse_text_time("created_at")).select(*EVENT_COLUMNS)


def require_fields(events: DataFrame, fields=REQUIRED_FIELDS) -> DataFrame:
    """Drop rows where any required field is null (one filter, pushed to the scan)."""
    return events.filter(reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in fields]))


def to_key_value(events: DataFrame) -> DataFrame:
    """The message shape of the event topic: key = domain, value = the event as JSON.

    created_at is written as ISO-8601 text with an explicit UTC offset.
    """
    body = F.struct(
        "domain", "page_id", "page_title", "user_id", "user_name", "is_bot",
        F.date_format(F.col("created_at").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .alias("created_at"),
        "title_length",
    )
    return events.select(F.col("domain").alias("key"), F.to_json(body).alias("value"))
