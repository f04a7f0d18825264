"""Result export: JSON documents and key/value messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.functions.timefn import micros_between


def iso_text(ts: Column | str) -> Column:
    """ISO-8601 text of a UTC timestamp, fraction only when non-zero (like ``datetime.isoformat``)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    ntz = ts.cast("timestamp_ntz")
    second = F.date_format(ntz, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ntz),
                    F.lit(1_000_000))
    return F.when(ts.isNull(), F.lit(None).cast("string")) \
        .when(micros == 0, second) \
        .otherwise(F.concat(second, F.lit("."), F.lpad(micros.cast("string"), 6, "0")))


def with_iso_times(df: DataFrame) -> DataFrame:
    """Every timestamp column rendered as ISO text; other columns unchanged."""
    out = df
    for name, dtype in df.dtypes:
        if dtype in ("timestamp", "timestamp_ntz"):
            out = out.withColumn(name, iso_text(name))
    return out


def export_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write rows as JSON lines with ISO timestamps (one file per partition, in parallel)."""
    with_iso_times(df).write.mode(mode).json(path)


def alerts_to_key_value(alerts: DataFrame, key: str = "domain") -> DataFrame:
    """Alert rows in the message shape of an alert topic: key = site, value = JSON document."""
    doc = with_iso_times(alerts)
    return doc.select(F.col(key).alias("key"), F.to_json(F.struct(*doc.columns)).alias("value"))
