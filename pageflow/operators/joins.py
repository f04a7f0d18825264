"""Join helpers: broadcast only a side whose size has been measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_ROW_OVERHEAD = 16


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes (-1 = never broadcast)."""
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    raw = raw.strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix):
            return int(float(raw[: -len(suffix)]) * units[suffix])
    return int(raw)


def payload_bytes(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Exact payload size of the given string/binary columns plus a fixed per-row overhead."""
    cols = columns or [f.name for f in df.schema.fields]
    width = F.lit(DEFAULT_ROW_OVERHEAD)
    for name in cols:
        dtype = df.schema[name].dataType.typeName()
        if dtype in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
        else:
            width = width + F.lit(8)
    return F.sum(width)


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, exact payload bytes) of ``df`` from one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("n"), payload_bytes(df).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def checked_broadcast(df: DataFrame, max_bytes: int | None = None,
                      size: int | None = None) -> tuple[DataFrame, bool]:
    """Return (df, broadcast?) after measuring df's exact size with one aggregate.

    Within the limit the side is persisted (the broadcast and any later query
    over the same plan read the cache, and so does a repeated size check) and
    wrapped in ``broadcast()``. Beyond it nothing is cached and the caller's
    join stays a shuffle join (sort-merge, with AQE skew handling), so an
    unexpectedly large side costs a re-read, never executor memory. ``size``
    skips the measurement when the caller already has it (see :func:`measure`).
    """
    limit = broadcast_limit(df) if max_bytes is None else max_bytes
    if limit <= 0:
        return df, False
    if size is None:
        size = measure(df)[1]
    if size <= limit:
        return F.broadcast(df.persist()), True
    return df, False
