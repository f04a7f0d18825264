"""Time helpers.

Batch inputs carry TIMESTAMP_NTZ (UTC wall clock). ``date_trunc`` would turn
those into session-zone TIMESTAMPs, so bucketing here is done with
``timestamp_diff`` / ``timestamp_add``, which keep the NTZ type and do not
depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "1970-01-01 00:00:00"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_between(start: Column | str, end: Column | str) -> Column:
    """end - start in microseconds (bigint), exact."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return micros_between(start, end) / F.lit(1_000_000.0)


def minutes_window_start(ts: Column | str, minutes: int) -> Column:
    """Epoch-aligned bucket start for an NTZ timestamp, as ``window(ts, 'N minutes').start``."""
    ts = _c(ts)
    epoch = F.lit(_EPOCH_NTZ).cast("timestamp_ntz")
    us = micros_between(epoch, ts)
    return F.timestamp_add("MICROSECOND", us - F.pmod(us, F.lit(minutes * 60_000_000)), epoch)


def hour_floor(ts: Column | str) -> Column:
    """Start of the UTC hour of an NTZ timestamp."""
    return minutes_window_start(ts, 60)


_LAST_SECOND = 253_402_300_799.0  # 9999-12-31 23:59:59 UTC


def parse_event_time(value: Column | str) -> Column:
    """ISO-8601 text (``Z`` or an offset, optional fraction) or epoch seconds -> TIMESTAMP.

    Invalid text and numbers out of range give null (``try_to_timestamp`` / ``try_cast``), so ANSI mode
    can stay on while bad rows are filtered out downstream.
    """
    value = _c(value)
    seconds = value.try_cast("double")
    # a number beyond the year 9999 (NaN and infinity too) is no time; NaN compares as the largest
    in_range = F.abs(seconds) <= F.lit(_LAST_SECOND)
    return (F.when(seconds.isNull(), F.try_to_timestamp(value))
            .when(in_range, F.timestamp_micros(F.round(seconds * 1_000_000).cast("long"))))


def parse_text_time(value: Column | str) -> Column:
    """ISO-8601 text -> TIMESTAMP, null if it is none; a number is no epoch time here ("2024" is a year)."""
    return F.try_to_timestamp(_c(value))


def alert_timestamp(value: Column | str | None = None) -> Column:
    """Alert write time: a given NTZ text / Column, else the query's current timestamp."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, str):
        return F.lit(value).cast("timestamp_ntz")
    return value


# newest_key: (time descending, id ascending) packed into one DECIMAL(38,0)
_KEY_TYPE = "decimal(38,0)"
_ID_SPAN = "100000000000000000000"        # 10^20 > every shifted long id
_ID_OFFSET = "9223372036854775808"        # 2^63 shifts any long id to >= 0


def newest_key(ts: Column | str, row_id: Column | str) -> Column:
    """A sortable key whose ``max`` is the newest row, the smallest id breaking ties.

    ``micros(ts) * 10^20 + (10^20 - 1 - (id + 2^63))`` is exact for any long id
    and fits DECIMAL(38,0). Unlike ``max(struct(...))`` (a struct buffer, which
    forces a sort-based aggregate), ``max(key)`` / ``max_by(x, key)`` keep
    fixed-width buffers and run as hash aggregates.
    """
    ts, row_id = _c(ts), _c(row_id)
    micros = micros_between(F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), ts.cast("timestamp_ntz"))
    span = F.lit(_ID_SPAN).cast(_KEY_TYPE)
    shifted = row_id.cast(_KEY_TYPE) + F.lit(_ID_OFFSET).cast(_KEY_TYPE)
    return (micros.cast(_KEY_TYPE) * span + (span - F.lit(1).cast(_KEY_TYPE) - shifted)).cast(_KEY_TYPE)
