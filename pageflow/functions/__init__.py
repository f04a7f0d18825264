"""Column-level building blocks (all JVM built-ins, no Python UDFs)."""

from pageflow.functions.rules import severity, spam_reason
from pageflow.functions.text import STOP_WORDS, keep_keyword, title_words
from pageflow.functions.timefn import (alert_timestamp, hour_floor, micros_between,
                                       minutes_window_start, parse_event_time, seconds_between)
from pageflow.functions.truthy import first_truthy, nonblank, nonzero

__all__ = [
    "STOP_WORDS", "keep_keyword", "title_words", "severity", "spam_reason",
    "alert_timestamp", "hour_floor", "micros_between", "minutes_window_start", "parse_event_time",
    "seconds_between", "first_truthy", "nonblank", "nonzero",
]
