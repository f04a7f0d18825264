"""Spam rules on page titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reason and severity labels, the URL and digit-run patterns and
# the length limits. Rules are checked in this order; the first match wins.
REASON_URL = "title_contains_url"
REASON_DIGITS = "title_contains_many_digits"
REASON_SHORT = "title_too_short"
REASON_LONG = "title_too_long"
URL_PATTERN = r"(?i)(https?://|www\.)"
DIGIT_RUN_PATTERN = "[0-9]{7,}"
MIN_TITLE_LENGTH = 3
MAX_TITLE_LENGTH = 100


def spam_reason(title: Column | str = "page_title", length: Column | str = "title_length") -> Column:
    """First matching rule, or null.

    The length rules use the supplied length column, so a null length fires no
    length rule. The patterns are unanchored searches, which also covers titles
    that contain newlines.
    """
    title = F.col(title) if isinstance(title, str) else title
    length = F.col(length) if isinstance(length, str) else length
    return (F.when(title.rlike(URL_PATTERN), F.lit(REASON_URL))
            .when(title.rlike(DIGIT_RUN_PATTERN), F.lit(REASON_DIGITS))
            .when(length < MIN_TITLE_LENGTH, F.lit(REASON_SHORT))
            .when(length > MAX_TITLE_LENGTH, F.lit(REASON_LONG)))


def severity(reason: Column | str = "reason") -> Column:
    reason = F.col(reason) if isinstance(reason, str) else reason
    return (F.when(reason == REASON_URL, F.lit("high"))
            .when(reason == REASON_DIGITS, F.lit("medium"))
            .otherwise(F.lit("low")))
