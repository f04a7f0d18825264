"""Title tokeniser and keyword filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the original behaviour: the characters that
# count as part of a word (Latin, basic Cyrillic plus the Ukrainian letters,
# digits) and the stop-word list.
WORD_CHARS = "A-Za-zА-Яа-яІіЇїЄєҐґ0-9"
NON_WORD_RUN = f"[^{WORD_CHARS}]+"
STOP_WORDS = (
    "the", "and", "of", "in", "on", "for", "to", "a", "an",
    "та", "і", "в", "у", "на", "з", "до", "для",
    "de", "la", "le", "el", "en", "der", "die", "das",
)
MIN_KEYWORD_LENGTH = 4


def title_words(title: Column | str) -> Column:
    """array<string> of lower-cased words; separators become empty strings at the edges."""
    title = F.col(title) if isinstance(title, str) else title
    return F.split(F.lower(F.regexp_replace(title, NON_WORD_RUN, " ")), r"\s+")


def keep_keyword(word: Column | str, stop_words: Iterable[str] = STOP_WORDS,
                 min_len: int = MIN_KEYWORD_LENGTH) -> Column:
    """Predicate: non-empty, not a stop word, at least ``min_len`` characters, not all digits."""
    word = F.col(word) if isinstance(word, str) else word
    cond = (word != "") & (F.length(word) >= min_len) & ~word.rlike("^[0-9]+$")
    stop_words = list(stop_words)
    if stop_words:
        cond = cond & ~word.isin(stop_words)
    return cond
