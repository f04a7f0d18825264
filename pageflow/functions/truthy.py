"""Fallback chains with "first truthy value" semantics.

An empty string, a zero and null all fall through to the next candidate,
which is not what a bare ``coalesce`` does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nonblank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def nonzero(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


def first_truthy(*candidates: Column, default: Column | None = None, kind: str = "string") -> Column:
    """coalesce over the candidates with their falsy values nulled out."""
    wrap = nonblank if kind == "string" else nonzero
    parts = [wrap(c) for c in candidates]
    if default is not None:
        parts.append(default)
    return F.coalesce(*parts)
