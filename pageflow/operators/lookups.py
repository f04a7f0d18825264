"""Point lookups and range reads over the keyed tables.

Each is filter -> total order -> limit, which plans as a pushed-down filter
plus TakeOrderedAndProject (a per-partition top-n, then a merge of n rows per
partition); nothing is sorted globally.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _check_limit(limit: int, hi: int = 500) -> None:
    if not 1 <= limit <= hi:
        raise ValueError(f"limit must be within 1..{hi}")


def _clean_domain(domain: str | None) -> str | None:
    if domain is None:
        return None
    domain = domain.strip()
    return domain or None


def parse_iso(value: str) -> str:
    """ISO-8601 argument (``Z`` allowed) -> UTC wall-clock text for an NTZ literal."""
    try:
        parsed = datetime.fromisoformat(value.replace("Z", "+00:00"))
    except ValueError as exc:
        raise ValueError(f"invalid ISO timestamp: {value!r}") from exc
    if parsed.tzinfo is not None:
        parsed = parsed.astimezone(timezone.utc).replace(tzinfo=None)
    return parsed.isoformat(sep=" ")


def page_by_id(pages: DataFrame, page_id: int) -> DataFrame:
    """The page row(s) with this id; an empty result means not found."""
    return pages.filter(F.col("page_id") == F.lit(page_id).cast("long"))


def pages_by_user(pages: DataFrame, user_id: int, limit: int = 100) -> DataFrame:
    _check_limit(limit)
    return (pages.filter(F.col("user_id") == F.lit(user_id).cast("long"))
            .orderBy(F.desc("created_at"), "page_id").limit(limit))


def pages_by_domain(pages: DataFrame, domain: str, start: str | None = None, end: str | None = None,
                    limit: int = 100) -> DataFrame:
    """Newest pages of a site; the inclusive [start, end] range applies only when both are given."""
    _check_limit(limit)
    out = pages.filter(F.col("domain") == domain)
    if start and end:
        lo, hi = parse_iso(start), parse_iso(end)
        out = out.filter(F.col("created_at").between(F.lit(lo).cast("timestamp_ntz"),
                                                     F.lit(hi).cast("timestamp_ntz")))
    return out.orderBy(F.desc("created_at"), "page_id").limit(limit)


def metric_rows(metrics: DataFrame, domain: str | None = None, limit: int = 100) -> DataFrame:
    """Language or bot metric rows, newest window first within each site."""
    _check_limit(limit)
    domain = _clean_domain(domain)
    out = metrics if domain is None else metrics.filter(F.col("domain") == domain)
    return out.orderBy("domain", F.desc("window_start")).limit(limit)


def alert_rows(alerts: DataFrame, domain: str | None = None, limit: int = 100,
               severity: str | None = None) -> DataFrame:
    """Spam or burst alert rows, newest first within each site; optional severity filter."""
    _check_limit(limit)
    domain = _clean_domain(domain)
    out = alerts if domain is None else alerts.filter(F.col("domain") == domain)
    if severity not in (None, "all"):
        if severity not in ("low", "medium", "high"):
            raise ValueError("severity must be one of all, low, medium, high")
        out = out.filter(F.col("severity") == severity)
    if "keyword" in out.columns:
        order = ["domain", F.desc("window_start"), "keyword"]
    else:
        order = ["domain", F.desc("alert_time"), F.desc("created_at"), "page_id"]
    return out.orderBy(*order).limit(limit)
