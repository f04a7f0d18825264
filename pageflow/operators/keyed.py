"""Primary-key semantics: latest row per key and the raw fan-out tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageflow.schema import PAGES_BY_ID, PAGES_BY_USER, RAW_PAGES


def _order(order: Sequence[tuple[str, bool] | str | Column]) -> list[Column]:
    cols = []
    for item in order:
        if isinstance(item, tuple):
            name, descending = item
            cols.append(F.desc(name) if descending else F.asc(name))
        elif isinstance(item, str):
            cols.append(F.asc(item))
        else:
            cols.append(item)
    return cols


def latest_per_key(df: DataFrame, keys: Sequence[str],
                   order: Sequence[tuple[str, bool] | str | Column]) -> DataFrame:
    """Keep the first row of every key in ``order`` (give a total order for determinism).

    ``row_number() = 1`` is planned with a partial WindowGroupLimit before the
    shuffle, so even a key holding a third of the rows ships one row per map
    task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_order(order)))
    return df.withColumn("_rn", rank).filter(F.col("_rn") == 1).drop("_rn")


def raw_fanout(events: DataFrame) -> dict[str, DataFrame]:
    """One parsed batch -> the three query-shaped copies of the raw rows."""
    return {spec.name: events.select(*spec.columns) for spec in (RAW_PAGES, PAGES_BY_USER, PAGES_BY_ID)}


def pages_by_id_latest(pages: DataFrame, per_domain: bool = False) -> DataFrame:
    """``pages_by_id`` resolved: the newest row wins per page_id.

    Ids are only unique within a site, so ``per_domain=True`` keys by
    (domain, page_id) instead and keeps pages of different sites apart.
    """
    keys = ["domain", "page_id"] if per_domain else ["page_id"]
    return latest_per_key(pages.select(*PAGES_BY_ID.columns), keys,
                          [("created_at", True), ("domain", False)])
