"""All registered queries and oracle statements, gathered from the plan modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pageflow.plans import catalog, ingest, streams
from pageflow.session import use_utc


def _in_utc(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        return query(spark, sf_dir)
    run.__name__ = getattr(query, "__name__", "query")
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(catalog.QUERIES)
    out.update(streams.QUERIES)
    out.update(ingest.QUERIES)
    return {name: _in_utc(q) for name, q in out.items()}


def oracle_sql() -> dict[str, str]:
    out = dict(catalog.ORACLE_SQL)
    out.update(streams.ORACLE_SQL)
    out.update(ingest.ORACLE_SQL)
    return out
