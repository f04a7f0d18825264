"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.session import checkpoint_root, materialize

#: Rows of a narrow table (a few numbers each) up to which a join broadcasts it: about 30 MB.
BROADCAST_ROWS = 400_000
#: Rows of a narrow table that a task writes, so that small tables don't become many tiny files.
TASK_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint below ``spark.checkpoint.dir``.

    For narrow tables that several later steps read; a lost executor then costs no recomputation
    of what came before. The files go when the DataFrame is garbage-collected.
    """
    checkpoint_root(df.sparkSession)
    return materialize(df)


def join_narrow(big: DataFrame, narrow: DataFrame, on, how: str) -> DataFrame:
    """Join with a staged narrow table: broadcast up to ``BROADCAST_ROWS`` counted rows, else a shuffle join."""
    if narrow.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        narrow = F.broadcast(narrow)
    return big.join(narrow, on, how)


def as_columns(docs: DataFrame, *names: str) -> DataFrame:
    """Only the columns an operator reads, so that extra ones can't clash with its own."""
    return docs.select(*names)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b long) as (id, component_id = smallest id).

    Alternating large and small stars: every round joins an edge list with one minimum per node, the
    minimum being aggregated before the shuffle, so a node of any degree is never gathered. Rounds grow
    with the logarithm of the longest path; each ends in a reliable checkpoint. Empty edges give no row.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = staged(pairs)
    before, n = None, pairs.count()
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        # a round has about as many pairs as the one before
        pairs = staged(small.coalesce(-(-n // TASK_ROWS) or 1))
        now = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("u").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, n = now, now[0]
    return (pairs.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
            .unionByName(pairs.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()))
