"""The documents table to mixed, sharded training data, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last return the
columns of the documents table. ``run`` applies them one after the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.llm import decontamination, mixing, quality, sharding, similarity
from pageflow.llm.common import staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and boilerplate lines of the others."""
    good = quality.keep_good(docs)
    if "n_chars" in good.columns:
        good = good.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return good


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the least doc_id."""
    return similarity.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix uses them, by training position."""
    return mixing.mix(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    return sharding.shard(docs)


STAGES = [("quality rules", quality_stage), ("n-gram Jaccard join", jaccard_stage), ("benchmark decontamination", decontamination_stage),
          ("mixing sources", mixing_stage), ("sharding", sharding_stage)]

#: The mix and the shards depend on hash orders that SQL engines don't share; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's rows are staged below ``spark.checkpoint.dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs)
    return docs
