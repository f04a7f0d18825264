"""Keyed tables on plain Parquet: insert = upsert by primary key.

Layout below ``root/<table>/``::

    log/gen=G/batch_id=N/part-*.parquet   one directory per micro-batch
    base/upto=G-N/part-*.parquet         compacted snapshot of every log entry <= (G, N)

A micro-batch is written with mode ``overwrite`` into its own directory, so a
retried or replayed batch replaces exactly what it wrote before (idempotent
under executor loss and driver restarts). ``gen`` is raised by the caller
whenever a streaming checkpoint is discarded, because batch ids then restart
at 0 and would otherwise overwrite older batches.

Readers resolve the newest row per key: rows from higher (gen, batch_id) win;
inside one batch the table's own order decides (newest first), then the full
row, so the result is deterministic. In an additive table (``spec.merge``) the rows of a key are partial
aggregates of different batches and are merged instead. ``compact`` writes the resolved state as a new base; readers
only ever pick bases and log batches whose writer finished (``_SUCCESS``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageflow.operators.keyed import latest_per_key
from pageflow.schema import KEY_BUCKETS, TableSpec

_SUCCESS = "_SUCCESS"
#: Bytes of a row group in tables with Bloom filters.
LOOKUP_ROW_GROUP = 16 << 20


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def table_path(root: str, spec: TableSpec) -> str:
    return f"{root.rstrip('/')}/{spec.name}"


def upsert_batch(df: DataFrame, spec: TableSpec, root: str, gen: int, batch_id: int) -> None:
    """Write one batch of rows for ``spec``; re-running the same (gen, batch_id) is a no-op in effect."""
    path = f"{table_path(root, spec)}/log/gen={int(gen)}/batch_id={int(batch_id)}"
    df.select(*spec.columns).write.mode("overwrite").parquet(path)


def _latest_base(spark: SparkSession, spec: TableSpec, root: str) -> tuple[str, int, int] | None:
    base_dir = f"{table_path(root, spec)}/base"
    best = None
    for name in _children(spark, base_dir):
        if not name.startswith("upto="):
            continue
        gen, batch = (int(x) for x in name[len("upto="):].split("-"))
        if not path_exists(spark, f"{base_dir}/{name}/{_SUCCESS}"):
            continue  # an unfinished compaction
        if best is None or (gen, batch) > best[1:]:
            best = (f"{base_dir}/{name}", gen, batch)
    return best


def _finished_batches(spark: SparkSession, log_dir: str) -> list[tuple[int, int]]:
    """(gen, batch) of every log directory whose writer finished, in order; unfinished ones stay unseen."""
    fs, p = _fs(spark, f"{log_dir}/gen=*/batch_id=*/{_SUCCESS}")
    found = []
    for status in fs.globStatus(p) or []:  # one listing, however many batches
        batch = status.getPath().getParent()
        found.append((int(batch.getParent().getName()[len("gen="):]), int(batch.getName()[len("batch_id="):])))
    return sorted(found)


def _resolved(spark: SparkSession, spec: TableSpec, root: str,
              limit: tuple[int, int] | None = None, key_filter: Column | None = None,
              partition_filter: Column | None = None, partition_value: int | str | None = None
              ) -> tuple[DataFrame | None, tuple[int, int] | None]:
    """Newest row per key (only log entries up to ``limit`` when given), plus the last (gen, batch) it covers."""
    parts = []
    upto = None
    base = _latest_base(spark, spec, root)
    if base is not None:
        path, bgen, bbatch = base
        upto = (bgen, bbatch)
        if partition_value is None or not spec.partition:
            rows = spark.read.parquet(path)
        elif path_exists(spark, one := f"{path}/{spec.partition[0]}={partition_value}"):
            rows = spark.read.parquet(one)  # the other directories aren't even listed
        else:
            rows = spark.read.parquet(path).filter(F.lit(False))
        if partition_filter is not None and spec.partition:
            rows = rows.filter(partition_filter)
        if key_filter is not None:
            rows = rows.filter(key_filter)
        parts.append(rows.select(*spec.columns)
                     .withColumn("gen", F.lit(bgen)).withColumn("batch_id", F.lit(bbatch).cast("long")))
    log_dir = f"{table_path(root, spec)}/log"
    newer = [entry for entry in _finished_batches(spark, log_dir)
             if (upto is None or entry > upto) and (limit is None or entry <= limit)]
    if newer:
        # only the directories newer than the base are listed and read
        paths = [f"{log_dir}/gen={g}/batch_id={b}" for g, b in newer]
        log = spark.read.option("basePath", log_dir).parquet(*paths)
        if key_filter is not None:
            log = log.filter(key_filter)
        parts.append(log.select(*spec.columns, F.col("gen").cast("int").alias("gen"),
                                F.col("batch_id").cast("long").alias("batch_id")))
    if not parts:
        return None, None
    covered = max(newer, default=upto)
    if not newer:
        return parts[0], covered  # a base has one row per key already
    rows = parts[0]
    for extra in parts[1:]:
        rows = rows.unionByName(extra)
    if spec.merge:
        return rows.groupBy(*spec.key).agg(*[F.expr(agg).alias(c) for c, agg in spec.merge]).select(*spec.columns), covered
    prior = [(c, desc) for c, desc in spec.order if c not in spec.key]
    order = [("gen", True), ("batch_id", True), *prior,
             *[(c, False) for c in spec.columns if c not in spec.key and c not in dict(prior)]]
    return latest_per_key(rows, list(spec.key), order), covered


def read_latest(spark: SparkSession, spec: TableSpec, root: str, key_filter: Column | None = None,
                partition_filter: Column | None = None) -> DataFrame:
    """The table as of now: one row per primary key, newest write wins.

    ``key_filter`` may only reference key columns: it is applied before the
    newest version of each key is chosen, so it reaches the parquet scans
    (row-group skipping through min/max statistics). ``partition_filter``
    references the base's partition column (e.g. ``date``) and prunes whole
    directories of the compacted base; it must be implied by ``key_filter``.
    """
    resolved, _ = _resolved(spark, spec, root, key_filter=key_filter,
                            partition_filter=partition_filter)
    if resolved is None:
        raise FileNotFoundError(f"table {spec.name} has no data under {root}")
    return resolved.select(*spec.columns)


def read_key(spark: SparkSession, spec: TableSpec, root: str, value: int) -> DataFrame:
    """The rows of a table whose first key column is ``value``; for tables partitioned by that column's buckets.

    One directory of the base is listed and read; in it row groups are skipped by their statistics and Bloom filters.
    Batches newer than the base are read with the same filter.
    """
    name, expr = spec.partition
    key = spec.key[0]
    if expr != f"pmod({key}, {KEY_BUCKETS})":
        raise ValueError(f"table {spec.name} is not partitioned by buckets of {key}")
    wanted = F.col(key) == F.lit(value).cast("long")
    resolved, _ = _resolved(spark, spec, root, key_filter=wanted, partition_value=int(value) % KEY_BUCKETS)
    if resolved is None:
        raise FileNotFoundError(f"table {spec.name} has no data under {root}")
    return resolved.select(*spec.columns)


def compact(spark: SparkSession, spec: TableSpec, root: str, upto: tuple[int, int] | None = None,
            partition_by: list[str] | None = None) -> str | None:
    """Fold the log up to ``upto = (gen, batch_id)`` into a new base; returns its path.

    Only fold batches the stream has *committed* (e.g. the last batch id in the
    query's progress): a committed batch is never re-run, while an uncommitted
    one may be retried and must stay in the log so its retry still wins.
    Without ``upto`` everything present is folded (for a stopped stream).
    Old bases and log directories are left for a retention job; readers ignore
    log entries already covered by the newest finished base.
    """
    resolved, covered = _resolved(spark, spec, root, upto)
    if resolved is None:
        return None
    base = _latest_base(spark, spec, root)
    if base is not None and base[1:] == covered:
        return base[0]  # nothing newer to fold; its files are not rewritten while they are read
    upto = upto or covered
    path = f"{table_path(root, spec)}/base/upto={int(upto[0])}-{int(upto[1])}"
    rows = resolved.select(*spec.columns)
    parts = list(partition_by or [])
    if spec.partition and not parts:
        name, expr = spec.partition
        rows = rows.withColumn(name, F.expr(expr))
        parts = [name]
    order = parts + [c for c in spec.sort if c not in parts]
    if order:
        # range partitioning splits a busy day over many tasks and files (a hash
        # repartition by day would put a whole day into one task); rows are then
        # sorted inside each file so min/max statistics on the sort columns prune.
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    writer = rows.write.mode("overwrite")
    if parts:
        writer = writer.partitionBy(*parts)
    for column in spec.bloom:
        # a dictionary would take the place of the Bloom filter; small row groups keep a lookup's read small
        writer = (writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.enable.dictionary#{column}", "false")
                  .option("parquet.bloom.filter.adaptive.enabled", "true").option("parquet.block.size", str(LOOKUP_ROW_GROUP)))
    writer.parquet(path)
    return path
