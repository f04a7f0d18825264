"""Sharding by sampled splitters (DataFrame functions only).

Records are ordered by a key and cut into ranges at splitters drawn from a size-weighted sample; a range
whose exact size is over the limit is divided by further splitters. The exact size of every range then gives
each record its byte position in the whole order, and the shard is that position's share of all bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageflow.llm.common import as_columns, staged

SHARDS = 40
#: Ranges a shard is made of at least, rows a range should hold at most, and ranges at most: with the sampled
#: keys per range they bound what reaches the driver.
RANGES_PER_SHARD = 16
ROWS_PER_RANGE = 2_000_000
MAX_RANGES = 20_000
SAMPLES_PER_RANGE = 24
LOWEST = -1 << 63


def _range_of(splitters: list[tuple[int, int]]) -> Column:
    """Number of splitters at or below the row's (k1, k2), by bisection over two constant arrays."""
    n = len(splitters)
    if not n:
        return F.lit(0)
    first, second = F.lit([a for a, _ in splitters]), F.lit([b for _, b in splitters])
    steps = F.lit([1 << i for i in reversed(range(n.bit_length()))])

    def step(low: Column, by: Column) -> Column:
        at = low + by
        a, b = F.get(first, at - 1), F.get(second, at - 1)
        return F.when((at <= n) & ((a < F.col("k1")) | ((a == F.col("k1")) & (b <= F.col("k2")))), at).otherwise(low)

    return F.aggregate(steps, F.lit(0), step)


def _sample(rows: DataFrame, per_byte: float, salt: int) -> list[tuple[int, int, float]]:
    """Keys of a sample in which a row's chance grows with its size; each with the bytes it stands for."""
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(per_byte))
    drawn = (F.pmod(F.xxhash64("k1", "k2", F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))) < chance
    got = rows.where(drawn).select("k1", "k2", (F.col("size") / chance).alias("w")).collect()
    return sorted((r.k1, r.k2, r.w) for r in got)


def _quantiles(sample: list[tuple[int, int, float]], parts: int) -> list[tuple[int, int]]:
    """Keys that cut the sample's weight into ``parts`` near equal parts.

    The first cut in a group of equal k1 comes before the group; only a group of several parts is cut inside.
    """
    total, seen, out, n = sum(w for *_, w in sample), 0.0, [], 1
    for a, b, w in sample:
        seen += w
        if n < parts and seen >= total * n / parts:
            out.append((a, b) if out and out[-1][0] == a else (a, LOWEST))
            n = int(seen * parts / total) + 1
    return out


def splitters(rows: DataFrame, shards: int, ranges_per_shard: int = RANGES_PER_SHARD) -> tuple[list, list]:
    """(splitters, exact [rows, bytes] of each range) for rows (k1, k2, size).

    The sample has about ``SAMPLES_PER_RANGE`` keys for each of at most ``MAX_RANGES`` ranges, whatever the input's size.
    Ranges over twice the mean size are sampled again and divided, until none is or none can be.
    """
    total, n_rows = rows.agg(F.sum("size"), F.count("*")).first()
    if not total:
        return [], []
    want = min(MAX_RANGES, max(shards * ranges_per_shard, n_rows // ROWS_PER_RANGE))
    cuts = sorted(set(_quantiles(_sample(rows, want * SAMPLES_PER_RANGE / total, 0), want)))
    for salt in range(1, 9):
        sized = {r.r: (r.n, r.bytes, r.largest) for r in rows.groupBy(_range_of(cuts).alias("r")).agg(
            F.count("*").alias("n"), F.sum("size").alias("bytes"), F.max("size").alias("largest")).collect()}
        over = [r for r, (n, size, largest) in sized.items() if n > 1 and size > 2 * max(total / want, largest)]
        if not over:
            break
        inside = rows.withColumn("r", _range_of(cuts)).where(F.col("r").isin(over))
        again = _sample(inside.select("k1", "k2", "size"), want * SAMPLES_PER_RANGE / total, salt)
        more = set()
        for r in over:
            low, high = cuts[r - 1] if r else (LOWEST, LOWEST), cuts[r] if r < len(cuts) else (1 << 62, 0)
            own = [x for x in again if low <= x[:2] < high]
            more.update(_quantiles(own, int(sized[r][1] * want / total) + 2))
        if not more - set(cuts):
            break
        cuts = sorted(set(cuts) | more)
    return cuts, [sized.get(r, (0, 0))[:2] for r in range(len(cuts) + 1)]


def shard(docs: DataFrame, shards: int = SHARDS, ranges_per_shard: int = RANGES_PER_SHARD) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): ``shards`` shards of near equal bytes.

    ``size`` is the UTF-8 bytes of the text plus 16. Records are ordered by the text's hash and then the id,
    so equal texts lie together. Such a group goes to the shard of its middle if it has at most 1/16 of a shard's
    bytes; a larger one is divided by id where a shard ends. ``slot`` counts
    from 0 in each shard without gaps. A null text has no bytes and crc32 0; a null id sorts first; repeated
    rows each keep a row; an empty table gives none. Other columns are not read.
    """
    rows = staged(as_columns(docs, "doc_id", "text").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16).alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("k1"),
        F.coalesce("doc_id", F.lit(LOWEST)).cast("long").alias("k2")))
    cuts, sized = splitters(rows, shards, ranges_per_shard)
    before_rows, before_bytes = [0], [0]
    for n, size in sized:
        before_rows.append(before_rows[-1] + n)
        before_bytes.append(before_bytes[-1] + size)
    total = before_bytes[-1]
    in_range = Window.partitionBy("r").orderBy("k1", "k2", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (rows.withColumn("r", _range_of(cuts))
              .withColumn("at", F.get(F.lit(before_rows), F.col("r")) + F.row_number().over(in_range) - 1)
              .withColumn("to", F.get(F.lit(before_bytes), F.col("r")) + F.sum("size").over(in_range)))
    group = Window.partitionBy("r", "k1")  # whole, unless a splitter cuts it
    cut = F.array_contains(F.lit(sorted({a for a, b in cuts if b != LOWEST}) or [-1]), F.col("k1"))
    whole = ~cut & (F.sum("size").over(group) * (shards * 16) <= total)
    middle = (F.when(whole, F.min(F.col("to") - F.col("size")).over(group) + F.max("to").over(group))
              .otherwise(2 * F.col("to") - F.col("size")))
    placed = placed.withColumn("shard", F.least(
        F.lit(shards - 1), F.floor(middle.cast("decimal(38,0)") * shards / F.lit(2 * max(1, total)).cast("decimal(38,0)"))).cast("int"))
    placed = placed.select("doc_id", "size", F.col("k1").alias("text_crc32"), "shard", "at")
    begin = placed.groupBy("shard").agg(F.min("at").alias("begin"))  # a row per shard
    return (placed.join(F.broadcast(begin), "shard")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("at") - F.col("begin")).cast("long").alias("slot")))


def op3_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shard(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
