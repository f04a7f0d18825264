"""Centroid clustering by Shallot search: exact k-means over integers with bounded vectors.

Every vector remembers its nearest and its second-nearest centroid, an upper bound of its distance to the one and a
lower bound of its distance to all others; centroid movements loosen the bounds. A vector whose bounds still part is
left where it is. For the others the search starts from the closer of the two remembered centroids and goes through
that one's neighbours in order of distance. The ball that can hold a nearest or second-nearest centroid has the radius
(distance to the start) + (distance to the second so far), so it shrinks while the search goes on. Bounds are floats
rounded outwards and only ever exclude; what they leave is compared by exact integer distances, ties to the lower number.

Vectors carry their bounds from round to round in one table, cut by a checkpoint. A task sends, for each centroid, the
sum of the vectors that came and went: the driver holds nothing but centroids and their sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.llm.common import staged

SIZE = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
SEED = "2:"
#: Components beyond it would not leave room for a squared distance in 64 bits.
LIMIT = 1 << 27
_UP, _DOWN = 1 + 1e-9, 1 - 1e-9
ROWS = "vec_id long, vector binary, near int, second int, upper double, lower double, distance long, of int, sums binary, n long"


def whole_vectors(embeddings: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector): vectors of exactly ``size`` finite components as integers floor(scale * x), packed as int32."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            flat = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            good = np.isfinite(flat).all(axis=1)
            whole = np.floor(scale * flat[good])
            if len(whole) and np.abs(whole).max() > LIMIT:
                raise ValueError(f"a component of an embedding exceeds {LIMIT // scale}: squared distances need more than 64 bits")
            whole = np.ascontiguousarray(whole, dtype="<i4")
            offsets = pa.array(np.arange(len(whole) + 1) * size * 4, pa.int32())
            vectors = pa.Array.from_buffers(pa.binary(), len(whole), [None, offsets.buffers()[1], pa.py_buffer(whole)])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").filter(pa.array(good)), vectors], ["vec_id", "vector"])

    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where((F.size("embedding") == size) & ~F.exists("embedding", lambda x: x.isNull()))
    return rows.mapInArrow(pack, "vec_id long, vector binary")


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Packed vectors as rows of int64."""
    flat = np.frombuffer(b"".join(column.to_pylist()), dtype="<i4")
    return flat.reshape(len(column), size).astype(np.int64)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


class Centres:
    """Centroids with each one's neighbours in order of a lower bound of their distance."""

    def __init__(self, centroids: np.ndarray):
        self.at = centroids
        gap = centroids[:, None, :] - centroids[None, :, :]
        distance = np.sqrt(np.einsum("ijk,ijk->ij", gap, gap).astype(float)) * _DOWN
        np.fill_diagonal(distance, -1.0)
        self.order = np.argsort(distance, axis=1, kind="stable")  # itself first
        self.gap = np.take_along_axis(distance, self.order, axis=1)
        #: half the distance to the closest other one
        self.half = self.gap[:, 1] / 2 if len(centroids) > 1 else np.full(1, np.inf)


def assign(vectors: np.ndarray, centres: Centres, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> None:
    """Nearest and second-nearest centroid of every vector and the bounds, updated in place."""
    k = len(centres.at)
    if k == 1:
        near[:], lower[:] = 0, np.inf
        return
    open_ = np.flatnonzero(upper >= np.maximum(lower, centres.half[near]))
    first = _squared(vectors[open_], centres.at[near[open_]])
    upper[open_] = np.sqrt(first.astype(float)) * _UP
    still = upper[open_] >= np.maximum(lower[open_], centres.half[near[open_]])
    open_, first = open_[still], first[still]
    if not len(open_):
        return
    x = vectors[open_]
    best, best_d, other = near[open_].astype(np.int64), first, second[open_].astype(np.int64)
    other_d = _squared(x, centres.at[other])
    swap = (other_d < best_d) | ((other_d == best_d) & (other < best))
    best[swap], other[swap] = other[swap], best[swap]
    best_d[swap], other_d[swap] = other_d[swap], best_d[swap]
    start, start_d = best.copy(), np.sqrt(best_d.astype(float)) * _UP
    seen = np.stack((best, other), axis=1)
    live = np.arange(len(open_))
    for j in range(1, k):
        # by the triangle inequality nothing beyond the ball is closer than the second
        live = live[centres.gap[start[live], j] <= start_d[live] + np.sqrt(other_d[live].astype(float)) * _UP]
        if not len(live):
            break
        c = centres.order[start[live], j]
        new = (c != seen[live, 0]) & (c != seen[live, 1])
        at, c = live[new], c[new]
        d = _squared(x[at], centres.at[c])
        nearer = (d < best_d[at]) | ((d == best_d[at]) & (c < best[at]))
        between = ~nearer & ((d < other_d[at]) | ((d == other_d[at]) & (c < other[at])))
        a = at[nearer]
        other[a], other_d[a] = best[a], best_d[a]
        best[a], best_d[a] = c[nearer], d[nearer]
        a = at[between]
        other[a], other_d[a] = c[between], d[between]
    near[open_], second[open_] = best, other
    upper[open_], lower[open_] = np.sqrt(best_d.astype(float)) * _UP, np.sqrt(other_d.astype(float)) * _DOWN


def _round(centroids: np.ndarray, moved: np.ndarray | None, size: int, last: bool):
    """Assign once: vectors with their bounds, then the task's sums of the vectors that changed their centroid."""
    centres, k = Centres(centroids), len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            vectors = _matrix(batch.column("vector"), size)
            if moved is None:
                before, near, second = np.full(n, -1), np.zeros(n, np.int32), np.full(n, min(1, k - 1), np.int32)
                upper, lower = np.full(n, np.inf), np.zeros(n)
            else:
                near, second, upper, lower = (np.array(batch.column(c).to_numpy()) for c in ("near", "second", "upper", "lower"))
                before = near.copy()
                upper = (upper + moved[near]) * _UP
                # the others came closer by as much as the one that moved most
                most = np.argmax(moved)
                rest = np.delete(moved, most).max(initial=0.0)
                lower = (lower - np.where(near == most, rest, moved[most])) * _DOWN
                lower = np.maximum(lower, 0.0)
            assign(vectors, centres, near, second, upper, lower)
            change = before != near
            np.add.at(sums, near[change], vectors[change])
            counts += np.bincount(near[change], minlength=k)
            gone = change & (before >= 0)
            np.subtract.at(sums, before[gone], vectors[gone])
            counts -= np.bincount(before[gone], minlength=k)
            distance = pa.array(_squared(vectors, centroids[near])) if last else pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vector"), pa.array(near, pa.int32()), pa.array(second, pa.int32()), pa.array(upper),
                 pa.array(lower), distance, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())], names)
        some = np.flatnonzero((sums != 0).any(axis=1) | (counts != 0))
        empty = [pa.nulls(len(some), t) for t in (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64())]
        yield pa.RecordBatch.from_arrays([*empty, pa.array(some, pa.int32()), pa.array([s.astype("<i8").tobytes() for s in sums[some]], pa.binary()),
                                          pa.array(counts[some], pa.int64())], names)

    names = [c.split()[0] for c in ROWS.split(", ")]
    return run


def _merged(size: int):
    """(of, sums, n) of many tasks -> one row per centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for of, sums, n in zip(*(batch.column(c).to_pylist() for c in ("of", "sums", "n")), strict=True):
                mine = total.setdefault(of, [np.zeros(size, np.int64), 0])
                mine[0] += np.frombuffer(sums, "<i8")
                mine[1] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([s.astype("<i8").tobytes() for s, _ in total.values()], pa.binary()),
                                          pa.array([n for _, n in total.values()], pa.int64())], ["of", "sums", "n"])
    return run


def _first_centroids(vectors: DataFrame, n: int, k: int, seed: str, size: int) -> np.ndarray:
    """The ``k`` vectors of the least hash; ties by components."""
    h = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(h.alias("h"), "vector")
    limit, wanted = 1.0, min(k, n)
    while True:
        # hashes are uniform: a few times k rows lie below this share of their range, so that tasks send few
        limit = min(1.0, 8.0 * k / n if limit == 1.0 else limit * 64)
        low = rows if limit >= 1.0 else rows.where(F.col("h") < format(int(limit * (1 << 64)), "016x"))
        top = low.orderBy("h", "vector").limit(wanted).collect()
        if len(top) == wanted:
            return np.array([np.frombuffer(r.vector, "<i4") for r in top], dtype=np.int64).reshape(wanted, size)


def cluster(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED, size: int = SIZE,
            scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every vector kept, final centroids).

    Kept are vectors of exactly ``size`` components, none null or non-finite. The first centroids are the ``k`` of least
    sha256 of ``<seed><vec_id>`` (a null id: the seed alone; ties by components), all if there are fewer. A round assigns
    every vector, then replaces each centroid that has vectors by the floor of their mean; the others stay. Repeated rows
    count each, a null vec_id stays null, an empty table gives no row and no centroid, other columns aren't read. A
    component beyond ``LIMIT / scale`` raises an error.
    """
    spark = embeddings.sparkSession
    rows = staged(whole_vectors(embeddings, size, scale))
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, size), np.int64)
    centroids = _first_centroids(rows, n, k, seed, size)
    k = len(centroids)
    sums, counts, moved = np.zeros((k, size), dtype=object), np.zeros(k, dtype=object), None
    for i in range(rounds + 1):
        last = i == rounds
        rows = staged(rows.mapInArrow(_round(centroids, moved, size, last), ROWS))
        if not last:
            # a row per task and centroid, added up by centroid before the driver gets them; a task adds up some eight
            parts = rows.where("of is not null").select("of", "sums", "n").repartition(-(-k // 8), "of")
            for r in parts.mapInArrow(_merged(size), "of int, sums binary, n long").collect():
                sums[r.of] += np.frombuffer(r.sums, "<i8").astype(object)
                counts[r.of] += r.n
            new = centroids.copy()
            for c in range(k):
                if counts[c]:
                    new[c] = [int(s) // int(counts[c]) for s in sums[c]]
            moved = np.sqrt(_squared(new, centroids).astype(float)) * _UP
            centroids = new
        rows = rows.where("of is null")
    return rows.select("vec_id", F.col("near").alias("cluster"), "distance"), centroids


def op12_centroids(spark, sf_dir: str) -> DataFrame:
    """Cluster and distance of every embedding, the clusters' inertia and a digest of their centroids."""
    rows, centroids = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    sums = {r["cluster"]: int(r.s) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()]
    per = [(c, s, sum(sums.values()), digests[c]) for c, s in sums.items()]  # a row per centroid
    per = spark.createDataFrame(per, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (rows.join(F.broadcast(per), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
