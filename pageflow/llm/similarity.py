r"""N-gram Jaccard join by a token-group matrix.

Similar documents are partitioned into groups, each group's token union is stored as rows (token, group), the
overlap of two groups is bounded from these rows, and only groups whose bound qualifies are opened and compared.

* A document's tokens are its distinct 5-word shingles; equal sets are one class, represented by one document.
* Classes with the same least hash form a bucket of similar documents, whose linked parts are groups (a bucket is cut
  to chunks of bounded size, other classes are groups of one); the groups' first documents meet again by a second hash, and
  linked groups merge.
* If |X & Y| >= 0.8 |X | Y|, the prefixes of X and Y in any common order of tokens share at least c of them, where a
  prefix has |X| - ceil(0.8 |X|) + c tokens. The matrix holds the prefixes. Tokens that a sample of documents shows to be
  frequent come last in the order, which keeps rows short; the order changes the work, never the result.
* Group pairs below the bound can't hold a link. The others are opened: the larger group's sets, in chunks of bounded size,
  are compared exactly with the sets of the other's documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.llm.common import components, join_narrow, staged
from pageflow.llm.words import mix, pieces, sum_by_row, unique_in_rows, windows, words_of

SHINGLE = 5
#: Share of documents whose tokens are counted for the order, and most frequent tokens kept (8 bytes each, broadcast).
SAMPLE = 16
FREQUENT = 1 << 18
#: Tokens that a task opens at once.
CHUNK_TOKENS = 300_000
NO_ID = (1 << 63) - 1
KEYS = (0x632BE59BD9B4E019, 0x2545F4914F6CDD1D)


def _links(common, a, b):
    """100 |X & Y| >= 80 |X | Y|."""
    return 100 * common >= 80 * (a + b - common)


def _shared(n: np.ndarray) -> np.ndarray:
    """Prefix tokens that two linked sets share at least, if the smaller has n tokens."""
    return 1 + n // 25


def token_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of every row, sorted, and each row's range.

    A text of fewer than five words has one token, its whole sequence; one without words has none.
    """
    words = words_of(column, lower=True)
    hashes, first = windows(words, SHINGLE)
    n = np.diff(words.first)
    row = np.repeat(np.arange(len(n)), np.diff(first))
    for k in range(1, SHINGLE):
        short = np.flatnonzero(n == k)
        if len(short):
            h = words.hash[words.first[short]].copy()
            for j in range(1, k):
                h = h * np.uint64(0x9FB21C651E98DF25) + words.hash[words.first[short] + j]
            hashes, row = np.concatenate((hashes, mix(h + np.uint64(k)))), np.concatenate((row, short))
    hashes, row = unique_in_rows(hashes, row)
    return hashes, np.searchsorted(row, np.arange(len(n) + 1))


def _signatures(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each row's set."""
    return mix(sum_by_row(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).view(np.int64), first).view(np.uint64)
               + np.diff(first).astype(np.uint64)).view(np.int64)


def _narrow_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", 1 << 21):
        tokens, first = token_sets(batch.column("text"))
        n = np.diff(first)
        some, keys = n > 0, []
        for salt in KEYS:
            key = np.zeros(len(n), np.uint64)
            if some.any():
                key[some] = np.minimum.reduceat(mix(tokens + np.uint64(salt)), first[:-1][some])
            keys.append(pa.array(key.view(np.int64)))
        yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("row", "id", "doc_id")), pa.array(_signatures(tokens, first)),
                                          pa.array(n.astype(np.int64)), *keys], ["row", "id", "doc_id", "sig", "n", "key0", "key1"])


def _sampled_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", 1 << 21):
        tokens, first = token_sets(batch.column("text"))
        sig = np.repeat(_signatures(tokens, first), np.diff(first))
        drawn = sig.view(np.uint64) % np.uint64(SAMPLE) == 0
        token, own = unique_in_rows(tokens[drawn].view(np.int64), sig[drawn])
        yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(own)], ["token", "sig"])


def _matrix_rows(frequent):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.sort(frequent.value)
        for batch in pieces(batches, "text", 1 << 21):
            tokens, first = token_sets(batch.column("text"))
            n, sig = np.diff(first), _signatures(tokens, first)
            known = batch.column("sig").fill_null(0).to_numpy(zero_copy_only=False) == sig
            assigned = batch.column("sig").is_valid().to_numpy(zero_copy_only=False) & known
            group = np.where(assigned, batch.column("group").fill_null(0).to_numpy(zero_copy_only=False), sig)
            drop = assigned & batch.column("group").is_null().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(n)), n)
            late = np.zeros(len(tokens), dtype=bool)
            if len(last):
                at = np.searchsorted(last, tokens)
                late = last[np.minimum(at, len(last) - 1)] == tokens
            order = np.lexsort((late, row))  # stable: tokens of a row are sorted already
            prefix = np.where(drop, 0, np.minimum(n, n - (4 * n + 4) // 5 + _shared(n)))
            keep = np.arange(len(tokens)) - first[row] < prefix[row]  # order keeps rows in place
            token, own = tokens[order][keep].view(np.int64), row[keep]
            # one row per token and group of the batch, with the sizes of its sets
            order = np.lexsort((group[own], token))
            token, own = token[order], own[order]
            if not len(token):
                continue
            new = np.ones(len(token), dtype=bool)
            new[1:] = (token[1:] != token[:-1]) | (group[own][1:] != group[own][:-1])
            start = np.flatnonzero(new)
            low, high = np.minimum.reduceat(n[own], start), np.maximum.reduceat(n[own], start)
            yield pa.RecordBatch.from_arrays([pa.array(token[start]), pa.array(group[own][start]), pa.array((low << 32) | high)],
                                             ["token", "group", "sizes"])
    return emit


def _group_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of groups that share a token, from matrix rows sorted by (token, group).

    Groups whose set sizes differ too much are left out. The rows of the last token are held until the next begins.
    """
    held = [np.zeros(0, np.int64)] * 3

    def pairs(token, group, sizes):
        if not len(token):
            return
        new = np.ones(len(token), dtype=bool)
        new[1:] = (token[1:] != token[:-1]) | (group[1:] != group[:-1])
        start = np.flatnonzero(new)
        token, group = token[start], group[start]
        low, high = np.minimum.reduceat(sizes >> 32, start), np.maximum.reduceat(sizes & 0xFFFFFFFF, start)
        begin = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        end = np.repeat(np.append(begin[1:], len(token)), np.diff(np.append(begin, len(token))))
        n = end - np.arange(len(token)) - 1  # partners after each row in its run
        at, room = 0, 1 << 20
        total = np.cumsum(n)
        while at < len(n):  # about ``room`` pairs at once
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + room, "right")))
            m = n[at:to]
            a = np.repeat(np.arange(at, to), m)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(m) - m, m)
            fit = (5 * high[a] >= 4 * low[b]) & (5 * high[b] >= 4 * low[a])
            a, b = a[fit], b[fit]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(group[a]), pa.array(group[b]), pa.array(_shared(np.minimum(low[a], low[b])))],
                                                 ["a", "b", "need"])
            at = to

    for batch in batches:
        token, group, sizes = (np.concatenate((h, batch.column(x).to_numpy(zero_copy_only=False)))
                               for h, x in zip(held, ("token", "group", "sizes"), strict=True))
        if not len(token):
            continue
        done = int(np.searchsorted(token, token[-1]))
        yield from pairs(token[:done], group[:done], sizes[:done])
        held = [token[done:], group[done:], sizes[done:]]
    yield from pairs(*held)


class _Opened:
    """Sets of the rows of a bucket under dense token numbers."""

    def __init__(self, column: pa.Array):
        self.tokens, self.first = token_sets(column)
        self.n = np.diff(self.first)
        self.sig = _signatures(self.tokens, self.first)

    def sets(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(dense tokens, ranges, number of tokens) of some rows."""
        n = self.n[rows]
        first = np.concatenate(([0], np.cumsum(n)))
        at = np.repeat(self.first[rows], n) + np.arange(first[-1]) - np.repeat(first[:-1], n)
        names, dense = np.unique(self.tokens[at], return_inverse=True)
        return dense, first, len(names)


def _common(dense: np.ndarray, first: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Tokens of each set that are marked; no set is empty."""
    return np.add.reduceat(mark[dense].astype(np.int64), first[:-1])


def _linked_parts(column: pa.Array, groups: list[np.ndarray]) -> np.ndarray:
    """For each row the least signature linked with it in its group, links taken transitively."""
    opened = _Opened(column)
    out = opened.sig.copy()
    for rows in groups:
        rows = rows[np.unique(opened.sig[rows], return_index=True)[1]]
        rows = rows[opened.n[rows] > 0]
        if len(rows) < 2:
            continue
        dense, first, size = opened.sets(rows)
        n, left = opened.n[rows], np.arange(len(rows))
        while len(left):
            part, queue, left = [left[0]], [left[0]], left[1:]
            while queue and len(left):
                q = queue.pop()
                mark = np.zeros(size, dtype=bool)
                mark[dense[first[q]:first[q + 1]]] = True
                m = n[left]
                own = np.concatenate(([0], np.cumsum(m)))
                at = np.repeat(first[left], m) + np.arange(own[-1]) - np.repeat(own[:-1], m)
                near = _links(_common(dense[at], own, mark), m, n[q])
                part.extend(left[near])
                queue.extend(left[near])
                left = left[~near]
            part = np.array(part)
            out[rows[part]] = opened.sig[rows[part]].min()
    # rows of equal sets share the result
    names, inverse = np.unique(opened.sig, return_inverse=True)
    least = np.full(len(names), np.iinfo(np.int64).max)
    np.minimum.at(least, inverse, out)
    return least[inverse]


def _partition(batch_groups: list[np.ndarray]) -> list[np.ndarray]:
    order = np.lexsort(batch_groups[::-1])
    change = np.zeros(len(order), dtype=bool)
    for x in batch_groups:
        change[1:] |= x[order][1:] != x[order][:-1]
    return np.split(order, np.flatnonzero(change))


def _bucket_groups(table: pa.Table) -> pa.Table:
    """Groups among the documents of each (key, chunk) of a task's bucket."""
    groups = _partition([table.column(x).to_numpy() for x in ("key", "chunk")])
    part = _linked_parts(table.column("text").combine_chunks(), groups)
    return pa.table({"sig": table.column("sig"), "group": pa.array(part)})


def _open(table: pa.Table) -> pa.Table:
    """Links between each opened group of a task's bucket and the documents that query it."""
    opened = _Opened(table.column("text").combine_chunks())
    owner, group = table.column("owner").to_numpy(zero_copy_only=False), table.column("group").to_numpy()
    found: list[tuple[int, int]] = []
    for rows in _partition([table.column(x).to_numpy() for x in ("open", "chunk", "block")]):
        rows = rows[opened.n[rows] > 0]
        mine, asks = rows[owner[rows]], rows[~owner[rows]]
        if not len(mine) or not len(asks):
            continue
        dense, first, size = opened.sets(np.concatenate((mine, asks)))
        k = len(mine)
        own, own_first, n = dense[:first[k]], first[:k + 1], opened.n[mine]
        met = set()
        for i, q in enumerate(asks):
            if group[q] in met:
                continue
            mark = np.zeros(size, dtype=bool)
            mark[dense[first[k + i]:first[k + i + 1]]] = True
            if _links(_common(own, own_first, mark), n, opened.n[q]).any():
                met.add(group[q])
                found.append((int(group[mine[0]]), int(group[q])))
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _bucketed(docs: DataFrame, rows: DataFrame, by: list[str], fn, schema: str) -> DataFrame:
    """Bring the texts of narrow ``rows`` (row, n, ...) together by hashed buckets of about ``CHUNK_TOKENS`` tokens."""
    total = rows.agg(F.sum("n")).first()[0] or 0
    buckets = int(total // CHUNK_TOKENS) + 1
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*by), F.lit(buckets)))
    return join_narrow(docs, rows, "row", "inner").groupBy("bucket").applyInArrow(fn, schema)


def _opened_links(texts: DataFrame, members: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links (a, b) between groups, for pairs (open, asks, open_tokens, tokens).

    An opened group is cut to chunks, the documents that ask it to blocks, and every block meets every chunk.
    """
    chunks = pairs.withColumn("chunks", F.ceil(F.col("open_tokens") / CHUNK_TOKENS))
    load = pairs.groupBy("open").agg(F.ceil(F.sum("tokens") / CHUNK_TOKENS).alias("blocks"))
    pairs = staged(chunks.join(load, "open"))
    own = members.select("row", "sig", "n", "group")
    queries = (pairs.join(own, F.col("asks") == F.col("group")).withColumn("block", F.pmod(F.xxhash64("sig"), "blocks"))
               .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))))
    owners = (pairs.select("open", "chunks", "blocks").distinct().join(own, F.col("open") == F.col("group"))
              .withColumn("chunk", F.pmod(F.xxhash64("sig"), "chunks"))
              .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    columns = ["row", "n", "group", "open", "chunk", "block"]
    opened = queries.select(*columns, F.lit(False).alias("owner")).unionByName(owners.select(*columns, F.lit(True).alias("owner")))
    return _bucketed(texts, staged(opened), ["open", "chunk", "block"], _open, "a long, b long")


def row_key() -> Column:
    """Key of a row's doc_id and text; a null doc_id or one of several texts doesn't identify a row."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.col("text").cast("string"))


def _grouped(docs: DataFrame) -> DataFrame:
    """(row, first, doc_id, n_shingles, component_id): ``jaccard_groups`` with the keys of the row and of its component's first row."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"), row_key().alias("row"))
    rows = staged(docs.mapInArrow(_narrow_rows, "row long, id long, doc_id long, sig long, n long, key0 long, key1 long"))
    texts = docs.select("row", "text")
    classes = staged(rows.where("n > 0").groupBy("sig").agg(F.min(F.struct("id", "row")).alias("c"), F.count("*").alias("copies"),
                                                         *[F.first(x).alias(x) for x in ("n", "key0", "key1")])
                     .select("c.*", "sig", "copies", "n", "key0", "key1"))
    # groups: linked parts of the classes with one least hash; then the same for the groups' first classes
    members = classes.select("row", "id", "sig", "n", F.col("sig").alias("group"))
    for x in ("key0", "key1"):
        heads = members.where("sig = group").select("sig").join(classes.select("sig", "row", "n", F.col(x).alias("key")), "sig")
        keys = heads.groupBy("key").agg(F.count("*").alias("m"), F.sum("n").alias("tokens")).where("m > 1")
        alike = heads.join(keys, "key").withColumn("chunk", F.pmod(F.xxhash64("sig"), F.ceil(F.col("tokens") / CHUNK_TOKENS)))
        parts = staged(_bucketed(texts, staged(alike.select("row", "sig", "n", "key", "chunk")), ["key", "chunk"], _bucket_groups,
                                 "sig long, group long").distinct())
        parts = parts.where("sig <> group").select(F.col("sig").alias("group"), F.col("group").alias("into"))
        members = staged(members.join(parts, "group", "left").select("row", "id", "sig", "n", F.coalesce("into", "group").alias("group")))
    # the matrix
    counts = texts.mapInArrow(_sampled_tokens, "token long, sig long").distinct().groupBy("token").agg(F.count("*").alias("c")).where("c > 1")
    frequent = [r.token for r in counts.orderBy(F.desc("c"), "token").limit(FREQUENT).select("token").collect()]  # at most FREQUENT
    frequent = docs.sparkSession.sparkContext.broadcast(np.array(frequent, dtype=np.int64).view(np.uint64))
    copies = rows.where("n > 0").join(classes.where("copies > 1").select("sig", F.col("row").alias("first")), "sig").where("row <> first")
    assigned = staged(copies.select("row", "sig", F.lit(None).cast("long").alias("group")).distinct()
                      .unionByName(members.where("group <> sig").select("row", "sig", "group")))
    matrix = join_narrow(texts, assigned, "row", "left").select("text", "sig", "group").mapInArrow(
        _matrix_rows(frequent), "token long, group long, sizes long")
    pairs = (matrix.repartition("token").sortWithinPartitions("token", "group").mapInArrow(_group_pairs, "a long, b long, need long")
             .groupBy("a", "b").agg(F.count("*").alias("common"), F.min("need").alias("need")).where("common >= need"))
    pairs = staged(pairs.select("a", "b"))
    # the larger group of each pair is opened for the other; first each group asks its largest neighbour only, then
    # the pairs that are still in different components are left
    sizes = members.groupBy("group").agg(F.sum("n").alias("tokens"))
    a, b = (sizes.select(F.col("group").alias(x), F.col("tokens").alias(f"{x}_tokens")) for x in "ab")
    first = F.col("a_tokens") >= F.col("b_tokens")
    both = staged(pairs.join(a, "a").join(b, "b").select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("open"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("asks"),
        F.greatest("a_tokens", "b_tokens").alias("open_tokens"), F.least("a_tokens", "b_tokens").alias("tokens")))
    near = both.groupBy("asks").agg(F.max(F.struct("open_tokens", "open", "tokens")).alias("x")).select("asks", "x.*")
    links = staged(_opened_links(texts, members, near))
    part = staged(components(links))
    of_open, of_asks = (part.select(F.col("id").alias(x), F.col("component_id").alias(f"{x}_part")) for x in ("open", "asks"))
    rest = both.join(of_open, "open", "left").join(of_asks, "asks", "left").where(
        F.coalesce("open_part", "open") != F.coalesce("asks_part", "asks")).select(both.columns)
    reached = components(links.unionByName(_opened_links(texts, members, staged(rest))))
    whole = members.join(reached, members["group"] == reached["id"], "left").select(
        "sig", "row", members["id"], F.coalesce("component_id", "group").alias("root"))
    least = whole.groupBy("root").agg(F.min(F.struct("id", "row")).alias("l"))
    of_class = whole.join(least, "root").select("sig", F.col("l.id").alias("least"), F.col("l.row").alias("first"))
    out = rows.join(of_class, "sig", "left")
    component = F.coalesce(F.when(F.col("n") > 0, F.col("least")), F.col("id"))
    return out.select("row", F.coalesce("first", "row").alias("first"), "doc_id", F.col("n").alias("n_shingles"), F.when(component < NO_ID, component).alias("component_id"))


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    component_id is the least doc_id reachable by links, the document's own included. A null or empty text has no
    shingle and is linked with nothing; rows with a null doc_id count as the largest id, written as null; repeated rows
    each get a row; an empty table gives none. Other columns are not read.
    """
    return _grouped(docs).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, that of its least doc_id; the columns of ``docs``.

    Rows without a doc_id stay. Different texts of one doc_id are rows of their own; repeated rows count once.
    """
    found = staged(_grouped(docs)).where("doc_id is not null")
    gone = found.where("row <> first").select(F.col("row").alias("row_key_")).distinct()
    kept = join_narrow(docs.withColumn("row_key_", row_key()), staged(gone), "row_key_", "left_anti")
    if found.where("row = first").groupBy("row").count().where("count > 1").limit(1).count():
        kept = kept.where("doc_id is not null").dropDuplicates(["row_key_"]).unionByName(kept.where("doc_id is null"))
    return kept.select(*docs.columns)


def op5_jaccard(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return jaccard_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
