r"""Spelling variant grouping by search schemes over a bidirectional FM-index of the delimited vocabulary.

Two words one edit apart agree on the first half or on the second half of either. The vocabulary is indexed twice, as it
is and reversed, which are the two directions of a bidirectional index: one search matches the second half exactly and
extends to the left over the first with one error, the other does the same to the right. An extension is one binary
search for the suffix-rank interval, a word's delimiters anchor it at both ends, and since words are delimited the rank
of the whole word says which it is. With two halves no search turns round, so the two intervals needn't be kept in step.

The vocabulary is range-partitioned by (length, word) for one direction and by (length, reversed word) for the other; a
block holds the index of its words alone, and a word is sent only to the blocks whose range holds its half in one of
the three lengths it can be near to. Words of one length that share a half are bounded by what the other half can be.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.llm.common import staged

MIN_LETTERS = 5
MIN_COUNT = 3
#: Of the occurrences of a word, one in so many loses a letter.
DROP_EVERY = 97
#: A form has at least so many times the occurrences of its variant.
MIN_RATIO = 2
#: Words of a block, and queries that are searched at once.
BLOCK_WORDS = 20_000
QUERIES = 4_000
#: Codes of letters: a-z, U+00C0 to U+00FF; 0 is the delimiter.
SIGMA = 27 + 64
_LAST = "\U0010ffff"


def _codes(words: list[str]) -> np.ndarray:
    """Codes of all words, each followed by its delimiter."""
    points = np.frombuffer(("\0".join(words) + "\0").encode("latin-1"), dtype=np.uint8).astype(np.int64)
    return np.where(points == 0, 0, np.where(points < 0x80, points - 0x60, points - 0xC0 + 27))


class Index:
    """FM-index of distinct words, extended to the left; delimiters rank by the order of ``words``."""

    def __init__(self, words: list[str]):
        text = _codes(words)
        n, end = len(text), text == 0
        word = np.cumsum(end) - end
        rank = np.where(end, word, text + len(words))
        step = 1
        while True:  # prefix doubling; a suffix is told apart at its delimiter at the latest
            after = np.zeros(n, dtype=np.int64)
            after[:n - step] = rank[step:] + 1
            key = rank * (n + SIGMA + len(words) + 2) + after
            order = np.argsort(key, kind="stable")
            new = np.empty(n, dtype=np.int64)
            new[order] = np.cumsum(np.concatenate(([0], key[order][1:] != key[order][:-1])))
            rank = new
            if rank[order[-1]] == n - 1:
                break
            step *= 2
        self.before = text[order - 1]  # the letter before each suffix, by rank
        by_letter = np.argsort(self.before, kind="stable")
        self.width = n + 1
        #: (letter, rank) pairs in order: where a pair would stand is the rank of the extended suffix
        self.places = self.before[by_letter] * self.width + by_letter
        #: words by the rank of their whole suffix
        self.whole = word[order[by_letter[:len(words)]]]
        self.n_words = len(words)

    def extend(self, letter, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes with ``letter`` put before them."""
        base = letter * self.width
        return np.searchsorted(self.places, base + low), np.searchsorted(self.places, base + high)

    def children(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval number, letter) of every letter before the suffixes of the intervals, delimiters left out."""
        size = high - low
        small = np.flatnonzero(size <= SIGMA)
        at = np.repeat(small, size[small])
        ranks = np.arange(len(at)) - np.repeat(np.cumsum(size[small]) - size[small], size[small]) + low[at]
        found = np.unique(at * SIGMA + self.before[ranks])
        large = np.flatnonzero(size > SIGMA)
        every = (large[:, None] * SIGMA + np.arange(1, SIGMA)).ravel()
        found = np.concatenate((found[found % SIGMA > 0], every))
        return found // SIGMA, found % SIGMA

    def near(self, queries: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (query, word) pairs one edit apart where the last ``exact`` letters of the query end the word too."""
        pattern = _codes(queries)
        ends = np.flatnonzero(pattern == 0)
        first = np.concatenate(([0], ends[:-1] + 1))
        length = ends - first
        q = np.arange(len(queries))
        low, high, rest = np.zeros(len(q), np.int64), np.full(len(q), self.n_words), length.copy()
        found: list[np.ndarray] = []

        def wanted(q_: np.ndarray, rest_: np.ndarray) -> np.ndarray:
            return pattern[first[q_] + np.maximum(rest_, 1) - 1]

        def finish(q_, rest_, low_, high_) -> None:
            """What is left must match exactly."""
            while len(q_):
                done = rest_ == 0
                a, b = self.extend(0, low_[done], high_[done])
                hit = b > a
                found.append(q_[done][hit] * self.n_words + self.whole[a[hit]])
                q_, rest_, low_, high_ = q_[~done], rest_[~done], low_[~done], high_[~done]
                low_, high_ = self.extend(wanted(q_, rest_), low_, high_)
                keep = high_ > low_
                q_, rest_, low_, high_ = q_[keep], rest_[keep] - 1, low_[keep], high_[keep]

        waiting: list[tuple[np.ndarray, ...]] = []  # at the border of the halves, without an error so far
        while len(q):
            border = length[q] - rest == exact[q]
            waiting.append((q[border], rest[border], low[border], high[border]))
            q, rest, low, high = q[~border], rest[~border], low[~border], high[~border]
            low, high = self.extend(wanted(q, rest), low, high)
            keep = high > low
            q, rest, low, high = q[keep], rest[keep] - 1, low[keep], high[keep]
        q, rest, low, high = (np.concatenate(x) for x in zip(*waiting, strict=True))
        while len(q):
            letter = np.where(rest > 0, wanted(q, rest), -1)
            some = rest > 0
            finish(q[some], rest[some] - 1, low[some], high[some])  # the word lacks a letter
            at, put = self.children(low, high)
            other = put != letter[at]  # a letter put beside an equal one is found further left
            at, put = at[other], put[other]
            lows, highs = self.extend(put, low[at], high[at])
            finish(q[at], rest[at], lows, highs)  # the word has one more
            some_at = rest[at] > 0
            finish(q[at][some_at], rest[at][some_at] - 1, lows[some_at], highs[some_at])  # another letter
            q, rest, low, high = q[some], rest[some], low[some], high[some]
            low, high = self.extend(letter[some], low, high)
            keep = high > low
            q, rest, low, high = q[keep], rest[keep] - 1, low[keep], high[keep]
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return pairs // self.n_words, pairs % self.n_words


def occurrences(docs: DataFrame, drop_every: int = DROP_EVERY) -> DataFrame:
    r"""(word): every run ``[A-Za-zÀ-ÿ]+`` of every text, A-Z lowered; of those whose crc32 of
    ``<doc_id>:<run>`` is divisible by ``drop_every`` the letter at that crc32 modulo the length is left out."""
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(text, F.lit(r"[a-zÀ-ÿ]+"), F.lit(0))).alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run"))
    at = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return runs.select(F.when(h % drop_every == 0, shorter).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of at least ``MIN_LETTERS`` letters and ``MIN_COUNT`` occurrences."""
    words = occurrences(docs).where(F.length("word") >= MIN_LETTERS)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


def _half(word: str, backward: bool) -> str:
    """The half that is matched exactly, from the side on which the blocks are ordered."""
    middle = len(word) // 2
    return word[middle:][::-1] if backward else word[:middle]


def _router(ends: list, backward: bool):
    """Words -> (block, word): every block whose range may hold a word near it."""
    number, lows, highs = [r.block for r in ends], [tuple(r.low) for r in ends], [tuple(r.high) for r in ends]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, rows = [], []
            for row, word in enumerate(batch.column("word").to_pylist()):
                half, mine = _half(word, backward), set()
                for size in (len(word) - 1, len(word), len(word) + 1):
                    mine.update(number[bisect_left(highs, (size, half)):bisect_right(lows, (size, half + _LAST))])
                blocks += mine
                rows += [row] * len(mine)
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(np.ones(len(rows), bool)),
                                              batch.column("word").take(pa.array(rows, pa.int64())), pa.nulls(len(rows), pa.int64())],
                                             ["block", "query", "word", "n"])
    return route


def _searcher(backward: bool):
    """Rows (block, query, word, n) by block, its words before its queries -> (word, n_near, best_n, best) of the queries."""

    def turned(words: list[str]) -> list[str]:
        return words if backward else [w[::-1] for w in words]

    def search(index: Index, words: list[str], counts: list[int], queries: list[str]) -> pa.RecordBatch:
        exact = np.array([len(w) - len(w) // 2 if backward else len(w) // 2 for w in queries], dtype=np.int64)
        out: dict[str, list] = {}
        for q, w in zip(*(x.tolist() for x in index.near(turned(queries), exact)), strict=True):
            query, word = queries[q], words[w]
            middle = len(query) // 2
            if backward and query[:middle] == word[:middle]:
                continue  # the other direction has it
            mine = out.setdefault(query, [0, 0, ""])
            mine[0] += 1
            if (-counts[w], word) < (-mine[1], mine[2]):
                mine[1:] = counts[w], word
        return pa.RecordBatch.from_arrays(
            [pa.array(list(out), pa.string()), pa.array([x[0] for x in out.values()], pa.int64()),
             pa.array([x[1] for x in out.values()], pa.int64()), pa.array([x[2] for x in out.values()], pa.string())],
            ["word", "n_near", "best_n", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, index, words, counts = None, None, [], []
        for batch in batches:
            of, asked = batch.column("block").to_numpy(), batch.column("query").to_numpy(zero_copy_only=False)
            names, n = batch.column("word").to_pylist(), batch.column("n").to_pylist()
            cuts = np.flatnonzero((of[1:] != of[:-1]) | (asked[1:] != asked[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(of)], strict=True):
                if a == b:
                    continue
                if of[a] != block:
                    block, index, words, counts = of[a], None, [], []
                if not asked[a]:
                    words += names[a:b]
                    counts += n[a:b]
                    continue
                if index is None:
                    index = Index(turned(words))
                for at in range(a, b, QUERIES):
                    yield search(index, words, counts, names[at:min(b, at + QUERIES)])
    return run


def _one_way(words: DataFrame, n_blocks: int, backward: bool) -> DataFrame:
    """(word, n_near, best_n, best): near words found with one half exact, from every block that has any."""
    key = F.reverse("word") if backward else F.col("word")
    blocks = words.select("word", "n", F.length("word").alias("size"), key.alias("key"))
    # distinct keys: a range is as long as any other
    blocks = staged(blocks.repartitionByRange(n_blocks, "size", "key").withColumn("block", F.spark_partition_id()))
    ends = blocks.groupBy("block").agg(F.min(F.struct("size", "key")).alias("low"), F.max(F.struct("size", "key")).alias("high"))
    ends = ends.orderBy("block").collect()  # a row per block
    mine = blocks.select("block", F.lit(False).alias("query"), "word", "n")
    asked = words.select("word").mapInArrow(_router(ends, backward), "block int, query boolean, word string, n long")
    rows = mine.unionByName(asked).repartition(len(ends), "block").sortWithinPartitions("block", "query", "word")
    return rows.mapInArrow(_searcher(backward), "word string, n_near long, best_n long, best string")


def _block_count(n: int, cores: int) -> int:
    return max(-(-n // BLOCK_WORDS), min(2 * cores, -(-n // 1000)), 1)


def _roots(edges: DataFrame) -> DataFrame:
    """(word, root) of every (word, form): the last form reached, by doubling jumps.

    A form has at least twice the occurrences of its word, so chains end and are at most as long as counts have bits.
    """
    at = staged(edges.select("word", F.col("form").alias("root")))
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = at.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        after = staged(after)
        at = after.select("word", "root")
        if not after.where("moved").limit(1).count():
            return at


def spelling_groups(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary of ``docs`` (doc_id, text).

    Two words are near if they differ by one inserted, deleted or replaced letter. ``form``: the near word of most
    occurrences (ties: the least), if it has at least ``MIN_RATIO`` times the word's; ``root``: the last form reached
    from the word. A null text has no words, a null doc_id counts as empty text, repeated rows count each, an empty
    table gives no row; other columns aren't read.
    """
    spark = docs.sparkSession
    words = staged(vocabulary(docs.select("doc_id", "text")))
    n = words.count()
    n_blocks = _block_count(n, spark.sparkContext.defaultParallelism)
    found = _one_way(words, n_blocks, False).unionByName(_one_way(words, n_blocks, True)) if n else None
    if found is None:
        found = spark.createDataFrame([], "word string, n_near long, best_n long, best string")
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top"))
    rows = words.join(near, "word", "left")
    has: Column = -F.col("top.less") >= MIN_RATIO * F.col("n")
    rows = staged(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("top.best")).alias("form"),
                              F.when(has, -F.col("top.less")).alias("form_n")))
    roots = _roots(rows.where("form is not null"))
    return (rows.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op11_spelling(spark, sf_dir: str) -> DataFrame:
    """Form, root and near words of every word of the documents."""
    return spelling_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
