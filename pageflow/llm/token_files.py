"""Token ids in ORC files: written in ascending doc_id order, read back by stripes.

A row holds a document's ids as a list of integers, which ORC stores run-length encoded in stripes, with a row index
every ``INDEX_ROWS`` rows and Bloom filters on the document id. Files are cut into splits at stripes, so tasks read
stripes in parallel, and a filter on ids skips stripes and row groups by the indexes and filters alone.

Texts are range-partitioned by id before they are encoded, so no text is encoded twice; a row also holds its file's
number and the ids before it in its file, so that its place among all ids needs only the files' totals.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageflow.llm.words import LETTERS, LOWER, WORD, Words, buffer_of, pieces, rows_of, slices, sum_by_row, words_in
from pageflow.session import scratch_path

#: The end-of-document id.
END = 2
INDEX_ROWS = 1000
STRIPE_BYTES = 16 << 20
#: UTF-8 bytes of text per file.
FILE_BYTES = 64 << 20
#: Words that an encoder remembers; more, and it begins anew.
REMEMBERED = 1_500_000
_APOSTROPHE, _LATIN = 0x27, 0xC3
_bytes = np.arange(256)
_second = (_bytes >= 0x80) & (_bytes < 0xC0) & (_bytes != 0x97) & (_bytes != 0xB7)  # after _LATIN: a letter U+00C0 to U+00FF
_SIGN, _LETTER, _DIGIT = 0, 1, 2
_kind = np.full(256, _SIGN, dtype=np.uint8)
_kind[LETTERS] = _LETTER
_kind[0x30:0x3A] = _DIGIT
COLUMNS = "doc_id long, part int, before long, n_tokens long, ids array<int>"


def _cut(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """The words of a byte buffer of texts, ``first`` by text, and which of them are plain.

    Texts are cut at white space. A piece of ASCII and Latin-1 letters without an apostrophe is plain: it is cut further
    into runs of letters, single digits and runs of other signs, and its ASCII letters are lowered.
    """
    plain, cut = np.zeros(len(data), dtype=bool), np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    for a, b in slices(data, WORD):
        part, inside = data[a:b], WORD[data[a:b]]
        latin = np.zeros(b - a, dtype=bool)  # bytes of Latin-1 letters
        latin[:-1] = (part[:-1] == _LATIN) & _second[part[1:]]
        latin[1:] |= latin[:-1]
        odd = np.flatnonzero(((part >= 0x80) & ~latin) | (part == _APOSTROPHE))
        begins = cut[a:b].copy()
        begins[0] = True
        begins[1:] |= ~inside[:-1]
        start = np.flatnonzero(begins)  # every piece begins at one of these, and ends before the next
        good = np.ones(len(start), dtype=bool)
        good[np.searchsorted(start, odd, "right") - 1] = False
        here = np.repeat(good, np.diff(start, append=b - a)) & inside
        plain[a:b] = here
        kind = _kind[part]
        cut[a + 1:b] |= here[1:] & here[:-1] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
    words = words_in(np.where(plain, LOWER[data], data), np.flatnonzero(cut), WORD)
    return words._replace(first=np.searchsorted(words.start, offsets)), plain[words.start]


class Encoder:
    """A string column to the ids of its texts.

    With ``by_words`` every distinct word of :func:`_cut` is encoded once and found again by a 64-bit hash. That is right
    for tokenizers that normalise by NFC and lower case, drop white space, take runs of letters, single digits, runs of
    other signs and English contractions as words, and mark word ends by ``</w>``: none of their steps crosses a cut.
    Plain words are encoded together as one text. Texts that hold a special token, and all texts without ``by_words``,
    are encoded whole.
    """

    def __init__(self, path: str, by_words: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = by_words
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True) if by_words else {}
        self.ends_word = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        #: words by hash, in order, and where their ids are
        self.hashes, self.begin, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, number of ids of each word), plain words first."""
        [ids] = self._whole([b" ".join(w for w, p in zip(words, plain, strict=True) if p).decode()])
        others = self._whole([w.decode() for w, p in zip(words, plain, strict=True) if not p])
        length = np.diff(np.flatnonzero(self.ends_word[ids]), prepend=-1)
        return np.concatenate((ids, *others)), np.concatenate((length, [len(x) for x in others])).astype(np.int64)

    def _places(self, words: Words, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, length) of every word's ids in ``self.ids``; new words are encoded."""
        if max(len(self.hashes), len(self.ids) // 8) > REMEMBERED:
            self._forget()
        hashes, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), dtype=bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != hashes[inside]
        new = np.flatnonzero(new)
        if len(new):
            simple, raw = plain[first[new]], words.data.tobytes()
            texts = [raw[a:b] for a, b in zip(words.start[first[new]].tolist(), words.end[first[new]].tolist(), strict=True)]
            ids, length = self._learn(texts, simple)
            begin = len(self.ids) + np.cumsum(length) - length
            place = np.empty(len(new), dtype=np.int64)
            place[np.argsort(~simple, kind="stable")] = np.arange(len(new))
            self.ids = np.concatenate((self.ids, ids))
            self.hashes, self.begin, self.length = (np.insert(known, at[new], more) for known, more in (
                (self.hashes, hashes[new]), (self.begin, begin[place]), (self.length, length[place])))
            at = np.searchsorted(self.hashes, hashes)
        return self.begin[at][which], self.length[at][which]

    def encode(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after the other, ``end`` appended to each; each row's range in them)."""
        n = len(column)
        whole = np.full(n, not self.by_words)
        for token in self.special if self.by_words else ():
            whole |= pc.fill_null(pc.match_substring(column, token), False).to_numpy(zero_copy_only=False)
        texts = column.filter(pa.array(whole)).to_pylist()
        apart = dict(zip(np.flatnonzero(whole).tolist(), self._whole([t or "" for t in texts]), strict=True))
        if apart:
            column = pc.if_else(pa.array(whole), pa.scalar("", column.type), column)
        words, plain = _cut(*buffer_of(column))
        begin, length = self._places(words, plain) if len(plain) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        sizes = sum_by_row(length, words.first) + 1
        for row_, ids in apart.items():
            sizes[row_] = len(ids) + 1
        first = np.concatenate(([0], np.cumsum(sizes)))
        out = np.full(first[-1], end, dtype=np.uint32)
        # a word's place: after those before it in its row
        place = np.cumsum(length) - length
        row = rows_of(words.first)
        if len(row):
            place = place - place[words.first[row]] + first[row]
            step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            out[np.repeat(place, length) + step] = self.ids[np.repeat(begin, length) + step]
        for row_, ids in apart.items():
            out[first[row_]:first[row_ + 1] - 1] = ids
        return out, first


@lru_cache(maxsize=2)
def _encoder(path: str, by_words: bool) -> Encoder:
    """One for all tasks of a Python worker."""
    return Encoder(path, by_words)


def _write_rows(path: str, by_words: bool, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = _encoder(path, by_words), TaskContext.get().partitionId(), 0
        for batch in pieces(batches, "text"):
            ids, first = encoder.encode(batch.column("text"), end)
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(batch.num_rows, part), pa.int32()), pa.array(first[:-1] + before),
                 pa.array(np.diff(first)), lists], [c.split()[0] for c in COLUMNS.split(", ")])
            before += int(first[-1])
    return run


def write_tokens(docs: DataFrame, out: str, tokenizer_path: str, by_words: bool = False, end: int = END, file_bytes: int = FILE_BYTES,
                 stripe_bytes: int = STRIPE_BYTES, index_rows: int = INDEX_ROWS) -> None:
    """Write the ids of every text of ``docs`` (doc_id, text) with ``end`` appended as ORC files below ``out``.

    Rows ascend by doc_id through the files in order of their names; null ids come first, rows of one id by a hash of
    their text. ``by_words``: see :class:`Encoder`. A null text has the end id alone; repeated rows are written each; an empty table gives files without
    rows. Other columns aren't read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # rows alike in id and text may lie in any file
    order = ["doc_id", F.xxhash64("text"), F.monotonically_increasing_id()]
    keyed = rows.select("doc_id", "text", order[1].alias("text_key"), order[2].alias("row"))
    files = max(-(-size // file_bytes), spark.sparkContext.defaultParallelism)
    spread = keyed.repartitionByRange(files, "doc_id", "text_key", "row").sortWithinPartitions("doc_id", "text_key", "row")
    ids = spread.select("doc_id", "text").mapInArrow(_write_rows(tokenizer_path, by_words, end), COLUMNS)
    writer = ids.write.mode("overwrite").option("compression", "zstd")
    for key, value in {"orc.stripe.size": stripe_bytes, "orc.row.index.stride": index_rows, "orc.bloom.filter.columns": "doc_id",
                       "orc.bloom.filter.fpp": 0.01, "orc.rows.between.memory.checks": 100}.items():
        writer = writer.option(key, str(value))
    writer.orc(out)


def read_tokens(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None, low: int | None = None,
                high: int | None = None) -> DataFrame:
    """Rows of the files; ``doc_ids`` (a few) and ``low`` .. ``high`` (inclusive) reach the scan as filters on doc_id, so that
    stripes and row groups without such ids are skipped by their metadata."""
    rows = spark.read.schema(COLUMNS).orc(path)
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin(list(doc_ids)))
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.where(F.col("doc_id") <= high)
    return rows


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        at = lists.offsets.to_numpy()
        raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False)).astype("<u4").tobytes())
        sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "part", "before")), pa.array(np.diff(at).astype(np.int64)),
                                          pa.array(sums, pa.int64())], ["doc_id", "part", "before", "n_tokens", "ids_crc32"])


def token_places(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of the files: the ids before it, its own, and their CRC-32."""
    rows = read_tokens(spark, path)
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = files.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    read = rows.select("doc_id", "part", "before", "ids").mapInArrow(
        _checked, "doc_id long, part int, before long, n_tokens long, ids_crc32 long")
    return (read.join(F.broadcast(files), "part")
            .select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))


def op13_token_files(spark, sf_dir: str) -> DataFrame:
    """Place, number and checksum of every document's token ids, read back from ORC files."""
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.path("word_bpe_49k.json"), by_words=True)
    return token_places(spark, path)
