r"""Quality rules by cross-document line frequency.

Lines are normalised and hashed, the distinct documents of a host that hold a line are counted, lines above a
limit (a share of the host's documents, or a count whatever the host's size) are removed, and a document that loses most
of its words is rejected. The source column is the host. Equal
texts of a host count as one document, so copies don't make each other's lines boilerplate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageflow.llm.common import BROADCAST_ROWS, staged
from pageflow.llm.words import (LOWER, WORD, Words, chain, list_array, mix, pieces, rows_of, sum_by_row, unique_in_rows, windows,
                                words_in, words_of)

#: A line is boilerplate of a host if more than this share of the host's documents hold it, and this many at least,
MAX_SHARE = 0.10
MIN_DOCS = 20
#: or if more documents than this hold it.
MAX_DOCS = 100
#: A document is depleted if removal leaves less than this share of its words.
MIN_LEFT = 0.3
MIN_WORDS = 50

_bytes = np.arange(256)
_digit = (_bytes >= 0x30) & (_bytes <= 0x39)
_content = (((_bytes | 0x20) >= 0x61) & ((_bytes | 0x20) <= 0x7A)) | _digit | (_bytes >= 0x80)
_in_line = _bytes != 0x0A
_symbol = np.isin(_bytes, np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
_first_byte = (_bytes & 0xC0) != 0x80
# digits are one class in a normalised line
_NORMAL = np.where(_digit, 0x30, LOWER).astype(np.uint8)
#: Stands for the document itself among its lines, so that one count gives a host's documents too.
DOCUMENT = -1


class Lines:
    """Lines of a batch with a word in them: hash of the raw line, of the normalised one, and words per line."""

    def __init__(self, column: pa.Array):
        self.words: Words = words_of(column)
        data, first = self.words.data, self.words.first
        offsets = _offsets(column)
        raw = words_in(data, offsets, _in_line)
        in_line = np.searchsorted(self.words.start, raw.start), np.searchsorted(self.words.start, raw.end)
        n = in_line[1] - in_line[0]
        some = n > 0
        self.n_words, self.raw, self.start, self.end = n[some], raw.hash[some], raw.start[some], raw.end[some]
        self.first = np.searchsorted(self.start, offsets)
        normal = words_in(_NORMAL[data], offsets, _content)
        at = np.searchsorted(normal.start, self.start), np.searchsorted(normal.start, self.end)
        ranges = np.concatenate((at[0], at[1][-1:])) if len(at[0]) else np.zeros(1, np.int64)
        # content words outside the kept lines lie in none; runs are contiguous because a line without a word has none
        self.normal = chain(normal.hash, ranges).view(np.int64)
        self.offsets, self.first_word = offsets, first


def _offsets(column: pa.Array) -> np.ndarray:
    from pageflow.llm.words import buffer_of
    return buffer_of(column)[1]


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", 1 << 21):
        lines = Lines(batch.column("text"))
        hashes, row = unique_in_rows(lines.normal, rows_of(lines.first))
        some = hashes != 0
        hashes, row = np.concatenate((hashes[some], np.full(batch.num_rows, DOCUMENT))), np.concatenate((row[some], np.arange(batch.num_rows)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("host").take(pa.array(row)), batch.column("text_key").take(pa.array(row)), pa.array(hashes, pa.int64())],
            ["host", "text_key", "line"])


def _pair(hosts: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """One number for every (host, line)."""
    return mix(mix(hosts.view(np.uint64)) + lines.view(np.uint64))


def host(source: Column) -> Column:
    """The host of a source, as a number; null is a host of its own."""
    return F.xxhash64(F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n")))


def _host_lines(docs: DataFrame) -> DataFrame:
    """(host, text_key, line) for every line of every document, and for the document itself."""
    rows = docs.select(host(F.col("source")).alias("host"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_line_rows, "host long, text_key long, line long")


def boilerplate(docs: DataFrame, max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS, max_docs: int = MAX_DOCS) -> DataFrame:
    """(host, line): hashes of normalised lines that too many distinct documents of a host hold."""
    counts = (_host_lines(docs).distinct().groupBy("host", "line").agg(F.count("*").alias("n"))
              .where(f"n >= {int(min_docs)} or n > {int(max_docs)} or line = {DOCUMENT}"))
    counts = staged(counts)
    total = counts.where(f"line = {DOCUMENT}").select("host", F.col("n").alias("total"))
    above = ((F.col("n") >= min_docs) & (F.col("n") > max_share * F.col("total"))) | (F.col("n") > max_docs)
    return staged(counts.where(f"line <> {DOCUMENT}").join(total, "host").where(above).select("host", "line"))


def _with_known(docs: DataFrame, rows: DataFrame, lines: DataFrame):
    """(``rows`` with the column known, broadcast boilerplate or None).

    Up to ``BROADCAST_ROWS`` boilerplate lines go to every task as sorted numbers. Beyond that each document gets the
    list of its own boilerplate lines, joined by host and text.
    """
    if lines.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        found = np.array([(r.host, r.line) for r in lines.toLocalIterator()], dtype=np.int64).reshape(-1, 2)
        keys = np.unique(_pair(found[:, 0].copy(), found[:, 1].copy()))
        return rows.withColumn("known", F.lit(None).cast("array<long>")), docs.sparkSession.sparkContext.broadcast(keys)
    known = (_host_lines(docs).distinct().join(lines, ["host", "line"], "left_semi")
             .groupBy("host", "text_key").agg(F.collect_list("line").alias("known")))  # one text's lines
    return rows.join(known, ["host", "text_key"], "left"), None


def _judged(with_text: bool, min_left: float, shared):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1 << 21):
            column = batch.column("text")
            lines = Lines(column)
            words, rows = lines.words, np.arange(batch.num_rows)
            n_words = np.diff(words.first)
            total = np.concatenate(([0], np.cumsum(WORD[words.data] & _first_byte[words.data])))
            word_chars = total[lines.offsets[1:]] - total[lines.offsets[:-1]]
            n_symbols = sum_by_row(_symbol[words.data], lines.offsets)
            line_row = rows_of(lines.first)
            n_dup = np.diff(lines.first) - np.bincount(unique_in_rows(lines.raw, line_row)[1], minlength=batch.num_rows)
            n_repeat = _repeated(words, rows)
            base_failed = (n_words < MIN_WORDS) | (100 * n_repeat > 50 * n_words)
            # boilerplate lines of the row's host
            if shared:
                line_keys = _pair(batch.column("host").to_numpy()[line_row], lines.normal)
                at = np.searchsorted(shared.value, line_keys)
                gone = np.append(shared.value, np.uint64(0))[at] == line_keys
                gone &= at < len(shared.value)
            else:
                known = batch.column("known")
                flat, at = known.flatten().to_numpy(zero_copy_only=False), known.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                gone = np.isin(_pair(line_row, lines.normal), _pair(np.repeat(rows, at), flat.astype(np.int64)))
            n_removed = np.bincount(line_row[gone], weights=lines.n_words[gone], minlength=batch.num_rows).astype(np.int64)
            depleted = (n_removed > 0) & ((n_words - n_removed) < min_left * n_words)
            out = {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup, "n_repeat_words": n_repeat,
                   "n_removed_words": n_removed}
            arrays = [batch.column("doc_id")] + [pa.array(x.astype(np.int64)) for x in out.values()]
            arrays += [pa.array(base_failed), pa.array(~base_failed & ~depleted)]
            names = ["doc_id", *out, "base_failed", "kept"]
            if with_text:
                arrays += [_without(column, lines, gone, line_row)] + [batch.column(i) for i in range(4, batch.num_columns)]
                names += ["text"] + batch.schema.names[4:]
            yield pa.RecordBatch.from_arrays(arrays, names)
    return judge


def _repeated(words: Words, rows: np.ndarray) -> np.ndarray:
    """Words per row in 3-word windows that the row holds twice or more."""
    h, first = windows(words, 3)
    if not len(h):
        return np.zeros(len(rows), np.int64)
    row = rows_of(first)
    order = np.lexsort((h, row))
    same = (h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1])
    twice = np.zeros(len(h), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words.hash) + 1, dtype=bool)
    at = np.flatnonzero(twice)
    at = at - first[row[at]] + words.first[row[at]]
    for k in range(3):
        covered[at + k] = True
    return sum_by_row(covered[:-1], words.first)


def _without(column: pa.Array, lines: Lines, gone: np.ndarray, line_row: np.ndarray) -> pa.Array:
    """Texts without the lines marked ``gone`` and their line ends; other rows are untouched."""
    texts = column.to_pylist()
    for row in np.unique(line_row[gone]):
        raw = texts[row].encode()
        mine = np.flatnonzero(gone & (line_row == row))
        keep, at = [], 0
        for s, e in zip(lines.start[mine] - lines.offsets[row], lines.end[mine] - lines.offsets[row], strict=True):
            keep.append(raw[at:s])
            at = min(len(raw), e + 1)
        texts[row] = b"".join([*keep, raw[at:]]).decode()
    return pa.array(texts, column.type)


FIGURES = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "n_removed_words long, base_failed boolean, kept boolean")


def judge(docs: DataFrame, with_text: bool = False, max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS,
          min_left: float = MIN_LEFT, max_docs: int = MAX_DOCS) -> DataFrame:
    """Figures and verdict of every row of ``docs`` (``FIGURES``); ``with_text`` adds the text without boilerplate lines
    and the other columns of ``docs``.

    A null text counts as empty and fails the base rules, as do all texts under 50 words. A null source is a host, a
    null doc_id stays null, repeated rows each get a row, an empty table gives none. Extra columns don't matter.
    """
    lines = boilerplate(docs, max_share, min_docs, max_docs)
    others = [c for c in docs.columns if c not in ("doc_id", "text")] if with_text else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       host(F.col("source")).alias("host"), F.xxhash64("text").alias("text_key"),
                       *[F.col(c).alias(f"other_{i}") for i, c in enumerate(others)])
    rows, shared = _with_known(docs, rows, lines)
    rows = rows.select("doc_id", "text", "host", "known", *[f"other_{i}" for i in range(len(others))])
    schema = FIGURES
    if with_text:
        schema += ", text string" + "".join(f", other_{i} {docs.select(c).dtypes[0][1]}" for i, c in enumerate(others))
    out = rows.mapInArrow(_judged(with_text, min_left, shared), schema)
    return out.withColumnsRenamed({f"other_{i}": c for i, c in enumerate(others)}) if others else out


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without rejected documents and boilerplate lines; the columns of ``docs``."""
    return judge(docs, with_text=True).where("kept").select(*docs.columns)


def op6_quality(spark, sf_dir: str) -> DataFrame:
    """Figures and verdict of every document."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
