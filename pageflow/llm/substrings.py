r"""Substring dedup by relative Lempel-Ziv parsing over anchored reference blocks.

Every document is cut into overlapping blocks at content-defined anchors: the anchor of a 13-word window is the
least hash among its 5-word shingles, and a block is the run of windows with the same anchor. Equal windows have equal
anchors, so a window's match lies in a block with the same anchor or nowhere. All blocks of the corpus are indexed
by anchor; a document is parsed greedily against the index, each block that an earlier document holds whole being
a factor, and neighbouring factors merge. At factor boundaries, where an anchor is known but the block around it
differs, the windows are checked one by one; a bitmap of these anchors tells a second scan which windows to send.
Words in factors are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.llm.common import staged
from pageflow.llm.words import Words, chain_of, mix, pieces, rows_of, windows, words_of

WINDOW = 13
SHINGLE = 5
#: Spans (8 bytes each) up to which the join that brings them to their documents broadcasts them.
BROADCAST_SPANS = 2_000_000
NO_ID = (1 << 63) - 1
#: Bits of the map of edge anchors (8 MB): a full map costs rows, never results.
EDGE_BITS = 1 << 26
# block: to be looked up; factor: found in an earlier document; edge: an anchor whose blocks' windows must be checked
BLOCK, FACTOR, EDGE = 0, 1, 2


def _pack(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A span of window starts as one number."""
    return (low << 32) | high


def blocks(words: Words) -> tuple[np.ndarray, ...]:
    """(row, anchor, content, first window, last window) of every block; windows counted in the row."""
    shingles, first = windows(words, SHINGLE)
    reach = WINDOW - SHINGLE + 1
    counts = np.maximum(np.diff(words.first) - (WINDOW - 1), 0)
    row = np.repeat(np.arange(len(counts)), counts)
    if not len(row):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty
    begin = np.concatenate(([0], np.cumsum(counts)))[:-1]
    window = np.arange(len(row)) - begin[row]
    at = first[row] + window
    best, arg = shingles[at], at.copy()
    for j in range(1, reach):
        here = shingles[at + j]
        less = here < best
        best[less] = here[less]
        arg[less] = at[less] + j
    new = np.ones(len(row), dtype=bool)
    new[1:] = (arg[1:] != arg[:-1]) | (row[1:] != row[:-1])
    start = np.flatnonzero(new)
    stop = np.concatenate((start[1:], [len(row)])) - 1
    row, low, high = row[start], window[start], window[stop]
    base = words.first[row]
    content = chain_of(words.hash, base + low, base + high + WINDOW)
    return row, best[start].view(np.int64), content.view(np.int64), low, high


def _merged(doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans sorted by document, with neighbours joined."""
    if not len(doc):
        return doc, low, high
    order = np.lexsort((high, low, doc))
    doc, low, high = doc[order], low[order], high[order]
    # within a document the reach so far; documents are told apart by a rising offset
    rank = np.cumsum(np.concatenate(([0], (doc[1:] != doc[:-1]).astype(np.int64))))
    step = int(high.max()) + 2
    reach = np.maximum.accumulate(high + rank * step)
    new = np.ones(len(doc), dtype=bool)
    new[1:] = low[1:] + rank[1:] * step > reach[:-1] + 1
    new[1:] |= rank[1:] != rank[:-1]
    start = np.flatnonzero(new)
    last = np.concatenate((start[1:], [len(doc)])) - 1
    return doc[start], low[start], reach[last] - rank[start] * step


def _known(doc: np.ndarray, *key: np.ndarray) -> np.ndarray:
    """Rows whose key a smaller id of the same batch has: copies are settled before the shuffle."""
    order = np.lexsort((doc, *key))
    new = np.zeros(len(doc), dtype=bool)
    new[:1] = True
    for x in key:
        new[1:] |= x[order][1:] != x[order][:-1]
    known = np.zeros(len(doc), dtype=bool)
    if len(doc):
        known[order] = doc[order] > doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    return known


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        ids, keys = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("id", "row"))
        row, anchor, content, low, high = blocks(words_of(batch.column("text")))
        doc, key = ids[row], keys[row]
        known = _known(doc, content, anchor)
        fkey, flow, fhigh = _merged(key[known], low[known], high[known])
        rest = ~known
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate((anchor[rest], mix(fkey.view(np.uint64)).view(np.int64)))),
            pa.array(np.concatenate((content[rest], fkey))),
            pa.array(np.concatenate((doc[rest], fkey))),
            pa.array(np.concatenate((key[rest], fkey))),
            pa.array(np.concatenate((_pack(low[rest], high[rest]), _pack(flow, fhigh)))),
            pa.array(np.concatenate((np.full(rest.sum(), BLOCK, np.int8), np.full(len(fkey), FACTOR, np.int8))))],
            ["anchor", "content", "id", "row", "span", "kind"])


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Factors and edges from blocks sorted by (anchor, content, id).

    The first document of a content keeps it; the others have a factor there. An anchor with several contents is an
    edge, told once with the anchor in place of the span. Between batches only one row of the last anchor is held.
    """
    held = [np.zeros(0, np.int64)] * 5
    several = False  # the held rows are of an anchor known to have several contents, and have been told
    for batch in batches:
        kind = batch.column("kind").to_numpy(zero_copy_only=False)
        own = [batch.column(x).to_numpy(zero_copy_only=False) for x in ("anchor", "content", "id", "row", "span")]
        done = kind == FACTOR
        out = [(own[3][done], own[4][done], FACTOR)]
        n_held = len(held[0])
        anchor, content, doc, key, span = (np.concatenate((h, x[~done])) for h, x in zip(held, own, strict=True))
        n = len(anchor)
        if n:
            new_anchor = np.ones(n, dtype=bool)
            new_anchor[1:] = anchor[1:] != anchor[:-1]
            new = new_anchor.copy()
            new[1:] |= content[1:] != content[:-1]
            start = np.flatnonzero(new)
            least = doc[start][np.cumsum(new) - 1]
            run = np.cumsum(new_anchor) - 1
            many = np.bincount(run[new]) > 1
            told = np.zeros(len(many), dtype=bool)
            told[0] = several and n_held > 0
            many |= told
            later = doc > least
            out.append((key[later], span[later], FACTOR))
            edge = anchor[np.flatnonzero(new_anchor)][many & ~told]
            out.append((edge, edge, EDGE))
            several = bool(many[-1])
            held = [x[start[-1]:start[-1] + 1] for x in (anchor, content, doc, key, span)]  # the first document of the last content
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([x[0] for x in out])), pa.array(np.concatenate([x[1] for x in out])),
            pa.array(np.concatenate([np.full(len(x[0]), x[2], np.int8) for x in out]))], ["row", "span", "kind"])


def _edge_windows(bitmap):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(window hash, id, row, window) for the windows of blocks with an edge anchor, once per document."""
        marked = bitmap.value
        for batch in pieces(batches, "text"):
            ids, keys = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("id", "row"))
            words = words_of(batch.column("text"))
            hashes, first = windows(words, WINDOW)
            row, anchor, _, low, high = blocks(words)
            bit = anchor.view(np.uint64) % np.uint64(EDGE_BITS)
            some = (marked[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
            row, low, n = row[some], low[some], (high - low + 1)[some]
            row, at = np.repeat(row, n), np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            window, doc, key = hashes[first[row] + at].view(np.int64), ids[row], keys[row]
            known = _known(doc, window)
            window[known] = mix(key[known].view(np.uint64)).view(np.int64)  # needs no look-up: goes anywhere
            yield pa.RecordBatch.from_arrays(
                [pa.array(window), pa.array(doc), pa.array(key), pa.array(_pack(at, at)), pa.array(np.where(known, FACTOR, BLOCK).astype(np.int8))],
                ["window", "id", "row", "span", "kind"])
    return emit


def _spans(column: pa.Array) -> tuple[np.ndarray, ...]:
    """(row, first window, last window) of every span of a list column."""
    n = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(n)), n), flat >> 32, flat & 0xFFFFFFFF


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of windows sorted by (window, id) that a smaller id holds."""
    window_, least = None, None
    for batch in batches:
        done = batch.column("kind").to_numpy(zero_copy_only=False) == FACTOR
        every = [batch.column(x).to_numpy(zero_copy_only=False) for x in ("window", "id", "row", "span")]
        if done.any():
            yield pa.RecordBatch.from_arrays([pa.array(every[2][done]), pa.array(every[3][done])], ["row", "span"])
        window, doc, key, span = (x[~done] for x in every)
        if not len(window):
            continue
        new = np.ones(len(window), dtype=bool)
        new[1:] = window[1:] != window[:-1]
        start = doc[np.flatnonzero(new)]
        if window[0] == window_:
            start[0] = least
        low = start[np.cumsum(new) - 1]
        window_, least = window[-1], low[-1]
        later = doc > low
        yield pa.RecordBatch.from_arrays([pa.array(key[later]), pa.array(span[later])], ["row", "span"])


def _merge_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, low, high = _spans(batch.column("spans"))
        row, low, high = _merged(row, low, high)
        first = np.searchsorted(row, np.arange(batch.num_rows + 1))
        lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(_pack(low, high), pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("row"), lists], ["row", "spans"])


def _with_spans(docs: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """Join documents with their span lists; broadcast only if the counted spans are few."""
    n = spans.agg(F.sum(F.size("spans") + 2)).first()[0] or 0
    return docs.join(F.broadcast(spans) if n <= BROADCAST_SPANS else spans, "row", how)


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(row, spans): for rows (id, row, text), the spans of window starts whose 13 words a smaller id holds too."""
    found = staged(rows.mapInArrow(_block_rows, "anchor long, content long, id long, row long, span long, kind byte")
                   .repartition("anchor").sortWithinPartitions("anchor", "content", "id")
                   .mapInArrow(_look_up, "row long, span long, kind byte"))
    # edge anchors as a bitmap of fixed size, put together by Spark
    bit = F.pmod(F.col("span"), F.lit(EDGE_BITS))
    edge = found.where(f"kind = {EDGE}").select(F.floor(bit / 32768).cast("int").alias("bucket"), (bit % 32768).cast("long").alias("bit"))
    bitmap = np.zeros(EDGE_BITS // 8, np.uint8)
    for r in edge.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():  # at most EDGE_BITS / 32768 rows of 4 KB
        bitmap[r.bucket * 4096:(r.bucket + 1) * 4096] = np.frombuffer(r.bits, np.uint8)
    checked = (rows.mapInArrow(_edge_windows(rows.sparkSession.sparkContext.broadcast(bitmap)), "window long, id long, row long, span long, kind byte")
               .repartition("window").sortWithinPartitions("window", "id").mapInArrow(_matched, "row long, span long"))
    every = found.where(f"kind = {FACTOR}").select("row", "span").unionByName(checked)
    every = every.groupBy("row").agg(F.collect_list("span").alias("spans"))  # one document's own
    return staged(every.mapInArrow(_merge_lists, "row long, spans array<long>"))


def _kept(with_text: bool):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            words = words_of(batch.column("text"))
            row, low, high = _spans(batch.column("spans"))
            n = np.diff(words.first)
            some = low < n[row]
            row, low, high = row[some], low[some], high[some]
            mark = np.zeros(len(words.hash) + 1, dtype=np.int64)
            np.add.at(mark, words.first[row] + low, 1)
            np.add.at(mark, words.first[row] + np.minimum(high + WINDOW, n[row]), -1)
            stay = np.cumsum(mark)[:-1] == 0
            texts, digests, kept = batch.column("text").to_pylist(), [], []
            left = np.add.reduceat(np.append(stay, False).astype(np.int64), words.first[:-1]) * (n > 0)
            for i, text in enumerate(texts):
                own = (text or "").encode().split()
                if left[i] < n[i]:
                    own = compress(own, stay[words.first[i]:words.first[i + 1]].tolist())
                own = b" ".join(own)
                digests.append(hashlib.sha256(own).hexdigest())
                kept.append(own.decode() if with_text else None)
            arrays = [batch.column("doc_id"), pa.array(n.astype(np.int64)), pa.array((n - left).astype(np.int64)), pa.array(digests)]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(kept, pa.string())] * with_text,
                                             ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text)
    return keep


def drop_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept_text]) for every row of ``docs``.

    A word goes if one of the 13-word windows over it also starts in a document with a smaller doc_id. A null or
    empty text has no words; a null doc_id counts as larger than all others. Rows that share a doc_id, or have none, lose
    what smaller ids hold, each by its own text, and nothing to one another. Repeated rows each get a row. An empty table gives no row; other columns are not read.
    """
    # an id may be shared or null: spans belong to the row, which its id and text tell
    id_, text = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.col("text").cast("string")
    rows = docs.select(id_.alias("id"), F.xxhash64(id_, text).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    spans = repeated_spans(rows.select("id", "row", "text"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return _with_spans(rows, spans, "left").select("doc_id", "text", "spans").mapInArrow(_kept(with_text), schema)


def op7_substrings(spark, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated passages."""
    return drop_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
