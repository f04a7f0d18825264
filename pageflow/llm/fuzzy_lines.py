r"""Fuzzy line dedup: SimHash of normalised lines, pigeonhole blocks, edit similarity, connected groups.

Distinct normalised lines get a 64-bit SimHash of their words and word pairs. Hashes that differ in at most ``DISTANCE`` bits
agree in ``MATCH`` of ``BLOCKS`` blocks, so lines meet under every choice of blocks. One replaced word changes more bits than
that in all but long lines, so lines also meet by ``BANDS`` bands of least hashes of their word pairs, within ``FAR`` bits.
Most keys belong to one line alone: they are shuffled as packed marks, and only lines that share one are read again.
Those whose edit similarity is high are linked, and of each connected group only the first occurrence in the corpus stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.llm.common import components, join_narrow, staged
from pageflow.llm.words import LOWER, Words, buffer_of, chain, mix, pieces, unique_in_rows, words_in

#: Lines of fewer words are copies only if their normalised words are equal: they are too short to tell a near copy from a coincidence.
MIN_WORDS = 5
DISTANCE, BLOCKS, MATCH = 3, 6, 3
#: Lines that meet by bands are compared up to so many bits; unrelated lines differ in 32.
BANDS, FAR = 16, 24
#: Least hashes of a band: (how many, for lines of so many words at least, at most); neighbouring ranges overlap.
LEVELS = ((2, 0, 11), (3, 9, 22), (4, 18, 1 << 62))
MIN_SIMILARITY = 0.9
NO_ID = (1 << 63) - 1
#: Bits of a band's key that choose its bucket, and of the rest that mark it there; bits that mark a line. Lines that meet by
#: chance because their keys' marks are equal are compared like others.
BUCKET_BITS, KEY_BITS, LINE_BITS = 10, 32, 40
#: Two blocks of every choice of MATCH blocks, so that a hash goes to six places, in so many buckets each, in place of twenty.
PAIRS = ((0, 1), (0, 2), (1, 2), (3, 4), (3, 5), (4, 5))
PAIR_BITS = 8
#: Bits of the map of lines that share a key (8 MB): a full map costs rows, never results.
MAP_BITS = 1 << 26

_bytes = np.arange(256)
_digit = (_bytes >= 0x30) & (_bytes <= 0x39)
_content = (((_bytes | 0x20) >= 0x61) & ((_bytes | 0x20) <= 0x7A)) | _digit | (_bytes >= 0x80)
_NORMAL = np.where(_digit, 0x30, LOWER).astype(np.uint8)
#: The eight bits of a byte, one in each byte of a number, so that 255 of them can be added at once.
_SPREAD = np.unpackbits(_bytes.astype(np.uint8)).view(np.uint64)
_WORDS_AT_ONCE = 127
_EDGES = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
_BLOCKS = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in pairwise(_EDGES)]
_TRIPLES = [[x for x in combinations(range(BLOCKS), MATCH) if next(p for p in PAIRS if set(p) <= set(x)) == pair] for pair in PAIRS]


def lines_of(column: pa.Array, min_words: int = 1) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """(content words, each line's range of words, its row, its number) of the lines with enough words.

    A line's number counts all lines of its text, empty ones too.
    """
    data, offsets = buffer_of(column)
    words = words_in(_NORMAL[data], offsets, _content)
    # a line begins where its row begins and after every line break
    after = np.flatnonzero(data == 0x0A) + 1
    start = np.unique(np.concatenate((offsets[:-1], after)))
    row = np.searchsorted(offsets[:-1], start, "right") - 1
    number = np.arange(len(start)) - np.searchsorted(start, offsets[:-1])[row] if len(start) else row
    first = np.searchsorted(words.start, start)
    last = np.append(first[1:], len(words.start))
    keep = last - first >= min_words
    return words, np.stack((first[keep], last[keep])), row[keep], number[keep]


def _squeeze(words: Words, ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of the given lines alone, and each line's range among them."""
    n = ranges[1] - ranges[0]
    first = np.concatenate(([0], np.cumsum(n)))
    at = np.repeat(ranges[0], n) + np.arange(first[-1]) - np.repeat(first[:-1], n)
    return at, first


def simhash(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64-bit SimHash of every line's words and pairs of neighbouring words; no line is empty."""
    out = np.zeros(len(first) - 1, dtype=np.uint64)
    at = 0
    while at < len(out):  # about 100,000 words at once
        to = max(at + 1, int(np.searchsorted(first, first[at] + 100_000, "right")) - 1)
        h, f = hashes[first[at]:first[to]], first[at:to + 1] - first[at]
        pair = mix(h * np.uint64(0x9E3779B97F4A7C15) + np.append(h[1:], np.uint64(0)))
        n = -(-np.diff(f) // _WORDS_AT_ONCE)  # parts of a line
        part = np.concatenate(([0], np.cumsum(n)))
        start = np.repeat(f[:-1] - _WORDS_AT_ONCE * part[:-1], n) + _WORDS_AT_ONCE * np.arange(part[-1])
        votes = np.empty((len(start), 64), dtype=np.uint8)
        for k in range(8):
            bits = _SPREAD[pair.view(np.uint8)[k::8]]
            bits[f[1:] - 1] = 0  # the last word begins no pair
            bits += _SPREAD[h.view(np.uint8)[k::8]]
            votes[:, 8 * k:8 * k + 8] = np.add.reduceat(bits, start).view(np.uint8).reshape(-1, 8)
        votes = np.add.reduceat(votes, part[:-1], axis=0, dtype=np.int32)
        features = 2 * np.diff(f) - 1
        out[at:to] = np.packbits(2 * votes > features[:, None], axis=1).view(np.uint64).ravel()
        at = to
    return out


def bands(hashes: np.ndarray, first: np.ndarray, count: int = BANDS) -> tuple[np.ndarray, np.ndarray]:
    """(key, line) for every band of every line; lines of one word have none."""
    pair = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + np.append(hashes[1:], np.uint64(0)))
    inner = np.ones(len(pair), dtype=bool)
    inner[first[1:] - 1] = False  # the last word begins no pair
    pair, n = pair[inner], np.diff(first)
    lines = np.flatnonzero(n > 1)
    if not len(lines):
        return np.zeros(0, np.uint64), lines
    n = n[lines]
    start = np.concatenate(([0], np.cumsum(n - 1)[:-1]))
    odd = mix(np.arange(1, 1 + count * LEVELS[-1][0], dtype=np.uint64)) | np.uint64(1)
    keys, rows = [], []
    for band in range(count):
        total = np.full(len(lines), band + 1, dtype=np.uint64)
        for k in range(LEVELS[-1][0]):
            total = mix(total + np.minimum.reduceat(pair * odd[band * LEVELS[-1][0] + k], start))
            for size, low, high in LEVELS:
                if size == k + 1:
                    some = (n >= low) & (n <= high)
                    keys.append(total[some])
                    rows.append(lines[some])
    return np.concatenate(keys), np.concatenate(rows)


def _bits(hashes: np.ndarray, blocks: tuple[int, ...]) -> np.ndarray:
    """The bits of some blocks, mixed with their numbers: the key of a choice of blocks."""
    mask, number = sum(_BLOCKS[i] for i in blocks), sum(1 << i for i in blocks)
    return mix((hashes & np.uint64(mask)) + mix(np.array([number], dtype=np.uint64)))


def _packed(bucket: np.ndarray, *columns: tuple[np.ndarray, int]) -> tuple[np.ndarray, pa.Array]:
    """The buckets, and the bytes of each one's rows: so many low bytes of every column."""
    order = np.argsort(bucket, kind="stable")
    width = sum(n for _, n in columns)
    out, at = np.empty((len(bucket), width), dtype=np.uint8), 0
    for values, n in columns:
        out[:, at:at + n] = values[order].view(np.uint8).reshape(-1, 8)[:, :n]
        at += n
    size = np.bincount(bucket)
    some = np.flatnonzero(size)
    offsets = np.concatenate(([0], np.cumsum(size[some]))) * width
    return some, pa.Array.from_buffers(pa.large_binary(), len(some), [None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.binary())


def _unpacked(marks: pa.ChunkedArray, *sizes: int) -> list[np.ndarray]:
    """The columns of a bucket's rows."""
    every, at, out = np.frombuffer(b"".join(marks.to_pylist()), dtype=np.uint8).reshape(-1, sum(sizes)), 0, []
    for n in sizes:
        column = np.zeros((len(every), 8), dtype=np.uint8)
        column[:, :n] = every[:, at:at + n]
        out.append(column.view(np.uint64).ravel())
        at += n
    return out


def _marks(count: int):
    """(bucket, marks): marks of the bands and the hashes of the distinct lines of a batch, by bucket."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            words, ranges, _, _ = lines_of(batch.column("text"), MIN_WORDS)
            at, first = _squeeze(words, ranges)
            line, new = np.unique(chain(words.hash[at], first), return_index=True)
            if not len(line):
                continue
            at, first = _squeeze(words, ranges[:, new])
            hashes = simhash(words.hash[at], first)
            place = [(np.uint64(i << PAIR_BITS) + (_bits(hashes, pair) >> np.uint64(64 - PAIR_BITS))).astype(np.uint16) for i, pair in enumerate(PAIRS)]
            bucket, marks = _packed(np.concatenate(place), (np.tile(hashes, len(PAIRS)), 8), (np.tile(line, len(PAIRS)), LINE_BITS // 8))
            # bands have buckets below 0
            yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), marks], ["bucket", "marks"])
            if count:
                key, row = bands(words.hash[at], first, count)
                bucket, marks = _packed((key >> np.uint64(64 - BUCKET_BITS)).astype(np.uint16), (key, KEY_BITS // 8), (line[row], LINE_BITS // 8))
                yield pa.RecordBatch.from_arrays([pa.array(-1 - bucket.astype(np.int32)), marks], ["bucket", "marks"])
    return emit


def _meeting(key: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, mark) of the lines of every key that two different lines have."""
    ordered = np.sort(key)
    some = _among(key, np.unique(ordered[1:][ordered[1:] == ordered[:-1]]))
    mark, key = unique_in_rows(mark[some], key[some])
    same = key[1:] == key[:-1]
    both = np.zeros(len(key), dtype=bool)
    both[1:] |= same
    both[:-1] |= same
    return key[both], mark[both]


def _shared(bucket: pa.Table) -> pa.Table:
    """(key, mark) of the lines of one bucket for every key that two different lines have."""
    number = bucket.column("bucket")[0].as_py()
    if number < 0:
        key, mark = _unpacked(bucket.column("marks"), KEY_BITS // 8, LINE_BITS // 8)
        found = [_meeting(key + np.uint64((-1 - number) << KEY_BITS), mark)]
    else:
        hashes, mark = _unpacked(bucket.column("marks"), 8, LINE_BITS // 8)
        found = [_meeting(_bits(hashes, choice), mark) for choice in _TRIPLES[number >> PAIR_BITS]]
    key, mark = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
    return pa.table({"key": key, "mark": mark})


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which of the values are among the ordered ones."""
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        words, ranges, row, number = lines_of(batch.column("text"))
        at, first = _squeeze(words, ranges)
        yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row)), pa.array(number), pa.array(chain(words.hash[at], first).view(np.int64))],
                                         ["id", "number", "line"])


def _joined(words: Words, ranges: np.ndarray) -> pa.Array:
    """The words of every given line, joined by one space."""
    at, first = _squeeze(words, ranges)
    size = words.end[at] - words.start[at] + 1  # and a space
    to = np.concatenate(([0], np.cumsum(size)))
    source = np.repeat(words.start[at] - to[:-1], size) + np.arange(to[-1])
    source[to[1:] - 1] = 0
    data = words.data[source] if len(source) else np.zeros(0, np.uint8)
    data[to[1:] - 1] = 0x20
    data = np.delete(data, to[first[1:]] - 1)  # none after a line's last word
    offsets = to[first] - np.arange(len(first))
    return pa.Array.from_buffers(pa.large_string(), len(first) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.string())


def _line_texts(marked):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(line, mark, hash, size, normal) of the distinct lines of a batch that are on the map."""
        for batch in pieces(batches, "text"):
            words, ranges, _, _ = lines_of(batch.column("text"), MIN_WORDS)
            at, first = _squeeze(words, ranges)
            line, new = np.unique(chain(words.hash[at], first), return_index=True)
            mark = line & np.uint64((1 << LINE_BITS) - 1)
            bit = mark % np.uint64(MAP_BITS)
            found = (marked.value[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
            at, first = _squeeze(words, ranges[:, new[found]])
            text = _joined(words, ranges[:, new[found]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(line[found].view(np.int64)), pa.array(mark[found].view(np.int64)), pa.array(simhash(words.hash[at], first).view(np.int64)),
                 pc.utf8_length(text), text], ["line", "mark", "hash", "size", "normal"])
    return emit


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, by bit-parallel columns over one big integer."""
    a, b = _trimmed(a, b)
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, distance = full, 0, len(a)  # rises and falls between neighbouring cells of a column
    for x in b:
        same = where.get(x, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        rise, fall = down | (full & ~(diagonal | up)), up & diagonal
        distance += bool(rise & top) - bool(fall & top)
        rise, fall = (rise << 1 | 1) & full, (fall << 1) & full
        up, down = fall | (full & ~(diagonal | rise)), rise & diagonal
    return distance


def _most(size, min_similarity: float):
    """So many edits at most lie between lines of which the longer one has this size."""
    return (1 - min_similarity) * size + 1e-9


def _close_texts(x: list[str], y: list[str], most: list[int]) -> np.ndarray:
    """Which pairs of neither empty nor equal texts are ``most`` edits apart or less: bands around the diagonal, many pairs at a time."""
    order = sorted(range(len(x)), key=lambda i: -len(x[i]))
    wide = max(most)
    n, m = np.array([len(x[i]) for i in order]), np.array([len(y[i]) for i in order])
    kind = np.int16 if n[0] + 3 * wide < 30_000 else np.int32
    a, b = np.zeros((n[0], len(order)), np.uint32), np.full((n[0] + 2 * wide + 1, len(order)), 0xFFFFFFFF, np.uint32)
    for col, i in enumerate(order):
        a[:n[col], col] = np.frombuffer(x[i].encode("utf-32-le"), np.uint32)
        part = np.frombuffer(y[i].encode("utf-32-le"), np.uint32)[:len(b) - wide]
        b[wide:wide + len(part), col] = part
    # row r of the band is the cell of text y at i + r - wide, less r, so that a step along y is a running minimum
    cells = np.full((2 * wide + 2, len(order)), n[0] + 2 * wide, kind)
    cells[wide:-1] = -wide
    out = np.full(len(order), n[0] + 2 * wide)
    for i in range(n[0]):
        live = int(np.searchsorted(-n, -i, "left"))  # texts of more than i signs
        cells = cells[:, :live]
        step = cells[:-1] + (b[i:i + 2 * wide + 1, :live] != a[i, :live])
        np.minimum(step, cells[1:] + kind(2), out=step)
        cells[:-1] = np.minimum.accumulate(step, axis=0)
        done = np.flatnonzero(n[:live] == i + 1)
        at = m[done] - n[done] + wide
        out[done] = cells[at, done] + at
    close = np.zeros(len(order), dtype=bool)
    close[order] = out <= np.array(most)[order]
    return close


def _trimmed(a: str, b: str) -> tuple[str, str]:
    """Two texts without what they begin and end with alike."""
    low, most = 0, min(len(a), len(b))
    while low < most and a[low] == b[low]:
        low += 1
    high = 0
    while high < most - low and a[-1 - high] == b[-1 - high]:
        high += 1
    return a[low:len(a) - high], b[low:len(b) - high]


def _similar(min_similarity: float):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok, rest = np.zeros(batch.num_rows, dtype=bool), []
            for i, (x, y) in enumerate(zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)):
                most = int(_most(max(len(x), len(y)), min_similarity))
                if abs(len(x) - len(y)) > most:
                    continue
                x, y = _trimmed(x, y)
                if min(len(x), len(y)) == 0 or max(len(x), len(y)) <= most:
                    ok[i] = True
                elif len(x) > 2000:  # then the columns of one pair are work enough
                    ok[i] = edit_distance(x, y) <= most
                else:
                    rest.append((i, x, y, most))
            rest.sort(key=lambda r: (r[3], len(r[1])))
            for k in range(0, len(rest), 128):
                at, x, y, most = zip(*rest[k:k + 128], strict=True)
                ok[list(at)] = _close_texts(x, y, most)
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return check


def _verified(pairs: DataFrame, texts: DataFrame, min_similarity: float) -> DataFrame:
    """Pairs (a, b) of lines whose edit similarity is high enough."""
    pairs = staged(pairs)
    mine = texts.select("line", "normal")
    of = {x: join_narrow(mine, pairs.select(F.col(x).alias("line")).distinct(), "line", "left_semi") for x in ("a", "b")}
    # comparing costs more than its bytes tell: the pairs stay spread over a number of parts
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = (pairs.join(of["a"].select(F.col("line").alias("a"), F.col("normal").alias("x")), "a").repartition(parts, "b")
            .join(of["b"].select(F.col("line").alias("b"), F.col("normal").alias("y")), "b"))
    return both.select("a", "b", "x", "y").mapInArrow(_similar(min_similarity), "a long, b long")


def line_groups(docs: DataFrame, min_similarity: float = MIN_SIMILARITY, count: int = 0) -> tuple[DataFrame, DataFrame]:
    """(occurrences (id, number, line), groups (line, root)); a line of a group of one is not in the latter.

    A line under ``MIN_WORDS`` is in a group with its exact copies only.

    ``docs`` has id and text. ``count`` is the number of bands; without any, lines are linked within ``DISTANCE`` bits only.
    """
    spark = docs.sparkSession
    rows = staged(docs.mapInArrow(_line_rows, "id long, number long, line long"))
    marks = docs.select("text").mapInArrow(_marks(count), "bucket int, marks binary")
    shared = staged(marks.groupBy("bucket").applyInArrow(_shared, "key long, mark long"))
    # the lines that meet another, on a map of fixed size put together by Spark
    met = staged(shared.select("mark").distinct())
    bit = F.pmod(F.col("mark"), F.lit(MAP_BITS))
    bits = met.select(F.floor(bit / 32768).cast("int").alias("bucket"), (bit % 32768).cast("long").alias("bit"))
    marked = np.zeros(MAP_BITS // 8, np.uint8)
    for r in bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():  # at most MAP_BITS / 32768 rows of 4 KB
        marked[r.bucket * 4096:(r.bucket + 1) * 4096] = np.frombuffer(r.bits, np.uint8)
    found = docs.select("text").mapInArrow(_line_texts(spark.sparkContext.broadcast(marked)), "line long, mark long, hash long, size int, normal string")
    texts = staged(join_narrow(found, met, "mark", "left_semi").groupBy("line").agg(*(F.first(x).alias(x) for x in ("mark", "hash", "size", "normal"))))
    near = staged(shared.join(texts.select("mark", "line", "hash", "size"), "mark").select("key", "line", "hash", "size"))
    close = ((F.bit_count(F.col("hash").bitwiseXOR(F.col("other"))) <= (FAR if count else DISTANCE))
             & (F.abs(F.col("size") - F.col("other_size")) <= _most(F.greatest("size", "other_size"), min_similarity)))
    # each line with the least line of its block; then, where a block still holds several parts, across the parts
    head = near.groupBy("key").agg(F.min(F.struct("line", "hash", "size")).alias("h"))
    first = near.join(head.select("key", F.col("h.line").alias("a"), F.col("h.hash").alias("other"), F.col("h.size").alias("other_size")), "key").where(close)
    links = staged(_verified(first.where("line <> a").select("a", F.col("line").alias("b")).distinct(), texts, min_similarity))
    parts = staged(components(links))
    split = near.join(parts.select(F.col("id").alias("line"), "component_id"), "line", "left").withColumn("part", F.coalesce("component_id", "line"))
    open_keys = split.groupBy("key").agg((F.min("part") != F.max("part")).alias("open")).where("open").select("key")
    split = staged(split.join(open_keys, "key", "left_semi").select("key", "line", "hash", "size", "part"))
    other = split.select("key", F.col("line").alias("b"), F.col("hash").alias("other"), F.col("size").alias("other_size"), F.col("part").alias("part_b"))
    rest = split.join(other, "key").where("part <> part_b and line < b").where(close).select(F.col("line").alias("a"), "b").distinct()
    # the parts found so far are stars already, which take fewer rounds than their links
    links = parts.select(F.col("id").alias("a"), F.col("component_id").alias("b")).unionByName(_verified(rest, texts, min_similarity))
    return rows, components(links).select(F.col("id").alias("line"), F.col("component_id").alias("root"))


def dedup_lines(docs: DataFrame, min_similarity: float = MIN_SIMILARITY, count: int = 0) -> DataFrame:
    """(doc_id, n_lines, removed array<int>, n_removed) for every doc_id.

    n_lines counts the lines with a word; ``removed`` has the numbers (from 0, all lines counted) of the ones that go. The occurrence
    with the least (doc_id, number) of every group stays, a null doc_id counting as the largest. Repeated rows are one
    document; null and empty texts have no lines; an empty table gives no row; other columns are not read. With ``count``
    bands lines are linked by edit similarity alone, as ``op9_fuzzy_lines`` does; without, within ``DISTANCE`` bits.
    """
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.col("text").cast("string").alias("text"))
    rows, groups = line_groups(docs, min_similarity, count)
    rows = join_narrow(rows, staged(groups), "line", "left").withColumn("root", F.coalesce("root", "line"))
    first = rows.groupBy("root").agg(F.min(F.struct("id", "number")).alias("f")).select("f.id", "f.number")
    kept = first.groupBy("id").agg(F.collect_set("number").alias("kept"))  # one document's lines
    # a row without number stands for the document itself, and is in no list
    every = (rows.select("id", "number").unionByName(docs.select("id", F.lit(None).cast("long").alias("number")))
             .groupBy("id").agg(F.collect_set("number").alias("lines")))
    gone = F.array_sort(F.array_except("lines", F.coalesce("kept", F.array().cast("array<bigint>")))).cast("array<int>")
    out = every.join(kept, "id", "left").select("id", F.size("lines").cast("long").alias("n_lines"), gone.alias("removed"))
    return out.select(F.when(F.col("id") < NO_ID, F.col("id")).alias("doc_id"), "n_lines", "removed", F.size("removed").cast("long").alias("n_removed"))


def without_lines(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with the lines that ``dedup_lines`` removes cut from the text; the columns of ``docs``."""
    gone = found.where("n_removed > 0").select(F.col("doc_id").alias("id_"), F.col("removed").alias("removed_"))
    lines = F.split("text", "\n")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.coalesce("removed_", F.array().cast("array<int>")), i)), "\n")
    joined = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("id_")), "left")
    return joined.withColumn("text", F.when(F.col("removed_").isNull(), F.col("text")).otherwise(kept)).select(*docs.columns)


def op9_fuzzy_lines(spark, sf_dir: str) -> DataFrame:
    """Lines of all documents that go as copies of earlier ones."""
    return dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"), count=BANDS)
