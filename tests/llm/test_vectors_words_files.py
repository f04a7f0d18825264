"""Spelling groups, centroid clusters and token files against brute force, and on awkward tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pageflow.llm import centroids, spelling, token_files

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


# spelling variants

def near_words(words) -> dict[str, set]:
    wild, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            wild[w[:i], w[i + 1:]].add(w)
    for w in words:
        for i in range(len(w)):
            near[w] |= {v for v in wild[w[:i], w[i + 1:]] if v != w}
            if (v := w[:i] + w[i + 1:]) in words:
                near[w].add(v)
                near[v].add(w)
    return near


def spelling_by_hand(docs) -> set:
    n = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc_id, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            n[w[:h % len(w)] + w[h % len(w) + 1:] if h % 97 == 0 else w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near, form = near_words(set(n)), {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best and n[best] >= 2 * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), c, len(near[w]), n[form[w]] if w in form else None) for w, c in n.items()}


def spelled(rows) -> set:
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows.collect()}


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefghijklmnop"])
def test_index_finds_every_word_one_edit_away(letters):
    rng = random.Random(letters)
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(5, 8))) for _ in range(1500)})
    near = near_words(set(words))
    for backward in (False, True):
        turned = words if backward else [w[::-1] for w in words]
        exact = np.array([len(w) - len(w) // 2 if backward else len(w) // 2 for w in words])
        found = {(words[a], words[b]) for a, b in zip(*spelling.Index(turned).near(turned, exact), strict=True)}
        wanted = {(w, v) for w in words for v in near[w]
                  if (v.endswith(w[len(w) // 2:]) if backward else v.startswith(w[:len(w) // 2]))}
        assert found == wanted


def test_spelling_matches_brute_force(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(4, 9))) for _ in range(400)]
    texts = [" ".join(rng.choice(base[:k]) for _ in range(rng.randint(0, 300))) for k in (20, 100, 400) for _ in range(60)]
    docs = [(i, t.title() if i % 3 == 0 else t) for i, t in enumerate(texts)]
    docs += [(None, texts[0]), (None, None), (5, ""), (5, texts[5]), (7, "x" * 100_000 + " Straße ABCDÉ abcdé")] + [(100_000 + i, "z" * 3000) for i in range(4)]
    got = spelling.spelling_groups(spark.createDataFrame(docs, "doc_id long, text string"))
    assert spelled(got) == spelling_by_hand(docs)


def test_words_meet_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "_block_count", lambda n, cores: 23)
    rng = random.Random(6)
    base = ["".join(rng.choice("abc") for _ in range(rng.randint(5, 9))) for _ in range(600)]
    docs = [(i, " ".join(base[i % 7::7] * 3)) for i in range(20)]
    got = spelling.spelling_groups(spark.createDataFrame(docs, "doc_id long, text string"))
    assert spelled(got) == spelling_by_hand(docs)


def test_spelling_of_empty_and_clashing_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_groups(empty).collect() == []
    docs = [(1, "apple apple apple aple aple aple apple apple apple", "x", 1)]
    got = spelling.spelling_groups(spark.createDataFrame(docs, "doc_id long, text string, word string, n int"))
    assert spelled(got) == spelling_by_hand([d[:2] for d in docs])


# centroid clusters

def clusters_by_hand(rows, k, rounds, size):
    kept = [(i, np.floor(256 * np.array(v, dtype=float)).astype(np.int64)) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    at = np.stack([v for _, v in kept])
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1].astype("<i4").tobytes()))
    centres = np.stack([v for _, v in order[:k]])
    for i in range(rounds + 1):
        d = ((at[:, None, :] - centres[None]) ** 2).sum(-1)
        near = d.argmin(1)
        if i < rounds:
            for c in set(near.tolist()):
                centres[c] = at[near == c].sum(0) // (near == c).sum()
    return sorted(((-1 if i is None else i), int(c), int(x)) for (i, _), c, x in zip(kept, near, d.min(1), strict=True)), centres


@pytest.mark.parametrize("seed, k, spread", [(1, 7, 1.0), (2, 25, 0.02), (3, 1, 1.0), (4, 2, 0.0), (5, 400, 1.0)])
def test_clusters_match_brute_force(spark, seed, k, spread):
    """``spread`` 0.02 and 0 make many ties: components are whole numbers after scaling."""
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in spread * rng.normal(size=6)]) for i in range(300)]
    rows += [(3, rows[3][1]), (3, rows[9][1]), (None, rows[4][1]), (900, None), (901, []), (902, rows[0][1][:5]), (903, rows[0][1] + [0.0]),
             (904, [None] * 6), (905, [float("nan")] * 6), (906, [float("inf")] + [0.0] * 5)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, cluster string")
    got, centres = centroids.cluster(frame, k=k, size=6)
    want, wanted = clusters_by_hand(rows, k, centroids.ROUNDS, 6)
    assert sorted((-1 if r.vec_id is None else r.vec_id, r["cluster"], r.distance) for r in got.collect()) == want
    assert (centres == wanted).all()


def test_bounds_part_most_vectors():
    """Bounds hold, and leave few vectors to be searched again."""
    rng = np.random.default_rng(7)
    middle = rng.integers(-4000, 4000, (30, 8))
    x = middle[rng.integers(0, 30, 2000)] + rng.integers(-300, 300, (2000, 8))
    near, second = np.zeros(2000, np.int32), np.ones(2000, np.int32)
    upper, lower = np.full(2000, np.inf), np.zeros(2000)
    centroids.assign(x, centroids.Centres(middle), near, second, upper, lower)
    d = ((x[:, None] - middle[None]) ** 2).sum(-1)
    assert (near == d.argmin(1)).all() and (np.sqrt(np.sort(d, axis=1)[:, 1]) >= lower).all()
    searched = lower > 0  # the others are closer to their centroid than half its distance to any other
    assert (second == np.argsort(d, axis=1, kind="stable")[:, 1])[searched].all()
    half = centroids.Centres(middle).half
    assert np.mean(upper < np.maximum(lower, half[near])) > 0.9


def test_clusters_of_an_empty_table(spark):
    got, centres = centroids.cluster(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert got.collect() == [] and len(centres) == 0


def test_component_out_of_range_is_refused(spark):
    frame = spark.createDataFrame([(1, [1e9] * 6)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster(frame, k=1, size=6)


# token files

@lru_cache
def tokenizer_of(path):
    return Tokenizer.from_file(path)


def ids_by_hand(path, text):
    return [*tokenizer_of(path).encode(text or "", add_special_tokens=False).ids, token_files.END]


def test_words_are_encoded_as_whole_texts_are():
    rng = random.Random(3)
    signs = list("aAbBsStTrReEvVmlLdD''''  \n\t09.,-&#<|>\r\v\0\x1c\x85") + [
        "é", "ß", "Σ", "ς", "́", "̱", "H", "İ", " ", " ", "中", "٣", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>",
        "K", "ﬁ", "ẞ", "🙂", "‍", "½", "à", "ÿ", "ª", "É", "Ø", "×", "÷"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(20_000)] + [None, "", "x" * 200_000, "it's " * 40_000]
    encoder, tokenizer = token_files.Encoder(WORDS, True), Tokenizer.from_file(WORDS)
    for _ in range(2):  # the second time from what it remembers
        ids, first = encoder.encode(pa.array(texts, pa.string()), 2)
        got = [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
        assert got == [[*e.ids, 2] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_whole_texts_of_another_tokenizer():
    texts = ["two  words\n", None, "", "Naïve café"]
    ids, first = token_files.Encoder(BYTES).encode(pa.array(texts, pa.string()), 2)
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [ids_by_hand(BYTES, t) for t in texts]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 3)
    encoder = token_files.Encoder(WORDS, True)
    for text in ("one two three four", "five one two", "", "one's, two"):
        ids, _ = encoder.encode(pa.array([text]), 2)
        assert ids.tolist() == ids_by_hand(WORDS, text)


def scanned(frame) -> int:
    """Rows that the scan of ``frame`` gave."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().head().metrics().get("numOutputRows").get().value()


def test_files_round_trip_and_prune(spark, tmp_path):
    rng = random.Random(8)
    rows = [(2 * i, " ".join(rng.choice(["alpha", "béta", "gamma,", "d3lta"]) for _ in range(rng.randint(0, 60))), "x") for i in range(6000)]
    rows += [(None, "no id", "x"), (None, None, "x"), (4, rows[2][1], "x"), (4, rows[2][1], "x"), (4, "other", "x")]
    rng.shuffle(rows)
    docs, path = spark.createDataFrame(rows, "doc_id long, text string, part string"), str(tmp_path / "ids")
    token_files.write_tokens(docs, path, WORDS, by_words=True, stripe_bytes=1 << 15)
    back = token_files.read_tokens(spark, path)
    # files in order of their names hold ascending ids; a row's place is the ids before it
    per_file = back.select("doc_id", "part", "before", "ids", F.input_file_name().alias("file")).collect()
    per_file.sort(key=lambda r: (r.part, r.before))
    assert [r.file for r in per_file] == sorted(r.file for r in per_file)
    ids = [-1 if r.doc_id is None else r.doc_id for r in per_file]
    assert ids == sorted(ids)
    encode = {t: ids_by_hand(WORDS, t) for t in {r[1] for r in rows}}
    assert Counter((r.doc_id, tuple(r.ids)) for r in per_file) == Counter((i, tuple(encode[t])) for i, t, _ in rows)
    start, want = 0, []
    for r in per_file:
        want.append((r.doc_id, start, len(r.ids), zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())))
        start += len(r.ids)
    got = [tuple(r) for r in token_files.token_places(spark, path).collect()]
    assert Counter(got) == Counter(want)
    # row indexes skip by range, Bloom filters by id: odd ids lie inside the ranges but in no row
    assert 0 < scanned(token_files.read_tokens(spark, path, low=2000, high=2010)) <= token_files.INDEX_ROWS
    assert scanned(token_files.read_tokens(spark, path, doc_ids=[2001])) == 0
    assert token_files.read_tokens(spark, path, doc_ids=[2000]).count() == 1


def test_stripes_are_read_in_parallel(spark, tmp_path):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.sequence(F.col("id"), F.col("id") + 200)).alias("text"))
    path = str(tmp_path / "ids")
    token_files.write_tokens(docs, path, WORDS, by_words=True, stripe_bytes=1 << 16)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    largest = sorted((p for p in (tmp_path / "ids").glob("*.orc")), key=lambda p: p.stat().st_size)[-1]
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(largest.stat().st_size // 4))
    try:
        one = spark.read.orc(str(largest))
        assert one.groupBy(F.spark_partition_id()).count().count() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_empty_table_of_documents(spark, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_tokens(spark.createDataFrame([], "doc_id long, text string"), path, WORDS)
    assert token_files.token_places(spark, path).collect() == []
