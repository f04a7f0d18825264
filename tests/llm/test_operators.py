"""Each operator against a brute-force version, and on awkward tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pageflow.llm import (decontamination, fuzzy_lines, language, licences, mixing, queries, quality, sharding, similarity, substrings,
                          toxicity)

SF = "/root/testdata/sf0.001"
SF_LEARN = "/root/testdata/sf0.01"
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, id long, size long, sig long, n long, key string, words string, "
        "target double, rank int, shard int, spans string, known string, held_out string, `group` string")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 9))) + ("." if i % 9 == 8 else "") for i in range(n))


@pytest.fixture(scope="module")
def messy(spark):
    base = prose(1, 80)
    texts = [None, "", " \t\n", "one", "two words", base, base, base.replace(" ", "\n", 8), prose(2, 30_000), "### $$$ 123", "Ünïcode ñandú " * 30]
    rows = [(i if i != 3 else None, t, None if i % 4 == 0 else "en", None if i % 3 == 0 else f"s{i % 2}", None) + (None,) * 13
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [rows[5]], DOCS)  # a repeated row


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, None, i % 2 if i != 4 else None) for i in range(9)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, prose(1, 80)), (1, prose(1, 80)), (2, None), (3, ""), (None, "a b"), (5, "x")], "item_id long, text string")


def each(docs, labels, benchmark):
    return {
        "decontaminate": lambda: decontamination.decontaminate(docs, benchmark), "leaks": lambda: decontamination.leaks(docs, benchmark),
        "toxicity": lambda: toxicity.score(docs, labels), "shard": lambda: sharding.shard(docs), "language": lambda: language.identify(docs),
        "jaccard": lambda: similarity.jaccard_groups(docs), "keep_one": lambda: similarity.keep_one(docs), "quality": lambda: quality.judge(docs),
        "keep_good": lambda: quality.keep_good(docs), "substrings": lambda: substrings.drop_repeats(docs, with_text=True),
        "mix_plan": lambda: mixing.mix_plan(docs), "mix": lambda: mixing.mix(docs), "lines": lambda: fuzzy_lines.dedup_lines(docs),
        "licences": lambda: licences.scan_licences(docs)}


PER_ROW = {"toxicity", "shard", "language", "jaccard", "quality", "substrings", "mix_plan", "licences"}
SAME_COLUMNS = {"decontaminate", "keep_one", "keep_good", "mix"}


@pytest.mark.parametrize("name", sorted(PER_ROW | SAME_COLUMNS | {"leaks", "lines"}))
def test_awkward_rows_and_empty_tables(messy, labels, benchmark, name):
    out = each(messy, labels, benchmark)[name]()
    got = out.collect()
    if name in PER_ROW:
        assert len(got) == messy.count()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in messy.collect())
    if name in SAME_COLUMNS:
        assert out.columns == messy.columns
    empty = each(messy.limit(0), labels.limit(0), benchmark.limit(0))[name]()
    assert empty.count() == 0 and empty.columns == out.columns


def test_defined_results_of_awkward_rows(messy, labels, benchmark):
    by_id = lambda df: {r.doc_id: r for r in df.collect()}
    j = by_id(similarity.jaccard_groups(messy))
    assert [j[i].n_shingles for i in (0, 1, 2)] == [0, 0, 0] and j[1].component_id == 1 and j[6].component_id == j[7].component_id == 5
    assert j[None].n_shingles == 1 and j[None].component_id is None
    assert {i: r.lang_pred for i, r in by_id(language.identify(messy)).items() if i in (0, 1, 2, 9)} == dict.fromkeys((0, 1, 2, 9), "und")
    s = by_id(substrings.drop_repeats(messy))
    assert s[6].n_removed == s[6].n_words == 80 and s[5].n_removed == 0 and s[0].n_words == 0
    found = {(r.doc_id, r.item_id) for r in decontamination.leaks(messy, benchmark).collect()}
    assert found == {(5, 1), (6, 1), (7, 1)}
    assert {r.doc_id for r in similarity.keep_one(messy).where("doc_id in (5, 6, 7)").collect()} == {5}
    assert similarity.keep_one(messy).where("doc_id = 5").count() == 1


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    out = queries.QUERIES[name](spark, SF)
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(out.columns)
    assert sorted(map(tuple, out.select(*columns).collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("rows", [quality.BROADCAST_ROWS, 0])  # boilerplate broadcast, and joined
def test_quality_rejects_documents_of_lines_that_a_large_host_repeats(spark, monkeypatch, rows):
    monkeypatch.setattr(quality, "BROADCAST_ROWS", rows)
    plain = [prose(i, 60) for i in range(6000)]
    notices = [prose(9000 + i, 20) for i in range(4)]
    docs = [(i, t, "big") for i, t in enumerate(plain[:5800])]
    docs += [(10_000 + i, "\n".join([*notices, t.split(".")[0]]), "big") for i, t in enumerate(plain[:120])]  # 2 % of the host
    docs += [(20_000 + i, f"{notices[0]}\n{t}", "big") for i, t in enumerate(plain[5800:5900])]
    docs += [(30_000, "\n".join(notices), "small"), (30_001, "\n".join(notices), None), (None, "\n".join(notices), "big")]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    assert len(got) == len(docs) and not any(r.base_failed for r in got.values())
    assert {i for i, r in got.items() if not r.kept} == {10_000 + i for i in range(120)} | {None}
    assert all(got[20_000 + i].n_removed_words == 20 and got[20_000 + i].kept for i in range(100))
    assert got[30_000].n_removed_words == got[30_001].n_removed_words == 0
    texts = {r.doc_id: r.text for r in quality.keep_good(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    assert texts[20_000] == plain[5800] and texts[0] == plain[0] and 10_000 not in texts


def test_decontamination_finds_reparameterised_items(spark):
    item = "a train leaves the old station at 10 km from Rome and then drives 10 km more before it turns 3 times near the river"
    docs = [(1, f"first words here. {item} and more"), (2, item.replace("10", "25").replace("3", "7").replace("Rome", "Oslo")),
            (3, item.replace("10", "25", 1).replace("3", "7")), (4, prose(5, 60))]
    found = decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, item)], "item_id long, text string"))
    assert {(r.doc_id, r.same_values) for r in found.collect()} == {(1, True), (2, False)}  # in 3 one value became two


def test_decontamination_finds_renamed_sentence_openers(spark):
    item = "Alice has 5 apples. Bob has 7 more than Alice. Carol has twice as many. How many do they have together?"
    other = item.replace("Alice", "Dora").replace("Bob", "Emil").replace("Carol", "Fay").replace("5", "6").replace("7", "9")
    docs = [(1, other), (2, f'words before it\n"{other}"'), (3, f"Question {other}"), (4, f"Then {item}"),
            (5, other.replace("than Dora", "than Gus")), (6, "The wire at 220 V is 3 Km long and goes to town")]
    found = decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, item)], "item_id long, text string"))
    assert {(r.doc_id, r.same_values) for r in found.collect()} == {(1, False), (2, False), (3, False), (4, True)}  # in 5 one name became two
    words = spark.createDataFrame([docs[5]], "doc_id long, text string").select(decontamination.template(F.col("text"))).first()[0]
    assert words.count("_unit_") == 2 and words.count("_name_") == 1


def test_decontamination_finds_items_of_numbers_and_short_items(spark):
    items = [(1, "Sort these: 12, 7, 9, 31, 5, 18"), (2, "Define entropy briefly")]
    docs = [(1, "we ask: sort these: 12, 7, 9, 31, 5, 18 and then stop"), (2, "Sort these: 3, 8, 2, 44, 6, 91"), (3, "please define entropy briefly now")]
    found = decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.same_values) for r in found.collect()} == {(1, 1, True), (3, 2, True)}


def test_decontamination_matches_plain_search(spark):
    docs = spark.read.parquet(f"{SF_LEARN}/documents.parquet")
    bench = spark.read.parquet(f"{SF_LEARN}/benchmark.parquet")
    flat = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    texts = {r.doc_id: flat(r.text) for r in docs.collect()}
    want = {d for d, t in texts.items() for b in bench.collect() if flat(b.text)[:-5] in t}
    got = {r.doc_id for r in decontamination.leaks(docs, bench).collect()}
    assert want <= got and len(got - want) <= 2


def test_shards(spark):
    docs = spark.read.parquet(f"{SF_LEARN}/documents.parquet")
    got = sharding.shard(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    sizes, slots = Counter(), defaultdict(list)
    for r in got:
        raw = texts[r.doc_id].encode()
        assert r.size == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw)
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert sorted(sizes) == list(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r.size for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest + sum(sizes.values()) / 40 / 8
    hot = spark.createDataFrame([(i, "same text " * 20 if i % 3 else f"{i} other") for i in range(6000)], "doc_id long, text string")
    spread = [r[0] for r in sharding.shard(hot, 8).groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(spread) == 8 and max(spread) <= 1.02 * min(spread)


def test_mixing_targets(spark):
    docs = spark.read.parquet(f"{SF_LEARN}/documents.parquet").withColumn("source", F.when(F.col("source") != "src3", F.col("source")))
    got = mixing.mix_plan(docs).collect()
    own = {r.doc_id: (r.source, len(WORD.findall(r.text))) for r in docs.collect()}
    size = Counter()
    for s, n in own.values():
        size[s] += n
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = dict(zip(names, (mixing.WEIGHTS * len(names))[:len(names)], strict=True))
    target, free, left = {}, set(names), float(sum(size.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * size[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * size[s]
            left -= target[s]
            free.discard(s)
    taken, largest = Counter(), Counter()
    for r in got:
        s, n = own[r.doc_id]
        assert r.size == n and r.source_size == size[s] and abs(r.target - target[s]) < 1e-6 * target[s] and r.taken in (0, n, 2 * n, 3 * n)
        taken[s] += r.taken
        largest[s] = max(largest[s], n)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in names)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix_plan(docs.repartition(7)).collect()))
    uses = {r.doc_id: r.uses for r in got}
    assert Counter(r.doc_id for r in mixing.mix(docs).collect()) == Counter({d: u for d, u in uses.items() if u})


def test_jaccard_tells_texts_of_one_id_apart(spark):
    a, b, c, d, e = (prose(i, 120) for i in range(20, 25))
    docs = spark.createDataFrame([(None, a), (None, b), (1, a + " end"), (7, c), (7, d), (8, c + " end"), (9, e), (9, b + " end"), (7, c)],
                                 "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in similarity.jaccard_groups(docs).collect())
    assert got == sorted([("None", 116, "1"), ("None", 116, "9"), ("1", 117, "1"), ("7", 116, "7"), ("7", 116, "7"), ("7", 116, "7"),
                          ("8", 117, "7"), ("9", 116, "9"), ("9", 117, "9")])
    kept = sorted((str(r.doc_id), r.text) for r in similarity.keep_one(docs).collect())
    assert kept == sorted([("None", a), ("None", b), ("1", a + " end"), ("7", c), ("7", d), ("9", e), ("9", b + " end")])


def test_line_groups_match_brute_force(spark):
    rng = random.Random(3)
    lines = [prose(i, rng.randint(4, 60)) for i in range(40)]
    for i in range(60):
        words = rng.choice(lines[:40]).split()
        words[rng.randrange(len(words))] = "zzz"
        lines.append(" ".join(words))
    docs = [(i, "\n".join(rng.choice(lines) for _ in range(12))) for i in range(30)]
    got = {r.doc_id: set(r.removed) for r in fuzzy_lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    import pyarrow as pa
    normal, hashes = {}, {}
    for line in lines:
        words, ranges, *_ = fuzzy_lines.lines_of(pa.array([line]))
        if ranges.shape[1]:
            at, first = fuzzy_lines._squeeze(words, ranges)
            hashes[line] = int(fuzzy_lines.simhash(words.hash[at], first)[0])
            normal[line] = line.replace(".", "")
    group = {x: x for x in normal}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x
    for a in normal:
        for b in normal:
            near = bin(hashes[a] ^ hashes[b]).count("1") <= 3
            if near and fuzzy_lines.edit_distance(normal[a], normal[b]) <= 0.1 * max(len(normal[a]), len(normal[b])) + 1e-9:
                group[root(a)] = root(b)
    seen, want = set(), {i: set() for i, _ in docs}
    for i, text in docs:
        for k, line in enumerate(text.split("\n")):
            if line in normal:
                r = root(line)
                if r in seen:
                    want[i].add(k)
                seen.add(r)
    assert {i: s for i, s in got.items() if s} == {i: s for i, s in want.items() if s}


def test_line_groups_match_edit_similarity_alone(spark):
    rng = random.Random(5)
    lines = [prose(i, rng.randint(6, 60)).replace(".", "") for i in range(60)]
    for line in lines[:60]:
        for _ in range(3):
            words = line.split()
            words[rng.randrange(len(words))] = prose(rng.randrange(10**6), 1)
            lines.append(" ".join(words))
    alike = [(a, b) for a in lines for b in lines if a < b and abs(len(a) - len(b)) <= 0.1 * max(len(a), len(b))
             and fuzzy_lines.edit_distance(a, b) <= 0.1 * max(len(a), len(b)) + 1e-9]
    docs = spark.createDataFrame(list(enumerate(lines)), "id long, text string")
    rows, groups = fuzzy_lines.line_groups(docs, count=fuzzy_lines.BANDS)
    root = {r.id: r.root for r in rows.join(groups, "line", "left").select("id", F.coalesce("root", "line").alias("root")).collect()}
    at = {line: i for i, line in enumerate(lines)}
    assert len(alike) > 200 and sum(root[at[a]] == root[at[b]] for a, b in alike) >= 0.99 * len(alike)
    parent = {x: x for x in lines}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in alike:
        parent[find(a)] = find(b)
    assert all(find(a) == find(b) for a in lines for b in lines if root[at[a]] == root[at[b]])  # nothing else is linked


def line_arrays(lines):
    """(word hashes, each line's range, line hash) of texts of one line each."""
    import pyarrow as pa
    words, ranges, *_ = fuzzy_lines.lines_of(pa.array(lines))
    at, first = fuzzy_lines._squeeze(words, ranges)
    return words.hash[at], first, fuzzy_lines.chain(words.hash[at], first)


def test_marks_of_lines_find_every_shared_key(spark):
    rng = random.Random(7)
    lines = [prose(i, rng.randint(6, 40)).replace(".", "") for i in range(150)]
    lines += [" ".join("zzz" if i == 3 else w for i, w in enumerate(line.split())) for line in lines[:60]]
    hashes, first, line = line_arrays(lines)
    holders: dict = {}
    for i, h in enumerate(int(x) for x in fuzzy_lines.simhash(hashes, first)):
        for blocks in itertools.combinations(range(6), 3):
            holders.setdefault((blocks, *(h >> 64 * b // 6 & (1 << 64 * (b + 1) // 6 - 64 * b // 6) - 1 for b in blocks)), set()).add(i)
    for key, row in zip(*fuzzy_lines.bands(hashes, first), strict=True):
        holders.setdefault(int(key), set()).add(int(row))
    mask = (1 << fuzzy_lines.LINE_BITS) - 1
    want = sorted(sorted(int(line[i]) & mask for i in some) for some in holders.values() if len(some) > 1)
    # each line twice: its own copies don't make a key shared
    docs = spark.createDataFrame([(x,) for x in lines * 2], "text string").repartition(3)
    marks = docs.mapInArrow(fuzzy_lines._marks(fuzzy_lines.BANDS), "bucket int, marks binary")
    found = marks.groupBy("bucket").applyInArrow(fuzzy_lines._shared, "key long, mark long")
    got = found.groupBy("key").agg(F.sort_array(F.collect_list("mark")).alias("marks")).collect()
    assert sorted(r.marks for r in got) == want and len(want) > 500
    # 20 choices of blocks and 16 bands or more in well under 24 bytes a key
    one = docs.distinct().coalesce(1).mapInArrow(fuzzy_lines._marks(fuzzy_lines.BANDS), "bucket int, marks binary")
    assert one.agg(F.sum(F.length("marks"))).first()[0] < 300 * len(lines)


def test_simhash_counts_words_and_pairs_of_long_lines():
    lines = [prose(i, n) for i, n in enumerate((5, 127, 128, 254, 255, 700))] + ["abc " * 400]
    hashes, first, _ = line_arrays(lines)
    got = fuzzy_lines.simhash(hashes, first)
    for i, (a, b) in enumerate(itertools.pairwise(first)):
        h = hashes[a:b]
        pair = fuzzy_lines.mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
        bits = np.unpackbits(np.concatenate((h, pair)).view(np.uint8)).reshape(-1, 64).sum(axis=0)
        assert np.packbits(2 * bits > 2 * len(h) - 1).view(np.uint64)[0] == got[i]


def test_pairs_are_similar_by_edit_distance():
    import pyarrow as pa
    rng = random.Random(9)
    x, y = [], []
    for _ in range(600):
        a = [rng.choice("ab \u00e9\U0001f600") for _ in range(rng.choice((1, 8, 60, 300, 2500) if len(x) % 50 == 0 else (1, 8, 60, 200)))]
        b = a[:]
        for _ in range(rng.randint(0, 2 + len(a) // 6)):
            k = rng.randrange(len(b) + 1)
            b[k:k + rng.randint(0, 1)] = rng.choice(["", "x", "a"])
        x.append("".join(a))
        y.append("".join(b))
    pairs = pa.RecordBatch.from_pydict({"a": list(range(len(x))), "b": list(range(len(x))), "x": x, "y": y})
    for least in (0.95, 0.9, 0.8):
        want = [i for i, (a, b) in enumerate(zip(x, y, strict=True))
                if fuzzy_lines.edit_distance(a, b) <= (1 - least) * max(len(a), len(b)) + 1e-9]
        assert [i for found in fuzzy_lines._similar(least)([pairs]) for i in found.column("a").to_pylist()] == want and 100 < len(want) < 500


def test_exact_copies_of_short_lines(spark):
    docs = [(1, "All rights reserved.\nlonely"), (2, "other\nALL rights  reserved\n###"), (3, "all rights reserved"), (4, None), (5, "")]
    got = {r.doc_id: (r.n_lines, r.removed, r.n_removed) for r in fuzzy_lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: (2, [], 0), 2: (2, [1], 1), 3: (1, [0], 1), 4: (0, [], 0), 5: (0, [], 0)}


def test_repeated_passage_at_factor_boundaries(spark):
    a, b, c = prose(11, 200).split(), prose(12, 200).split(), prose(13, 200).split()
    docs = [(1, " ".join(a)), (2, " ".join(b[:50] + a[60:73] + b[50:])), (3, " ".join(c[:20] + a[10:40] + b[20:45] + c[20:] + a[60:72]))]
    got = {r.doc_id: r for r in substrings.drop_repeats(spark.createDataFrame(docs, "doc_id long, text string"), with_text=True).collect()}
    assert got[2].kept_text.split() == b and got[2].n_removed == 13
    assert got[3].kept_text.split() == c + a[60:72]
    assert got[3].kept_sha256 == hashlib.sha256(" ".join(c + a[60:72]).encode()).hexdigest()


def test_learned_models_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF_LEARN}/documents.parquet")
    lang = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in lang]) >= 0.97
    # sf0.01 has 45 toxic rows to learn from and 6 held out, too few for a figure
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = toxicity.score(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), labels).join(labels, "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    pairs = [(p.score > q.score) + 0.5 * (p.score == q.score) for p in scored if p.toxic for q in scored if not q.toxic]
    assert np.mean(pairs) >= 0.9
    found = licences.scan_licences(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    mit = [r for r in found if "Released under the MIT License." in r.text.split("\n")]
    assert mit and all("mit" in r.families for r in mit)
    assert np.mean([r.licence == "none" for r in found if "icense" not in r.text and "rights" not in r.text]) >= 0.98


def test_rows_of_one_id_lose_only_what_smaller_ids_hold(spark):
    a, b, c, d, e = (prose(20 + i, 60) for i in range(5))
    docs = [(1, a), (None, f"{a} {b}"), (None, f"{c} {d}"), (7, e), (7, a), (8, b)]
    rows = substrings.drop_repeats(spark.createDataFrame(docs, "doc_id long, text string"), with_text=True).collect()
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept_text) for r in rows)
    assert got == sorted([(1, 60, 0, a), (0, 120, 120, ""), (0, 120, 0, f"{c} {d}"), (7, 60, 0, e), (7, 60, 60, ""), (8, 60, 0, b)])


def test_mix_uses_equal_rows_as_planned(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", "en")] * 4 + [(2, "d e f g", "y", "en"), (2, "d e f g", "y", "de"), (None, None, "x", None)] * 2,
                                 "doc_id long, text string, source string, lang string")
    planned = mixing.mix_plan(docs).groupBy("doc_id", "source").agg(F.sum("uses").alias("n")).collect()
    mixed = mixing.mix(docs)
    got = Counter((r.doc_id, r.source) for r in mixed.collect())
    assert got == Counter({(r.doc_id, r.source): r.n for r in planned if r.n})
    assert mixed.columns == docs.columns


@pytest.mark.parametrize("change", [str.lower, str.upper, str.title])
def test_items_are_found_in_any_case(spark, change):
    item = "Alice has 5 apples. Bob has 7 more than Alice. Carol has twice as many. How many do they have together?"
    noun = "Der Hund und die Katze gehen mit dem Kind in den Garten und spielen dort am Abend mit einem Ball."
    docs = spark.createDataFrame([(1, f"{prose(31, 80)} {change(item)} {prose(32, 80)}"), (2, noun), (3, prose(33, 200))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, "What is 3 + 4?")], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect()] == [(1, 1)]


def test_items_of_many_lengths_are_found_in_one_pass(spark):
    items = [(i, " ".join(prose(40 + i, i).split())) for i in range(1, 14)]
    docs = [(i, f"{prose(60 + i, 40)} {t} {prose(80 + i, 40)}") for i, t in items]
    found = decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect() if r.doc_id == r.item_id} == {(i, i) for i, _ in items}


GPL3 = ("This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n"
        " * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.")
BSD = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:")
MPL = ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\n"
       "file, You can obtain one at https://mozilla.org/MPL/2.0/.")
STRANGE = ("Permission to redistribute this work under the terms of the Banana Licence, version 7, is granted to any person, "
           "provided that this copyright notice appears in all copies of the software")


@pytest.mark.parametrize("copies", [1, 300])
def test_licences_over_wrapped_lines(spark, copies):
    plain = [r.text for r in spark.read.parquet(f"{SF_LEARN}/documents.parquet").orderBy("doc_id").limit(400).collect()]
    plain = [t for t in plain if "icense" not in t and "rights" not in t and "CC0" not in t]
    notices = [(GPL3, "gpl-3.0"), (BSD, "bsd-3-clause"), (MPL, "mpl-2.0"), (STRANGE, "unknown")]
    docs, want = [(i, t) for i, t in enumerate(plain)], {i: "none" for i in range(len(plain))}
    for i, (notice, family) in enumerate(notices):
        for j, text in enumerate((notice, notice.replace("\n *", "").replace("\n", " "), f"{plain[i]}\n\n{notice}\n\n{plain[i + 5]}",
                                  f"{plain[i]}\n{notice}\n{plain[i + 5]}")):
            docs.append((1000 + 10 * i + j, text))
            want[1000 + 10 * i + j] = family
    docs += [(2000 + i, plain[0] + " and copies") for i in range(copies)]  # are not the whole background
    got = {r.doc_id: r.licence for r in licences.scan_licences(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    wrong = {i: (got[i], w) for i, w in want.items() if got[i] != w}
    assert not {i: w for i, w in wrong.items() if w[1] not in ("unknown", "none")}
    assert sum(w[1] == "none" for w in wrong.values()) == 0 and got[1030] == got[1031] == "unknown"


def test_run_scores_match_plain_sums():
    import pyarrow as pa
    model = licences.train([prose(i, 300).replace(".", "\n") for i in range(4)])
    text = f"{prose(50, 70)}\n{GPL3}\n\n{prose(51, 20)}"
    seen = licences.Passages(pa.array([None, text, "", "one"], pa.string()))
    assert seen.n_paragraphs.tolist() == [0, 2, 0, 1]
    words = licences._content_words(text) + ["one"]
    for length in range(1, licences.RUN + 1):
        first = seen.runs(length)
        got = model.run_scores(seen, first, length, model.totals(seen))
        for i, p in zip(first, got, strict=True):
            assert len(set(seen.paragraph[i:i + length])) == 1
            run = " ".join(words[seen.start[i]:seen.end[i + length - 1]])
            assert np.allclose(model.scores(*licences._grams_of([run]))[0], p, atol=1e-4)


def test_mixed_documents_count_the_training_order_itself(spark):
    docs = spark.read.parquet(f"{SF_LEARN}/documents.parquet").select("doc_id", "text", "source").limit(150)
    docs = docs.unionByName(docs.limit(20)).unionByName(spark.createDataFrame([(None, None, None), (None, None, None)], docs.schema))
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    got = mixing.mixed_documents(docs).collect()
    planned = mixing.mix_plan(docs).collect()
    rows = lambda found: Counter((r.doc_id, r.size, r.source_size, r.target, r.taken, r.uses, r.first_position) for r in found)
    assert rows(got) == rows(planned) and len(got) == docs.count()
    uses = mixing._uses(mixing._mixed(docs, mixing.WEIGHTS, mixing.MAX_EPOCHS, mixing.SLOPES))
    order = sorted(mixing.in_training_order(uses).collect(), key=lambda r: r.slot)
    assert [r.slot for r in order] == list(range(sum(r.uses for r in planned)))
    assert [r.position for r in order] == sorted(r.position for r in order)
    # the mix has its texts in this order
    assert [r.doc_id for r in mixing.mix(docs).collect()] == [r.doc_id for r in order]
    first = {}
    for r in order:
        first.setdefault(tuple(r.row), r.slot)
    assert sorted(first.values()) == sorted(r.first_slot for r in got if r.uses)
    again = mixing.mixed_documents(docs.repartition(5)).collect()
    assert Counter((r.doc_id, r.taken, r.first_slot) for r in again if r.size) == Counter((r.doc_id, r.taken, r.first_slot) for r in got if r.size)
