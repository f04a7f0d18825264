"""Property tests: Spark column rules vs direct Python statements of the same rules.

Each property evaluates one DataFrame of many generated rows, so a hypothesis
run costs a handful of Spark jobs.
"""

from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pageflow.functions.rules import severity, spam_reason
from pageflow.functions.text import STOP_WORDS, keep_keyword, title_words
from pageflow.functions.truthy import first_truthy

PIECES = st.sampled_from(list("abcXYZ019 _-:./ÁéŁłЁёАяІїЄєҐґ😀\n\twWhHtTpPsS")
                         + ["http://", "HTTPS://", "www.", "1234567", "Київ", "word"])
TITLE = st.lists(PIECES, max_size=25).map("".join)
TITLES = st.lists(TITLE, min_size=1, max_size=60)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

WORD_RUN = re.compile(r"[^A-Za-zА-Яа-яІіЇїЄєҐґ0-9]+")


def py_words(title: str) -> list[str]:
    return re.split(r"\s+", WORD_RUN.sub(" ", title).lower())


def py_keep(w: str) -> bool:
    return w != "" and w not in STOP_WORDS and len(w) >= 4 and not re.fullmatch(r"[0-9]+", w)


def py_reason(title: str, n: int | None):
    if re.search(r"(?i)(https?://|www\.)", title):
        return "title_contains_url"
    if re.search(r"[0-9]{7,}", title):
        return "title_contains_many_digits"
    if n is not None and n < 3:
        return "title_too_short"
    if n is not None and n > 100:
        return "title_too_long"
    return None


@SETTINGS
@given(TITLES)
def test_tokeniser_matches_python(spark, titles):
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    rows = df.select("t", title_words("t").alias("w"),
                     F.filter(title_words("t"), lambda x: keep_keyword(x)).alias("k")).collect()
    for r in rows:
        assert r.w == py_words(r.t)
        assert r.k == [w for w in py_words(r.t) if py_keep(w)]


@SETTINGS
@given(TITLES, st.lists(st.one_of(st.none(), st.integers(0, 150)), min_size=60, max_size=60))
def test_spam_rules_match_python(spark, titles, lengths):
    data = list(zip(titles, lengths))
    df = spark.createDataFrame(data, "t string, n int")
    rows = df.select("t", "n", spam_reason("t", "n").alias("r")).withColumn("s", severity("r")).collect()
    for r in rows:
        assert r.r == py_reason(r.t, r.n)
        assert r.s == {"title_contains_url": "high", "title_contains_many_digits": "medium"}.get(r.r, "low")


@SETTINGS
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.sampled_from(["", "a", "b"]))] * 3), min_size=1, max_size=30),
       st.lists(st.tuples(*[st.one_of(st.none(), st.sampled_from([0, 1, 7]))] * 3), min_size=30, max_size=30))
def test_truthy_chains_match_python_or(spark, texts, numbers):
    data = [t + n for t, n in zip(texts, numbers)]
    df = spark.createDataFrame(data, "a string, b string, c string, x long, y long, z long")
    rows = df.select(
        "*",
        first_truthy(F.col("a"), F.col("b"), F.col("c"), default=F.lit("d")).alias("s"),
        first_truthy(F.col("x"), F.col("y"), F.col("z"), default=F.lit(0).cast("long"), kind="number").alias("i"),
    ).collect()
    for r in rows:
        assert r.s == (r.a or r.b or r.c or "d")
        assert r.i == (r.x or r.y or r.z or 0)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.sampled_from(["a", "b", "c"])),
                min_size=1, max_size=80))
def test_latest_per_key_idempotent_and_order_free(spark, rows):
    from pageflow.operators.keyed import latest_per_key

    df = spark.createDataFrame(rows, "k int, v int, s string")
    order = [("v", True), ("s", False)]
    once = latest_per_key(df, ["k"], order)
    twice = latest_per_key(once, ["k"], order)
    shuffled = latest_per_key(df.repartition(7), ["k"], order)
    expect = {}
    for k, v, s in rows:
        best = expect.get(k)
        if best is None or (-v, s) < (-best[0], best[1]):
            expect[k] = (v, s)
    got = sorted(tuple(r) for r in once.collect())
    assert got == sorted((k, v, s) for k, (v, s) in expect.items())
    assert sorted(tuple(r) for r in twice.collect()) == got
    assert sorted(tuple(r) for r in shuffled.collect()) == got


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-2**63, 2**63 - 1),
                          st.sampled_from(["2024-01-01 00:00:00", "2024-01-01 00:00:00.000001",
                                           "1969-12-31 23:59:59.5", "2030-06-01 12:00:00"])),
                min_size=1, max_size=60))
def test_newest_key_orders_like_time_desc_id_asc(spark, rows):
    from datetime import datetime

    from pageflow.functions.timefn import newest_key

    df = spark.createDataFrame(rows, "g int, id long, t string") \
        .withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = {r.g: r.id for r in df.groupBy("g").agg(
        F.max_by("id", newest_key("t", "id")).alias("id")).collect()}
    expect = {}
    for g, i, t in rows:
        ts = datetime.fromisoformat(t)
        if g not in expect or (ts, -i) > (expect[g][0], -expect[g][1]):
            expect[g] = (ts, i)
    assert got == {g: i for g, (ts, i) in expect.items()}
