"""Rows of closed windows: the stream against the batch operators, late data, bounded state, and recovery."""

from __future__ import annotations

import json
import os
import random
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from pageflow.operators import closed, enrich, keywords, metrics
from pageflow.schema import (AUTHOR_HOURS, BOT_ACTIVITY, BREAKING_NEWS_ALERTS, CLOSED_ACTIVITY, CLOSED_BURSTS, KEYWORD_SPIKES, LANGUAGE_ACTIVITY,
                             RAW_PAGES)
from pageflow.session import scratch_path
from pageflow.sources import fixtures, tables
from pageflow.sources.events import parse_events, read_event_stream, require_fields
from pageflow.sources.tables import read_latest
from pageflow.streaming import runner
from pageflow.streaming.runner import run_available_now, start_all

START = 1_704_067_200  # 2024-01-01 00:00:00 UTC


def _event(i, at, domain="d", title="title", user=None, bot=False):
    stamp = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(START + at))
    user = i if user is None else user
    return json.dumps({"domain": domain, "page_id": i, "page_title": title, "user_id": user, "user_name": f"u{user}", "is_bot": bot,
                       "created_at": stamp, "title_length": len(title)})


def _batches(seed=1, n=12, size=60):
    """Files in order of time with gaps, so that windows have neighbours, none, and history beyond six windows."""
    rng, at, i, out = random.Random(seed), 0, 0, []
    for _ in range(n):
        at += rng.choice([60, 240, 900, 4800])
        lines = []
        for _ in range(size):
            i += 1
            words = " ".join(rng.choice(["flood", "storm", "quake", "election", f"nr{rng.randint(0, 9)}xx"]) for _ in range(rng.randint(1, 4)))
            lines.append(_event(i, at + rng.randint(0, 200), rng.choice("ab"), words, rng.randint(0, 9), rng.random() < 0.3))
        out.append(lines)
        at += 200
    out.append([_event(i + 1, at + 100_000, "z")])  # closes everything before
    return out


def _files(batches):
    folder = tempfile.mkdtemp(prefix="closed-in-")
    for i, lines in enumerate(batches):
        path = os.path.join(folder, f"part-{i:03d}.json")
        with open(path, "w") as out:
            out.write("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    return folder


def _stream(spark, folder):
    return require_fields(parse_events(read_event_stream(spark, "text", {"maxFilesPerTrigger": 1}, path=folder)))


def _batch(spark, folder):
    return require_fields(parse_events(spark.read.text(folder)))


def _rows(frame, *columns):
    return sorted((tuple(str(x) for x in r) for r in frame.select(*columns).collect()))


@pytest.fixture(scope="module")
def run(spark):
    folder, base = _files(_batches()), scratch_path(spark, "test-closed")
    queries = run_available_now(_stream(spark, folder), f"{base}/tables", f"{base}/cp", live=False, closed_windows=True)
    events = _batch(spark, folder).where("domain <> 'z'").cache()
    return f"{base}/tables", events, {q.name.split("_")[1]: q for q in queries}


def test_stored_trend_equals_the_batch_operator(spark, run):
    root, events, _ = run
    stored = read_latest(spark, CLOSED_ACTIVITY, root).where("domain <> 'z'")
    columns = ["domain", "window_start", "window_end", "pages_created", "trend", "previous_pages"]
    wanted = enrich.with_trend(metrics.language_activity(events, exact=True))
    assert _rows(stored, *columns) == _rows(wanted, *columns)
    assert {r.trend for r in stored.select("trend").collect()} == {"up", "down", "stable"}
    bots = ["domain", "window_start", "bot_pages", "human_pages", "bot_percent"]
    assert _rows(stored, *bots) == _rows(metrics.bot_activity(events), *bots)


def test_stored_names_equal_the_batch_lists(spark, run):
    root, events, _ = run
    stored = read_latest(spark, CLOSED_ACTIVITY, root).where("domain <> 'z'")
    wanted = enrich.top_actors(events.withColumn("created_at", F.date_trunc("minute", "created_at")))  # no order of activity: ties by name
    assert _rows(stored, "domain", "window_start", "top_bots", "top_humans") == _rows(wanted, "domain", "window_start", "top_bots", "top_humans")


def test_stored_spikes_and_titles_equal_the_batch_operators(spark, run):
    root, events, _ = run
    stored = closed.with_spike_ratio(read_latest(spark, CLOSED_BURSTS, root), read_latest(spark, KEYWORD_SPIKES, root))
    bursts = keywords.keyword_bursts(events)
    columns = ["domain", "keyword", "window_start", "window_end", "occurrences", "sample_pages"]
    assert _rows(stored, *columns) == _rows(bursts, *columns) and bursts.count() > 10
    wanted = enrich.spike_ratio(keywords.keyword_counts(events, titles=False), min_occurrences=5)
    assert _rows(stored, "domain", "keyword", "window_start", "spike_ratio") == _rows(wanted, "domain", "keyword", "window_start", "spike_ratio")
    assert stored.where("spike_ratio is null").count() and stored.where("spike_ratio is not null").count()


def test_batch_and_stream_of_one_operator_agree(spark, run):
    root, events, _ = run
    columns = [c for c in CLOSED_ACTIVITY.columns if c != "authors_sketch"]
    assert _rows(read_latest(spark, CLOSED_ACTIVITY, root).where("domain <> 'z'"), *columns) == _rows(closed.closed_activity(events), *columns)


def test_authors_of_windows_merge_without_counting_twice(spark, run):
    root, events, _ = run
    stored = read_latest(spark, CLOSED_ACTIVITY, root).where("domain <> 'z'")
    merged = {r.domain: (r.pages_created, r.unique_authors) for r in closed.authors_over(stored, None).collect()}
    wanted = {r.domain: (r.n, r.u) for r in events.groupBy("domain").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("u")).collect()}
    assert merged == wanted  # few authors: the sketch is exact
    assert stored.agg(F.sum("unique_authors")).first()[0] > sum(u for _, u in wanted.values())
    hours = closed.authors_over(stored, "hour")
    exact = events.groupBy("domain", F.date_trunc("hour", "created_at").alias("start")).agg(F.count_distinct("user_id").alias("unique_authors"))
    assert _rows(hours, "domain", "start", "unique_authors") == _rows(exact, "domain", "start", "unique_authors")


def test_sketch_of_many_authors_is_within_its_error(spark):
    events = spark.range(300_000).select(
        F.lit("d").alias("domain"), F.timestamp_seconds(F.lit(START) + F.col("id") % 7200).alias("created_at"), F.lit("t").alias("page_title"),
        (F.col("id") % 50_021).alias("user_id"), F.concat(F.lit("u"), F.col("id") % 7).alias("user_name"), F.lit(False).alias("is_bot"),
        F.lit(1).alias("title_length"))
    [found] = closed.authors_over(closed.closed_activity(events), None).collect()
    assert found.windows == 120 and abs(found.unique_authors - 50_021) <= 3 * closed.AUTHORS_ERROR * 50_021


def test_names_beyond_the_sketch_stay_within_its_error(spark):
    """A name with a tenth of a window's pages among 20,000 others is found, its count within the stated error."""
    n = 40_000
    events = spark.range(n).select(
        F.lit("d").alias("domain"), F.timestamp_seconds(F.lit(START)).alias("created_at"), F.lit("t").alias("page_title"), F.lit(1).alias("user_id"),
        F.when(F.col("id") % 10 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 20_000)).alias("user_name"),
        F.lit(True).alias("is_bot"), F.lit(1).alias("title_length"))
    [row] = closed.closed_activity(events).collect()
    first = json.loads(row.top_bots)[0]
    assert first["name"] == "hot" and abs(first["pages"] - n // 10) <= 3.5 / 128 * n and row.top_humans == "[]"


def test_first_names_are_exact_among_many(spark):
    """More names than any sketch of a fixed size holds, with close counts: the stream's and the batch's lists are exact."""
    pages = [(i % 2 == 0, i, 5 if i in (390, 395) else 4 if i in (391, 394) else 3 if i in (397, 398) else 2) for i in range(400)]
    lines = [_event(1000 * user + k, 5, user=user, bot=bot) for bot, user, n in pages for k in range(n)]
    random.Random(3).shuffle(lines)
    wanted = ([{"name": "u390", "pages": 5}, {"name": "u394", "pages": 4}, {"name": "u398", "pages": 3}],
              [{"name": "u395", "pages": 5}, {"name": "u391", "pages": 4}, {"name": "u397", "pages": 3}])
    folder, base = _files([lines, [_event(1, 5000, "z")]]), scratch_path(spark, "test-closed")
    run_available_now(_stream(spark, folder), f"{base}/tables", f"{base}/cp", live=False, closed_windows=True)
    for found in (read_latest(spark, CLOSED_ACTIVITY, f"{base}/tables"), closed.closed_activity(_batch(spark, folder))):
        [row] = found.where("domain = 'd'").collect()
        assert (json.loads(row.top_bots), json.loads(row.top_humans)) == wanted
        assert row.pages_created == sum(n for _, _, n in pages)


def test_a_window_without_bot_flags_has_empty_lists(spark):
    lines = [_event(1, 5, bot=None), _event(2, 65, user=7)]
    rows = closed.closed_activity(_batch(spark, _files([lines]))).orderBy("window_start").collect()
    assert [(r.pages_created, r.top_bots, r.top_humans) for r in rows] == [(1, "[]", "[]"), (1, "[]", '[{"name":"u7","pages":1}]')]


def test_state_is_dropped_after_the_last_span(spark, run):
    """The last event lies days after the others: only its own windows are left in the state."""
    for name, most in (("closed", 1 + 2), ("spikes", 1 + 7), ("titles", 1)):
        left = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in run[2][name].recentProgress if p["stateOperators"]]
        assert max(left) > most >= left[-1], name


def test_state_rows_of_titles_do_not_grow(spark):
    """A window with many titles of one keyword: as many state rows, each as small as with few."""

    def state(titles):
        lines = [_event(i, 5, title=f"storm number {'x' * 20} {i:07d}") for i in range(titles)]
        base = scratch_path(spark, "test-closed")
        [query] = [q for q in run_available_now(_stream(spark, _files([lines])), f"{base}/tables", f"{base}/cp", live=False, closed_windows=True)
                   if "titles" in q.name]
        ops = [op for p in query.recentProgress for op in p["stateOperators"] if op["numRowsTotal"]]
        return ops[-1]["numRowsTotal"]

    # three keywords per title: storm, number, the x run (figures are no keywords)
    assert state(2000) == 3 * 2000
    assert state(20) == 3 * 20


def test_late_rows_do_not_reopen_a_closed_window(spark):
    batches = [[_event(1, 5), _event(2, 65)], [_event(3, 600)], [_event(4, 700)], [_event(5, 10), _event(6, 800)], [_event(7, 5000)]]
    base = scratch_path(spark, "test-closed")
    run_available_now(_stream(spark, _files(batches)), f"{base}/tables", f"{base}/cp", live=False, closed_windows=True)
    got = {r.window_start.strftime("%H:%M"): (r.pages_created, r.trend) for r in read_latest(spark, CLOSED_ACTIVITY, f"{base}/tables").collect()}
    assert got["00:00"] == (1, "up") and got["00:01"] == (1, "stable") and got["00:10"] == (1, "up")


# recovery

TABLES = (LANGUAGE_ACTIVITY, BOT_ACTIVITY, BREAKING_NEWS_ALERTS, RAW_PAGES, AUTHOR_HOURS, CLOSED_ACTIVITY, CLOSED_BURSTS, KEYWORD_SPIKES)


def _contents(spark, root):
    out = {}
    for spec in TABLES:
        columns = [c for c in spec.columns if c not in ("alert_time", "authors_sketch")]
        out[spec.name] = _rows(read_latest(spark, spec, root), *columns)
    return out


@pytest.fixture(scope="module")
def undisturbed(spark):
    folder, base = _files(_batches(seed=2, n=5, size=40)), scratch_path(spark, "test-recovery")
    run_available_now(_stream(spark, folder), f"{base}/tables", f"{base}/cp", closed_windows=True)
    return folder, _contents(spark, f"{base}/tables")


@pytest.mark.parametrize("failing", [1, 3])
def test_a_sink_that_fails_after_its_write_leaves_no_trace(spark, undisturbed, monkeypatch, failing):
    """Every query's batch ``failing`` is written, then fails; a restart from the checkpoints replays it."""
    folder, wanted = undisturbed
    base, failed = scratch_path(spark, "test-recovery"), set()

    def upsert(df, spec, root, gen, batch_id):
        tables.upsert_batch(df, spec, root, gen, batch_id)
        if batch_id == failing and spec.name not in failed:
            failed.add(spec.name)
            raise RuntimeError(f"lost after writing {spec.name}")

    monkeypatch.setattr(runner, "upsert_batch", upsert)
    runs = 0
    while True:  # a query with several tables fails once for each
        runs += 1
        assert runs < 8
        queries = start_all(_stream(spark, folder), f"{base}/tables", f"{base}/cp", {"availableNow": True}, closed_windows=True)
        for q in queries:
            try:
                q.awaitTermination()
            except Exception as e:
                assert "lost after writing" in str(e)
        if all(q.exception() is None for q in queries):
            break
    assert failed and runs > 1
    assert _contents(spark, f"{base}/tables") == wanted


def test_a_query_stopped_between_batches_goes_on_from_its_checkpoint(spark, undisturbed):
    """Processing-time batches, stopped after two files, then run to the end by another start."""
    folder, wanted = undisturbed
    base = scratch_path(spark, "test-recovery")
    queries = start_all(_stream(spark, folder), f"{base}/tables", f"{base}/cp", {"processingTime": "0 seconds"}, closed_windows=True)
    until = time.time() + 90
    while time.time() < until and not all(q.lastProgress and q.lastProgress["batchId"] >= 1 for q in queries):
        time.sleep(0.2)
    seen = [q.lastProgress["batchId"] for q in queries]
    for q in queries:
        q.stop()
    assert min(seen) >= 1
    queries = run_available_now(_stream(spark, folder), f"{base}/tables", f"{base}/cp", closed_windows=True)
    assert all(q.recentProgress[0]["batchId"] >= 1 for q in queries if q.recentProgress)
    assert _contents(spark, f"{base}/tables") == wanted


def test_spikes_hold_titles_not_words(spark):
    """The first state of the spikes has a row per title, however many words it has; counts are those of the words."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    lines = [_event(i, 5, title=" ".join([f"word{letters[i % 26]}{letters[i // 26]}{letters[k]}" for k in range(6)] + ["storm", "storm"])) for i in range(50)]
    batches = [lines, [_event(100 + i, 700, title="storm") for i in range(5)], [_event(200, 100_000, domain="z")]]
    base = scratch_path(spark, "test-closed")
    queries = run_available_now(_stream(spark, _files(batches)), f"{base}/tables", f"{base}/cp", live=False, closed_windows=True)
    [spikes] = [q for q in queries if "spikes" in q.name]
    first = [min(op["numRowsTotal"] for op in p["stateOperators"] if op["numRowsTotal"]) for p in spikes.recentProgress if p["numInputRows"]][0]
    assert first == 50  # 351 words
    got = [(r.keyword, r.occurrences, r.spike_ratio) for r in read_latest(spark, KEYWORD_SPIKES, f"{base}/tables").orderBy("window_start").collect()]
    assert got == [("storm", 100, None), ("storm", 5, 5 * 6 / 100)]


# the driver's events in the order of time


def test_events_taken_in_the_order_of_time_lose_no_row(spark):
    """A table in any order, read in several micro-batches: the closed windows are those of the whole table."""
    base = scratch_path(spark, "test-order")
    rng = random.Random(5)
    rows = [(i, START + rng.randint(0, 6 * 3600) * 60, rng.randint(0, 40), rng.choice(["view", "click"])) for i in range(250)] + [(250, None, 1, "view")]
    (spark.createDataFrame(rows, "event_id long, s long, user_id long, event_type string")
     .select("event_id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "user_id", "event_type").coalesce(1).write.parquet(f"{base}/events.parquet"))
    (spark.range(8).select(F.col("id").alias("page_id"), F.lit("https://a.example.org/x").alias("url"),
                           F.concat(F.lit("<title>storm nr"), F.col("id") % 3, F.lit("</title>")).alias("html")).write.parquet(f"{base}/pages.parquet"))
    queries = run_available_now(fixtures.stream_page_events(spark, base, batch_rows=100), f"{base}/tables", f"{base}/cp", live=False,
                                closed_windows=True, keep_batches=2, words_in_state=False)
    assert all(sum(p["numInputRows"] > 0 for p in q.recentProgress) >= 3 for q in queries)
    events = fixtures.page_events(spark, base).withColumn("created_at", F.col("created_at").cast("timestamp")).cache()
    until = F.lit(events.agg(F.max("created_at")).first()[0]) - F.expr("interval 2 minutes")
    columns = [c for c in CLOSED_ACTIVITY.columns if c != "authors_sketch"]
    assert _rows(read_latest(spark, CLOSED_ACTIVITY, f"{base}/tables"), *columns) == _rows(closed.closed_activity(events).where(F.col("window_end") <= until), *columns)
    spikes = closed.closed_spikes(events).where(F.col("window_end") <= until)
    assert _rows(read_latest(spark, KEYWORD_SPIKES, f"{base}/tables"), *KEYWORD_SPIKES.columns) == _rows(spikes, *KEYWORD_SPIKES.columns) and spikes.count() > 3
    bursts = keywords.keyword_bursts(events).where(F.col("window_end") <= until)
    assert _rows(read_latest(spark, CLOSED_BURSTS, f"{base}/tables"), *CLOSED_BURSTS.columns) == _rows(bursts, *CLOSED_BURSTS.columns)
    # a state row per title, the state of two micro-batches, and no counts that a later window doesn't need
    state = {q.name.split("_")[1]: max(sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in q.recentProgress if p["stateOperators"]) for q in queries}
    assert state["titles"] == state["spikes"]
    kept = [name for name in os.listdir(f"{base}/tables/keyword_counts/gen=0") if name.startswith("window=")]
    assert 0 < len(kept) < events.where(F.col("created_at") < until).agg(F.count_distinct(F.window("created_at", "10 minutes"))).first()[0]
    for q in queries:
        assert len([x for x in os.listdir(f"{base}/cp/{q.name.split('_')[1]}/commits") if x.isdigit()]) <= 3
