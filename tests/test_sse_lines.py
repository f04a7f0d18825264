"""SSE dumps of any line ends, read by lines in splits that cut frames anywhere."""

from __future__ import annotations

import random

import pytest

from pageflow.sources.sse import read_sse_dump, read_sse_lines


def _dump(rng, end, frames=300):
    out, want = [], []
    for i in range(frames):
        data = [f'{{"id": {i},', f'"text": "{"é" * rng.randint(0, 40)} x"}}'] if rng.random() < 0.5 else [f'{{"id": {i}}}']
        lines = rng.sample([":comment", "event: message", f"id: {i}"], rng.randint(0, 3)) + ["data: " + d for d in data]
        out.append("".join(line + (end or rng.choice(["\n", "\r\n"])) for line in lines))
        out.append("".join(rng.choice(["", " ", "\t"]) + (end or rng.choice(["\n", "\r\n"])) for _ in range(rng.randint(1, 3))))
        want.append("\n".join(data))
    return "".join(out), want


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r", None])
@pytest.mark.parametrize("split", [64, 997, 1 << 20])
def test_frames_are_whole_wherever_splits_cut(spark, tmp_path, end, split):
    rng, want = random.Random(f"{end}{split}"), []
    for name in ("a", "b"):
        text, frames = _dump(rng, end, 60 if split == 64 else 300)
        (tmp_path / f"{name}.txt").write_bytes(text.rstrip().encode() if name == "a" else text.encode())  # a file may end in a frame
        want += frames
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = [r.value for r in read_sse_lines(spark, str(tmp_path)).collect()]
        splits = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(got) == sorted(want)
    assert splits > 10 or split > 997


def test_lines_agree_with_records(spark, tmp_path):
    text, want = _dump(random.Random(1), "\n")
    (tmp_path / "a.txt").write_bytes(text.encode())
    assert sorted(r.value for r in read_sse_dump(spark, str(tmp_path)).collect()) == sorted(want)
    assert sorted(r.value for r in read_sse_lines(spark, str(tmp_path)).collect()) == sorted(want)


def test_files_without_frames(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"")
    (tmp_path / "b.txt").write_bytes(b"\r\n\r\n: only a comment\r\n\r\ndata:\r\n\r\n")
    assert read_sse_lines(spark, str(tmp_path)).collect() == []
