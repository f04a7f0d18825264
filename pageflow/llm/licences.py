r"""Licence scan: a trained paragraph classifier, with a calibrated unknown class and template comparison.

A multinomial logistic regression over hashed word one- and two-grams is trained here on the family templates below,
varied by dropping and adding words, against a bounded sample of stretches of the corpus. The threshold under which
a licence-like passage counts as unknown is calibrated on families left out of training. A family is confirmed if a
template's word pairs are found in the passage, otherwise the passage is unknown.

Paragraphs are parted by lines without a word. A notice may be a line of a paragraph or be wrapped over several, so
every run of up to ``RUN`` neighbouring pieces of a paragraph is classified; a piece is a line, or at most ``PIECE``
words of a longer one. Of overlapping runs the one that fits a template best counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.llm.quality import _content
from pageflow.llm.words import LOWER, Words, buffer_of, mix, pieces, rows_of, words_in

# Public licence notices by family.
TEMPLATES = {
    "all-rights-reserved": ["All rights reserved.", "Copyright. All rights reserved. No part may be reproduced without permission."],
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."],
    "bsd-2-clause": ["Released under the BSD 2-Clause License.", "Licensed under the Simplified BSD License."],
    "bsd-3-clause": ["Released under the BSD 3-Clause License.",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "cc-by-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc0-1.0": ["Released under CC0 1.0.", "This work is dedicated to the public domain under CC0 1.0 Universal."],
    "epl-2.0": ["Licensed under the Eclipse Public License 2.0.",
                "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"],
    "gpl-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "isc": ["Licensed under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "lgpl-2.1": ["Licensed under the GNU Lesser General Public License, version 2.1.",
                 "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "mit": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "mpl-2.0": ["Licensed under the Mozilla Public License 2.0.",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"],
    "unlicense": ["Released under the Unlicense.",
                  "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"],
}
NONE, UNKNOWN = "none", "unknown"
FAMILIES = sorted(TEMPLATES)

BUCKETS = 1 << 18
#: The background of the training set: a stretch of so many characters of so many distinct texts, at most.
BACKGROUND_DOCS = 400
STRETCH = 2000
#: Words of a piece of a long line, and neighbouring pieces that are classified together.
PIECE = 24
RUN = 6
#: A run of fewer words (the shortest template has as many) is no licence.
MIN_WORDS = 3
VARIANTS = 24
#: A gram's value is SCALE / words of the paragraph, so that repeated words don't add up.
SCALE = 8.0
#: Share of a template's word pairs that confirms a family.
CONFIRM = 0.6
#: Share of a template's word pairs that keeps a passage out of the background.
SUSPECT = 0.3
#: So do this many different words that two families use and at most this share of the background's passages holds;
#: an unknown licence has as many, because a word or two (this, are) can make a short passage look like one.
TYPICAL, RARE = 4, 0.01
_NO_DIGIT = LOWER


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every word, bucket of every word pair, each range's words); the pair of a range's last word is bucket 0."""
    return _grams_of_words(words_in(_NO_DIGIT[data], offsets, _content))


def _grams_of_words(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h = words.hash
    pair = mix(h[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[1:]) if len(h) else h
    one = 1 + (h % np.uint64(BUCKETS - 1)).astype(np.int64)
    two = np.zeros(len(h), np.int64)
    two[:-1] = 1 + (pair % np.uint64(BUCKETS - 1)).astype(np.int64)
    last = words.first[1:][np.diff(words.first) > 0] - 1
    two[last] = 0
    return one, two, words.first


def _grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _grams(*buffer_of(pa.array(texts, pa.string())))


class Model:
    """Weights per bucket and class (the last class is none), and the calibrated thresholds."""

    def __init__(self, classes: list[str]):
        self.classes, self.threshold, self.gate = classes, 0.5, 0.5
        self.typical: set[int] = set()
        self.weights = np.zeros((BUCKETS, len(classes) + 1), np.float32)
        self.bias = np.zeros(len(classes) + 1, np.float32)

    def scores(self, one: np.ndarray, two: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Class probabilities of each range of words."""
        n = np.diff(first)
        out = np.tile(self.bias, (len(n), 1))
        some = n > 0
        if some.any():
            total = np.add.reduceat(self.weights[one] + self.weights[two], first[:-1][some], axis=0)
            out[some] += total * (SCALE / n[some])[:, None]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)

    def run_scores(self, seen: Passages, first: np.ndarray, length: int, total: np.ndarray) -> np.ndarray:
        """Class probabilities of runs; ``total`` has the weights of all words before each piece."""
        start, end = seen.start[first], seen.end[first + length - 1]
        out = total[first + length] - total[first] - self.weights[seen.two[end - 1]]  # the last word begins no pair
        out = out * (SCALE / (end - start))[:, None] + self.bias
        out = np.exp(out - out.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)

    def totals(self, seen: Passages) -> np.ndarray:
        """Weights of all words before each piece, and of all; words are read some pieces at a time."""
        out = np.zeros((len(seen.start) + 1, len(self.bias)))
        for at in range(0, len(seen.start), 4096):
            start, to = seen.start[at:at + 4096], seen.end[min(at + 4096, len(seen.start)) - 1]
            words = self.weights[seen.one[start[0]:to]] + self.weights[seen.two[start[0]:to]]
            out[1 + at:1 + at + len(start)] = np.add.reduceat(words, start - start[0], axis=0, dtype=np.float64)
        return np.cumsum(out, axis=0, out=out)

    def fit(self, texts: list[str], labels: np.ndarray, rounds: int = 60, rate: float = 0.5, decay: float = 1e-3) -> Model:
        """Full-batch gradient descent; deterministic."""
        one, two, first = _grams_of(texts)
        n = np.diff(first)
        # entries (text, gram) by gram, grams numbered densely
        gram, row = np.concatenate((one, two)), np.concatenate((rows_of(first), rows_of(first)))
        value = (SCALE / n[row]).astype(np.float32)
        row, value, gram = row[gram > 0], value[gram > 0], gram[gram > 0]  # the missing pair has no weight
        order = np.argsort(gram, kind="stable")
        row_g, value_g = row[order], value[order]
        used, start = np.unique(gram[order], return_index=True)
        by_row = np.argsort(row, kind="stable")
        dense, value_r = np.searchsorted(used, gram[by_row]), value[by_row][:, None]
        some = np.flatnonzero(np.bincount(row, minlength=len(n)))
        begin = np.searchsorted(row[by_row], some)
        w = np.zeros((len(used), len(self.bias)), np.float32)
        want = np.eye(len(self.bias), dtype=np.float32)[labels]
        count = np.bincount(labels, minlength=len(self.bias)).clip(1)
        weight = (1.0 / count)[labels].astype(np.float32)[:, None]
        weight[labels == len(self.classes)] *= len(self.classes)  # the background weighs as much as all families
        for _ in range(rounds):
            logits = np.tile(self.bias, (len(n), 1))
            logits[some] += np.add.reduceat(w[dense] * value_r, begin, axis=0)
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = (want - p / p.sum(axis=1, keepdims=True)) * weight
            w = w * (1 - decay) + rate * np.add.reduceat(error[row_g] * value_g[:, None], start, axis=0)
            self.bias += 0.1 * rate * error.sum(axis=0)
        self.weights[used] = w
        return self


def _varied(family: str, background: list[list[str]], rng: np.random.Generator) -> list[str]:
    """Templates with a few words dropped, and a few words of the corpus around them."""
    out = list(TEMPLATES[family])
    for template in TEMPLATES[family]:
        for _ in range(VARIANTS):
            words = [w for w in template.split() if rng.random() > 0.08]
            if len(background) and rng.random() < 0.5:
                extra = background[rng.integers(len(background))][:int(rng.integers(1, 5))]
                words = words + extra if rng.random() < 0.5 else extra + words
            out.append(" ".join(words))
    return out


def _pairs(text: str) -> set[int]:
    one, two, _ = _grams_of([text])
    return set(two[:-1].tolist()) if len(two) > 1 else set(one.tolist())


_TEMPLATE_PAIRS = {f: [_pairs(t) for t in ts] for f, ts in TEMPLATES.items()}


def fit_of(family: str, pairs: set[int]) -> float:
    """The largest share of one of the family's templates that is there."""
    return max(len(t & pairs) / len(t) for t in _TEMPLATE_PAIRS[family])


def confirmed(family: str, pairs: set[int]) -> bool:
    """Whether enough word pairs of one of the family's templates are there, and no other family's template fits better."""
    own = fit_of(family, pairs)
    return own >= CONFIRM and all(own >= fit_of(f, pairs) for f in FAMILIES)


class Passages:
    """Words of a batch with their grams, cut into pieces of lines, and the runs of neighbouring pieces of a paragraph."""

    def __init__(self, column: pa.Array):
        data, offsets = buffer_of(column)
        words = words_in(_NO_DIGIT[data], offsets, _content)
        self.one, self.two, self.first = _grams_of_words(words)
        n, self.n_rows = len(words.hash), len(column)
        row = rows_of(words.first)
        line = np.searchsorted(np.flatnonzero(data == 0x0A), words.start)
        step = np.diff(line, prepend=-2)
        new_row = np.diff(row, prepend=-1) > 0
        paragraph = new_row | (step > 1)
        new_line = paragraph | (step > 0)
        at = np.arange(n)
        cut = new_line | ((at - np.maximum.accumulate(np.where(new_line, at, 0))) % PIECE == 0)
        self.start = np.flatnonzero(cut)
        self.end = np.append(self.start[1:], n)[:len(self.start)]
        self.row, self.paragraph = row[self.start], np.cumsum(paragraph)[self.start]
        self.n_paragraphs = np.bincount(row[paragraph], minlength=self.n_rows)

    def runs(self, length: int) -> np.ndarray:
        """First pieces of the runs of ``length`` pieces with enough words."""
        last = max(0, len(self.start) - length + 1)
        enough = self.end[length - 1:][:last] - self.start[:last] >= MIN_WORDS
        return np.flatnonzero(enough & (self.paragraph[:last] == self.paragraph[length - 1:][:last]))

    def pairs(self, start: int, end: int) -> set[int]:
        """Word pairs of a run of words; the word itself if there is but one."""
        return set(self.two[start:end - 1].tolist()) if end - start > 1 else set(self.one[start:end].tolist())


def _plain_units(stretches: list[str]) -> tuple[list[str], set[str]]:
    """(pieces of the stretches, and runs of three, without licence-like ones; words typical of licences)."""
    seen = Passages(pa.array(stretches, pa.string()))
    every = set().union(*(t for ts in _TEMPLATE_PAIRS.values() for t in ts))
    known = np.isin(seen.two, np.array(sorted(every)))
    suspect = np.zeros(len(seen.start), dtype=bool)
    for length in range(1, RUN + 1):
        for i in seen.runs(length):
            start, end = seen.start[i], seen.end[i + length - 1]
            if known[start:end].any():
                pairs = seen.pairs(start, end)
                suspect[i:i + length] |= any(fit_of(f, pairs) >= SUSPECT for f in FAMILIES)
    words = [w for t in stretches for w in _content_words(t)]
    units = []
    for length in (1, 3):
        for i in seen.runs(length)[::length]:
            if not suspect[i:i + length].any():
                units.append(words[seen.start[i]:seen.end[i + length - 1]])
    # passages in the words of licences, be they of no known family
    families = Counter(w for ts in TEMPLATES.values() for w in {w for t in ts for w in _content_words(t)})
    held = Counter(w for u in units for w in set(u) if families[w] >= 2)
    typical = {w for w, n in families.items() if n >= 2 and held[w] <= RARE * len(units)}
    return [" ".join(u) for u in units if len(typical.intersection(u)) < TYPICAL], typical


def _content_words(text: str) -> list[str]:
    raw = buffer_of(pa.array([text], pa.string()))
    words = words_in(_NO_DIGIT[raw[0]], raw[1], _content)
    return [bytes(raw[0][s:e]).decode() for s, e in zip(words.start, words.end, strict=True)]


def train(stretches: list[str], seed: int = 7) -> Model:
    """A model from the templates and background stretches of the corpus; passages near a template are left out."""
    rng = np.random.default_rng(seed)
    plain, typical = _plain_units(stretches)
    background = [p.split() for p in plain]
    varied = {f: _varied(f, background, rng) for f in FAMILIES}

    def examples(families: list[str], part: slice) -> tuple[list[str], np.ndarray]:
        texts, labels = [], []
        for i, f in enumerate(families):
            own = varied[f][part]
            texts += own
            labels += [i] * len(own)
        own = plain[part] or [""]
        return texts + own, np.array(labels + [len(families)] * len(own))

    known, strange, like, plainly = [], [], [], [0.0]
    for left in range(3):  # every third family at a time is unknown to the model
        families = [f for i, f in enumerate(FAMILIES) if i % 3 != left]
        trial = Model(families).fit(*examples(families, slice(0, None, 2)))
        known += [s[:-1].max() for s in trial.scores(*_grams_of([t for f in families for t in varied[f][1::2]]))]
        left_out = trial.scores(*_grams_of([t for f in FAMILIES if f not in families for t in varied[f]]))
        strange += left_out[:, :-1].max(axis=1).tolist()
        like += (1 - left_out[:, -1]).tolist()
        plainly += (1 - trial.scores(*_grams_of(plain[1::2] or [""]))[:, -1]).tolist()
    known, strange = np.array(known), np.array(strange)
    tries = np.linspace(0.3, 0.9, 25)
    right = [(known >= t).mean() + 0.5 * (strange < t).mean() for t in tries]
    model = Model(FAMILIES).fit(*examples(FAMILIES, slice(None)))
    model.typical = set(_grams_of(sorted(typical))[0].tolist())
    model.threshold = float(tries[int(np.argmax(right))])
    # licence-like lies between held-out background passages and the families left out
    highest = np.quantile(plainly, 0.999) + 0.05
    model.gate = float(min(0.95, max(0.5, highest, (highest + np.quantile(like, 0.1)) / 2)))
    return model


def _passages_found(model: Model, seen: Passages) -> tuple[list[tuple[int, str, int]], np.ndarray]:
    """((row, confirmed family or unknown, first piece) of every passage, each row's largest score)."""
    total, score = model.totals(seen), np.zeros(seen.n_rows)
    runs = []
    for length in range(1, RUN + 1):
        first = seen.runs(length)
        if not len(first):
            continue
        p = model.run_scores(seen, first, length, total)
        for j in np.flatnonzero(p[:, -1] < 1 - model.gate):
            i, best = int(first[j]), int(p[j, :-1].argmax())
            score[seen.row[i]] = max(score[seen.row[i]], 1 - p[j, -1])
            family = model.classes[best]
            pairs = seen.pairs(seen.start[i], seen.end[i + length - 1])
            sure = p[j, best] >= model.threshold and confirmed(family, pairs)
            if sure or len(model.typical.intersection(seen.one[seen.start[i]:seen.end[i + length - 1]].tolist())) >= TYPICAL:
                runs.append((-fit_of(family, pairs) if sure else 1.0, length, i, family if sure else UNKNOWN))
    taken, found, reach = np.zeros(len(seen.start), dtype=bool), [], -1
    for fit, length, i, family in sorted(runs):  # confirmed ones by fit, the shortest first
        if fit <= 0 and not taken[i:i + length].any():
            taken[i:i + length] = True
            found.append((int(seen.row[i]), family, i))
    for i, length in sorted((i, length) for fit, length, i, _ in runs if fit > 0):
        if not taken[i:i + length].any():  # unknown runs that overlap are one passage
            if i > reach or seen.row[i] != seen.row[reach]:
                found.append((int(seen.row[i]), UNKNOWN, i))
            reach = max(reach, i + length - 1)
    return found, score


def _scan(shared):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in pieces(batches, "text", 1 << 21):
            seen = Passages(batch.column("text"))
            passages, score = _passages_found(model, seen)
            found: list[set[str]] = [set() for _ in range(batch.num_rows)]
            n_found, unknown = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for row, family, _ in passages:
                if family == UNKNOWN:
                    unknown[row] += 1
                else:
                    found[row].add(family)
                    n_found[row] += 1
            licence = [min(f) if len(f) == 1 else "several" if f else UNKNOWN if u else NONE for f, u in zip(found, unknown, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(seen.n_paragraphs.astype(np.int64)), pa.array(n_found), pa.array(unknown),
                 pa.array([sorted(f) for f in found], pa.list_(pa.string())), pa.array(licence), pa.array(score)],
                ["doc_id", "n_paragraphs", "n_licence", "n_unknown", "families", "licence", "score"])
    return scan


def background(docs: DataFrame) -> list[str]:
    """A stretch of ``BACKGROUND_DOCS`` distinct texts, those of least hash; it lies at a place that the hash chooses.

    The count of distinct hashes gives a bound on the hash first, so that few rows reach the sort whatever the size.
    """
    hashed = docs.where("text is not null").select(F.xxhash64("text").alias("h"), "text")
    n = hashed.agg(F.approx_count_distinct("h")).first()[0]
    bound = min((1 << 63) - 1, -(1 << 63) + (1 << 64) * 2 * BACKGROUND_DOCS // max(n, 1))
    stretch = f"substring(text, 1 + cast(pmod(h, greatest(char_length(text) - {STRETCH}, 0) + 1) as int), {STRETCH})"
    rows = hashed.where(F.col("h") <= bound).select("h", F.expr(stretch).alias("t")).groupBy("h").agg(F.first("t").alias("t"))
    return [r.t for r in rows.orderBy("h").limit(BACKGROUND_DOCS).collect()]


def scan_licences(docs: DataFrame, seed: int = 7) -> DataFrame:
    """(doc_id, n_paragraphs, n_licence, n_unknown, families, licence, score) for every row of ``docs``.

    ``n_licence`` and ``n_unknown`` count passages. ``licence`` is the one confirmed family, ``several``, ``unknown`` (a
    licence-like passage of no known family) or ``none``. Null and empty texts have no paragraph; a null doc_id stays null;
    repeated rows each get a row, and copies are one text of the background however many there are; an empty table gives
    none (the model then has no background). Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = train(background(docs), seed)
    return docs.mapInArrow(_scan(docs.sparkSession.sparkContext.broadcast(model)),
                           "doc_id long, n_paragraphs long, n_licence long, n_unknown long, families array<string>, licence string, score double")


def op10_licences(spark, sf_dir: str) -> DataFrame:
    """Licence notices in every document."""
    return scan_licences(spark.read.parquet(f"{sf_dir}/documents.parquet"))
