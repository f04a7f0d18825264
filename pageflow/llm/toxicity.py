r"""Toxicity: a convolutional text classifier trained in numpy.

Words are hashed to embeddings, filters of widths 1 to 3 slide over the whole text, the maximum of each filter is kept,
and a logistic layer gives the score. The threshold is calibrated for each language that a small word model guesses
from the text, and scores are shifted so that a language's threshold is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.llm.words import LETTERS, pieces, words_of

#: Labelled rows that the model is fitted on, at most, by class; and their words, at most each.
MAX_TOXIC, MAX_CLEAN, MAX_TRAIN_WORDS = 2500, 5000, 4000
BUCKETS = 1 << 20
#: A word is embedded if this many training rows hold it; all others are the zero vector.
MIN_ROWS = 3
DIM, WIDTHS, FILTERS = 8, (1, 2, 3), 6
CALIBRATION = 4  # every fourth training row calibrates
MIN_POSITIVES = 25


def held_out(doc_id):
    """Rows that nothing is learned from: crc32 of the id as text is divisible by 5."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def bucket_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash bucket of every word (lower-case letters), and each row's range."""
    words = words_of(column, LETTERS, lower=True)
    return (words.hash >> np.uint64(44)).astype(np.int32), words.first


def _train_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        ids, first = bucket_ids(batch.column("text"))
        lists = [ids[a:b][:MAX_TRAIN_WORDS] for a, b in zip(first[:-1], first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("toxic"), batch.column("lang"), pa.array(lists, pa.list_(pa.int32()))],
                                         ["h", "toxic", "lang", "words"])


class Model:
    """Embedding, filters, output layer, word model of the languages and thresholds."""

    index: np.ndarray  # bucket -> embedding row, 0 = none
    shifts: dict[int, float]

    def tables(self) -> list[list[np.ndarray]]:
        """What each word adds to each filter, by width and offset."""
        return [[(self.embedding @ k).astype(np.float32) for k in filters] for filters in self.filters]

    def logits(self, rows: np.ndarray, first: np.ndarray, tables=None) -> np.ndarray:
        """Of rows of embedding indexes; a row without words has no activation."""
        tables = tables or self.tables()
        n = np.diff(first)
        some = n > 0
        pooled = np.zeros((len(n), len(WIDTHS) * FILTERS), np.float32)
        if some.any():
            # a row is followed by zero words, so that windows at its end don't reach the next row
            gap = max(WIDTHS) - 1
            at = np.arange(len(rows)) + np.repeat(np.arange(len(n)) * gap, n)
            padded = np.zeros(len(rows) + len(n) * gap, rows.dtype)
            padded[at] = rows
            begin = first[:-1] + np.arange(len(n)) * gap
            cuts = np.stack((begin[some], begin[some] + n[some]), axis=1).ravel()
            for w, (width, own, bias) in enumerate(zip(WIDTHS, tables, self.filter_bias, strict=True)):
                act = own[0][padded]
                for j in range(1, width):
                    act[:-j] += own[j][padded[j:]]
                best = np.maximum.reduceat(act, cuts, axis=0)[::2]
                pooled[some, w * FILTERS:(w + 1) * FILTERS] = np.maximum(best + bias, 0)
        return pooled @ self.out + self.out_bias

    def language(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Likeliest language of each row by its words."""
        total = np.concatenate((np.zeros((1, self.by_lang.shape[1])), np.cumsum(self.by_lang[rows], axis=0, dtype=np.float64)))
        return (total[first[1:]] - total[first[:-1]]).argmax(axis=1)

    def scores(self, ids: np.ndarray, first: np.ndarray, tables=None) -> np.ndarray:
        """Calibrated probabilities."""
        rows = self.index[ids]
        shift = np.array([self.shifts[k] for k in range(self.by_lang.shape[1])])[self.language(rows, first)]
        return 1 / (1 + np.exp(-np.clip(self.logits(rows, first, tables) - shift, -30, 30)))


def train(texts: list[np.ndarray], toxic: np.ndarray, langs: list[str], seed: int = 3, rounds: int = 8, rate: float = 0.02) -> Model:
    """Fit the network by Adam on mini-batches; only the windows that win the pooling get a gradient."""
    rng, m = np.random.default_rng(seed), Model()
    # vocabulary: buckets of enough rows
    flat = np.concatenate([np.unique(t) for t in texts]) if texts else np.zeros(0, np.int32)
    rows_with = np.bincount(flat, minlength=BUCKETS)
    vocabulary = np.flatnonzero(rows_with >= MIN_ROWS)
    m.index = np.zeros(BUCKETS, np.int32)
    m.index[vocabulary] = 1 + np.arange(len(vocabulary))
    docs = [m.index[t] for t in texts]
    size = len(vocabulary) + 1
    names = sorted({x for x in langs if x is not None}) or ["und"]
    counts = np.full((size, len(names)), 0.5)
    for d, x in zip(docs, langs, strict=True):
        if x is not None:
            np.add.at(counts[:, names.index(x)], np.unique(d), 1)
    m.by_lang = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    m.by_lang -= m.by_lang.mean(axis=1, keepdims=True)
    m.by_lang[0] = 0
    part = np.arange(len(docs)) % CALIBRATION == 0
    fit = np.flatnonzero(~part)
    # the first coordinate starts at a word's log-odds in the rows it is fitted on
    held = np.zeros((size, 2))
    for i in fit:
        np.add.at(held[:, int(toxic[i])], np.unique(docs[i]), 1)
    n_rows = np.bincount(toxic[fit].astype(int), minlength=2) if len(fit) else np.ones(2)
    odds = np.log((held[:, 1] + 0.5) / (n_rows[1] + 1)) - np.log((held[:, 0] + 0.5) / (n_rows[0] + 1))
    m.embedding = rng.normal(0, 0.1, (size, DIM))
    m.embedding[:, 0] = 0.3 * odds
    m.embedding[0] = 0
    m.filters = [[rng.normal(0, 0.2, (DIM, FILTERS)) + np.eye(DIM, FILTERS)[:1].T.sum() * (np.arange(DIM)[:, None] == 0) * 0.5
                  for _ in range(w)] for w in WIDTHS]
    m.filter_bias = [np.full(FILTERS, 0.05) for _ in WIDTHS]
    m.out, m.out_bias = rng.normal(0.2, 0.1, len(WIDTHS) * FILTERS), np.array(-1.0)
    params = [m.embedding, *[k for f in m.filters for k in f], *m.filter_bias, m.out, m.out_bias]
    first_m, second_m, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(rounds if len(fit) else 0):
        for batch in np.array_split(rng.permutation(fit), max(1, len(fit) // 64)):
            grads, step = _gradients(m, [docs[i] for i in batch], toxic[batch]), step + 1
            for p, g, a, b in zip(params, grads, first_m, second_m, strict=True):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-6)
            m.embedding *= 1 - 1e-4
            m.embedding[0] = 0
    _calibrate(m, [docs[i] for i in np.flatnonzero(part)], toxic[part])
    m.embedding, m.by_lang = m.embedding.astype(np.float32), m.by_lang.astype(np.float32)
    return m


def _gradients(m: Model, docs: list[np.ndarray], toxic: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean log loss, in the order of the parameters."""
    g_embedding = np.zeros_like(m.embedding)
    g_filters = [[np.zeros_like(k) for k in f] for f in m.filters]
    g_bias, g_out, g_out_bias = [np.zeros(FILTERS) for _ in WIDTHS], np.zeros_like(m.out), np.zeros(())
    for d, y in zip(docs, toxic, strict=True):
        padded = np.concatenate((d, np.zeros(max(WIDTHS) - 1, d.dtype)))
        x, pooled, won = m.embedding[padded], [], []
        for width, filters, bias in zip(WIDTHS, m.filters, m.filter_bias, strict=True):
            if not len(d):
                pooled.append(np.zeros(FILTERS))
                won.append(None)
                continue
            act = sum(x[j:j + len(d)] @ filters[j] for j in range(width)) + bias
            at = act.argmax(axis=0)
            won.append(at)
            pooled.append(np.maximum(act[at, np.arange(FILTERS)], 0))
        z = np.concatenate(pooled)
        error = (1 / (1 + np.exp(-np.clip(z @ m.out + m.out_bias, -30, 30))) - y) / len(docs)
        g_out += error * z
        g_out_bias += error
        back = error * m.out * (z > 0)
        for w, (width, at) in enumerate(zip(WIDTHS, won, strict=True)):
            if at is None:
                continue
            g = back[w * FILTERS:(w + 1) * FILTERS]
            g_bias[w] += g
            for j in range(width):
                g_filters[w][j] += x[at + j].T * g
                np.add.at(g_embedding, padded[at + j], (m.filters[w][j] * g).T)
    return [g_embedding, *[k for f in g_filters for k in f], *g_bias, g_out, g_out_bias]


def _calibrate(m: Model, docs: list[np.ndarray], toxic: np.ndarray) -> None:
    """The logit of best F1 in each language, the common one where a language has too few toxic rows."""
    first = np.concatenate(([0], np.cumsum([len(d) for d in docs]))).astype(np.int64)
    rows = np.concatenate(docs) if len(docs) else np.zeros(0, np.int32)
    z, lang = m.logits(rows, first), m.language(rows, first)

    def best(some: np.ndarray) -> float:
        own, y = z[some], toxic[some]
        order = np.argsort(-own)
        hit = np.cumsum(y[order])
        f1 = 2 * hit / (np.arange(1, len(own) + 1) + max(1, y.sum()))
        # of equal choices the middle, half-way to the next score below
        top = np.flatnonzero(f1 >= f1.max() - 1e-9)
        k = top[len(top) // 2]
        below = own[order][k + 1] if k + 1 < len(own) else own[order][k] - 1
        return float((own[order][k] + below) / 2)

    everyone = np.ones(len(z), dtype=bool)
    common = best(everyone) if toxic.sum() else 0.0
    m.shifts = {k: best(lang == k) if toxic[lang == k].sum() >= MIN_POSITIVES else common for k in range(m.by_lang.shape[1])}


def _scored(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        tables = model.tables()
        for batch in pieces(batches, "text", 1 << 21):
            p = model.scores(*bucket_ids(batch.column("text")), tables).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])
    return score


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from a bounded sample of the labelled rows that are not held out.

    The sample takes rows in the order of a hash of their id, up to ``MAX_TOXIC`` toxic and ``MAX_CLEAN`` other ones. Rows
    without a label, an id or a text teach nothing. Without any labelled row all scores are the same.
    """
    known = labels.select("doc_id", "toxic").where("doc_id is not null and toxic is not null").where(~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("h", F.xxhash64("doc_id"))
    sample = known.where("toxic = 1").orderBy("h").limit(MAX_TOXIC).unionByName(known.where("toxic = 0").orderBy("h").limit(MAX_CLEAN))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), "lang").where("text is not null").join(F.broadcast(sample), "doc_id")
    table = rows.select("h", "toxic", "lang", "text").mapInArrow(_train_rows, "h long, toxic int, lang string, words array<int>").toArrow()
    table = table.take(pa.array(np.argsort(table.column("h").to_numpy(), kind="stable"))) if table.num_rows else table
    texts = [np.asarray(x.values, dtype=np.int32) for x in table.column("words")]
    return train(texts, np.array(table.column("toxic").to_pylist(), dtype=np.float64), table.column("lang").to_pylist())


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Null and empty texts get the score of a text without known words; a null doc_id is kept and not held out; repeated
    rows each get a row; an empty table gives none. Columns other than doc_id, text and, to learn from, lang are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scored(shared), "doc_id long, held_out boolean, score double, predicted int")


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
