r"""Language identification: a bidirectional gated recurrent network over bytes, trained in numpy.

Two GRUs read the bytes of a text from both sides; every position is labelled from both states, and a document's
probabilities are the mean over its positions. Texts are read whole, in stretches of ``STRETCH`` bytes that start from the
zero state, many at once. Letters are lower-cased (ASCII) and runs of other bytes become one space. Gates are piecewise linear and
the candidate is x / (1 + |x|), which numpy computes several times faster than exp and tanh.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageflow.llm.toxicity import held_out
from pageflow.llm.words import LETTERS, LOWER, buffer_of, pieces

#: Training rows that the network is fitted on at most, by language, and bytes of each.
MAX_ROWS, MAX_BYTES = 500, 1500
HIDDEN, STRETCH, LANES = 6, 96, 4096
STEPS, BATCH, RATE = 260, 192, 0.02

#: Input symbols: 0 is the space, then one per byte that can be part of a letter.
_SYMBOL = np.where(LETTERS, LOWER, 0).astype(np.uint8)


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all rows, runs of non-letters made one space, and each row's range."""
    x = _SYMBOL[data]
    keep = np.ones(len(x), dtype=bool)
    keep[1:] = (x[1:] != 0) | (x[:-1] != 0)
    keep[offsets[:-1][offsets[:-1] < len(x)]] = True
    total = np.concatenate(([0], np.cumsum(keep)))
    return x[keep], total[offsets]


def _gate(x: np.ndarray) -> np.ndarray:
    """Piecewise linear sigmoid, in place."""
    x *= 0.25
    x += 0.5
    return np.clip(x, 0, 1, out=x)


def _squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place."""
    y = np.abs(x)
    y += 1
    return np.divide(x, y, out=x)


class Gru:
    """One direction: gates z and r and the candidate, from a byte and the state. Arrays are (units, lanes)."""

    def __init__(self, rng: np.random.Generator):
        self.inputs = rng.normal(0, 0.3, (3 * HIDDEN, 256)).astype(np.float32)
        self.state = rng.normal(0, 0.3, (3 * HIDDEN, HIDDEN)).astype(np.float32)
        self.bias = np.zeros((HIDDEN, 1), np.float32)  # of the candidate's state part

    @property
    def params(self) -> list[np.ndarray]:
        return [self.inputs, self.state, self.bias]

    def run(self, x: np.ndarray, tape: list | None = None):
        """States after every step of x (steps, lanes)."""
        h, k = np.zeros((HIDDEN, x.shape[1]), np.float32), HIDDEN
        given, own = np.empty((3 * k, x.shape[1]), np.float32), np.empty((3 * k, x.shape[1]), np.float32)
        for row in x:
            np.take(self.inputs, row, axis=1, out=given, mode="clip")
            np.matmul(self.state, h, out=own)
            g = given[:2 * k] + own[:2 * k]
            g = _gate(g)
            u = own[2 * k:] + self.bias
            n = u * g[k:]
            n += given[2 * k:]
            n = _squash(n)
            if tape is not None:
                tape.append((h, g, u, n))
            h = h - n
            h *= g[:k]
            h += n
            yield h

    def back(self, x: np.ndarray, tape: list, grads: list[np.ndarray]) -> list[np.ndarray]:
        """Gradients by backpropagation through time, from the gradient of every state."""
        k = HIDDEN
        g_inputs, g_state, g_bias = np.zeros((256, 3 * k), np.float32), np.zeros_like(self.state), np.zeros_like(self.bias)
        carry = np.zeros_like(grads[0])
        for row, (h, g, u, n), given in zip(x[::-1], tape[::-1], grads[::-1], strict=True):
            carry = carry + given
            z, r = g[:k], g[k:]
            flat = np.abs(n) - 1
            d_n = carry * (1 - z) * flat * flat
            d_z = carry * (h - n) * 0.25 * ((z > 0) & (z < 1))
            d_r = d_n * u * 0.25 * ((r > 0) & (r < 1))
            d_u = d_n * r
            np.add.at(g_inputs, row, np.concatenate((d_z, d_r, d_n)).T)
            to_state = np.concatenate((d_z, d_r, d_u))
            g_state += to_state @ h.T
            g_bias += d_u.sum(axis=1, keepdims=True)
            carry = carry * z + self.state.T @ to_state
        return [g_inputs.T, g_state, g_bias]


class Model:
    def __init__(self, names: list[str], seed: int):
        rng = np.random.default_rng(seed)
        self.names, self.forward, self.backward = names, Gru(rng), Gru(rng)
        self.out = rng.normal(0, 0.3, (len(names), 2 * HIDDEN)).astype(np.float32)
        self.out_bias = np.zeros((len(names), 1), np.float32)

    @property
    def params(self) -> list[np.ndarray]:
        return [*self.forward.params, *self.backward.params, self.out, self.out_bias]

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Label probabilities of every position of x (steps, lanes): (steps, labels, lanes)."""
        logits = np.empty((len(x), len(self.names), x.shape[1]), np.float32)
        ahead, behind = np.ascontiguousarray(self.out[:, :HIDDEN]), np.ascontiguousarray(self.out[:, HIDDEN:])
        for t, h in enumerate(self.forward.run(x)):
            np.matmul(ahead, h, out=logits[t])
        logits += self.out_bias
        for t, h in enumerate(self.backward.run(x[::-1])):
            p = logits[len(x) - 1 - t]
            p += behind @ h
            np.exp(p, out=p)  # weights of a few units bound the logits
            p /= p.sum(axis=0)
        return logits

    def documents(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Mean label probabilities of every row of symbols; a row without symbols gets equal ones."""
        n = np.diff(first)
        out = np.zeros((len(n), len(self.names)))
        count = -(-n // STRETCH)
        row = np.repeat(np.arange(len(n)), count)
        at = first[row] + STRETCH * (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count))
        size = np.minimum(STRETCH, first[row + 1] - at)
        order = np.argsort(-size, kind="stable")  # stretches of one size together, the short ones last
        x = np.concatenate((x, np.zeros(STRETCH, x.dtype)))
        for low in range(0, len(order), LANES):
            own = order[low:low + LANES]
            steps = int(size[own].max())
            lanes = x[at[own] + np.arange(steps)[:, None]]
            valid = np.arange(steps)[:, None] < size[own]
            lanes[~valid] = 0
            p = self.positions(lanes)
            if not valid.all():
                p *= valid[:, None, :]
            np.add.at(out, row[own], p.sum(axis=0).T.astype(np.float64))
        some = n > 0
        out[some] /= n[some, None]
        out[~some] = 1 / len(self.names)
        return out


def train(texts: list[np.ndarray], labels: np.ndarray, names: list[str], seed: int = 5) -> Model:
    """Fit on random stretches, balanced by language, by Adam; every position of a stretch has its text's label."""
    model, rng = Model(names, seed), np.random.default_rng(seed)
    by_label = [[t for t, y in zip(texts, labels, strict=True) if y == k] for k in range(len(names))]
    pools = [np.concatenate(t + [np.zeros(STRETCH, np.uint8)]) for t in by_label]
    params = model.params
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        y = rng.integers(0, len(names), BATCH)
        begin = [rng.integers(0, len(pools[k]) - STRETCH + 1) for k in y]
        x = np.stack([pools[k][b:b + STRETCH] for k, b in zip(y, begin, strict=True)], axis=1)
        tapes: list[list] = [[], []]
        ahead = list(model.forward.run(x, tapes[0]))
        behind = list(model.backward.run(x[::-1], tapes[1]))[::-1]
        g_out, g_bias, g_ahead, g_behind = np.zeros_like(model.out), np.zeros_like(model.out_bias), [], []
        for a, b in zip(ahead, behind, strict=True):
            both = np.concatenate((a, b))
            p = model.out @ both + model.out_bias
            p = np.exp(p - p.max(axis=0))
            p /= p.sum(axis=0)
            p[y, np.arange(BATCH)] -= 1
            p /= BATCH * STRETCH
            g_out += p @ both.T
            g_bias += p.sum(axis=1, keepdims=True)
            back = model.out.T @ p
            g_ahead.append(back[:HIDDEN])
            g_behind.append(back[HIDDEN:])
        grads = [*model.forward.back(x, tapes[0], g_ahead), *model.backward.back(x[::-1], tapes[1], g_behind[::-1]), g_out, g_bias]
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for p, g, a, b in zip(params, grads, first, second, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return model


def fit(docs: DataFrame) -> Model | None:
    """A model from a bounded sample of the rows that are not held out: per language the first by a hash of the id.

    None if no row has a language, an id and a letter.
    """
    rows = docs.select("doc_id", "lang", F.col("text").cast("string").alias("text"))
    rows = rows.where("doc_id is not null and lang is not null").where(~held_out("doc_id")).where(F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", F.xxhash64("doc_id").alias("h"), F.substring("text", 1, MAX_BYTES).alias("text"))
    # the least hashes of a language: at most MAX_ROWS of a task for each before the shuffle
    from pyspark.sql import Window
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    sample = rows.withColumn("rank", rank).where(F.col("rank") <= MAX_ROWS).orderBy("lang", "h").collect()
    if not sample:
        return None
    names = sorted({r.lang for r in sample})
    x, first = symbols(*buffer_of(pa.array([r.text for r in sample])))
    return train([x[a:b] for a, b in zip(first[:-1], first[1:], strict=True)], np.array([names.index(r.lang) for r in sample]), names)


def _predicted(shared):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in pieces(batches, "text", 1 << 21):
            data, offsets = buffer_of(batch.column("text"))
            x, first = symbols(data, offsets)
            letters = np.diff(np.concatenate(([0], np.cumsum(x != 0)))[first]) > 0
            known = letters & (model is not None) & batch.column("letter").to_numpy(zero_copy_only=False)
            if model is not None:
                p = model.documents(x, first)
                best = p.argmax(axis=1)
                names = np.array(model.names, dtype=object)[best]
                score = p[np.arange(len(best)), best]
            else:
                names, score = np.full(batch.num_rows, "und", dtype=object), np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(np.where(known, names, "und").tolist(), pa.string()),
                 pa.array(np.where(known, np.clip(score, 0, 1), 0.0))], ["doc_id", "held_out", "lang_pred", "score"])
    return predict


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``.

    A null text and one without a letter give ``und`` with score 0, as does every text if there was nothing to learn from.
    A null doc_id is kept and not held out; repeated rows each get a row; an empty table gives none. Columns other than
    doc_id, text and, to learn from, lang are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"),
                       F.col("text").cast("string").alias("text"),
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    return rows.mapInArrow(_predicted(shared), "doc_id long, held_out boolean, lang_pred string, score double")


def op4_language(spark, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
