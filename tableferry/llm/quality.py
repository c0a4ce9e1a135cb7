"""Document quality by gated-attention multiple-instance learning.

A document is a bag of passages: its lines, long ones cut every ``PASSAGE_BYTES``. Each passage
is encoded by the shares of its byte classes, of their transitions and of distinct and repeated
words, then by a learned layer.
Gated attention weighs the passages of a bag; the weighted sum is the document's representation
and a logistic unit scores it. All of it is learned from document labels alone.

Fit: numpy on the driver, on at most ``bound`` labelled documents (their whole texts); features
are made in Spark tasks. Scores: Arrow batches in Spark tasks, no shuffle.

Cases: a null or empty text is a bag of one passage without bytes and gets that bag's score.
Without any usable label, or with labels of one kind only, every score is the share of label 1
(0.5 without labels). Repeated rows are scored each. Other columns are not looked at.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import held_out
from tableferry.llm.samples import labelled_sample, one_label
from tableferry.llm.slices import text_slices

PASSAGE_BYTES = 800
#: Bytes of a text whose passages are held at a time.
BLOCK_BYTES = 1 << 16
SAMPLE_BOUND = 4000
#: Passages that the fit takes of a document (a score takes all).
SAMPLE_PASSAGES = 4096
ACCEPT = 0.7


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Byte -> fine class (each ASCII sign by itself) and byte -> coarse class."""
    fine, coarse, sign = np.zeros(256, np.int64), np.zeros(256, np.int64), 7
    for b in range(256):
        char = chr(b)
        if b >= 0xC0:
            fine[b], coarse[b] = 5, 0
        elif b >= 0x80:
            fine[b], coarse[b] = 6, 0
        elif char.islower():
            fine[b], coarse[b] = 0, 0
        elif char.isupper():
            fine[b], coarse[b] = 1, 1
        elif char.isdigit():
            fine[b], coarse[b] = 2, 2
        elif char == " ":
            fine[b], coarse[b] = 3, 3
        elif b < 0x20 or b == 0x7F:
            fine[b], coarse[b] = 4, 3
        else:
            fine[b], coarse[b] = sign, 4
            sign += 1
    return fine, coarse


FINE, COARSE = _classes()
N_FINE, N_COARSE = int(FINE.max()) + 1, 5
WIDTH = N_FINE + N_COARSE * N_COARSE + 3


def passages(text: str | None) -> np.ndarray:
    """One row of features per passage of the whole text."""
    return np.concatenate(list(blocks(text)))


def features(raw: bytes) -> np.ndarray:
    """One row of features per passage of some lines."""
    data = np.frombuffer(raw, np.uint8)
    if len(data) == 0:
        return np.zeros((1, WIDTH), np.float32)
    ends = np.flatnonzero(data == 10) + 1
    starts = np.concatenate(([0], ends[ends < len(data)]))
    sizes = np.diff(np.append(starts, len(data)))
    pieces = -(-sizes // PASSAGE_BYTES)
    first = np.repeat(np.cumsum(pieces) - pieces, sizes)
    within = np.arange(len(data)) - np.repeat(starts, sizes)
    passage = first + within // PASSAGE_BYTES
    n = int(passage[-1]) + 1
    fine, coarse = FINE[data], COARSE[data]
    out = np.empty((n, WIDTH), np.float32)
    length = np.bincount(passage, minlength=n)
    out[:, :N_FINE] = np.bincount(passage * N_FINE + fine, minlength=n * N_FINE).reshape(n, N_FINE)
    steps = N_COARSE * N_COARSE
    moves = passage[1:] * steps + coarse[:-1] * N_COARSE + coarse[1:]
    out[:, N_FINE : N_FINE + steps] = np.bincount(moves, minlength=n * steps).reshape(n, steps)
    out[:, :-3] /= length[:, None]
    out[:, -1] = np.log1p(length)
    bounds = np.append(np.cumsum(length) - length, len(data)).tolist()
    for i in range(n):
        words = raw[bounds[i] : bounds[i + 1]].split()
        many = max(1, len(words))
        out[i, -3] = len(set(words)) / many
        out[i, -2] = sum(map(eq, words, words[1:])) / many
    return out


def blocks(text: str | None, most: int = BLOCK_BYTES):
    """Features of the passages of a text, block by block: a block ends at a line's end, or at a
    passage's end within a long line, so the passages are those of the whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    at = 0
    while len(raw) - at > most:
        cut = raw.rfind(b"\n", at, at + most) + 1
        if cut <= at:
            cut = at + most // PASSAGE_BYTES * PASSAGE_BYTES
        yield features(raw[at:cut])
        at = cut
    yield features(raw[at:])


def thinned(text: str | None, most: int = SAMPLE_PASSAGES) -> np.ndarray:
    """Features of a document of the sample: at most ``most`` passages, evenly spread over the whole
    text (each block gives its share, so no more than a block's are held besides)."""
    parts = []
    size = max(1, len((text or "").encode("utf-8", "surrogatepass")))
    for rows in blocks(text):
        share = max(1, int(most * min(1.0, BLOCK_BYTES / size)))
        parts.append(rows[np.unique(np.linspace(0, len(rows) - 1, min(share, len(rows))).astype(int))])
    return np.concatenate(parts)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class AttentionModel:
    """Gated attention over encoded passages; ``parts`` are the learned arrays."""

    def __init__(self, mean, scale, parts):
        self.mean, self.scale, self.parts = mean, scale, parts

    def forward(self, rows: np.ndarray, starts: np.ndarray):
        p = self.parts
        bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(rows))))
        x = np.clip((rows - self.mean) / self.scale, -6, 6)
        e = np.tanh(x @ p["We"] + p["be"])
        t, s = np.tanh(e @ p["V"]), _sigmoid(e @ p["U"])
        weight = (t * s) @ p["w"]
        weight = np.exp(weight - np.maximum.reduceat(weight, starts)[bag])
        a = weight / np.add.reduceat(weight, starts)[bag]
        z = np.add.reduceat(a[:, None] * e, starts)
        return x, e, t, s, a, z, bag, _sigmoid(z @ p["c"] + p["c0"])

    def score(self, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return self.forward(rows, starts)[-1]

    def score_long(self, parts) -> float:
        """The score of one document whose passages come in parts; only sums are held."""
        p, top, total, z = self.parts, -np.inf, 0.0, 0.0
        for rows in parts:
            x = np.clip((rows - self.mean) / self.scale, -6, 6)
            e = np.tanh(x @ p["We"] + p["be"])
            weight = (np.tanh(e @ p["V"]) * _sigmoid(e @ p["U"])) @ p["w"]
            higher = max(top, float(weight.max()))
            own, faded = np.exp(weight - higher), np.exp(top - higher)
            total, z, top = total * faded + own.sum(), z * faded + own @ e, higher
        return float(_sigmoid(z / total @ p["c"] + p["c0"])[0])


class ConstantModel:
    """The same score for every document."""

    def __init__(self, value: float):
        self.value = value

    def score(self, rows, starts):
        return np.full(len(starts), self.value)

    def score_long(self, parts):
        return self.value


def train(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 20, hidden: int = 24, seed: int = 7):
    """Adam on the logistic loss, by hand-written gradients."""
    if len(labels) == 0 or labels.min() == labels.max():
        return ConstantModel(float(labels.mean()) if len(labels) else 0.5)
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    mean, scale = every.mean(0), every.std(0) + 1e-3
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float64)
    parts = {
        "We": draw(every.shape[1], hidden), "be": np.zeros(hidden), "V": draw(hidden, 12), "U": draw(hidden, 12),
        "w": draw(12), "c": draw(hidden), "c0": np.zeros(1),
    }
    model = AttentionModel(mean, scale, parts)
    m = {k: np.zeros_like(v) for k, v in parts.items()}
    v2 = {k: np.zeros_like(v) for k, v in parts.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        rate = 0.01 * (1 - epoch / epochs) + 1e-4
        for at in range(0, len(order), 64):
            chosen = order[at : at + 64]
            rows = np.concatenate([bags[i] for i in chosen])
            sizes = np.array([len(bags[i]) for i in chosen])
            starts = np.cumsum(sizes) - sizes
            x, e, t, s, a, z, bag, score = model.forward(rows, starts)
            do = (score - labels[chosen]) / len(chosen)
            dz = (do[:, None] * parts["c"])[bag]
            da = (e * dz).sum(1)
            dw = a * (da - np.add.reduceat(a * da, starts)[bag])
            dgate = dw[:, None] * parts["w"]
            dt, ds = dgate * s * (1 - t * t), dgate * t * s * (1 - s)
            de = a[:, None] * dz + dt @ parts["V"].T + ds @ parts["U"].T
            de *= 1 - e * e
            grads = {
                "We": x.T @ de, "be": de.sum(0), "V": e.T @ dt, "U": e.T @ ds,
                "w": (t * s).T @ dw, "c": z.T @ do, "c0": np.array([do.sum()]),
            }
            step += 1
            for k, g in grads.items():
                g = g + 1e-4 * parts[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v2[k] = 0.999 * v2[k] + 0.001 * g * g
                parts[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_BOUND):
    """A model from at most ``bound`` labelled documents that are not held out."""
    sample = labelled_sample(docs, one_label(labels, "quality", "min"), bound)

    def features(batches):
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bag = thinned(text).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([bag], pa.binary()), pa.array([label], pa.int32())], ["bag", "label"])

    rows = sample.select("text", "label").mapInArrow(features, "bag binary, label int").collect()
    # The order of the tasks' rows must not change the fit.
    rows.sort(key=lambda r: (bytes(r["bag"]), r["label"]))
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, WIDTH) for r in rows]
    return train(bags, np.array([float(r["label"] > 0) for r in rows]))


def scores_of(model, texts: list[str | None]) -> np.ndarray:
    """The score of each text. Texts are taken together up to a block's bytes; a longer one is
    scored block by block, so memory does not depend on the texts."""
    out, group, held = np.empty(len(texts)), [], 0

    def flush():
        if group:
            part = [passages(texts[i]) for i in group]
            sizes = np.array([len(x) for x in part])
            out[group] = model.score(np.concatenate(part), np.cumsum(sizes) - sizes)

    for i, text in enumerate(texts):
        size = len(text or "")
        if size > BLOCK_BYTES // 4:
            out[i] = model.score_long(blocks(text))
            continue
        if held + size > BLOCK_BYTES:
            flush()
            group, held = [], 0
        group.append(i)
        held += size + 64
    flush()
    return out


def score(docs: DataFrame, model, accept: float = ACCEPT) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted."""

    def scored(batches):
        for batch in batches:
            for part in text_slices(batch, 1):
                values = scores_of(model, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(scored, "doc_id long, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= accept, 1).otherwise(0).alias("predicted"),
    )


def accepted(docs: DataFrame, model, accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` whose score is ``accept`` or more, with all their columns."""

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        return pd.Series(scores_of(model, texts.tolist()) >= accept)

    return docs.where(good(F.col("text")))
