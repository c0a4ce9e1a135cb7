"""Toxicity by classifier chains.

Categories are predicted one after the other by logistic models on the presence of words; each
model also gets the probabilities of the categories before it. In training those are out of
fold: the folds' models score the rows they have not seen, so a later model does not learn to
trust an earlier one more than it deserves. The last category decides.

Labels of the categories come as columns. ``categories_of`` makes them from one toxic label:
the narrow categories hold where the label holds and the text has one of the category's words,
then the label itself is the last category.

Fit: at most ``bound`` labelled documents (their whole texts). Spark counts the words of the
sample by label; the ``terms`` words that tell the labels apart best are the features. The small
models are fitted on the driver by Newton steps. Scores: Arrow batches, no shuffle.

Cases: a null or empty text has no words and gets the models' base rates. Without usable labels,
or with labels of one kind only in a category, that category's probability is its share of label
1 (0 without labels). Repeated rows are scored each. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import held_out
from tableferry.llm.samples import labelled_sample, one_label

SAMPLE_BOUND = 8000
TERMS = 200
FOLDS = 4
THRESHOLD = 0.5

#: Words of the narrow categories, for the weak labels only; the models learn their own words.
CATEGORY_WORDS = {
    "insult": ("idiot", "moron", "clown", "loser", "scum"),
    "contempt": ("pathetic", "worthless", "stupid", "trash", "disgusting"),
}

_LETTERS = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


def word_set(text: str | None) -> set[bytes]:
    """The distinct words of the whole text: runs of letters, A-Z lower-cased."""
    return set(text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()) if text else set()


def categories_of(words: set[bytes], toxic: int) -> list[int]:
    """0/1 for each narrow category and then for toxic itself."""
    narrow = [int(bool(toxic) and any(w.encode() in words for w in group)) for group in CATEGORY_WORDS.values()]
    return [*narrow, int(toxic > 0)]


class Logistic:
    """Ridge logistic regression by Newton steps; constant where the labels are of one kind."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 0.1):
        x = np.hstack([x, np.ones((len(x), 1))])
        self.weights = np.zeros(x.shape[1])
        if len(y) == 0 or y.min() == y.max():
            rate = float(y.mean()) if len(y) else 0.0
            self.weights[-1] = 30.0 if rate == 1 else -30.0
            return
        penalty = np.full(x.shape[1], ridge)
        penalty[-1] = 1e-6
        for _ in range(12):
            p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
            slope = x.T @ (p - y) + penalty * self.weights
            curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
            step = np.linalg.solve(curve, slope)
            self.weights -= step
            if np.abs(step).max() < 1e-4:
                break

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


class Chain:
    """One model per category, each fed with the probabilities before it."""

    def __init__(self, terms: list[bytes], names: list[str], models: list[Logistic]):
        self.at = {term: i for i, term in enumerate(terms)}
        self.names, self.models = names, models

    def features(self, sets: list[set[bytes]]) -> np.ndarray:
        x = np.zeros((len(sets), len(self.at)))
        known = self.at.keys()
        for i, words in enumerate(sets):
            for word in known & words:
                x[i, self.at[word]] = 1.0
        return x

    def __call__(self, x: np.ndarray) -> np.ndarray:
        earlier: list[np.ndarray] = []
        for model in self.models:
            earlier.append(model(np.column_stack([x, *earlier])))
        return np.column_stack(earlier)


def train(terms: list[bytes], names: list[str], x: np.ndarray, labels: np.ndarray, folds: int = FOLDS) -> Chain:
    """The chain over features ``x`` and one label column per name."""
    fold = np.arange(len(x)) % folds
    earlier: list[np.ndarray] = []
    models = []
    for column in range(len(names)):
        given, y = np.column_stack([x, *earlier]), labels[:, column]
        models.append(Logistic(given, y))
        unseen = np.zeros(len(x))
        for k in range(folds):
            if (fold == k).any():
                unseen[fold == k] = Logistic(given[fold != k], y[fold != k])(given[fold == k])
        earlier.append(unseen)
    return Chain(terms, names, models)


def fit(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_BOUND, terms: int = TERMS) -> Chain:
    """A chain from at most ``bound`` labelled documents that are not held out."""
    sample = labelled_sample(docs, one_label(labels, "toxic"), bound).select("text", "label")

    def words(batches):
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = sorted(word_set(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.binary()), pa.array([label] * len(found), pa.int32())], ["word", "label"]
                )

    sizes = {r["label"]: r["count"] for r in sample.groupBy((F.col("label") > 0).cast("int").alias("label")).count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    chosen: list[bytes] = []
    if n0 and n1:
        toxic = F.sum((F.col("label") > 0).cast("int"))
        counted = sample.mapInArrow(words, "word binary, label int").groupBy("word").agg(
            toxic.alias("d1"), (F.count("*") - toxic).alias("d0")
        )
        # Log odds ratio over its standard error, with half a document added to each cell.
        a, b = F.col("d1") + 0.5, F.lit(float(n1)) - F.col("d1") + 0.5
        c, d = F.col("d0") + 0.5, F.lit(float(n0)) - F.col("d0") + 0.5
        # Words that are only somewhat more common on one side go with length, not with the label.
        odds = F.abs(F.log(a * d / (b * c)))
        z = odds / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
        best = counted.where(F.col("d0") + F.col("d1") >= 5).withColumn("z", z).where((odds > 1) & (F.col("z") > 3))
        chosen = sorted(bytes(r["word"]) for r in best.orderBy(F.desc("z"), "word").limit(terms).collect())

    names = [*CATEGORY_WORDS, "toxic"]
    wanted = {*chosen, *(w.encode() for group in CATEGORY_WORDS.values() for w in group)}

    def kept(batches):
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([sorted(word_set(text) & wanted)], pa.list_(pa.binary())), pa.array([label], pa.int32())],
                    ["words", "label"],
                )

    rows = sample.mapInArrow(kept, "words array<binary>, label int").collect()
    sets = [{bytes(w) for w in r["words"]} for r in rows]
    order = sorted(range(len(rows)), key=lambda i: (sorted(sets[i]), rows[i]["label"]))
    sets, given = [sets[i] for i in order], [rows[i]["label"] for i in order]
    empty = Chain(chosen, names, [])
    y = np.array([categories_of(s, t) for s, t in zip(sets, given)], float).reshape(-1, len(names))
    return train(chosen, names, empty.features(sets), y)


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score of the last category, predicted, and
    one ``p_<name>`` per category."""
    columns = [f"p_{name}" for name in chain.names]

    def scored(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 512):
                sets = [word_set(x) for x in texts.slice(at, 512).to_pylist()]
                values = chain(chain.features(sets))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, 512), *(pa.array(values[:, i], pa.float64()) for i in range(len(columns)))],
                    ["doc_id", *columns],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(scored, "doc_id long, " + ", ".join(f"{c} double" for c in columns))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col(columns[-1]).alias("score"),
        F.when(F.col(columns[-1]) >= threshold, 1).otherwise(0).alias("predicted"),
        *columns,
    )
