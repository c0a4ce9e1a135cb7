"""Language identification by nearest centroid.

Texts become normalised TF-IDF vectors of letter trigrams, hashed to ``DIMENSIONS``. Each
language has several centroids, found by spherical k-means on its documents of a bounded sample;
a text gets the language of the centroid with the largest cosine. A text whose cosine is below
what nearly all sample members of that centroid reach is marked ``rejected``.

Document frequencies count all documents that may be learned from. Held-out documents, the
source and the id are never looked at.

Cases: a text that is null or has no letter gets ``und`` and score 0. Without any learnable
language every text gets ``und``. A text with letters always gets a learned language; on equal
cosines the first in order of name. Repeated rows are predicted each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableferry.llm.common import held_out

DIMENSIONS = 4096
SAMPLE_BOUND = 2000
CENTROIDS = 3
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_KEEP = np.array([b if b >= 0x80 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)


def counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed letter trigrams of the whole text; None without a letter."""
    if not text or not _LETTER.search(text):
        return None
    data = _KEEP[np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)]
    kept = np.flatnonzero(data[1:-1] != 32) + 1  # the middle of a trigram is never a blank
    if len(kept) == 0:
        return np.zeros(DIMENSIONS, np.float32)
    wide = data.astype(np.uint32)
    code = wide[kept - 1] * np.uint32(2654435761) + wide[kept] * np.uint32(2246822519) + wide[kept + 1] * np.uint32(3266489917)
    code ^= code >> np.uint32(15)
    code *= np.uint32(2654435769)
    return np.bincount(code >> np.uint32(20), minlength=DIMENSIONS).astype(np.float32)


def vectors(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows."""
    out = np.log1p(rows) * idf
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


class CentroidModel:
    """Centroids with their languages and the least cosine each accepts."""

    def __init__(self, idf, centers, langs, least):
        self.idf, self.centers, self.langs, self.least = idf, centers, langs, least

    def predict(self, rows: np.ndarray):
        cosine = vectors(rows, self.idf) @ self.centers.T
        best = cosine.argmax(1)
        value = np.clip(cosine[np.arange(len(best)), best], 0.0, 1.0)
        return best, value


def spherical(points: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """At most ``k`` unit centres of unit ``points`` and each point's centre."""
    mean = points.mean(0)
    chosen = [int((points @ mean).argmax())]
    near = points @ points[chosen[0]]
    while len(chosen) < min(k, len(points)):
        far = int(near.argmin())
        if near[far] > 1 - 1e-6:
            break
        chosen.append(far)
        near = np.maximum(near, points @ points[far])
    centers = points[chosen]
    for _ in range(rounds):
        own = (points @ centers.T).argmax(1)
        centers = np.stack([points[own == c].mean(0) if (own == c).any() else centers[c] for c in range(len(centers))])
        centers /= np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)
    return centers, (points @ centers.T).argmax(1)


def learnable(docs: DataFrame) -> DataFrame:
    """doc_id, text and lang of the documents that may be learned from."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    return rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))


def fit(docs: DataFrame, bound: int = SAMPLE_BOUND, k: int = CENTROIDS) -> CentroidModel | None:
    """Document frequencies from all learnable documents, centroids from at most ``bound``."""
    usable = learnable(docs)

    def frequencies(batches):
        df, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                row = counts(text)
                if row is not None:
                    df += row > 0
                    n += 1
        yield pa.RecordBatch.from_arrays([pa.array([df.tolist() + [n]], pa.list_(pa.int64()))], ["df"])

    sums = (
        usable.select("text")
        .mapInArrow(frequencies, "df array<long>")
        .select(F.posexplode("df").alias("at", "n"))
        .groupBy("at")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    total = np.zeros(DIMENSIONS + 1, np.int64)
    for row in sums:
        total[row["at"]] = row["n"]
    if total[-1] == 0:
        return None
    idf = np.log((1 + total[-1]) / (1 + total[:-1])).astype(np.float32) + 0.05

    # Of each language the rows with the smallest hashes of id and text, equal rows once.
    hashed = usable.withColumn("h", F.xxhash64("doc_id", "text"))
    places = hashed.select("lang", "h").distinct()
    langs_known = usable.select("lang").distinct().count()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    share = max(1, bound // max(1, langs_known))
    last = places.withColumn("place", place).where(F.col("place") <= share).groupBy("lang").agg(F.max("h").alias("last"))
    wanted = F.lit(False)
    for row in last.collect():
        wanted = wanted | ((F.col("lang") == row["lang"]) & (F.col("h") <= row["last"]))
    drawn = hashed.where(wanted).groupBy("lang", "h").agg(F.min("text").alias("text"))

    def sampled(batches):
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row = counts(text)
                if row is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row.astype(np.float32).tobytes()], pa.binary()), pa.array([lang])], ["row", "lang"]
                    )

    rows = drawn.select("text", "lang").mapInArrow(sampled, "row binary, lang string").collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["row"])))
    centers, langs, least = [], [], []
    for lang in sorted({r["lang"] for r in rows}):
        points = vectors(np.stack([np.frombuffer(r["row"], np.float32) for r in rows if r["lang"] == lang]), idf)
        found, own = spherical(points, k)
        for c, center in enumerate(found):
            members = points[own == c] @ center
            centers.append(center)
            langs.append(lang)
            least.append(float(np.quantile(members, 0.01)) if len(members) else 0.0)
    if not centers:
        return None
    return CentroidModel(idf, np.stack(centers).astype(np.float32), langs, np.array(least))


def predict(docs: DataFrame, model: CentroidModel | None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, rejected."""

    def predicted(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 256):
                part = [counts(x) if model else None for x in texts.slice(at, 256).to_pylist()]
                langs, scores, rejected = [UNKNOWN] * len(part), [0.0] * len(part), [True] * len(part)
                known = [i for i, x in enumerate(part) if x is not None]
                if known:
                    best, value = model.predict(np.stack([part[i] for i in known]))
                    for i, b, v in zip(known, best.tolist(), value.tolist()):
                        langs[i], scores[i], rejected[i] = model.langs[b], v, v < model.least[b]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, 256), pa.array(langs), pa.array(scores, pa.float64()), pa.array([bool(x) for x in rejected])],
                    ["doc_id", "lang_pred", "score", "rejected"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(predicted, "doc_id long, lang_pred string, score double, rejected boolean").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )
