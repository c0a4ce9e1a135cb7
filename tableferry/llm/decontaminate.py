"""Benchmark decontamination by pigeonhole edit matching.

A document is contaminated by a test item if some stretch of its text is within the item's error
budget, ``floor(error_rate * length)`` edits. Of ``budget + 1`` pieces of the item, at least one
stands unchanged in such a stretch. One Aho-Corasick automaton finds all pieces of a block of
items in one pass over the whole text; around each hit, Myers' bit-parallel distance decides. It
is taken of growing groups of pieces first: of a group of p pieces with at most p - 1 errors, one
half has fewer errors than pieces too, so a chance hit of one piece ends at its pair.

Both sides are compared in lower case with every run of white space as one blank; positions
count in that form.

The items are handled in blocks of at most ``BLOCK_BYTES``, whose sizes are counted before
anything is sent; each block is a pass over the documents. No shuffle of texts.

Cases: null and blank items match nothing; null and empty texts match nothing. Items that repeat
an item_id are matched each and reported by their best match. Repeated documents give their rows
again. An item longer than a block is a block of its own. Other columns are not looked at.
"""

from __future__ import annotations

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERROR_RATE = 0.1
BLOCK_BYTES = 4 << 20


def normal(text: str | None) -> str:
    """Lower case, white space as single blanks."""
    return " ".join(text.lower().split()) if text else ""


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece) of ``errors + 1`` pieces of nearly equal length; fewer if the item is short."""
    n = min(errors + 1, len(item))
    ends = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:])]


def masks(pattern: str) -> dict[str, int]:
    """For each sign the positions it has in the pattern, as bits."""
    found: dict[str, int] = {}
    for i, sign in enumerate(pattern):
        found[sign] = found.get(sign, 0) | 1 << i
    return found


def myers(where: dict[str, int], m: int, text: str, anchored: bool = False) -> tuple[int, int]:
    """Least edit distance of the pattern (length m) to a stretch of ``text``, and where it ends
    (the first such end). ``anchored``: the stretch begins at the begin of ``text``."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    carry = 1 if anchored else 0
    for at, sign in enumerate(text, 1):
        eq = where.get(sign, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(xh | plus))
        down = plus & xh
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1 | carry) & full
        down = (down << 1) & full
        plus = down | (full & ~(xv | up))
        minus = up & xv
        if score < best:
            best, end = score, at
    return best, end


class Matcher:
    """The automaton and the bit masks of one block of items."""

    def __init__(self, items: list[tuple[int | None, str]], error_rate: float):
        self.items = []
        self.offsets: list[list[int]] = []
        self.groups: dict[tuple[int, int, int], dict[str, int]] = {}
        found: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = normal(text)
            if text:
                errors = int(error_rate * len(text) + 1e-9)
                cut = pieces(text, errors)
                for k, (_, piece) in enumerate(cut):
                    found.setdefault(piece, []).append((len(self.items), k))
                self.items.append((item_id, text, errors, masks(text)))
                self.offsets.append([offset for offset, _ in cut] + [len(text)])
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if found:
            self.automaton.make_automaton()

    def grows(self, text: str, begin: int, i: int, k: int, tested: dict) -> bool:
        """Whether the groups of 2, 4, ... pieces around piece ``k``, found at ``begin``, are there
        too, each with fewer errors than pieces. ``tested`` keeps what was found for equal
        stretches, of which repetitive texts have many."""
        offsets, item = self.offsets[i], self.items[i][1]
        n, width = len(offsets) - 1, 2
        while width < n:
            first = k // width * width
            after = min(n, first + width)
            errors = after - first - 1
            if errors:
                a, b = offsets[first], offsets[after]
                where = self.groups.get((i, first, after))
                if where is None:
                    where = self.groups[i, first, after] = masks(item[a:b])
                low = begin - (offsets[k] - a) - errors
                stretch = text[max(0, low) : low + b - a + 2 * errors]
                fits = tested.get((i, first, after, stretch))
                if fits is None:
                    fits = myers(where, b - a, stretch)[0] <= errors
                    if len(stretch) <= 256:
                        if len(tested) >= 20_000:
                            tested.clear()
                        tested[i, first, after, stretch] = fits
                if not fits:
                    return False
            width *= 2
        return True

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """For each item the stretches of ``text`` that may hold it, overlapping ones as one."""
        out: dict[int, list[list[int]]] = {}
        if not self.items:
            return out
        tested: dict = {}
        for last, (size, places) in self.automaton.iter(text):
            begin = last - size + 1
            for i, k in places:
                _, item, errors, _ = self.items[i]
                low = begin - self.offsets[i][k] - errors
                high = min(len(text), low + len(item) + 2 * errors)
                low = max(0, low)
                spans = out.get(i)
                if spans and low <= spans[-1][1] and spans[-1][0] <= high:
                    # Next to a stretch that is verified anyway: it grows, and no test is needed.
                    spans[-1] = [min(low, spans[-1][0]), max(high, spans[-1][1])]
                elif self.grows(text, begin, i, k, tested):
                    out.setdefault(i, []).append([low, high])
        for spans in out.values():
            spans.sort()
            kept = [spans[0]]
            for span in spans[1:]:
                if span[0] <= kept[-1][1]:
                    kept[-1][1] = max(kept[-1][1], span[1])
                else:
                    kept.append(span)
            spans[:] = kept
        return out

    def matches(self, text: str | None, first_only: bool = False) -> list[tuple[int | None, int, int, int]]:
        """(item_id, distance, start, end) of the best match of each item within its budget."""
        text = normal(text)
        out: dict[int | None, tuple[int, int, int]] = {}
        for i, spans in self.windows(text).items():
            item_id, item, errors, where = self.items[i]
            for low, high in spans:
                distance, end = myers(where, len(item), text[low:high])
                if distance <= errors:
                    if first_only:
                        return [(item_id, distance, low, low + end)]
                    end += low
                    before = text[max(0, end - len(item) - errors) : end][::-1]
                    _, length = myers(masks(item[::-1]), len(item), before, anchored=True)
                    found = (distance, end - length, end)
                    if item_id not in out or found < out[item_id]:
                        out[item_id] = found
        return [(item_id, *found) for item_id, found in out.items()]


_MATCHERS: dict = {}


def _matcher(shared, error_rate: float) -> Matcher:
    """The matcher of a broadcast block, built once per worker."""
    key = (shared.value[0], error_rate)
    if key not in _MATCHERS:
        if len(_MATCHERS) >= 4:
            _MATCHERS.clear()
        _MATCHERS[key] = Matcher(shared.value[1], error_rate)
    return _MATCHERS[key]


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES):
    """Broadcast variables, each with at most ``block_bytes`` of items (or one larger text).

    The sizes are counted in Spark first; the driver holds one block at a time.
    """
    spark = benchmark.sparkSession
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = items.withColumns({"size": F.octet_length("text"), "h": F.xxhash64("text")})
    total = items.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    n = 1 if total <= block_bytes else -(-2 * total // block_bytes)
    while True:
        dealt = items.withColumn("block", F.pmod("h", F.lit(n)))
        sizes = dealt.groupBy("block").agg(F.sum("size").alias("size"), F.countDistinct("h").alias("texts"))
        over = sizes.where((F.col("size") > block_bytes) & (F.col("texts") > 1)).limit(1).count()
        if not over:
            break
        n *= 2
    for block in range(n):
        rows = dealt.where(F.col("block") == block).select("item_id", "text").collect()
        if rows:
            given = sorted(((r["item_id"], r["text"]) for r in rows), key=lambda x: (x[1], x[0] is None, x[0] or 0))
            yield spark.sparkContext.broadcast((hash(tuple(given)), given))


def hits(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row and item in it: doc_id, item_id, distance, start_char, end_char."""
    schema = "doc_id long, item_id long, distance int, start_char long, end_char long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    names = ["doc_id", "item_id", "distance", "start_char", "end_char"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def job(shared):
        def run(batches):
            matcher = _matcher(shared, error_rate)
            for batch in batches:
                found = [
                    (doc_id, *match)
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for match in matcher.matches(text)
                ]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names)

        return rows.mapInArrow(run, schema)

    out = docs.sparkSession.createDataFrame([], schema)
    parts = [job(shared) for shared in blocks(benchmark, block_bytes)]
    for part in parts:
        out = part if len(parts) == 1 else out.unionAll(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    for shared in blocks(benchmark, block_bytes):

        def free(shared=shared):
            @F.pandas_udf("boolean")
            def run(texts: pd.Series) -> pd.Series:
                matcher = _matcher(shared, error_rate)
                return pd.Series([not matcher.matches(x, first_only=True) for x in texts], dtype=bool)

            return run

        docs = docs.where(free()(F.col("text")))
    return docs
