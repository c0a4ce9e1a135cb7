"""Helpers that several operators share: reading, word hashes, written tables, components."""

from __future__ import annotations

import pathlib
import re
import tempfile
import zipfile

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.session import written

#: Words of a shingle, and the least Jaccard similarity, where a contract says nothing else.
SHINGLE_WORDS = 5
SIMILARITY = 0.75

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MIX_A = np.uint64(0xFF51AFD7ED558CCD)
_MIX_B = np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(33)
_ROUND = np.uint64(0x9E3779B97F4A7C15)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the executors, once per application; they need not share its folder."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = pathlib.Path(__file__).resolve().parents[1]
        target = pathlib.Path(tempfile.mkdtemp(prefix="tableferry-"), "tableferry.zip")
        with zipfile.ZipFile(target, "w") as file:
            for source in sorted(package.rglob("*.py")):
                file.write(source, source.relative_to(package.parent))
        context.addPyFile(str(target))
        _shipped.add(context.applicationId)
    return spark


#: Rows of texts that cross to Python at a time. Spark's 10,000 take up to a hundred MB, several
#: times over, in each task that runs.
TEXT_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """From now on at most ``TEXT_ROWS`` rows cross to Python at a time, unless the session has a
    smaller number already. It stays so, for results are computed after the call; none depends on
    it."""
    knob = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(knob)) <= TEXT_ROWS:
        spark.conf.set(knob, str(TEXT_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder."""
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(column):
    """``column`` with A-Z lower-cased and everything else as it is."""
    return F.translate(column, _UPPER, _UPPER.lower())


def held_out(doc_id):
    """Whether a document is kept from every fit: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix of each value."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> _SHIFT
    x *= _MIX_A
    x ^= x >> _SHIFT
    x *= _MIX_B
    x ^= x >> _SHIFT
    return x


class WordHashes(dict):
    """64-bit hash of a word, remembered for up to ``most`` words and then begun anew."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, as UTF-8; none for a null text.

    ``bytes.split`` cuts at exactly x20 and x09-x0D, and ``bytes.lower`` changes A-Z only.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text (``words_of``), in order, made without a Python object
    per word: the sum over a word's bytes of a number for the byte times one for its place, mixed.
    """
    if not text:
        return np.zeros(0, np.uint64)
    data, at, parts = text.encode("utf-8", "surrogatepass"), 0, []
    while at < len(data):  # a long text in blocks that end at white space
        end = _SPACE.search(data, at + HASHED_BYTES)
        end = end.start() if end else len(data)
        parts.append(_word_hashes(np.frombuffer(data, np.uint8, end - at, at)))
        at = end
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _word_hashes(data: np.ndarray) -> np.ndarray:
    visible = np.zeros(len(data) + 2, bool)
    visible[1:-1] = _VISIBLE[data]
    edges = np.flatnonzero(visible[1:] != visible[:-1])
    if len(edges) == 0:
        return np.zeros(0, np.uint64)
    lengths = edges[1::2] - edges[::2]
    first = np.cumsum(lengths) - lengths
    places = np.arange(first[-1] + lengths[-1]) - np.repeat(first, lengths)
    most = int(lengths.max())
    weights = _PLACES if most <= len(_PLACES) else _weights(most)
    values = _BYTES[data[visible[1:-1]]] * weights[places]
    return mixed(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def _weights(n: int) -> np.ndarray:
    """An odd number for each of ``n`` places in a word."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * _ROUND) | np.uint64(1)


HASHED_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_VISIBLE = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * _MIX_A)
_BYTES[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]
_PLACES = _weights(256)


def xxh3_of(texts: list[str | None]) -> list[np.ndarray]:
    """For each text the hashes of its words (``words_of``), in order: those of ``WordHashes``,
    made for many texts at once and without a Python object per word."""
    out: list[np.ndarray] = []
    held: list[bytes] = []
    size = 0

    def flush():
        ends = np.cumsum([len(data) + 1 for data in held])
        starts, hashes = _xxh3_words(b" ".join(held))
        out.extend(np.split(hashes, np.searchsorted(starts, ends[:-1])))

    for text in texts:
        data = text.encode("utf-8", "surrogatepass").lower() if text else b""
        if len(data) > HASHED_BYTES:  # a long text in blocks that end at white space
            if held:
                flush()
                held, size = [], 0
            at, parts = 0, []
            while at < len(data):
                end = _SPACE.search(data, at + HASHED_BYTES)
                end = end.start() if end else len(data)
                parts.append(_xxh3_words(data[at:end])[1])
                at = end
            out.append(np.concatenate(parts))
            continue
        held.append(data)
        size += len(data)
        if size > HASHED_BYTES:
            flush()
            held, size = [], 0
    if held:
        flush()
    return out


def _xxh3_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins, and XXH3 (64 bits, no seed) of it: by its published rules for up to 3,
    8 and 16 bytes, by the library for longer words."""
    padded = data + bytes(8)
    signs = np.frombuffer(padded, np.uint8)
    visible = np.zeros(len(data) + 2, bool)
    visible[1:-1] = _VISIBLE[signs[: len(data)]]
    edges = np.flatnonzero(visible[1:] != visible[:-1])
    starts, ends = edges[::2], edges[1::2]
    sizes = ends - starts
    out = np.empty(len(starts), np.uint64)
    # Four and eight bytes from any place on.
    four = np.ndarray((len(data) + 5,), "<u4", padded, strides=(1,))
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    at = np.flatnonzero(sizes <= 3)
    first, last, n = starts[at], ends[at] - 1, sizes[at]
    x = signs[first].astype(np.uint64) << np.uint64(16) | signs[first + (n >> 1)].astype(np.uint64) << np.uint64(24)
    x = (x | signs[last] | n.astype(np.uint64) << np.uint64(8)) ^ _FLIP_3
    x = (x ^ x >> np.uint64(33)) * _XXH_2
    x = (x ^ x >> np.uint64(29)) * _XXH_3
    out[at] = x ^ x >> np.uint64(32)
    at = np.flatnonzero((sizes >= 4) & (sizes <= 8))
    x = (four[ends[at] - 4].astype(np.uint64) + (four[starts[at]].astype(np.uint64) << np.uint64(32))) ^ _FLIP_8
    x ^= (x << np.uint64(49) | x >> np.uint64(15)) ^ (x << np.uint64(24) | x >> np.uint64(40))
    x *= _XXH_MIX
    x = (x ^ (x >> np.uint64(35)) + sizes[at].astype(np.uint64)) * _XXH_MIX
    out[at] = x ^ x >> np.uint64(28)
    at = np.flatnonzero((sizes >= 9) & (sizes <= 16))
    low, high = eight[starts[at]] ^ _FLIP_LOW, eight[ends[at] - 8] ^ _FLIP_HIGH
    # The product in 128 bits, its halves xored.
    half, rest = np.uint64(32), np.uint64(0xFFFFFFFF)
    a, b, c, d = low & rest, low >> half, high & rest, high >> half
    cross = (a * c >> half) + (b * c & rest) + a * d
    folded = (b * c >> half) + (cross >> half) + b * d ^ (cross << half | a * c & rest)
    x = sizes[at].astype(np.uint64) + low.byteswap() + high + folded
    x = (x ^ x >> np.uint64(37)) * _XXH_AVALANCHE
    out[at] = x ^ x >> np.uint64(32)
    for i in np.flatnonzero(sizes > 16).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]])
    return starts, out


_XXH_2, _XXH_3 = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_XXH_MIX, _XXH_AVALANCHE = np.uint64(0x9FB21C651E98DF25), np.uint64(0x165667919E3779F9)
_SECRET = bytes.fromhex("b8fe6c3923a44bbe7c01812cf721ad1cded46de9839097db7240a4a4b7b3671fcb79e64eccc0e578825ad07dccff7221b8084674f743248e")
_KEYS = np.frombuffer(_SECRET, "<u8")
_FLIP_3 = np.uint64(int.from_bytes(_SECRET[:4], "little") ^ int.from_bytes(_SECRET[4:8], "little"))
_FLIP_8, _FLIP_LOW, _FLIP_HIGH = _KEYS[1] ^ _KEYS[2], _KEYS[3] ^ _KEYS[4], _KEYS[5] ^ _KEYS[6]


def shingle_hashes(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of the runs of ``size`` words in order; a shorter text is one run; no word, none.

    Polynomial in the word hashes with an odd multiplier, mixed at the end, so that the order
    of the words counts.
    """
    n = len(words)
    if n == 0:
        return words
    if n < size:
        value = np.uint64(n)
        with np.errstate(over="ignore"):
            for word in words:
                value = value * _ROUND + word
        return mixed(np.array([value], dtype=np.uint64))
    value = words[: n - size + 1] * np.uint64(1)
    for k in range(1, size):
        value = value * _ROUND + words[k : n - size + 1 + k]
    return mixed(value)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest reachable node.

    Alternates large-star and small-star steps: each joins every node's neighbours to their
    smallest, so the edge count never grows and chains halve. Every round is written to the
    shared folder, which ends the lineage. Nothing but two sums per round reaches the driver.
    """

    def smallest(sym: DataFrame) -> DataFrame:
        return sym.groupBy("u").agg(F.min("v").alias("low"))

    def signature(df: DataFrame):
        row = df.agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("s"),
        ).first()
        return row["n"], row["s"]

    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = written(pairs.where("a <> b").distinct(), label)
    before = signature(pairs)
    while before[0]:
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            pairs.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        low = smallest(both).select("u", F.least("u", "low").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Each node now points down only; join what a node points at to the smallest of it.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
            .select(F.col("e.a").alias("a"), F.col("e.m").alias("b"))
        )
        pairs = written(small.where("a <> b").distinct(), label)
        after = signature(pairs)
        if after == before:
            break
        before = after
    # Converged: every node but the roots has one edge, to its root.
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
