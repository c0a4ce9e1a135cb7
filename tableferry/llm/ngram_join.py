"""N-gram Jaccard join by parity sketches.

A document's set holds its distinct 5-word shingles. With J(A, B) >= t the symmetric difference
is at most (1-t)/(1+t) * (|A| + |B|), which is d = (|A| + |B|) / 7 for t = 0.75. Every shingle flips
one bit of a sketch, so the Hamming distance of two sketches is at most their symmetric difference.

Candidates (pigeonhole per size band): a band's sketch is cut into more pieces than its largest d;
equal pieces must remain. A piece is kept as the hash of its set bits. Of two documents' pieces at
most d differ, so under any one order of all pieces the first d + 1 of each share one; a document
joins on its first d + 1. The order puts pieces last whose shingles all stand in very many
documents, by counts over all documents folded into 2^20 counters, and else begins with those that
are least likely by chance: the sum of their words' log frequencies, counted likewise over all
texts. It is part of a piece's key, so both documents order it alike; only the order depends on
the counts, no result does. Pieces without a bit come last and are used only if the others do not suffice. A band spans
a factor of 2 in size; a document that may have partners in the band below joins there too.

Work stays linear in groups of copies: equal sets are one class, linked by one edge each; in a
task, a set's pieces are sent once. Pieces with the same members are one bucket, and buckets with one smallest member
are joined if that makes no more pairs. Each document first meets the smallest members of its buckets,
those ``LEADERS`` with which it shares most. Those pairs are sifted by sketch and verified, and components are formed. Buckets that still span
several components are led by other members in turn, a member again meeting few, as long as their
pairs across components are many and links are found; then all pairs across components that are left are compared: small
buckets by a join, large ones in blocks of members whose sketches are compared in place, so that
only pairs that may hold are ever written.

Cases: a null or empty text, or one without words, has an empty set and links with nothing. Rows
of one doc_id count as one document for the components. A null doc_id links with nothing and has
a null component. Other columns of the input are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableferry.llm.common import SHINGLE_WORDS, SIMILARITY, WordHashes, components, mixed, shingle_hashes, small_batches, word_hashes, words_of
from tableferry.session import written

BAND = 2
PIECES = 0.6  # pieces of a band's sketch, as a share of the band's largest size
PIECE_BITS = np.uint64(12)
COUNTERS = 1 << 20
SEGMENT = 1 << 14
SEEN_SETS = 50_000
CERTAIN = 5 * 255  # the largest sum of ranks, so that more shingles make a piece rarer
BLOCK = 4096  # members of a bucket that one task compares with as many others
TASK_ROWS = 50_000
TASK_PAIRS = 200_000
LEADERS = 2  # leaders that a member meets in one turn
ACROSS = 16  # pairs per row of the buckets up to which they are tried in all pairs
SMALL = 16  # members of a bucket up to which its pairs are joined
LAST = 1 << 40  # added to what comes last in the order

_PREP = "doc_id long, n long, f1 long, f2 long, sketch binary, segment int, counters binary"
_LOW = np.uint64(COUNTERS - 1)


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted; a plain sort is faster than numpy's ``unique``."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def shingle_set(text: str | None, hashes: WordHashes | None = None) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; ``hashes`` are those of words, if given."""
    return distinct(shingle_hashes(word_hashes(text) if hashes is None else hashes.of(words_of(text))))


def ranked_set(words: np.ndarray, ranks: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the shingles of a text's word hashes, and for each its place in
    the order: the sum of its words' ranks, or ``LAST`` and more if it is frequent."""
    own = shingle_hashes(words)
    first = np.argsort(own)  # equal shingles have equal words, so any of them gives the rank
    own = own[first]
    new = np.append(True, own[1:] != own[:-1])
    own, first = own[new], first[new]
    each = ranks[words & _LOW].astype(np.int64)
    if len(words) < SHINGLE_WORDS:
        rank = np.full(len(own), each.sum())
    else:
        total = np.concatenate(([0], np.cumsum(each)))
        rank = (total[SHINGLE_WORDS:] - total[:-SHINGLE_WORDS])[first]
    return own, rank + frequent[own & _LOW] * LAST


def band_of(n: int) -> int:
    band = 0
    while n >= BAND ** (band + 1):
        band += 1
    return band


def bands(n: int, t: float = SIMILARITY) -> list[tuple[int, int]]:
    """(band, largest symmetric difference to a partner there) of a set of ``n`` shingles."""
    share, own = (1 - t) / (1 + t), band_of(n)
    out = [(own, int(share * (n + int(n / t + 1e-9)) + 1e-9))]
    most = BAND**own - 1  # the largest set of the band below
    if own and n * t <= most:
        out.append((own - 1, int(share * (n + most) + 1e-9)))
    return out


def bits_of(hashes: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """The set bits of a set's sketch in a band, as piece number and place within the piece, and
    for each the index of a shingle that sets it."""
    count = np.uint64(piece_count(band))
    place = mixed(hashes + np.uint64(band + 1))
    code = (((place >> PIECE_BITS) % count) << PIECE_BITS) | (place & np.uint64((1 << int(PIECE_BITS)) - 1))
    room = len(hashes).bit_length()
    # Code and index in one number, so that one plain sort does.
    both = np.sort((code << np.uint64(room)) | np.arange(len(hashes), dtype=np.uint64))
    code = both >> np.uint64(room)
    starts = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    odd = starts[np.diff(np.append(starts, len(code))) & 1 == 1]
    return code[odd], (both[odd] & np.uint64((1 << room) - 1)).astype(np.int64)


def piece_count(band: int) -> int:
    """More than any symmetric difference within the band."""
    most = BAND ** (band + 1)
    return max(int(PIECES * most), 2)


def pieces(hashes: np.ndarray, rank: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the pieces that have a bit, and their place in the order.

    The place is hashed into the key: documents that disagree on it hold different shingles
    there, which counts as a difference of the piece.
    """
    code, first = bits_of(hashes, band)
    if len(code) == 0:
        return code, code.astype(np.int64)
    starts = np.flatnonzero(np.append(True, np.diff(code >> PIECE_BITS) != 0))
    own = rank[first]
    # Last only if every shingle is frequent; else the more shingles, the earlier.
    order = np.add.reduceat(own % LAST - CERTAIN, starts) + np.minimum.reduceat(own // LAST, starts) * LAST
    bits = np.add.reduceat(mixed(code + np.uint64(0x51)), starts)
    return mixed(bits + mixed(order.view(np.uint64)) + np.uint64(band)), order


def empty_pieces(hashes: np.ndarray, band: int, wanted: int) -> np.ndarray:
    """Keys of the first ``wanted`` pieces without a bit, in order of place."""
    held = np.unique(bits_of(hashes, band)[0] >> PIECE_BITS)
    free = np.setdiff1d(np.arange(piece_count(band), dtype=np.uint64), held)[:wanted]
    return mixed(mixed(free + np.uint64(0x9999)) + np.uint64(band))


def keys_of(hashes: np.ndarray, rank: np.ndarray, t: float = SIMILARITY) -> np.ndarray:
    """The keys a document joins on: in each of its bands the first d + 1 pieces in the order."""
    out = []
    for band, d in bands(len(hashes), t):
        keys, order = pieces(hashes, rank, band)
        if len(keys) > d + 1:
            last = np.partition(order, d)[d]
            ties = np.sort(keys[order == last])
            before = keys[order < last]
            keys = np.concatenate([before, ties[: d + 1 - len(before)]])
        elif len(keys) < d + 1:
            keys = np.concatenate([keys, empty_pieces(hashes, band, d + 1 - len(keys))])
        out.append(keys)
    return np.concatenate(out)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Parity bits of a set, packed; at least twice as many bits as shingles, a power of two."""
    bits = max(64, 1 << int(2 * len(hashes) - 1).bit_length())
    flips = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((flips & 1).astype(np.uint8), bitorder="little")


def distance(a: np.ndarray, b: np.ndarray) -> int:
    """Hamming distance of two packed sketches; the longer is folded to the shorter's length."""
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _prepare(batches):
    """A row per document (size, fingerprint, sketch); at the end the task's counts of words and
    of documents per shingle."""
    counts = np.zeros((2, COUNTERS), np.int64)
    names = ["doc_id", "n", "f1", "f2", "sketch", "segment", "counters"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def count(kind, parts):
        if parts:
            places = (np.concatenate(parts) & _LOW).astype(np.int64)
            counts[kind] += np.bincount(places, minlength=COUNTERS)

    for given in batches:
        ids, texts = given.column(0), given.column(1)
        for at in range(0, given.num_rows, 1000):
            rows, every_word, every_set = [], [], []
            for doc_id, text in zip(ids.slice(at, 1000).to_pylist(), texts.slice(at, 1000).to_pylist()):
                words = word_hashes(text)
                own = distinct(shingle_hashes(words))
                if len(own) == 0:
                    rows.append((doc_id, 0, 0, 0, None, None, None))
                    continue
                f1, f2 = (int(x.sum(dtype=np.uint64).astype(np.int64)) for x in (own, mixed(own + np.uint64(7))))
                rows.append((doc_id, len(own), f1, f2, sketch(own).tobytes(), None, None))
                every_word.append(words)
                every_set.append(own)
            yield batch(rows)
            count(0, every_word)
            count(1, every_set)
    if counts.any():
        small = np.minimum(counts, 65_535).astype(np.uint16).reshape(-1, SEGMENT)
        yield batch([(None, None, None, None, None, i, part.tobytes()) for i, part in enumerate(small)])


def _summed(batches):
    """Sums of the counters by segment; one array per segment is held."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for segment, counters in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            values = np.frombuffer(counters, np.uint16).astype(np.int64)
            sums[segment] = sums[segment] + values if segment in sums else values
    for segment, values in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([segment], pa.int32()), pa.array([values.tobytes()], pa.binary())], ["segment", "counters"]
        )


def order_tables(prepared: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rank of the words of each counter (8 times the log of its count), and whether the shingles
    of each counter are frequent: well above what chance folds into one counter."""
    rows = prepared.where("segment is not null").select("segment", "counters")
    rows = rows.repartition("segment").mapInArrow(_summed, "segment int, counters binary").collect()
    total = np.zeros((2 * COUNTERS // SEGMENT, SEGMENT), np.int64)
    for row in rows:
        total[row["segment"]] = np.frombuffer(row["counters"], np.int64)
    words, sets = total.reshape(2, COUNTERS)
    return np.minimum(8 * np.log2(1 + words), 255).astype(np.uint8), sets > 16 + 3 * sets.mean()


def buckets(docs: DataFrame, tables: tuple[np.ndarray, np.ndarray], t: float) -> DataFrame:
    """(key, id, low, pieces) of every bucket with several members; low is its smallest member.

    Near copies share most of their pieces, and documents with a passage in common those within it,
    so very many pieces have the same members. They are one bucket: its key is a hash of the
    members, ``pieces`` the number of those it stands for. Two sets of members with one hash make
    a larger bucket, which loses no pair. ``joined_buckets`` then joins those that are nearly alike."""
    shared = docs.sparkSession.sparkContext.broadcast(tables)  # 2 MB, whatever the texts are

    def emitted(batches):
        seen = set()
        ranks, frequent = shared.value
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = word_hashes(text)
                if len(words) == 0:
                    continue
                own, rank = ranked_set(words, ranks, frequent)
                print_ = (len(own), int(own.sum(dtype=np.uint64)), int(mixed(own + np.uint64(7)).sum(dtype=np.uint64)))
                if print_ in seen:
                    continue
                if len(seen) >= SEEN_SETS:
                    seen.clear()
                seen.add(print_)
                found = keys_of(own, rank, t).view(np.int64)
                ids.append(np.full(len(found), doc_id, np.int64))
                keys.append(found)
                if len(ids) == 500:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(ids))], ["key", "id"])
                    ids, keys = [], []
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(ids))], ["key", "id"])

    rows = docs.where("doc_id is not null").mapInArrow(emitted, "key long, id long")
    # One shuffle by key; a set of copies sends one row per task, so a bucket holds different sets.
    dealt = rows.selectExpr(
        "id",
        "min(id) over (partition by key) low",
        "max(id) over (partition by key) high",
        "sum(shiftright(xxhash64(id), 24)) over (partition by key) total",  # 40 bits each: no overflow
        "count(*) over (partition by key) members",
    )
    dealt = dealt.where("low < high").selectExpr("xxhash64(total, low, high) key", "id", "low", "members")
    alike = dealt.groupBy("key", "id").agg(F.min("low").alias("low"), F.count("*").alias("pieces"), F.max("members").alias("members"))
    return joined_buckets(written(alike, "buckets"))


def joined_buckets(groups: DataFrame) -> DataFrame:
    """(key, id, low, pieces) from buckets (key, id, low, pieces, members), where those of one
    smallest member are a single bucket if its pairs are no more than theirs together.

    Each piece that a few of many near copies lack has other members than the next, so such a group
    stands in about as many buckets as it has pieces, with all its members in each. A bucket of
    all their members holds every pair of theirs, once."""
    led = written(groups.groupBy("low", "id").agg(F.sum("pieces").alias("pieces"), F.sum("members").alias("pairs")), "led")
    sizes = led.groupBy("low").agg(F.count("*").alias("n"), F.sum("pairs").alias("pairs"))
    whole = written(sizes.where("n * n <= pairs").select("low"), "whole")
    own = groups.join(whole, "low", "left_anti").select("key", "id", "low", "pieces")
    return led.join(whole, "low").selectExpr("xxhash64(low) key", "id", "low", "pieces").unionAll(own)


def sifted(pairs: DataFrame, nodes: DataFrame, t: float) -> DataFrame:
    """Pairs (a, b) that size and sketch let through. Pairs of equal sets need no test."""
    share = (1 - t) / (1 + t)

    def run(batches):
        for batch in batches:
            a, b, na, nb, sa, sb = (c.to_pylist() for c in batch.columns)
            keep = [
                distance(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)) <= share * (m + n) + 1e-9
                for m, n, x, y in zip(na, nb, sa, sb)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(x: str) -> DataFrame:
        return nodes.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"), F.struct("f1", "f2").alias(f"f{x}"))

    def sketches(x: str) -> DataFrame:
        return nodes.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))

    near = (F.col("na") >= t * F.col("nb") - 1e-9) & (F.col("nb") >= t * F.col("na") - 1e-9)
    equal = (F.col("na") == F.col("nb")) & (F.col("fa") == F.col("fb"))
    # Sizes first: they drop many pairs before any sketch moves.
    sized = pairs.join(side("a"), "a").join(side("b"), "b").where(near & ~equal).select("a", "b", "na", "nb")
    joined = sized.join(sketches("a"), ["a", "na"]).join(sketches("b"), ["b", "nb"])
    return joined.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, t: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have a Jaccard similarity of ``t`` or more."""
    pairs = written(pairs, "pairs")
    spark = pairs.sparkSession
    involved = written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "involved")
    # A semi-join with a filter on a small written table lets Spark put a Bloom filter before the
    # shuffle of the texts, so only texts of candidates move. The filter holds for every id.
    texts = docs.join(involved.where(F.col("doc_id") >= F.lit(-(1 << 63))), "doc_id", "left_semi")
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    joined = pairs.join(two, "b").join(one, "a")

    def run(batches):
        last, other = None, None
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if tb != last:
                    last, other = tb, shingle_set(tb)
                own = shingle_set(ta)
                both = len(np.intersect1d(own, other, assume_unique=True))
                keep.append(both >= t * (len(own) + len(other) - both) - 1e-9 and both > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    found = joined.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long").distinct()
    knob = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(knob)
    spark.conf.set(knob, "0")
    try:
        return written(found, "links")
    finally:
        spark.conf.set(knob, before)


def most_shared(pairs: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of a member a and a leader b, from one row per bucket they share (with
    the number of its ``pieces``, or else each counts once); of each member's the ``LEADERS`` with
    which it shares most. Members of a group of near copies stand in many buckets with different
    leaders, so all such pairs are many per member; the others of a bucket are met later if it
    still spans several components."""
    often = pairs.groupBy("a", "b").agg((F.sum("pieces") if "pieces" in pairs.columns else F.count("*")).alias("n"))
    ranked = often.withColumn("place", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("n"), "b")))
    return ranked.where(F.col("place") <= LEADERS).select("a", "b")


def led_pairs(live: DataFrame, turn: int) -> DataFrame:
    """Distinct pairs (a, b), a > b, of members and another leader of their bucket, of different
    components. Documents lead in the same order everywhere, so few lead many buckets."""
    lead = live.groupBy("key").agg(F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("draw"), "id", "root")).alias("lead"))
    met = live.join(lead, "key").where(F.col("root") != F.col("lead.root"))
    met = most_shared(met.select(F.col("id").alias("a"), F.col("lead.id").alias("b"), *(["pieces"] if "pieces" in live.columns else [])))
    return met.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def spanning(groups: DataFrame, found: DataFrame) -> DataFrame:
    """(key, id, pieces, root) of the buckets whose members are of several components."""
    of = groups.select("key", "id", "pieces").join(found, F.col("id") == F.col("node"), "left")
    of = of.select("key", "id", "pieces", F.coalesce("root", "id").alias("root"))
    ends = of.selectExpr("*", "min(root) over (partition by key) low", "max(root) over (partition by key) high")
    return written(ends.where("low < high").drop("low", "high"), "live")


def across_size(live: DataFrame) -> tuple[int, int]:
    """Rows of the buckets, and pairs of their members that are of different components."""
    parts = live.groupBy("key", "root").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("own"))
    total = sizes.agg(F.sum("n").alias("n"), F.sum((F.col("n") * F.col("n") - F.col("own")) / 2).alias("pairs")).first()
    return total["n"] or 0, total["pairs"] or 0


def folded(sketches: np.ndarray, length: int) -> np.ndarray:
    """Sketches, one a row, folded to a shorter length."""
    while sketches.shape[1] > length:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def near_members(members: list[tuple], t: float):
    """(a, b), a > b, of the members (id, root, n, sketch, side) of one block that are of different
    components and that size and sketch let through; of two sides, one of each."""
    share = (1 - t) / (1 + t)
    ids, roots, sizes, sides = (np.array([m[i] for m in members], np.int64) for i in (0, 1, 2, 4))
    lengths = np.array([len(m[3]) for m in members])
    mixed_sides = len(np.unique(sides)) > 1
    by_length = {
        x: (np.flatnonzero(lengths == x), np.stack([np.frombuffer(m[3], np.uint8) for m in members if len(m[3]) == x]))
        for x in np.unique(lengths).tolist()
    }
    for i in range(len(members)):
        own = np.frombuffer(members[i][3], np.uint8)[None]
        for length, (places, sketches) in by_length.items():
            fits = (roots[places] != roots[i]) & (sizes[places] >= t * sizes[i] - 1e-9) & (t * sizes[places] - 1e-9 <= sizes[i])
            fits &= (sides[places] > sides[i]) if mixed_sides else (places > i)
            if fits.any():
                common = min(length, own.shape[1])
                far = np.bitwise_count(folded(sketches[fits], common) ^ folded(own, common)).sum(1)
                chosen = places[fits]
                for other in ids[chosen[far <= share * (sizes[chosen] + sizes[i]) + 1e-9]].tolist():
                    yield max(int(ids[i]), other), min(int(ids[i]), other)


def across_pairs(live: DataFrame, n_rows: int, nodes: DataFrame, t: float) -> DataFrame:
    """Distinct pairs (a, b) of members of one bucket and different components, all that may hold.
    ``live`` has ``n_rows`` rows."""
    sized = live.selectExpr("*", "count(*) over (partition by key) members")
    small = sized.where(F.col("members") <= SMALL)
    left = small.select("key", F.col("id").alias("a"), F.col("root").alias("ra"))
    right = small.select("key", F.col("id").alias("b"), F.col("root").alias("rb"))
    pairs = left.join(right, "key").where("ra > rb").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))

    # Members of a large bucket are dealt into blocks; two blocks meet at a time. Buckets are
    # compared one after the other in tasks of about TASK_ROWS rows: the same pairs meet in many
    # buckets, and a task writes a pair once.
    large = sized.where(F.col("members") > SMALL).join(nodes.select(F.col("doc_id").alias("id"), "n", "sketch"), "id")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    large = large.withColumn("blocks", blocks).withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    task = F.pmod(F.xxhash64("key"), F.lit(max(1, n_rows // TASK_ROWS)))
    met = met.select(
        task.alias("task"), "key", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"),
        "id", "root", "n", "sketch", "side",
    )
    dealt = met.repartition("task", "x", "y").sortWithinPartitions("key", "x", "y")

    def run(batches):
        held, last, out = [], None, set()

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

        for given in batches:
            for _, key, x, y, *member in zip(*(c.to_pylist() for c in given.columns)):
                if (key, x, y) != last:
                    out.update(near_members(held, t))
                    held, last = [], (key, x, y)
                    if len(out) > TASK_PAIRS:
                        yield batch()
                        out = set()
                held.append(tuple(member))
        out.update(near_members(held, t))
        if out:
            yield batch()

    return pairs.unionAll(dealt.mapInArrow(run, "a long, b long")).distinct()


def linked(docs: DataFrame, t: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prepared = written(docs.mapInArrow(_prepare, _PREP), "sets")
    rows = prepared.where("segment is null").select("doc_id", "n", "f1", "f2", "sketch")
    nodes = rows.where("n > 0 and doc_id is not null")
    owners = nodes.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    copies = nodes.join(owners, ["n", "f1", "f2"]).where("doc_id <> low").select(F.col("doc_id").alias("a"), F.col("low").alias("b"))

    groups = written(buckets(docs, order_tables(prepared), t), "buckets")
    stars = groups.where("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b"), "pieces")
    tried = written(most_shared(stars), "stars")
    links = verified(sifted(tried, nodes, t), docs, t)
    edges = written(links.unionAll(copies), "edges")
    found = written(components(edges), "components")

    # Buckets that still span several components: while the pairs across them are many, more
    # members are led, each bucket by another one; what is left is tried in all pairs.
    live, turn = spanning(groups, found), 1
    while True:
        n_rows, n_pairs = across_size(live)
        if n_pairs <= ACROSS * n_rows:
            break
        led = written(led_pairs(live, turn).join(tried, ["a", "b"], "left_anti"), "stars")
        more = verified(sifted(led, nodes, t), docs, t)
        tried = written(tried.unionAll(led), "stars")
        few = more.count() * 100 < led.count()
        edges = written(edges.unionAll(more), "edges")
        found = written(components(edges), "components")
        live, turn = spanning(live, found), turn + 1  # components only grow, so no other bucket can span several
        if few:
            break
    across = across_pairs(live, n_rows, nodes, t)
    across = across.join(tried, ["a", "b"], "left_anti")
    more = verified(sifted(across, nodes, t), docs, t)
    if not more.isEmpty():
        found = written(components(edges.unionAll(more)), "components")
    out = rows.join(found, rows["doc_id"] == found["node"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id"))


def one_per_group(docs: DataFrame, t: float = SIMILARITY) -> DataFrame:
    """``docs`` with the smallest doc_id of each component; rows without an id all stay."""
    gone = linked(docs, t).where("component_id <> doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["__gone"], "left_anti")
