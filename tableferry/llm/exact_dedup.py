"""Exact deduplication: owners of equal texts, found in compressed radix (Patricia) tries.

Every task first puts its own texts into tries, so that a group of copies, however large,
leaves one row per task. Those rows are dealt by length and content hash and sorted by them;
each partition inserts the full byte strings into tries. A terminal node holds the smallest
identifier (or the largest, as asked) and the number of rows.

Memory: rows come sorted by (length, hash), by Spark's sort, which spills by itself. A trie
holds texts of one length only. Once it holds ``max_bytes`` of text, its terminals are emitted
at the next change of hash and the subtree is dropped: no later row can be equal to any of it.

Cases: a null text counts as empty, and all empty texts are one group. Rows that repeat a
doc_id count as rows of their group; all of them carry the same owner. A null doc_id owns a
group only if every row of the group has none. Other columns of the input are not looked at.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import lower_ascii

_HELD = "text binary, size int, hash long, sha string, owner long, n long"


class Trie:
    """Compressed radix trie over byte strings; terminals hold (owner, count, tag)."""

    __slots__ = ("root", "held", "pick")

    def __init__(self, pick):
        self.root: list = [b"", {}, None]  # edge label, children by first byte, terminal
        self.held = 0
        self.pick = pick

    def insert(self, text: bytes, owner: int | None, n: int, tag) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                node[1][text[at]] = [text[at:], {}, [owner, n, tag]]
                self.held += len(text) - at
                return
            label = child[0]
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            cut = common_length(label, text[at : at + len(label)])
            node[1][text[at]] = upper = [label[:cut], {label[cut]: child}, None]
            child[0] = label[cut:]
            node, at = upper, at + cut
        if node[2] is None:
            node[2] = [owner, n, tag]
        else:
            last = node[2]
            last[0] = owner if last[0] is None else last[0] if owner is None else self.pick(last[0], owner)
            last[1] += n

    def terminals(self):
        """(text, owner, count, tag) of every text in the trie."""
        stack = [(b"", self.root)]
        while stack:
            before, (label, children, last) = stack.pop()
            text = before + label
            if last is not None:
                yield text, *last
            stack += [(text, child) for child in children.values()]


def common_length(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _tries(keep: str, max_bytes: int, ordered: bool):
    """A function of Arrow batches that emits one row per distinct text a trie has held.

    ``ordered`` input comes by (size, hash): a full trie is let go only where the hash changes.
    Without an order a full trie is let go at once and its texts may be emitted again later.
    """
    pick = min if keep == "smallest" else max
    names = ["text", "size", "hash", "sha", "owner", "n"]
    types = [pa.binary(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def emitted(tries: dict[int, Trie]):
        rows: list = []
        held = 0
        for size, trie in tries.items():
            for text, owner, n, (hashed, sha) in trie.terminals():
                rows.append((text, size, hashed, sha, owner, n))
                held += size
                if held > 8 << 20:
                    yield rows
                    rows, held = [], 0
        if rows:
            yield rows

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    def run(batches):
        tries: dict[int, Trie] = {}
        held, last = 0, None
        for given in batches:
            for text, size, hashed, sha, owner, n in zip(*(given.column(x).to_pylist() for x in names)):
                if held > max_bytes and (size, hashed) != last:
                    for rows in emitted(tries):
                        yield batch(rows)
                    tries, held = {}, 0
                elif ordered and last is not None and size != last[0] and held > max_bytes // 8:
                    for rows in emitted(tries):  # a length that is over
                        yield batch(rows)
                    tries, held = {}, 0
                last = (size, hashed)
                trie = tries.get(size)
                if trie is None:
                    trie = tries[size] = Trie(pick)
                before = trie.held
                trie.insert(text, owner, n, (hashed, sha))
                held += trie.held - before
        for rows in emitted(tries):
            yield batch(rows)

    return run


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id and the normalised text of every row, with its length in bytes and its hashes."""
    text = lower_ascii(F.coalesce(F.col("text"), F.lit(""))).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id",
        "text",
        F.length("text").alias("size"),
        F.xxhash64("text").alias("hash"),
        F.sha2("text", 256).alias("sha"),
    )


def owners(docs: DataFrame, keep: str = "smallest", max_bytes: int = 64 << 20) -> DataFrame:
    """One row per distinct normalised text: sha, size, owner (doc_id), n (rows that have it)."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    rows = keyed(docs).select("text", "size", "hash", "sha", F.col("doc_id").alias("owner"), F.lit(1).cast("long").alias("n"))
    local = rows.mapInArrow(_tries(keep, max_bytes, False), _HELD)
    dealt = local.repartition("size", "hash").sortWithinPartitions("size", "hash")
    return dealt.mapInArrow(_tries(keep, max_bytes, True), _HELD).select("sha", "size", "owner", "n")


def assign(docs: DataFrame, keep: str = "smallest", max_bytes: int = 64 << 20) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Rows find their owner by the text's SHA-256; the join splits a hot text's rows at run time.
    """
    rows = keyed(docs).select("doc_id", "sha")
    found = owners(docs, keep, max_bytes)
    return rows.join(found, "sha", "left").select(
        "doc_id",
        F.col("owner").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("owner")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, keep: str = "largest", max_bytes: int = 64 << 20) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they are.

    Of rows that repeat the owner's doc_id with an equal text, one stays.
    """
    marked = docs.withColumn("__sha", keyed_sha(F.col("text"))).withColumn("__id", F.col("doc_id").cast("long"))
    found = owners(docs, keep, max_bytes).select(F.col("sha").alias("__sha"), F.col("owner").alias("__id"))
    kept = marked.join(
        found,
        (marked["__sha"] == found["__sha"]) & marked["__id"].eqNullSafe(found["__id"]),
        "left_semi",
    )
    return kept.dropDuplicates(["__sha"]).drop("__sha", "__id")


def keyed_sha(text):
    """SHA-256, lower-case hex, of the normalised text."""
    return F.sha2(lower_ascii(F.coalesce(text, F.lit(""))).cast("binary"), 256)
