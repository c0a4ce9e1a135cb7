"""Spelling variants: near words by search in a trie of letter-group counts.

Letters fall into ``GROUPS`` groups. A word's vector holds how many of its letters each group has,
and a trie arranges the words by these counts, one group per level. Words one edit apart differ by
at most one surplus and one deficit: a deleted letter takes one from one count, a replaced one
moves one from a group to another (or within it). The depth-first search for a word goes down
with its own counts and may spend, in this order, one surplus (a count less by one) and then one
deficit (a count more by one). So it finds words that are shorter by one letter, words of equal
length whose counts are smaller at the first difference, and words with equal counts; of the last,
only smaller words are taken. That finds each pair from exactly one side. The words of a leaf
have one length; they are looked up by their first and their second half, one of which an edit
leaves as it is, and each hit is verified letter by letter.

Scale: the trie is cut into shards, the subtrees of at most ``SHARD_WORDS`` words (more only where
the vocabulary exceeds ``INNER_NODES`` times that, so that at most ``INNER_NODES`` nodes a level lie
above the shards). These upper nodes are all the driver and the tasks get. A leaf with more words
than a shard is cut into blocks by hash, and every search that reaches it visits all of them. Each
word goes to its own shard and to the shards its search reaches; a task builds one shard's trie at
a time and streams the searches through it. Pairs are written from one side, then counted from
both; a word has at most some hundred near words, whatever the table.

Cases: null and empty texts have no words. A null doc_id is an empty text in the crc32 key. Rows
that repeat a document count again. Ties are settled by code-point order. Whole texts are read,
however long. Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import lower_ascii
from tableferry.session import discard, written, written_at

#: Runs of letters (A-Z is lower-cased before).
RUNS = "[a-zÀ-ÿ]+"
GROUPS = 10
SHARD_WORDS = 5_000
INNER_NODES = 20_000


def words(docs: DataFrame, least_length: int = 5, least_count: int = 3, every: int | None = 97) -> DataFrame:
    """word, n: the words of all texts with their number of occurrences.

    Of each ``every``-th (document, word) pair, by crc32, one letter is deleted: h % length says
    which. None deletes nothing.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(RUNS), F.lit(0))).alias("run"),
    )
    word = F.col("run")
    if every is not None:
        hashed = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        runs = runs.select("run", hashed.alias("h"))
        at = (F.col("h") % F.char_length("run")).cast("int")
        cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
        word = F.when(F.col("h") % every == 0, cut).otherwise(F.col("run"))
    found = runs.select(word.alias("word")).where(F.char_length("word") >= least_length)
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def vector(word: str) -> tuple[int, ...]:
    """Number of letters of each group; a letter's group is its code point modulo ``GROUPS``."""
    counts = [0] * GROUPS
    for letter in word:
        counts[ord(letter) % GROUPS] += 1
    return tuple(counts)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced letter makes ``a`` of ``b``."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[at + 1 :] == (b[at + 1 :] if len(a) == len(b) else b[at:])


class Leaf:
    """Words with equal counts, found by either half."""

    __slots__ = ("heads", "tails", "cut")

    def __init__(self, length: int):
        self.cut = length // 2
        self.heads: dict[str, list] = {}
        self.tails: dict[str, list] = {}

    def insert(self, word: str, n: int) -> None:
        self.heads.setdefault(word[: self.cut], []).append((word, n))
        self.tails.setdefault(word[self.cut :], []).append((word, n))

    def near(self, word: str, state: int):
        """Words of the leaf one edit from ``word``, each once."""
        cut, shorter = self.cut, state == 1
        tail = word[cut + 1 :] if shorter else word[cut:]
        for other, n in self.heads.get(word[:cut], ()):
            if (state or other < word) and one_edit(word, other):
                yield other, n
        for other, n in self.tails.get(tail, ()):
            if other[:cut] != word[:cut] and (state or other < word) and one_edit(word, other):
                yield other, n


class Trie:
    """Words by their letter-group counts, one group per level."""

    def __init__(self):
        self.root: dict = {}

    def insert(self, word: str, n: int) -> None:
        counts = vector(word)
        node = self.root
        for count in counts[:-1]:
            node = node.setdefault(count, {})
        leaf = node.get(counts[-1])
        if leaf is None:
            leaf = node[counts[-1]] = Leaf(len(word))
        leaf.insert(word, n)

    def near(self, word: str):
        """(word, n) of the near words that a search from ``word`` has to find.

        State 0 has spent nothing, 1 the surplus, 2 the surplus and the deficit.
        """
        counts = vector(word)
        stack = [(self.root, 0, 0)]
        while stack:
            node, depth, state = stack.pop()
            if depth == GROUPS:
                yield from node.near(word, state)
                continue
            count = counts[depth]
            depth += 1
            child = node.get(count)
            if child is not None:
                stack.append((child, depth, state))
            if state == 0:
                child = node.get(count - 1)
                if child is not None:
                    stack.append((child, depth, 1))
            elif state == 1:
                child = node.get(count + 1)
                if child is not None:
                    stack.append((child, depth, 2))


class AnyCount(dict):
    """Below the upper nodes every count may have words."""

    def get(self, count, default=None):
        return super().get(count, "")


def upper_trie(inner: set[tuple[int, ...]]) -> AnyCount:
    """The nodes above the shards as nested dictionaries; "" stands for a shard. The root is one
    of them, as ``inner`` holds the empty prefix."""
    root = AnyCount()
    for prefix in sorted(inner, key=len):
        node = root
        for count in prefix:
            below = node.get(count)
            if below == "":
                below = AnyCount()
                node[count] = below
            node = below
    return root


def shards_of(counts: tuple[int, ...], upper, everything: bool):
    """Prefixes of the shards a word's search reaches, or (not ``everything``) of its own."""
    stack = [(upper, (), 0)]
    while stack:
        node, prefix, state = stack.pop()
        if node == "" or len(prefix) == GROUPS:
            yield prefix
            continue
        count = counts[len(prefix)]
        tried = [(count, state)]
        if everything and state == 0 and count:
            tried.append((count - 1, 1))
        elif everything and state == 1:
            tried.append((count + 1, 2))
        for c, after in tried:
            stack.append((node.get(c), (*prefix, c), after))


def _key(prefix: tuple[int, ...], block: int = 0) -> str:
    return ",".join(map(str, prefix)) + (f"/{block}" if block else "")


def upper_nodes(vocabulary: DataFrame, shard_words: int) -> tuple[set, dict]:
    """(nodes with more than a shard's words, blocks that each such leaf needs).

    At most ``INNER_NODES`` nodes of a level hold more than 1/INNER_NODES of all words, so what
    reaches the driver is bounded whatever the vocabulary.
    """

    def counted(batches):
        prefixes: Counter = Counter()

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(prefixes), pa.string()), pa.array(list(prefixes.values()), pa.int64())], ["prefix", "n"]
            )

        for given in batches:
            for word in given.column(0).to_pylist():
                counts = vector(word)
                prefixes.update(_key(counts[:depth]) for depth in range(1, GROUPS + 1))
                if len(prefixes) > 200_000:
                    yield batch()
                    prefixes.clear()
        yield batch()

    total = vocabulary.count()
    most = max(shard_words, -(-total // INNER_NODES))
    parts = vocabulary.select("word").mapInArrow(counted, "prefix string, n long")
    rows = parts.groupBy("prefix").agg(F.sum("n").alias("n")).where(F.col("n") > most).collect()
    inner = {(): total} | {tuple(map(int, r["prefix"].split(","))): r["n"] for r in rows}
    blocks = {p: -(-n // most) for p, n in inner.items() if len(p) == GROUPS}
    return set(inner), blocks


def near_pairs(vocabulary: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(a, n_a, b, n_b): every pair of near words once."""
    inner, blocks = upper_nodes(vocabulary, shard_words)
    upper = upper_trie({p for p in inner if len(p) < GROUPS})

    def dealt(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                shards, homes, names, numbers = [], [], [], []

                def add(shard, home, word, n):
                    shards.append(shard)
                    homes.append(home)
                    names.append(word)
                    numbers.append(n)

                for word, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    counts = vector(word)
                    (own,) = shards_of(counts, upper, False)
                    add(_key(own, xxhash.xxh3_64_intdigest(word) % blocks.get(own, 1)), True, word, n)
                    for prefix in shards_of(counts, upper, True):
                        for block in range(blocks.get(prefix, 1)):
                            add(_key(prefix, block), False, word, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards, pa.string()), pa.array(homes, pa.bool_()), pa.array(names, pa.string()), pa.array(numbers, pa.int64())],
                    ["shard", "home", "word", "n"],
                )

    def searched(batches):
        shard, trie = None, Trie()
        for batch in batches:
            found: list[tuple] = []
            for name, home, word, n in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if name != shard:
                    shard, trie = name, Trie()
                if home:
                    trie.insert(word, n)
                else:
                    found += [(word, n, other, m) for other, m in trie.near(word)]
                if len(found) > 50_000:
                    yield _pairs(found)
                    found = []
            yield _pairs(found)

    rows = vocabulary.select("word", "n").mapInArrow(dealt, "shard string, home boolean, word string, n long")
    rows = rows.repartition("shard").sortWithinPartitions("shard", F.desc("home"))
    return rows.mapInArrow(searched, "a string, n_a long, b string, n_b long")


def _pairs(found: list[tuple]) -> pa.RecordBatch:
    columns = zip(*found) if found else ([], [], [], [])
    types = [pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["a", "n_a", "b", "n_b"])


def forms(vocabulary: DataFrame, shard_words: int = SHARD_WORDS, ratio: int = 2) -> DataFrame:
    """word, n, n_near, form, form_n of every word that has a near word.

    The form is the most frequent near word (of several the smallest) if it is ``ratio`` times as
    frequent as the word; else null.
    """
    pairs = near_pairs(vocabulary, shard_words)
    sides = F.explode(
        F.array(
            F.struct(F.col("a").alias("word"), F.col("n_a").alias("n"), F.struct((-F.col("n_b")).alias("m"), F.col("b").alias("w")).alias("other")),
            F.struct(F.col("b").alias("word"), F.col("n_b").alias("n"), F.struct((-F.col("n_a")).alias("m"), F.col("a").alias("w")).alias("other")),
        )
    )
    near = pairs.select(sides.alias("s")).select("s.*").groupBy("word").agg(
        F.first("n").alias("n"), F.count("*").alias("n_near"), F.min("other").alias("best")
    )
    enough = -F.col("best.m") >= ratio * F.col("n")
    return near.select(
        "word", "n", "n_near", F.when(enough, F.col("best.w")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n")
    )


def roots(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): root is where the chain of forms ends.

    Every round doubles the way a word has gone. Forms are at least twice as frequent as their
    words, so a chain has at most 62 links and six rounds do.
    """
    spark = links.sparkSession
    current, folder = written_at(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after, place = written_at(
            current.join(ahead, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "roots",
        )
        discard(spark, folder)
        current, folder = after.drop("moved"), place
        if after.where("moved").isEmpty():
            return current


def variants(docs: DataFrame, least_length: int = 5, least_count: int = 3, every: int | None = 97, shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs``."""
    vocabulary = written(words(docs, least_length, least_count, every), "vocabulary")
    near = written(forms(vocabulary, shard_words).drop("n"), "forms")
    ends = roots(near.where("form IS NOT NULL"))
    return (
        vocabulary.join(near, "word", "left")
        .join(ends, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )
