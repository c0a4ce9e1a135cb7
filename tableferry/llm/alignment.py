"""Alignment of two tokenizers over the same texts: overlaps, groups, links and their counts.

Side A is a byte-level BPE file (tokenizers), side B a piece model (sentencepiece) that puts a blank
before a text; A is given the text with that blank. Every token has a range of bytes. Per batch,
``pandas.merge_asof`` keyed by document finds for each token's start the other side's token that
covers it, from A to B and from B to A. The union of both directions holds every overlapping pair.
Where both tokens of an overlap end alike, a group ends; all A and B tokens of a group are linked.

A text is cut into words before each blank or line break that stands alone between two visible
signs. Neither tokenizer's tokens span such a place, so the ids are those of the whole text, and it
is a common end of both sides. The different words of some megabytes of text are encoded once, in
one run of each tokenizer. Longer texts are worked on in slices between such places.

Corpus counts: per document, equal links are one pair with its number of links, written once. A
pair's count is the number of documents (rows) that hold it. The ``FREQUENT`` pairs of the largest
counts, a fixed number, are broadcast, and most links are looked up there; the other pairs, none
of which is in more documents than those, are joined.

Cases: a null or empty text, and one whose tokens' bytes are not the text's, has no tokens: zeros
and ''. Special tokens' strings are plain text. Repeated rows count as documents of their own; a
null doc_id stays null. A group of very many tokens is counted by its different ids, block by
block. Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tableferry.llm.bpe import byte_signs, coder
from tableferry.llm.slices import SLICE_BYTES, spread, text_slices
from tableferry.session import written

#: Pairs that every task gets, whatever the corpus.
FREQUENT = 1 << 16
#: Links expanded at a time.
BLOCK = 1 << 20
#: Pairs in a row, so that Arrow batches of rows stay small.
ROW_PAIRS = 1024
_BITS = 20  # a pair is A's id << _BITS | B's id
#: Bytes of text whose words are encoded together, words a tokenizer gets in one text, and bytes of
#: text that are aligned at a time.
WORDS_BYTES = 4 << 20
RUN_WORDS = 20_000
ALIGNED_BYTES = 1 << 19

_PLACE = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: Texts in which not every blank and line break is such a place, or that hold the sign of a cut.
_ODD = re.compile(r"\s\s|\s\Z|\0")
#: Words that keep their ids among others: no white space but the sign in front.
_WORD = re.compile(r"[ \n]\S+")


# -- the two tokenizers -----------------------------------------------------------------------


class Side:
    """One tokenizer: the ids of words, and the bytes of every id.

    ``together`` encodes a text that many words make up, ``alone`` each text of a list.
    """

    def __init__(self, pieces: list[bytes], together, alone):
        self.pieces, self.together, self.alone = pieces, together, alone
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        if len(pieces) > 1 << _BITS:
            raise ValueError(f"a vocabulary of more than {1 << _BITS} entries")

    def spells(self, ids: list[int], text: str) -> bool:
        return b"".join(map(self.pieces.__getitem__, ids)) == text.encode()

    def run(self, words: list[str]) -> list[bytes] | None:
        """The ids of words that stand one after the other; None if they do not spell them."""
        text = "".join(words)
        ids = self.together(text)
        if not self.spells(ids, text):
            return None
        ids = np.array(ids, np.int32)
        ends = np.cumsum(self.sizes[ids])
        stops = np.cumsum([len(w.encode()) for w in words])
        last = np.searchsorted(ends, stops)
        if (ends[last] != stops).any():
            return None
        data, cuts = ids.tobytes(), [0, *(4 * (last + 1)).tolist()]
        return [data[x:y] for x, y in zip(cuts, cuts[1:])]

    def encode(self, words: list[str]) -> tuple[list[bytes], np.ndarray]:
        """The ids of each word (32-bit numbers as bytes), and whether their bytes spell it."""
        made: list = [b""] * len(words)
        spelt = np.ones(len(words), bool)
        joined, rest = [], []
        for i, word in enumerate(words):
            if word:
                (joined if _WORD.fullmatch(word) else rest).append(i)
        for at in range(0, len(joined), RUN_WORDS):
            part = joined[at : at + RUN_WORDS]
            found = self.run([words[i] for i in part])
            if found is None:
                rest += part
            else:
                for i, ids in zip(part, found):
                    made[i] = ids
        for i, ids in zip(rest, self.alone([words[i] for i in rest])):
            made[i], spelt[i] = np.array(ids, np.int32).tobytes(), self.spells(ids, words[i])
        return made, spelt


@lru_cache(maxsize=1)
def byte_side(path: str) -> Side:
    """Byte-level BPE; an entry's signs stand for bytes."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True
    signs = byte_signs()
    names = [tokenizer.id_to_token(i) or "" for i in range(max(tokenizer.get_vocab().values()) + 1)]
    pieces = [bytes(signs[c] for c in name) if all(c in signs for c in name) else name.encode() for name in names]

    def alone(texts: list[str]) -> list[list[int]]:
        return [one.ids for one in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    # The same merges in tiktoken, which takes special tokens' strings for plain text here.
    return Side(pieces, coder(path).core.encode_ordinary, alone)


@lru_cache(maxsize=1)
def piece_side(path: str) -> Side:
    """Piece model with byte fallback; it puts a blank before each text, written as U+2581.

    A text that begins with its blank is encoded without it. One that begins with a line break has
    the model's own blank as a token of its own in front, which goes.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.vocab_size())]
    blank = "▁"
    if any(blank in name.lstrip(blank) or "\n" in name for name in names) or model.encode(" a\n") != [
        model.piece_to_id(blank), *model.encode("a\n")
    ]:
        raise ValueError(f"{path}: tokens may span the places where texts are cut")
    own = model.piece_to_id(blank)
    pieces = [
        bytes([int(name[1:-1], 16)]) if model.is_byte(i) else name.replace(blank, " ").encode()
        for i, name in enumerate(names)
    ]

    def alone(texts: list[str]) -> list[list[int]]:
        made = model.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        return [ids if text[0] == " " else ids[1:] if ids[:1] == [own] else [] for text, ids in zip(texts, made)]

    return Side(pieces, lambda text: alone([text])[0], alone)


# -- one batch --------------------------------------------------------------------------------


def parts(text: str, most: int = SLICE_BYTES):
    """The text with a blank in front, in slices that begin at a place no token spans."""
    whole, at = " " + text, 0
    while len(whole) - at > most:
        cut = _PLACE.search(whole, at + most)
        if cut is None:
            break
        yield whole[at : cut.start()]
        at = cut.start()
    yield whole[at:]


def cut_words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(different words, number of each word of the texts in order, words of each text)."""
    plain = [not _ODD.search(text) for text in texts]
    marked = [t.replace(" ", "\0 ").replace("\n", "\0\n") for t, fits in zip(texts, plain) if fits]
    split = pc.split_pattern(pa.array(marked, pa.string()), "\0")
    others = [_PLACE.split(text) for text, fits in zip(texts, plain) if not fits]
    words = pa.chunked_array([split.flatten(), pa.array([w for ws in others for w in ws], pa.string())])
    coded = words.combine_chunks().dictionary_encode()
    # In the order of the texts, those of either kind come one after the other.
    counts = np.zeros(len(texts), np.int64)
    kind = np.array(plain, bool)
    counts[kind] = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    counts[~kind] = [len(ws) for ws in others]
    starts = np.zeros(len(texts), np.int64)
    order = np.concatenate([np.flatnonzero(kind), np.flatnonzero(~kind)])
    starts[order] = np.cumsum(counts[order]) - counts[order]
    index = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)[index], counts


def encoded(sides: tuple[Side, Side], texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, bool]]:
    """For each text its ids on both sides, and whether the bytes of both spell it."""
    different, word, counts = cut_words(texts)
    ids, good = [], np.ones(len(texts), bool)
    for side in sides:
        made, spelt = side.encode(different)
        ids.append(spread(word, counts, made, "<i4"))
        ends = np.cumsum(counts)
        wrong = np.append(0, np.cumsum(~spelt[word]))
        good &= wrong[ends] == wrong[ends - counts]
    return list(zip(*ids, good.tolist()))


def frame(side: Side, made: list[np.ndarray], starts: np.ndarray) -> pd.DataFrame:
    """(doc, start, end, id) of the tokens of texts, in order; positions run on over the texts, so
    that they are sorted. ``starts``: where each text begins, whether or not it has tokens."""
    doc = np.repeat(np.arange(len(made)), [len(ids) for ids in made])
    ids = np.concatenate(made)
    sizes = side.sizes[ids]
    ends = np.cumsum(sizes)
    before = np.concatenate([[0], np.cumsum(np.bincount(doc, sizes, len(made)))[:-1]]).astype(np.int64)
    ends = ends + (starts - before)[doc]
    return pd.DataFrame({"doc": doc.astype(np.int64), "start": ends - sizes, "end": ends, "id": ids.astype(np.int64)})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (of ``a``, of ``b``) of all pairs whose byte ranges overlap, in order.

    Each token start finds the covering token of the other side; a pair overlaps exactly where
    one of the two starts within the other.
    """

    def covering(left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
        other = pd.DataFrame({"doc": right["doc"], "start": right["start"], "row": np.arange(len(right))})
        return pd.merge_asof(left[["doc", "start"]], other, on="start", by="doc")["row"].to_numpy(np.int64)

    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    in_b, in_a = covering(a, b), covering(b, a)
    # Pairs that start together are found from both sides and taken once.
    inner = np.flatnonzero(a["start"].to_numpy()[in_a] != b["start"].to_numpy())
    keys = np.concatenate([np.arange(len(a)) << 32 | in_b, in_a[inner] << 32 | inner])
    keys.sort(kind="stable")  # two sorted runs
    return keys >> 32, keys & 0xFFFFFFFF


@dataclass
class Aligned:
    """Tokens of a batch of texts: ids, text number and group of each; groups run on over texts."""

    a: pd.DataFrame
    b: pd.DataFrame
    pairs: tuple[np.ndarray, np.ndarray]
    group_a: np.ndarray
    group_b: np.ndarray
    n_groups: int


def aligned(sides: tuple[Side, Side], texts: list[tuple[int, np.ndarray, np.ndarray]]) -> Aligned:
    """The alignment of texts given by their number of bytes and their ids on both sides."""
    starts = np.cumsum([0] + [size for size, _, _ in texts])[:-1]
    a, b = (frame(side, [t[i] for t in texts], starts) for i, side in enumerate(sides, 1))
    row_a, row_b = overlaps(a, b)
    end_a, end_b = a["end"].to_numpy(), b["end"].to_numpy()
    ends = end_a[row_a][end_a[row_a] == end_b[row_b]]  # once each, rising
    group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
    return Aligned(a, b, (row_a, row_b), group_a, group_b, len(ends))


def linked_pairs(found: Aligned):
    """(doc, pair, links) in parts: every pair of ids linked in a text, with the number of links of
    that part. A part expands about ``BLOCK`` links."""
    id_a, id_b = found.a["id"].to_numpy(), found.b["id"].to_numpy()
    doc = found.a["doc"].to_numpy()
    size_b = np.bincount(found.group_b, minlength=found.n_groups)
    size_a = np.bincount(found.group_a, minlength=found.n_groups)
    first_b = np.cumsum(size_b) - size_b
    first_a = np.cumsum(size_a) - size_a
    large = size_a * size_b > BLOCK
    for group in np.flatnonzero(large).tolist():
        ids_a, n_a = np.unique(id_a[first_a[group] : first_a[group] + size_a[group]], return_counts=True)
        ids_b, n_b = np.unique(id_b[first_b[group] : first_b[group] + size_b[group]], return_counts=True)
        step = max(1, BLOCK // len(ids_b))
        for at in range(0, len(ids_a), step):
            pair = (ids_a[at : at + step, None] << _BITS | ids_b[None, :]).ravel()
            yield np.full(len(pair), doc[first_a[group]]), pair, (n_a[at : at + step, None] * n_b[None, :]).ravel()
    rows = np.flatnonzero(~large[found.group_a])
    width = size_b[found.group_a[rows]]
    ends = np.cumsum(width)
    at = 0
    while at < len(rows):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + BLOCK, "right")))
        some, w = rows[at:stop], width[at:stop]
        inner = np.arange(int(w.sum())) - np.repeat(np.cumsum(w) - w, w)
        other = id_b[np.repeat(first_b[found.group_a[some]], w) + inner]
        yield np.repeat(doc[some], w), np.repeat(id_a[some], w) << _BITS | other, np.ones(len(other), np.int64)
        at = stop


def summed(docs: np.ndarray, pairs: np.ndarray, links: np.ndarray):
    """Equal (doc, pair) once, in order, with their links added."""
    order = np.lexsort((pairs, docs))
    docs, pairs, links = docs[order], pairs[order], links[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (pairs[1:] != pairs[:-1])
    at = np.flatnonzero(new)
    return docs[at], pairs[at], np.add.reduceat(links, at) if len(at) else links


class Spelling:
    """The text form of groups: decimal ids, ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, n_a: int, n_b: int):
        a, b = [str(i) for i in range(n_a)], [str(i) for i in range(n_b)]
        self.forms = np.array([*(x + "," for x in a), *(x + "|" for x in a), *(x + "," for x in b), *(x + ";" for x in b)], object)
        self.n_a, self.n_b = n_a, n_b

    def texts(self, found: Aligned, n_texts: int) -> list[str]:
        """For each text its groups, each ended by ``;``."""

        def form(frame: pd.DataFrame, group: np.ndarray, first: int, size: int) -> np.ndarray:
            last = np.append(group[1:] != group[:-1], True)[: len(group)]
            return first + frame["id"].to_numpy() + size * last

        codes = np.concatenate(
            [form(found.a, found.group_a, 0, self.n_a), form(found.b, found.group_b, 2 * self.n_a, self.n_b)]
        )
        group = np.concatenate([2 * found.group_a, 2 * found.group_b + 1])
        order = np.argsort(group, kind="stable")
        shown = self.forms[codes[order]].tolist()
        doc = np.concatenate([found.a["doc"].to_numpy(), found.b["doc"].to_numpy()])[order]
        ends = np.searchsorted(doc, np.arange(n_texts + 1))
        return ["".join(shown[x:y]) for x, y in zip(ends[:-1], ends[1:])]


# -- documents --------------------------------------------------------------------------------


@dataclass
class Document:
    """What the slices of one document add up to."""

    doc_id: int | None
    good: bool = True
    n: np.ndarray = field(default_factory=lambda: np.zeros(3, np.int64))  # A tokens, B tokens, groups
    pairs: list = field(default_factory=list)
    sha: object = field(default_factory=hashlib.sha256)

    def add(self, n: np.ndarray, shown: str, pairs: np.ndarray, links: np.ndarray) -> None:
        self.sha.update((";" if self.n[2] else "").encode() + shown[:-1].encode())
        self.n = self.n + n
        self.pairs.append((pairs, links))
        if len(self.pairs) > 8:
            self.pairs = [self.total()]

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(self.pairs) == 1:
            return self.pairs[0]
        pairs, links = (np.concatenate(x) for x in zip(*self.pairs))
        return summed(np.zeros(len(pairs), np.int64), pairs, links)[1:]


_NONE = np.zeros(0, np.int32)


def _finished(waiting: list[tuple[Document, str, bool]], sides: tuple[Side, Side], shown: Spelling):
    """The documents that end among the slices ``waiting`` (document, slice, whether its last)."""
    made = encoded(sides, [text for _, text, _ in waiting])
    at = 0
    while at < len(waiting):
        # Some slices at a time are aligned; their words were encoded together.
        stop, held = at, 0
        while stop < len(waiting) and (stop == at or held < ALIGNED_BYTES):
            held += len(waiting[stop][1])
            stop += 1
        part = waiting[at:stop]
        texts = [
            (len(text.encode()), ids_a, ids_b) if good else (0, _NONE, _NONE)
            for (_, text, _), (ids_a, ids_b, good) in zip(part, made[at:stop])
        ]
        found, n_texts = aligned(sides, texts), len(part)
        first = np.append(found.group_a[1:] != found.group_a[:-1], True)[: len(found.a)]
        owners = found.a["doc"].to_numpy(), found.b["doc"].to_numpy(), found.a["doc"].to_numpy()[first]
        counts = np.stack([np.bincount(owner, minlength=n_texts) for owner in owners], axis=1)
        sums = [summed(*links) for links in linked_pairs(found)]
        docs, pairs, links = summed(*(np.concatenate(x) for x in zip(*sums))) if sums else (np.zeros(0, np.int64),) * 3
        ends = np.searchsorted(docs, np.arange(n_texts + 1))
        groups = shown.texts(found, n_texts)
        for i, (document, _, last) in enumerate(part):
            document.good &= made[at + i][2]
            if document.good:
                document.add(counts[i], groups[i], pairs[ends[i] : ends[i + 1]], links[ends[i] : ends[i + 1]])
            if last:
                yield document
        at = stop


def _documents(rows, sides: tuple[Side, Side], shown: Spelling):
    """A finished Document for each (doc_id, text), in order."""
    waiting: list[tuple[Document, str, bool]] = []
    held = 0
    for doc_id, text in rows:
        document = Document(doc_id, bool(text))
        slices = parts(text) if text else iter([""])
        part = next(slices)
        while part is not None:
            after = next(slices, None)
            waiting.append((document, part, after is None))
            held += len(part)
            part = after
            if held > WORDS_BYTES:
                yield from _finished(waiting, sides, shown)
                waiting, held = [], 0
    if waiting:
        yield from _finished(waiting, sides, shown)


_DOCS = pa.schema(
    [
        ("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
        ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("links", pa.list_(pa.int64())),
    ]
)
_DOCS_SQL = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, links array<long>"
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _DOCS)], schema=_DOCS)


def documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document its numbers of tokens, groups and links, the digest of its groups, and its
    linked pairs with their numbers of links. ``row`` tells equal documents apart once written; one
    with more than ``ROW_PAIRS`` pairs has further rows with nothing else in them."""

    def run(batches):
        sides = byte_side(path_a), piece_side(path_b)
        shown = Spelling(len(sides[0].pieces), len(sides[1].pieces))
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in text_slices(batch, 1, WORDS_BYTES):
                out = []
                for document in _documents(zip(part.column(0).to_pylist(), part.column(1).to_pylist()), sides, shown):
                    good = document.good
                    pairs, links = document.total() if good else (np.zeros(0, np.int64),) * 2
                    n = document.n.tolist() if good else [0, 0, 0]
                    sha = document.sha.hexdigest() if good else ""
                    out.append((row, document.doc_id, *n, int(links.sum()), sha, pairs[:ROW_PAIRS], links[:ROW_PAIRS]))
                    for at in range(ROW_PAIRS, len(pairs), ROW_PAIRS):
                        out.append((row, *[None] * 6, pairs[at : at + ROW_PAIRS], links[at : at + ROW_PAIRS]))
                    row += 1
                    if len(out) >= 500:
                        yield _batch(out)
                        out = []
                if out:
                    yield _batch(out)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _DOCS_SQL)


def token_overlaps(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, a_id, a_start, a_end, b_id, b_start, b_end, group_no of every overlapping pair of
    tokens; bytes and groups are counted within the text that has the blank in front."""

    names = ["doc_id", "a_id", "a_start", "a_end", "b_id", "b_start", "b_end", "group_no"]

    def run(batches):
        sides = byte_side(path_a), piece_side(path_b)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text or not all(good for part in parts(text) for _, _, good in encoded(sides, [part])):
                    continue
                at = groups = 0
                for part in parts(text):
                    found = aligned(sides, [(len(part.encode()), *encoded(sides, [part])[0][:2])])
                    a, b = found.a.iloc[found.pairs[0]], found.b.iloc[found.pairs[1]]
                    columns = [a["id"], a["start"] + at, a["end"] + at, b["id"], b["start"] + at, b["end"] + at, found.group_a[found.pairs[0]] + groups]
                    owner = pa.array([doc_id] * len(a), pa.int64())
                    yield pa.RecordBatch.from_arrays([owner, *(pa.array(np.asarray(c, np.int64)) for c in columns)], names)
                    at, groups = at + len(part.encode()), groups + found.n_groups

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, ", ".join(f"{name} long" for name in names))


def pair_counts(made: DataFrame) -> DataFrame:
    """pair, n (documents that hold it linked), best (whether n is the most of its A id)."""
    counts = made.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = written(counts.withColumn("a", F.shiftright("pair", _BITS)), "pair-counts")
    # One row per entry of A's vocabulary.
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def linked(docs: DataFrame, path_a: str, path_b: str, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    made = written(documents(docs, path_a, path_b), "aligned")
    counts = written(pair_counts(made), "pair-facts")
    top = counts.orderBy(F.desc("n"), "pair").limit(frequent).collect()
    top.sort(key=lambda r: r["pair"])
    known = tuple(np.array([r[c] for r in top], t) for c, t in (("pair", np.int64), ("n", np.int64), ("best", np.int64)))
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def look_up(batches):
        pairs_known, n_known, best_known = shared.value
        for batch in (whole.slice(at, 1_000) for whole in batches for at in range(0, whole.num_rows, 1_000)):
            offsets = batch.column(1).offsets.to_numpy()
            pairs = batch.column(1).flatten().to_numpy()
            links = batch.column(2).flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            at = np.minimum(np.searchsorted(pairs_known, pairs), max(0, len(pairs_known) - 1))
            hit = pairs_known[at] == pairs if len(pairs_known) else np.zeros(len(pairs), bool)
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            for total, facts in zip(sums, (best_known, n_known)):
                np.add.at(total, row[hit], links[hit] * facts[at[hit]])
            rest = np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=batch.num_rows))]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(rest), pa.array(x[~hit])) for x in (pairs, links)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, sums), *lists], ["row", "n_best", "count_sum", "pairs", "links"])

    looked = written(
        made.select("row", "pairs", "links").mapInArrow(
            look_up, "row long, n_best long, count_sum long, pairs array<long>, links array<long>"
        ),
        "looked-up",
    )
    rest = looked.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("p")).select("row", "p.pairs", "p.links")
    rest = rest.join(counts, rest["pairs"] == counts["pair"]).select(
        "row",
        F.when(F.col("best"), F.col("links")).otherwise(0).alias("n_best"),
        (F.col("links") * F.col("n")).alias("count_sum"),
    )
    sums = (
        looked.select("row", "n_best", "count_sum")
        .unionAll(rest)
        .groupBy("row")
        .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )
    own = made.where("n_a IS NOT NULL").select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return own.join(sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
