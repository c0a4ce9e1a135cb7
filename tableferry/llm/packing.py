"""Best-fit packing of token sequences by a configuration linear program.

Texts are tokenised, an end id is added, and only documents longer than a sequence are cut. What
is packed are the pieces' lengths, at most ``capacity`` different ones, so the histogram that the
driver gets has at most that many rows, and all that is planned there has a size of its own,
whatever the corpus.

The plan: a configuration says how often each length stands in one sequence. The linear program
minimises the number of sequences so that every length is covered as often as it occurs. It is
solved by multiplicative weights: every length has a price, at first its share of a sequence. In
each round an unbounded knapsack by dynamic programming finds the configurations worth most at
these prices, for each length the best that holds it. Prices of lengths that these cover too often
fall by a factor, so the next round takes others; the average of the rounds is the solution. Any
prices give a lower bound on the number of sequences, which stands in the plan.

Rounding: each configuration is taken its rounded number of times, as far as its pieces are there.
The pieces left are packed best fit, longest first.

Placing: the pieces of one length are numbered without a sort, by task and place in the task, so a
length that a third of all pieces have is no single task's work. A number tells the configuration,
the sequence and the place in it, by search in a table whose size the plan bounds.

Cases: a null or empty text is the end id alone, one piece. Repeated rows are packed each. A null
doc_id stays null. Texts of any length are read in slices, cut at white space, which no token
spans. Strings of special tokens become their ids, as the tokenizers library does it. Other
columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import itertools
import json
import re
import unicodedata
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tableferry.llm.bpe import byte_signs
from tableferry.llm.slices import spread, text_slices
from tableferry.session import written

CAPACITY = 2048
END_ID = 0
ROUNDS = 30
RATE = 0.2  # how far prices fall in the first round
#: Configurations of the linear program that are rounded; pieces of others are left to best fit.
MOST_CONFIGURATIONS = 8_192

#: Bytes of text whose words are looked at together: the more, the fewer words are encoded again.
WORDS_BYTES = 8 << 20

_BLANK = re.compile(rb"[ \t-\r]")


# -- the plan ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Plan:
    """Configurations ((length, count), ...) with how often each is used, and the lower bound."""

    uses: list[tuple[tuple[tuple[int, int], ...], int]]
    bound: int

    @property
    def n_sequences(self) -> int:
        return sum(times for _, times in self.uses)


def knapsack(price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(worth, take) for every room up to ``capacity``: the most that lengths fitting in it are
    worth, and the longest length of such a choice (0: the last token stays empty). Lengths may
    be taken any number of times; a price of -inf takes a length out."""
    worth, take = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        gains = price[room:0:-1] + worth[:room]
        best = int(gains.argmax())
        if gains[best] > worth[room - 1]:
            worth[room], take[room] = gains[best], room - best
        else:
            worth[room] = worth[room - 1]
    return worth, take


def configuration(take: np.ndarray, first: int, capacity: int) -> dict[int, int]:
    """The best configuration that holds ``first``."""
    counts, room = {first: 1}, capacity - first
    while room:
        length = int(take[room])
        if length:
            counts[length] = counts.get(length, 0) + 1
        room -= length or 1
    return counts


def solved(demand: np.ndarray, capacity: int, rounds: int = ROUNDS):
    """(configuration -> times, lower bound): the linear program by multiplicative weights.

    Each round answers the prices with configurations that cover every length: those worth most,
    longest length first. The answers of all rounds but the first third are averaged.
    """
    lengths = np.flatnonzero(demand)
    price = np.full(capacity + 1, -np.inf)
    price[lengths] = lengths / capacity
    times: dict[tuple, float] = {}
    bound, first = 0.0, rounds // 3
    for number in range(rounds):
        worth, take = knapsack(price, capacity)
        bound = max(bound, float(price[lengths] @ demand[lengths]) / worth[capacity])
        cover = np.zeros(capacity + 1)
        for length in lengths[::-1].tolist():
            missing = demand[length] - cover[length]
            if missing <= 1e-9:
                continue
            # No length is taken more often than it occurs at all.
            counts = {k: min(c, int(demand[k])) for k, c in configuration(take, length, capacity).items()}
            use = missing / counts[length]
            for k, c in counts.items():
                cover[k] += c * use
            if number >= first:
                key = tuple(sorted(counts.items(), reverse=True))
                times[key] = times.get(key, 0.0) + use / (rounds - first)
        over = np.clip(cover[lengths] / demand[lengths] - 1, 0, 1)
        price = price.copy()
        price[lengths] *= np.exp(-RATE / np.sqrt(1 + number) * over) / worth[capacity]
    return times, bound


def planned(demand: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    """Configurations that use up ``demand`` (occurrences of each length) exactly.

    Rounded twice, with all configurations and with those that leave no token empty; the better
    one stands.
    """
    demand = np.asarray(demand, np.int64)
    if not demand.any():
        return Plan([], 0)
    times, bound = solved(demand.astype(float), capacity, rounds)
    least = -(-int(np.arange(capacity + 1) @ demand) // capacity)
    chosen = sorted(times.items(), key=lambda item: (-item[1], item[0]))[:MOST_CONFIGURATIONS]
    full = [item for item in chosen if sum(length * n for length, n in item[0]) == capacity]
    plans = [Plan(rounded(demand, some, capacity), max(least, int(np.ceil(bound - 1e-6)))) for some in (chosen, full)]
    return min(plans, key=lambda plan: plan.n_sequences)


def rounded(demand: np.ndarray, chosen: list, capacity: int) -> list:
    """Each configuration its rounded number of times, as far as there are pieces; the rest best fit."""
    left, uses = demand.copy(), {}
    for counts, wanted in chosen:
        use = min(int(wanted + 0.5), *(int(left[k]) // c for k, c in counts))
        if use:
            for k, c in counts:
                left[k] -= use * c
            uses[counts] = use
    for counts, use in best_fit(left, capacity):
        uses[counts] = uses.get(counts, 0) + use
    return list(uses.items())


def best_fit(demand: np.ndarray, capacity: int) -> list:
    """(configuration, times) of best fit: the longest piece first, each into the fullest sequence
    that has room for it. Sequences with equal contents are one group, so the work grows with
    the number of lengths, not with that of the pieces."""
    open_groups: dict[int, list] = {}  # room -> [(configuration, times)]
    rooms: list[int] = []

    def put(counts: tuple, room: int, times: int) -> None:
        if room not in open_groups:
            bisect.insort(rooms, room)
        open_groups.setdefault(room, []).append((counts, times))

    def with_more(counts: tuple, length: int, n: int) -> tuple:
        return (*counts, (length, n))

    for length in np.flatnonzero(demand)[::-1].tolist():
        pieces = int(demand[length])
        grown = []  # not to be entered again by this length
        while pieces:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                counts, room, times = (), capacity, -(-pieces // (capacity // length))
            else:
                room = rooms[at]
                counts, times = open_groups[room].pop()
                if not open_groups[room]:
                    del open_groups[room], rooms[at]
            each = room // length
            whole = min(times, pieces // each)
            pieces -= whole * each
            if whole:
                grown.append((with_more(counts, length, each), room - each * length, whole))
            if whole < times and pieces:
                grown.append((with_more(counts, length, pieces), room - pieces * length, 1))
                whole, pieces = whole + 1, 0
            if whole < times and counts:
                put(counts, room, times - whole)
        for group in grown:
            put(*group)
    return [group for groups in open_groups.values() for group in groups]


def slots(plan: Plan, capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, by their number: one row per length of a configuration,
    sorted by length and first number. Number n of a row's ``count`` a sequence is in sequence
    ``sequence + n // count`` at ``offset + n % count * length``."""
    taken, sequence, rows = [0] * (capacity + 1), 0, []
    for counts, times in plan.uses:
        offset = 0
        for length, count in counts:
            rows.append((length, taken[length], count, sequence, offset))
            taken[length] += count * times
            offset += length * count
        sequence += times
    rows.sort()
    columns = zip(*rows) if rows else [()] * 5
    return {k: np.array(v, np.int64) for k, v in zip(("length", "first", "count", "sequence", "offset"), columns)}


# -- the pieces -------------------------------------------------------------------------------


def _of_category(letter: str) -> str:
    """The plain signs whose Unicode category begins with ``letter``, for a character class."""
    return "".join(re.escape(c) for c in map(chr, _PLAIN_SIGNS) if unicodedata.category(c)[0] == letter)


#: Latin signs that lower-case sign by sign and that no normal form changes, but for white space.
_PLAIN_SIGNS = [*range(0x21, 0x7F), *range(0xA1, 0x130), *range(0x131, 0x180)]
_PLAIN = re.compile("[\n!-~\u00a1-\u012f\u0131-\u017f]*")
_LETTERS, _NUMBERS = _of_category("L"), _of_category("N")
#: The tokenizer's pattern on such words, and line breaks between them.
_CUT = re.compile(rf"\n|'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+")
_END = "\x01"  # stands for the suffix that ends a word; no plain word has it


class WordCoder:
    """Ids of words between white space, for a tokenizer that drops white space, lower-cases and
    ends words by a suffix: a text's ids are those of its words.

    Words of plain Latin signs are cut by the tokenizer's pattern and merged by tiktoken, many at a
    time. It is given the same merges, with the suffix as one byte. Other words, and those with a
    special token, go through the tokenizers library.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [token["content"].encode() for token in spec["added_tokens"]]
        self.core = None
        if self.known(spec):
            self.core, self.ids = self.merged(spec["model"])

    def known(self, spec: dict) -> bool:
        """Whether the file is of the kind that the fast way repeats."""
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = [p.get("pattern", {}).get("Regex") for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        pattern = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
        model = spec["model"]
        return kinds == ["NFC", "Replace", "Lowercase"] and cuts == [pattern, None] and model["type"] == "BPE" and bool(
            model["end_of_word_suffix"]
        )

    def merged(self, model: dict) -> tuple[tiktoken.Encoding, np.ndarray]:
        """The merges as ranks, and the id of each rank."""
        signs, suffix, end = byte_signs(), model["end_of_word_suffix"], _END.encode()

        def data(token: str) -> bytes:
            last = token.endswith(suffix)
            return bytes(signs[c] for c in (token[: -len(suffix)] if last else token)) + (end if last else b"")

        ranks = {bytes([b]): b for b in range(256)}
        ids = np.zeros(512 + len(model["merges"]), "<u4")
        names = {b: c for c, b in signs.items()}
        for b in range(256):
            ids[b] = model["vocab"].get(names[b], 0)
            ranks[bytes([b]) + end] = 256 + b
            ids[256 + b] = model["vocab"].get(names[b] + suffix, 0)
        for i, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            ranks[data(left) + data(right)] = 512 + i
            ids[512 + i] = model["vocab"][left + right]
        pattern = f"[^{_END}]+{_END}"
        return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), ids

    def fast(self, words: list[bytes]) -> list[bytes] | None:
        """Ids of plain words; None if one of them is not plain."""
        text = b"\n".join(words).decode("utf-8")
        if not _PLAIN.fullmatch(text):
            return None
        cut = _CUT.findall(text.lower())
        ranks = np.array(self.core.encode_ordinary(_END.join([*cut, "\n", ""])), np.int64)
        breaks = np.flatnonzero(ranks == 256 + ord("\n"))
        data = self.ids[ranks].tobytes()
        ends = (4 * breaks).tolist()
        starts = [0, *(end + 4 for end in ends[:-1])]
        return [data[a:b] for a, b in zip(starts, ends)]

    def slow(self, words: list[bytes]) -> list[bytes]:
        made = self.whole.encode_batch_fast([w.decode("utf-8") for w in words], add_special_tokens=False)
        return [np.array(one.ids, "<u4").tobytes() for one in made]

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as bytes of unsigned 32-bit numbers, little-endian."""
        if self.core is None:
            return self.slow(words)
        plain = [w.isascii() or _PLAIN.fullmatch(w.decode("utf-8")) is not None for w in words]
        plain = [fits and not (b"<" in w and any(t in w for t in self.special)) for fits, w in zip(plain, words)]
        found = self.fast([w for w, fits in zip(words, plain) if fits])
        if found is None:  # an ASCII word with a control sign
            plain = [fits and _PLAIN.fullmatch(w.decode("utf-8")) is not None for fits, w in zip(plain, words)]
            found = self.fast([w for w, fits in zip(words, plain) if fits])
        rest = iter(self.slow([w for w, fits in zip(words, plain) if not fits]))
        quick = iter(found)
        return [next(quick) if fits else next(rest) for fits in plain]


@lru_cache(maxsize=2)
def word_coder(path: str) -> WordCoder:
    return WordCoder(path)


def ids_of(coder: WordCoder, texts: pa.Array) -> list[bytes]:
    """The ids of each text as bytes. Equal words of the texts are encoded once."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = split.flatten().dictionary_encode()
    made = coder.encode(coded.dictionary.cast(pa.binary()).to_pylist())
    word = coded.indices.to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    return [ids.tobytes() for ids in spread(word, sizes, made, "<u4")]


def long_ids(coder: WordCoder, text: str):
    """The ids of a long text, slice by slice."""
    data, at = text.encode("utf-8"), 0
    while at < len(data):
        cut = _BLANK.search(data, at + WORDS_BYTES) if len(data) - at > WORDS_BYTES else None
        stop = cut.start() if cut else len(data)
        yield from ids_of(coder, pa.array([data[at:stop].decode("utf-8")], pa.string()))
        at = stop


def cut_pieces(parts, capacity: int):
    """The bytes of a document's pieces: whole if it fits in a sequence, else cut at its length."""
    held, size = b"", 4 * capacity
    for part in parts:
        held += part
        full = max(0, (len(held) - 1) // size)  # the last piece waits for more
        for k in range(full):
            yield held[k * size : (k + 1) * size]
        held = held[full * size :]
    yield held


def id_pieces(coder: WordCoder, texts: pa.Array, capacity: int):
    """For each text the bytes of its pieces; the end id comes last."""
    end = END_ID.to_bytes(4, "little")
    if len(texts) == 1 and texts[0].is_valid and len(texts[0].as_py()) > WORDS_BYTES:
        yield cut_pieces(itertools.chain(long_ids(coder, texts[0].as_py()), [end]), capacity)
    else:
        for ids in ids_of(coder, texts):
            yield cut_pieces([ids + end], capacity)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """task, nth, doc_id, piece, start, length, ids_crc32: every piece with its number among the
    pieces of its length in its task."""

    def cut(batches):
        coder, task = word_coder(path), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            for part in text_slices(batch, 1, WORDS_BYTES):
                rows = []
                for doc_id, made in zip(part.column(0).to_pylist(), id_pieces(coder, part.column(1), capacity)):
                    for piece, data in enumerate(made):
                        length = len(data) // 4
                        rows.append((task, seen[length], doc_id, piece, piece * capacity, length, zlib.crc32(data)))
                        seen[length] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(cut, "task int, nth long, doc_id long, piece int, start long, length int, ids_crc32 long")


_PIECES = pa.schema(
    [
        ("task", pa.int32()), ("nth", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()),
        ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64()),
    ]
)


def numbered(made: DataFrame) -> DataFrame:
    """``pieces`` (written) with ``number``: consecutive from 0 within each length.

    A task's pieces of a length follow those of the tasks before it; the window reads one row per
    task and length.
    """
    counts = made.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return made.join(bases, ["length", "task"]).withColumn("number", F.col("base") + F.col("nth"))


def histogram(made: DataFrame, capacity: int = CAPACITY) -> np.ndarray:
    """Pieces of each length; at most ``capacity`` rows reach the driver."""
    demand = np.zeros(capacity + 1, np.int64)
    for row in made.groupBy("length").agg(F.count("*").alias("n")).collect():
        demand[row["length"]] = row["n"]
    return demand


def placed(made: DataFrame, plan: Plan, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of numbered pieces."""
    shared = made.sparkSession.sparkContext.broadcast(slots(plan, capacity))

    def place(batches):
        table = shared.value
        keys = (table["length"] << 44) | table["first"]
        for batch in batches:
            length = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
            number = batch.column(5).to_numpy(zero_copy_only=False)
            slot = np.searchsorted(keys, (length << 44) | number, "right") - 1
            number = number - table["first"][slot]
            count = table["count"][slot]
            sequence = table["sequence"][slot] + number // count
            offset = table["offset"][slot] + number % count * length
            columns = [batch.column(i) for i in range(3)] + [pa.array(length), batch.column(4), pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, _OUT)

    rows = made.select("doc_id", "piece", "start", "length", "ids_crc32", "number")
    return rows.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


_OUT = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its sequence and its offset there."""
    made = written(pieces(docs, path, capacity), "pieces")
    plan = planned(histogram(made, capacity), capacity)
    return placed(numbered(made), plan, capacity)
