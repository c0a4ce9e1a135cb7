"""Packing: pieces against the tokenizer, plans against best fit and bounds, places against each other."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tableferry.llm import packing
from tableferry.llm.common import ship, table
from tableferry.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def pieces_of(rows, capacity=2048):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4").tobytes()
            out.append((doc_id, piece, at, len(part) // 4, zlib.crc32(part)))
    return sorted(out, key=str)


def check(frame, rows, capacity=2048):
    """Pieces as expected; sequences gapless and within capacity. Returns the number of sequences."""
    found = [tuple(r[c] for c in COLUMNS) for r in frame.collect()]
    assert sorted((r[:5] for r in found), key=str) == pieces_of(rows, capacity)
    sequences = defaultdict(list)
    for *_, length, _, sequence, offset in found:
        sequences[sequence].append((offset, length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def decreasing(lengths, capacity):
    """Sequences that plain best fit decreasing needs."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(capacity - length)
    return len(rooms)


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    out = QUERIES["op12_best_fit_packing"](spark, SF)
    assert dict(out.dtypes) == {c: "int" if c == "piece" else "bigint" for c in COLUMNS}
    n = check(out, rows)
    lengths = [r[3] for r in pieces_of(rows)]
    assert n <= decreasing(lengths, 2048) and n <= -(-sum(lengths) // 2048) + 1


@pytest.mark.parametrize("capacity", [8, 64])
def test_small_capacity(spark, capacity):
    rng = random.Random(capacity)
    ship(spark)
    rows = [(i, " ".join(["word"] * rng.choice([0, 1, 3, 7, 8, 9, 30, 63, 64, 200]))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    n = check(packing.packed(docs, PATH, capacity), rows, capacity)
    assert n <= decreasing([r[3] for r in pieces_of(rows, capacity)], capacity)


def histogram(lengths, capacity=2048):
    return np.bincount(lengths, minlength=capacity + 1)


def test_plans_use_every_piece_and_beat_best_fit():
    rng = np.random.default_rng(3)
    thirds = np.concatenate([[a, b, 2048 - a - b] for a, b in zip(rng.integers(520, 800, 400), rng.integers(520, 720, 400))])
    cases = {
        "long tail": np.clip(np.exp(rng.normal(6, 0.8, 3_000)), 1, 2048).astype(int), "middle": rng.integers(400, 1000, 2_000),
        "three exact": thirds, "one length": np.full(999, 700), "tiny": rng.integers(1, 9, 5_000), "single": np.array([2048]),
    }
    for name, lengths in cases.items():
        demand = histogram(lengths)
        plan = packing.planned(demand)
        used = np.zeros_like(demand)
        for counts, times in plan.uses:
            assert sum(length * n for length, n in counts) <= 2048 and times > 0
            for length, n in counts:
                used[length] += n * times
        assert (used == demand).all(), name
        assert plan.bound <= plan.n_sequences <= decreasing(lengths.tolist(), 2048), name
    middle = cases["middle"]
    assert packing.planned(histogram(middle)).n_sequences < decreasing(middle.tolist(), 2048)


def test_bound_holds_for_small_cases():
    """Against the best packing, found by trying all."""

    def least(lengths, capacity):
        best = len(lengths)

        def go(i, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if i == len(lengths):
                best = len(rooms)
                return
            for k, room in enumerate(rooms):
                if room >= lengths[i] and room not in rooms[:k]:
                    go(i + 1, rooms[:k] + [room - lengths[i]] + rooms[k + 1 :])
            go(i + 1, [*rooms, capacity - lengths[i]])

        go(0, [])
        return best

    rng = random.Random(5)
    for _ in range(40):
        lengths = sorted((rng.randint(1, 12) for _ in range(rng.randint(1, 9))), reverse=True)
        plan = packing.planned(histogram(lengths, 12), 12)
        assert plan.bound <= least(lengths, 12) <= plan.n_sequences <= least(lengths, 12) + 1


def test_group_best_fit_is_best_fit():
    rng = random.Random(6)
    for _ in range(60):
        lengths = [rng.choice([1, 2, 3, 5, 8, 13, 20]) for _ in range(rng.randint(1, 60))]
        made = packing.best_fit(histogram(lengths, 20), 20)
        assert sum(times for _, times in made) == decreasing(lengths, 20)


def test_words_are_encoded_as_the_whole_text(spark):
    texts = [
        "Mixed CASE words, it's\tfine\r\n x\x0bb\x0cy", "a\u00a0b\u2003c\x85d\x1ce", "e\u0301 \u0301x ΑΣ Β ΣΑΣ", "<|endoftext|>a <|startoftext|> b<|endoftext|>",
        "日本 語", "ﬁ İ ß", "  ", "x" * 300, "0123 4.5", "가각 각",
    ]
    ship(spark)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(packing.packed(docs, PATH), list(enumerate(texts)))


def test_the_fast_way_is_the_librarys():
    """Random words of plain Latin signs, control signs, contractions and special tokens."""
    coder = packing.WordCoder(PATH)
    assert coder.core is not None
    rng = random.Random(8)
    signs = "abcdefghijklmnopqrstuvwxyzABCDEÀÉßÿĿſŁłĳŉı0123'.,-<|>\x01\x7f\x1c¹½ªº×÷¡İ日e\u0301"
    words = ["".join(rng.choices(signs, k=rng.randint(1, 12))) for _ in range(4_000)]
    words += ["it's", "'SS", "we'LL've", "<|endoftext|>", "a<|endoftext|>b", "x" * 500, "0" * 50, "<|startoftext|"]
    data = [w.encode() for word in words for w in [word.encode().decode()] if w.encode().split() == [w.encode()]]
    assert coder.encode(data) == coder.slow(data)
    found = coder.fast([b"plain", b"it's.", "Éà½".encode()])
    assert found == coder.slow([b"plain", b"it's.", "Éà½".encode()]) and coder.fast([b"a\x01"]) is None


def test_slices_change_nothing(monkeypatch):
    coder = packing.word_coder(PATH)
    text = "some words of a text\nthat is cut \t often " * 200
    made = lambda texts: [list(p) for p in packing.id_pieces(coder, pa.array(texts, pa.string()), 64)]
    (whole,) = made([text])
    monkeypatch.setattr(packing, "WORDS_BYTES", 37)
    assert made([text]) == [whole] and made([text, None, text]) == [whole, [bytes(4)], whole]
    assert all(len(p) == 256 for p in whole[:-1]) and 0 < len(whole[-1]) <= 256


def test_odd_rows(spark, odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check(packing.packed(odd, PATH), rows)
    assert packing.packed(none, PATH).count() == 0
