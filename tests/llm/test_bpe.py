import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tableferry.llm import bpe

from tests.llm.conftest import ODD

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(1)
    signs = ["a", "b", "  ", "\n", "\t", "'s", "é", " ", "日本", "!?", "12", "<|endoftext|>", " ", " x", " "]
    out = ["", "x<|endoftext|>y", "<|endof", " " * 3000, "\n" * 3000 + "a", "a" * 20000]
    for size in (20, 300, 4000):
        out += ["".join(rng.choice(signs) for _ in range(rng.randrange(size))) for _ in range(120)]
    out += ["".join(rng.choice("ab") for _ in range(6000)) for _ in range(10)]
    words = ["the", "quick", "Brown", "fox's", "über", "don't", "42", "(end)"]
    out += [" ".join(rng.choice(words) for _ in range(2000)) for _ in range(20)]
    return out


def test_encoder_agrees_with_the_library(library):
    encoder = bpe.Encoder(bpe.coder(PATH))
    for text in texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.text(text) == ids
        assert encoder.code.decode(ids) == library.decode(ids, skip_special_tokens=False).encode()


def test_chunks_do_not_depend_on_their_place():
    rng = random.Random(2)
    passage = bytes(rng.choice(b"abcdefgh ") for _ in range(30_000))
    for before in (b"", b"x" * 777):
        data = before + passage
        ends = {end - len(before) for end in bpe.cuts(data)}
        assert {e for e in bpe.cuts(passage) if 64 < e} <= ends


def rows_of(texts, library):
    out = []
    for doc_id, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    return sorted(out, key=str)


def test_digests(spark, odd, library):
    got = sorted((tuple(r) for r in bpe.digests(odd, PATH).collect()), key=str)
    assert got == rows_of([(i, t) for i, t, *_ in ODD], library)


@pytest.mark.parametrize("most_bytes", [0, 4000, 1 << 20])
def test_the_dictionary_never_changes_the_ids(spark, none, library, most_bytes):
    rng = random.Random(3)
    shared = " ".join(rng.choice(["alpha", "beta's", "gämma", "12", "..."]) for _ in range(3000))
    given = [(i, f"{rng.random()} {shared[rng.randrange(500):]} {'z' * i}") for i in range(12)]
    docs = spark.createDataFrame(given, "doc_id long, text string")
    known = bpe.dictionary(docs, PATH, most_bytes)
    assert bool(known) == (most_bytes > 0)
    assert sorted((tuple(r) for r in bpe.digests(docs, PATH, most_bytes).collect()), key=str) == rows_of(given, library)


def test_ids_and_round_trip(spark, odd):
    for row in bpe.encode(odd, PATH).collect():
        assert row["decoded"] in {t or "" for _, t, *_ in ODD}
        assert (len(row["ids"]) == 0) == (row["decoded"] == "")


def test_empty(none):
    assert bpe.digests(none, PATH).count() == 0


@pytest.mark.parametrize("text", [" " * 3_000_000, "\n" * 2_000_000 + "end", "a" + "\t \n" * 500_000 + " b  c", "x \u3000" * 9 + "\u2003" * 5_000 + "y"])
def test_long_runs_of_white_space(library, text):
    """Millions of blanks, which the pattern matcher of the fast library gives up on."""
    ids = bpe.Encoder(bpe.coder(PATH)).text(text)
    assert bpe.coder(PATH).decode(ids) == text.encode()
    if len(text) < 1_600_000:
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_runs_around_the_limit(library):
    rng = random.Random(9)
    coder = bpe.coder(PATH)
    for size in (bpe.LONG_RUN - 1, bpe.LONG_RUN, bpe.LONG_RUN + 1):
        for last in ("", "a", "'s", "\x1c", "é", "1"):
            run = "".join(rng.choice(" \n\t\u00a0") for _ in range(size))
            text = rng.choice(["", "b", "9 b"]) + run + last + " tail"
            assert coder.plain(text.encode()) == library.encode(text, add_special_tokens=False).ids


def test_chunks_are_shared_in_texts_without_blanks(library):
    """Ids of a text without any safe place, whose chunks are known already."""
    rng = random.Random(10)
    text = "".join(chr(0x4E00 + rng.randrange(3_000)) for _ in range(9_000))
    encoder = bpe.Encoder(bpe.coder(PATH))
    want = library.encode(text, add_special_tokens=False).ids
    assert encoder.text(text) == want and encoder.text("文" + text)[-500:] == want[-500:]
