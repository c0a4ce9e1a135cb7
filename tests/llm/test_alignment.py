"""Cross-tokenizer alignment against whole-text encoding and plain loops."""

import hashlib
import json
import random
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tableferry.llm import alignment
from tableferry.llm.bpe import byte_signs
from tableferry.llm.common import ship, table
from tableferry.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@cache
def loaded():
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    with open(A, encoding="utf-8") as file:
        names = {i: t for t, i in json.load(file)["model"]["vocab"].items()}
    return tokenizer, model, names


def groups_of(text):
    """[(A ids, B ids)] of a text by whole encoding, or nothing."""
    if not text:
        return []
    tokenizer, model, names = loaded()
    signs = byte_signs()
    ids_a = tokenizer.encode(" " + text, add_special_tokens=False).ids
    ids_b = model.encode(text)
    bytes_a = [bytes(signs[c] for c in names[i]) if i in names else b"<|endoftext|>" for i in ids_a]
    bytes_b = [
        bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
        for i in ids_b
    ]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return []

    def ends(pieces):
        at, out = 0, []
        for piece in pieces:
            at += len(piece)
            out.append(at)
        return out

    ends_a, ends_b = ends(bytes_a), ends(bytes_b)
    common = set(ends_a) & set(ends_b)

    def cut(ids, ends):
        out = [[]]
        for i, end in zip(ids, ends):
            out[-1].append(i)
            if end in common:
                out.append([])
        return out[:-1]

    return list(zip(cut(ids_a, ends_a), cut(ids_b, ends_b)))


def expected(rows):
    found = [(doc_id, groups_of(text)) for doc_id, text in rows]
    holding = Counter()
    for _, groups in found:
        holding.update({(a, b) for xs, ys in groups for a in xs for b in ys})
    most = defaultdict(int)
    for (a, _), n in holding.items():
        most[a] = max(most[a], n)
    out = []
    for doc_id, groups in found:
        links = [(a, b) for xs, ys in groups for a in xs for b in ys]
        shown = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        out.append(
            (
                doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                sum(holding[link] == most[link[0]] for link in links), sum(holding[link] for link in links),
                hashlib.sha256(shown.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=str)


TEXTS = [
    "Plain words, it's 1234 numbers.\nA new line\n\n  and blanks  \t tabs ", " leading blank", "\nbreak first", "trailing \n",
    "日本語のテキスト 中文 混在 text", "नमस्ते दुनिया สวัสดีชาวโลก", "emoji 👩‍👩‍👧 x é e\u0301 ﬁ Å", "<|endoftext|> and <s> </s> <unk> <0x41>",
    "a▁b ▁ c", "x\u00a0y\u2003z \u3000w", "a\x00b \x01 c\x1cd \x85e", "é le éà là\nÈre ça", "ab " * 50 + "\n" * 9 + "'s 't", "\r\n line\r\nends",
    "if x:\n    return  y\n", "𝔘𝔫𝔦 \U0010ffff \ufeff z", "word", " ", "\n", "  ", "   a", "\n\n a",
]


def test_query_by_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    out = QUERIES["op13_cross_alignment"](spark, SF)
    assert out.columns == COLUMNS
    assert [t for c, t in out.dtypes] == ["bigint"] * 7 + ["string"]
    assert got(out) == expected(rows)


@pytest.mark.parametrize("frequent", [0, 5, 1 << 16])
def test_texts_of_every_kind(spark, frequent):
    ship(spark)
    rows = list(enumerate(TEXTS)) + [(None, "no id"), (3, None), (3, ""), (7, TEXTS[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = expected(rows)
    assert sum(r[3] > 0 for r in want) > 15 and sum(r[3] == 0 for r in want) >= 3
    assert got(alignment.linked(docs, A, B, frequent)) == want


def test_slices_and_blocks_change_nothing(monkeypatch):
    texts = [" ".join(TEXTS[:8]) * 3, "中文" * 300, "one two\nthree " * 40, "a▁b " * 9]
    sides = alignment.byte_side(A), alignment.piece_side(B)
    shown = alignment.Spelling(len(sides[0].pieces), len(sides[1].pieces))

    def made():
        return [
            (d.good, d.n.tolist(), d.sha.hexdigest(), *(x.tolist() for x in d.total()))
            for d in alignment._documents(list(enumerate(texts)), sides, shown)
        ]

    whole = made()
    for name, value in (("WORDS_BYTES", 60), ("ALIGNED_BYTES", 40), ("BLOCK", 3), ("RUN_WORDS", 2)):
        monkeypatch.setattr(alignment, name, value)
    monkeypatch.setattr(alignment.parts, "__defaults__", (50,))
    assert sum(1 for _ in alignment.parts(texts[2])) > 5
    assert made() == whole
    assert [w[1][2] for w in whole] == [len(groups_of(t)) for t in texts]


def test_words_keep_their_ids_among_others():
    """Random words, encoded in one text and alone."""
    rng = random.Random(12)
    signs = "abcABC é日▁'.,-0123<|>\t\x00\x01\u00a0\u0301s"
    words = [rng.choice(" \n") + "".join(rng.choices(signs, k=rng.randint(1, 9))) for _ in range(3_000)]
    words += [" <|endoftext|>", " <s>", "\n<0x41>", " " + "z" * 400, "\n" + "中" * 90]
    for side in (alignment.byte_side(A), alignment.piece_side(B)):
        made, spelt = side.encode(words)
        alone = side.alone(words)
        assert [np.frombuffer(x, np.int32).tolist() for x in made] == alone
        assert spelt.tolist() == [side.spells(ids, word) for ids, word in zip(alone, words)]


def test_overlaps(spark):
    ship(spark)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = alignment.token_overlaps(docs, A, B).collect()
    for r in rows:
        assert max(r["a_start"], r["b_start"]) < min(r["a_end"], r["b_end"])
    for doc_id, text in enumerate(TEXTS):
        own = [r for r in rows if r["doc_id"] == doc_id]
        groups = groups_of(text)
        assert len({r["group_no"] for r in own}) == len(groups)
        spans_a = {(r["a_start"], r["a_end"], r["a_id"]) for r in own}
        spans_b = {(r["b_start"], r["b_end"], r["b_id"]) for r in own}
        assert [i for *_, i in sorted(spans_a)] == [i for x, _ in groups for i in x]
        assert [i for *_, i in sorted(spans_b)] == [i for _, y in groups for i in y]
        # Every pair whose ranges meet is there, once.
        assert len(own) == sum(x[0] < y[1] and y[0] < x[1] for x in spans_a for y in spans_b)


def test_odd_rows(spark, odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert got(alignment.linked(odd, A, B)) == expected(rows)
    assert alignment.linked(none, A, B).count() == 0


def test_a_long_text_and_many_pairs(spark):
    """More slices than one and more pairs than a row holds."""
    ship(spark)
    long = spark.range(60_000).select(F.concat_ws("", F.md5(F.col("id").cast("string")), F.lit(" ")).alias("w"))
    text = " ".join(r["w"].strip()[:9] for r in long.collect())
    rows = [(1, text * 3), (2, text[:5_000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r for r in alignment.linked(docs, A, B).collect()}
    tokenizer, model, _ = loaded()
    assert out[1]["n_a"] == len(tokenizer.encode(" " + text * 3, add_special_tokens=False).ids)
    assert out[1]["n_b"] == len(model.encode(text * 3))
    assert len(out) == 2 and out[1]["count_sum"] >= out[1]["n_links"] >= out[1]["n_best"] > 0
