"""Spelling variants against plain definitions."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tableferry.llm import spelling
from tableferry.llm.common import table
from tableferry.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, least_length=5, least_count=3, every=97):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= least_length and k >= least_count}


def edits(word, letters):
    """Every word one edit away."""
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    for i in range(len(word) + 1):
        for c in letters:
            out.add(word[:i] + c + word[i:])
            if i < len(word):
                out.add(word[:i] + c + word[i + 1 :])
    return out - {word}


def expected(n):
    letters = {c for w in n for c in w}
    near = {w: edits(w, letters) & n.keys() for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    rows = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return rows


def got(frame):
    rows = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_by_brute_force(spark):
    docs = table(spark, SF, "documents")
    out = QUERIES["op11_spelling_variants"](spark, SF)
    assert dict(out.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    want = expected(counted([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert len(want) > 500 and any(r[1] for r in want)
    assert got(out) == want


@pytest.mark.parametrize("shard_words", [1, 3, 40, 5_000])
def test_shards_and_blocks_find_every_pair(spark, shard_words):
    """Few letters, so that leaves are large and cut into blocks."""
    rng = random.Random(4)
    rows = [(i, " ".join("".join(rng.choices("abkéu", k=rng.randint(4, 6))) for _ in range(60))) for i in range(20)]
    rows += [(90, "abcde abcde abcdu abcd abcdef " * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = expected(counted(rows, 4, 1))
    assert got(spelling.variants(docs, 4, 1, shard_words=shard_words)) == want


def test_chains_and_ties(spark):
    counts = {"abcdef": 40, "abcdeg": 20, "abcdhg": 10, "abckhg": 5, "zzzzz": 4, "zzzzy": 4, "mnopq": 9, "mnopx": 18, "mnopa": 18}
    docs = spark.createDataFrame([(1, " ".join(w for w, n in counts.items() for _ in range(n)))], "doc_id long, text string")
    rows = {r["word"]: r for r in spelling.variants(docs, every=None).collect()}
    assert {w: r["n"] for w, r in rows.items()} == counts
    assert rows["abckhg"]["root"] == rows["abcdeg"]["root"] == "abcdef" and rows["abcdef"]["form"] is None
    assert rows["zzzzz"]["form"] is None and rows["zzzzz"]["n_near"] == 1  # not twice as frequent
    assert rows["mnopq"]["form"] == "mnopa"  # the smaller of two equally frequent


def test_odd_rows(spark, odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert got(spelling.variants(odd)) == expected(counted(rows))
    assert spelling.variants(none).count() == 0


def test_letters(spark):
    """Only A-Z is lower-cased; the letter range holds the two arithmetic signs in it."""
    docs = spark.createDataFrame([(1, "ÀBCDE àbcde a×÷bc " * 3), (2, "ſtrange ßÿabc-ßÿabc " * 3)], "doc_id long, text string")
    assert got(spelling.variants(docs)) == expected(counted([tuple(r) for r in docs.collect()]))


def test_one_edit():
    rng = random.Random(1)
    for _ in range(3_000):
        a, b = ("".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(2))
        assert spelling.one_edit(a, b) == (b in edits(a, "abc"))


def test_no_pair_is_written_twice(spark):
    words = spark.createDataFrame([(w, 5) for w in ("aaaaa", "aaaab", "aaaba", "baaaa", "aaaa", "aaaaaa")], "word string, n long")
    pairs = spelling.near_pairs(words, 2).select(F.least("a", "b"), F.greatest("a", "b")).collect()
    assert len(pairs) == len(set(pairs)) == 8
