import random

import pytest

from tableferry.llm import decontaminate as D


def edits(pattern, text):
    """Least edit distance of ``pattern`` to a stretch of ``text``, by the plain table."""
    before = [0] * (len(text) + 1)
    for i, sign in enumerate(pattern, 1):
        row = [i]
        for j, other in enumerate(text, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (sign != other)))
        before = row
    return min(before)


def test_myers_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(500):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(1, 70)))
        b = "".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))
        assert D.myers(D.masks(a), len(a), b)[0] == edits(a, b)


def spoiled(rng, text, n):
    signs = list(text)
    for _ in range(n):
        at = rng.randrange(len(signs))
        kind = rng.random()
        if kind < 0.4:
            signs[at] = rng.choice("abcdefg ")
        elif kind < 0.7:
            del signs[at]
        else:
            signs.insert(at, rng.choice("abcdefg"))
    return "".join(signs)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def case():
    rng = random.Random(2)
    items = [(i, prose(rng, rng.randint(2, 25))) for i in range(25)]
    docs = []
    for i in range(120):
        item = rng.choice(items)[1]
        middle = spoiled(rng, item, rng.randint(0, 2 + len(item) // 8)) if rng.random() < 0.8 else ""
        docs.append((i, f"{prose(rng, rng.randint(0, 40))} {middle.upper() if i % 3 == 0 else middle}\n{prose(rng, 10)}"))
    return items, docs


def expected(items, docs, rate):
    out = set()
    for doc_id, text in docs:
        text = D.normal(text)
        for item_id, item in items:
            item = D.normal(item)
            distance = edits(item, text)
            if item and distance <= int(rate * len(item) + 1e-9):
                out.add((doc_id, item_id, distance))
    return out


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.2])
def test_against_brute_force(spark, case, rate):
    items, docs = case
    want = expected(items, docs, rate)
    given = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows = D.hits(*given, error_rate=rate).collect()
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in rows} == want
    texts, names = dict(docs), dict(items)
    for r in rows:
        stretch = D.normal(texts[r["doc_id"]])[r["start_char"] : r["end_char"]]
        assert edits(D.normal(names[r["item_id"]]), stretch) == r["distance"]
    kept = {r["doc_id"] for r in D.clean(*given, error_rate=rate).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _, _ in want}


def test_blocks_change_nothing(spark, case):
    items, docs = case
    given = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert len(list(D.blocks(given[1], 300))) > 3
    rows = D.hits(*given, block_bytes=300).collect()
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in rows} == expected(items, docs, D.ERROR_RATE)


def test_odd_rows(spark, odd, none):
    items = [(1, "three four five six"), (1, "one two three"), (2, None), (3, "  "), (None, "lorem ipsum dolor"), (4, "z" * 9000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = {(r["doc_id"], r["item_id"], r["distance"]) for r in D.hits(odd, bench).collect()}
    assert rows == {(4, 1, 0), (5, 1, 0), (6, None, 0)}
    kept = D.clean(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    assert D.hits(none, bench).count() == 0
    assert D.hits(odd, bench.limit(0)).count() == 0
    assert D.clean(odd, bench.limit(0)).count() == odd.count()


def test_repetitive_texts_take_linear_time():
    """Every sign is a hit of many pieces; stretches are verified once."""
    import time

    items = [(1, "a" * 200), (2, "na " * 60), (3, "a" * 20 + "bcdefghij " * 12)]
    matcher = D.Matcher(items, 0.1)
    for text, found in (("a" * 100_000, {1}), ("na " * 30_000, {2}), ("b" * 50 + "a" * 30_000, {1})):
        begin = time.perf_counter()
        assert {m[0] for m in matcher.matches(text)} == found
        assert time.perf_counter() - begin < 20  # minutes and more without that


def test_repetitive_texts_by_brute_force():
    rng = random.Random(11)
    items = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(5, 30))) * rng.randint(1, 3)) for i in range(12)]
    matcher = D.Matcher(items, 0.15)
    for _ in range(60):
        text = "".join(rng.choice(["ab", "a", "bba", "aaaa"]) * rng.randint(1, 9) for _ in range(rng.randint(1, 9)))
        want = {i: edits(D.normal(x), text) for i, x in items}
        want = {i: n for i, n in want.items() if n <= int(0.15 * len(D.normal(items[i][1])) + 1e-9)}
        assert {m[0]: m[1] for m in matcher.matches(text)} == want
