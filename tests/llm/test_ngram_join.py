import random

import numpy as np
import pytest

from tableferry.llm import common, ngram_join
from tableferry.llm.common import WordHashes, components

from tests.llm.conftest import ODD


def plain_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def expected(rows):
    sets = [plain_set(text) for _, text in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j, (b, _) in enumerate(rows[:i]):
            if a is not None and b is not None and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), root(i) if i is not None else None) for (i, _), s in zip(rows, sets)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_odd_rows(odd):
    assert found(ngram_join.linked(odd)) == expected([(i, t) for i, t, *_ in ODD])


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.5:
            words[at] = f"w{rng.randrange(10**6)}"
        elif kind < 0.75:
            del words[at]
        else:
            words.insert(at, f"w{rng.randrange(10**6)}")
    return words


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(60)]
    rows, n = [], 0
    for _ in range(40):  # families of near copies at and around the threshold, of all sizes
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([1, 3, 6, 9, 20, 60, 200, 700]))]
        if rng.random() < 0.5:
            base += passage
        for _ in range(rng.randint(1, 9)):
            n += 1
            rows.append((n, " ".join(edited(rng, base, rng.randint(0, 1 + len(base) // 30)))))
    chain = [f"c{i}" for i in range(300)]  # each near the next, the ends far apart
    for k in range(12):
        n += 1
        rows.append((n, " ".join(chain[k * 8 : k * 8 + 200])))
    rng.shuffle(rows)
    return rows


def test_against_brute_force(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(7)
    assert found(ngram_join.linked(docs)) == expected(corpus)


def test_one_of_each_group_stays(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in ngram_join.one_per_group(docs).collect())
    assert kept == sorted({c for _, _, c in expected(corpus)})


def test_empty(none):
    assert ngram_join.linked(none).count() == 0
    assert ngram_join.one_per_group(none).columns == none.columns


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a = np.unique(rng.integers(0, 400, rng.integers(1, 200)).astype(np.uint64))
        b = np.unique(rng.integers(0, 400, rng.integers(1, 200)).astype(np.uint64))
        assert ngram_join.distance(ngram_join.sketch(a), ngram_join.sketch(b)) <= len(np.setxor1d(a, b))


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(5)
    ranks = rng.integers(0, 255, ngram_join.COUNTERS).astype(np.int64)
    rank_of = lambda x: ranks[x & np.uint64(ngram_join.COUNTERS - 1)] + (x % np.uint64(3) == 0) * ngram_join.LAST
    for _ in range(400):
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        off = int(rng.integers(0, len(a) // 7 + 1))
        b = np.unique(np.concatenate([a[off:], rng.integers(0, 1 << 63, int(rng.integers(0, off + 1))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 75 * (len(a) + len(b) - both):
            assert len(np.intersect1d(ngram_join.keys_of(a, rank_of(a)), ngram_join.keys_of(b, rank_of(b))))


def test_pieces_without_a_bit_are_used_if_needed():
    a = np.array([7], np.uint64)
    assert len(ngram_join.empty_pieces(a, 3, 5)) == 5
    assert len(ngram_join.keys_of(a, np.zeros(1, np.int64))) >= 1


def test_a_bands_pieces_outnumber_its_differences():
    for n in range(1, 40_000):
        for band, d in ngram_join.bands(n):
            assert d < ngram_join.piece_count(band)


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = list(range(2000))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    want = {x: root(x) for a, b in edges if a != b for x in (a, b)}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == want
    assert len(got) == len(want)


def test_hashes_follow_the_words():
    hashes = WordHashes(most=3)
    one = ngram_join.shingle_set("a b c d e f a b c d e", hashes)
    two = ngram_join.shingle_set("A  b\tc\nd e F a b c d e", hashes)
    assert len(one) == len(plain_set("a b c d e f a b c d e")) and (one == two).all()


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    """A bucket far above a block's size, of which hardly any pair is linked."""
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(edited(rng, base, rng.randint(0, 5)))) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(ngram_join.linked(docs)) == expected(rows)


def test_near_members_are_all_pairs_that_may_hold():
    rng = np.random.default_rng(9)
    base = np.unique(rng.integers(0, 1 << 63, 90).astype(np.uint64))
    sets = [np.unique(np.concatenate([rng.permutation(base)[: rng.integers(40, 90)], rng.integers(0, 1 << 63, 9).astype(np.uint64)])) for _ in range(40)]
    members = [(i, i % 5, len(x), ngram_join.sketch(x).tobytes(), 0) for i, x in enumerate(sets)]
    got = set(ngram_join.near_members(members, 0.75))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(np.intersect1d(a, b))
            if i % 5 != j % 5 and both >= 0.75 * (len(a) + len(b) - both):
                assert (i, j) in got
    assert all(i > j and i % 5 != j % 5 for i, j in got)
    sides = [(*m[:4], i % 2) for i, m in enumerate(members)]
    assert {p for p in got if p[0] % 2 != p[1] % 2} == set(ngram_join.near_members(sides, 0.75))


def test_ids_at_the_lower_end_are_linked(spark):
    rng = random.Random(10)
    base = [f"w{i}" for i in range(200)]
    low = -(1 << 63)
    rows = [(low + i, " ".join(edited(rng, base, 2))) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(ngram_join.linked(docs)) == expected(rows)
    assert {r["component_id"] for r in ngram_join.linked(docs).collect()} == {low}


def test_a_member_meets_the_leaders_it_shares_most_with(spark):
    shared = [(9, 1)] * 3 + [(9, 2)] + [(9, 3)] * 2 + [(8, 4)] * 2 + [(8, 1)] * 2 + [(8, 2)] * 2
    got = ngram_join.most_shared(spark.createDataFrame(shared, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == [(8, 1), (8, 2), (9, 1), (9, 3)]


def test_few_documents_lead_many_buckets(spark):
    """60 buckets, each of 40 out of 50 members that are no copies of each other."""
    rng = random.Random(11)
    live = [(key, i, i) for key in range(60) for i in rng.sample(range(50), 40)]
    pairs = ngram_join.led_pairs(spark.createDataFrame(live, "key long, id long, root long"), 1).collect()
    assert all(r.a > r.b for r in pairs) and len(set(pairs)) == len(pairs)
    assert {x for r in pairs for x in r} == set(range(50))
    assert len(pairs) <= ngram_join.LEADERS * 50


def test_pieces_with_the_same_members_are_one_bucket(spark):
    rng = random.Random(12)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(300))) for i in range(6)]
    rows += [(10 + i, text + " end") for i, text in rows[:3]] + [(20, rows[0][1] + " other end"), (20, rows[0][1] + " third end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    tables = (np.zeros(ngram_join.COUNTERS, np.uint8), np.zeros(ngram_join.COUNTERS, bool))
    got = ngram_join.buckets(docs, tables, 0.75).collect()
    members = {}
    for r in got:
        members.setdefault(r.key, set()).add(r.id)
        assert r.low == min(x.id for x in got if x.key == r.key)
    assert sum(r.pieces for r in got) > 300 and len(got) <= 24  # before: a row per piece and member
    assert {1, 11} in members.values() and {0, 10, 20} in members.values()


def test_buckets_that_are_nearly_alike_are_one(spark):
    """60 buckets, each of 40 out of 50 members, and two that have but their smallest member in common."""
    rng = random.Random(13)
    held = {key: rng.sample(range(50), 40) for key in range(60)} | {100: [100, *range(110, 140)], 101: [100, *range(140, 170)]}
    rows = [(key, i, min(ids), 2, len(ids)) for key, ids in held.items() for i in ids]
    got = ngram_join.joined_buckets(spark.createDataFrame(rows, "key long, id long, low long, pieces long, members long")).collect()
    members = {}
    for r in got:
        members.setdefault(r.key, set()).add(r.id)
        assert r.low == min(x.id for x in got if x.key == r.key)
    assert all(any(set(ids) <= x for x in members.values()) for ids in held.values())  # no pair is lost
    assert sum(r.pieces for r in got) == 2 * len(rows)
    assert set(held[100]) in members.values() and set(held[101]) in members.values()
    assert len(got) < 400 < len(rows) and sum(len(x) ** 2 for x in members.values()) <= sum(len(x) ** 2 for x in held.values())


def test_bucket_members_beyond_several_turns(spark):
    """What a turn leaves is looked for in what the turn before left."""
    live = spark.createDataFrame([(1, 1, 5), (1, 2, 5), (2, 2, 1), (2, 3, 1)], "key long, id long, pieces long")
    found = spark.createDataFrame([(1, 1), (2, 1)], "node long, root long")
    assert sorted(map(tuple, ngram_join.spanning(live, found).select("key", "id", "pieces", "root").collect())) == [(2, 2, 1, 1), (2, 3, 1, 3)]
    assert "LeftSemi" not in ngram_join.spanning(live, found)._jdf.queryExecution().toString()


def test_first_pieces_are_those_of_a_full_sort():
    rng = np.random.default_rng(13)
    for n in (1, 3, 40, 900):
        own = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        rank = rng.integers(0, 5, len(own)).astype(np.int64)
        want = []
        for band, d in ngram_join.bands(len(own)):
            keys, order = ngram_join.pieces(own, rank, band)
            keys = keys[np.lexsort((keys, order))[: d + 1]]
            want += [*keys.tolist(), *ngram_join.empty_pieces(own, band, d + 1 - len(keys)).tolist()]
        assert sorted(ngram_join.keys_of(own, rank).tolist()) == sorted(want)


def test_texts_cross_in_small_batches(spark, odd):
    knob = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(knob)
    try:
        for given, then in (("10000", "1000"), ("0", "1000"), ("50", "50")):
            spark.conf.set(knob, given)
            ngram_join.linked(odd)
            assert spark.conf.get(knob) == then
    finally:
        spark.conf.set(knob, before)


@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_word_hashes_follow_the_words(monkeypatch, block):
    monkeypatch.setattr(common, "HASHED_BYTES", block)
    rng = random.Random(14)
    texts = ["", " ", "a", "Ab aB\tAB\x0bab\x0c\x0dé É \x1f x\x00 \x85y", "x" * 3000 + " " + "x" * 2999, "\ud800 a"]
    texts += ["".join(rng.choice("abAB \n") for _ in range(rng.randrange(60))) for _ in range(300)]
    of = {}
    for text in texts:
        words, hashes = common.words_of(text), common.word_hashes(text).tolist()
        assert len(words) == len(hashes)
        for word, value in zip(words, hashes):
            assert of.setdefault(word, value) == value
    assert len(set(of.values())) == len(of)
    assert len(common.word_hashes(None)) == 0
