import hashlib
import random

from tableferry.llm import exact_dedup
from tableferry.llm.exact_dedup import Trie, common_length

from tests.llm.conftest import ODD


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def expected(rows, pick):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(lowered(text), []).append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        group = groups[lowered(text)]
        ids = [x for x in group if x is not None]
        keep = pick(ids) if ids else None
        out.append((doc_id, keep, len(group), doc_id == keep, hashlib.sha256(lowered(text).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_odd_rows(odd):
    assert found(exact_dedup.assign(odd, "largest")) == expected(ODD, max)
    assert found(exact_dedup.assign(odd)) == expected(ODD, min)


def test_tries_give_way_at_their_bound(spark):
    random.seed(1)
    rows = [(i, "".join(random.choice("aB") for _ in range(random.randint(0, 12)))) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(exact_dedup.assign(docs, "largest", max_bytes=200)) == expected(rows, max)


def test_empty(none):
    assert exact_dedup.assign(none, "largest").count() == 0
    assert exact_dedup.deduplicated(none).count() == 0


def test_one_row_of_each_group_stays(odd):
    kept = exact_dedup.deduplicated(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == sorted([2, 3, 5, 6, 7, None, 8], key=str)


def test_trie_holds_what_a_dict_holds():
    random.seed(2)
    trie, plain = Trie(min), {}
    for _ in range(4000):
        text = bytes(random.choice(b"ab") for _ in range(random.randint(0, 10)))
        owner = random.choice([None, random.randint(0, 99)])
        trie.insert(text, owner, 1, None)
        last, n = plain.get(text, (None, 0))
        plain[text] = (owner if last is None else last if owner is None else min(last, owner), n + 1)
    assert {t: (o, n) for t, o, n, _ in trie.terminals()} == plain


def test_common_length():
    assert common_length(b"abcd", b"abxd") == 2
    assert common_length(b"", b"a") == 0
    assert common_length(b"abc", b"abc") == 3
