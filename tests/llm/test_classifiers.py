import binascii

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableferry.llm import language, quality, toxicity
from tableferry.llm.common import table

SF = "/root/testdata/sf0.01"


def is_held_out(doc_id):
    return doc_id is not None and binascii.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SF, "labels")


def test_quality_on_held_out_documents(docs, labels):
    scored = quality.score(docs, quality.fit(docs, labels))
    assert scored.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = scored.join(labels, "doc_id").collect()
    assert all(r["held_out"] == is_held_out(r["doc_id"]) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    unseen = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == r["quality"] for r in unseen]) > 0.9


def test_toxicity_on_held_out_documents(docs, labels):
    chain = toxicity.fit(docs, labels)
    assert chain.names[-1] == "toxic" and len(chain.models) == 3
    rows = [r for r in toxicity.score(docs, chain).join(labels, "doc_id").collect() if r["held_out"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    assert np.mean(clean) < 0.02
    words = {w.encode() for group in toxicity.CATEGORY_WORDS.values() for w in group}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    plain = [r["predicted"] for r in rows if r["toxic"] and len(toxicity.word_set(texts[r["doc_id"]]) & words) > 1]
    assert plain and np.mean(plain) > 0.9


def test_language_on_held_out_documents(docs):
    rows = language.predict(docs, language.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    unseen = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in unseen]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(odd, some_labels):
    model = quality.fit(odd, some_labels)
    rows = quality.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    by_id = {}
    for r in rows:
        assert by_id.setdefault(r["doc_id"], r["score"]) == pytest.approx(r["score"])
    assert by_id[1] == pytest.approx(by_id[2])
    assert quality.accepted(odd, model).columns == odd.columns

    rows = toxicity.score(odd, toxicity.fit(odd, some_labels)).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)

    rows = language.predict(odd, language.fit(odd)).collect()
    assert len(rows) == odd.count()
    known = {r["doc_id"]: r["lang_pred"] for r in rows}
    assert known[1] == known[2] == known[3] == known[8] == "und"
    assert known[4] != "und" and known[7] != "und"
    assert {r["score"] for r in rows if r["lang_pred"] == "und"} == {0.0}


def test_nothing_to_learn_from(odd, none, some_labels):
    no_labels = some_labels.limit(0)
    assert {r["score"] for r in quality.score(odd, quality.fit(odd, no_labels)).collect()} == {0.5}
    assert {r["predicted"] for r in toxicity.score(odd, toxicity.fit(odd, no_labels)).collect()} == {0}
    assert language.fit(none) is None
    assert {r["lang_pred"] for r in language.predict(odd, None).collect()} == {"und"}
    assert quality.score(none, quality.fit(none, some_labels)).count() == 0
    assert toxicity.score(none, toxicity.fit(none, some_labels)).count() == 0
    assert language.predict(none, language.fit(odd)).count() == 0


def test_held_out_rows_never_change_a_fit(spark, docs, labels):
    from pyspark.sql import functions as F

    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = quality.fit(docs, labels), quality.fit(docs, turned)
    assert all((one.parts[k] == two.parts[k]).all() for k in one.parts)
    other = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    one, two = language.fit(docs), language.fit(other)
    assert one.langs == two.langs and np.allclose(one.centers, two.centers)


def test_passages_cover_the_whole_text():
    text = "ab " * 2000 + "\n\nx\n" + "é" * 900
    rows = quality.passages(text)
    assert np.expm1(rows[:, -1]).sum() == pytest.approx(len(text.encode()), rel=1e-3)
    assert len(rows) >= 8


def test_attention_gradient_learns_one_bad_passage():
    rng = np.random.default_rng(1)
    bags, y = [], []
    for i in range(300):
        rows = rng.normal(0, 1, (rng.integers(2, 9), quality.WIDTH)).astype(np.float32)
        if i % 2:
            rows[rng.integers(len(rows)), :4] += 6
        bags.append(rows)
        y.append(float(i % 2))
    model = quality.train(bags, np.array(y), epochs=25)
    sizes = np.array([len(b) for b in bags])
    scores = model.score(np.concatenate(bags), np.cumsum(sizes) - sizes)
    assert np.mean((scores > 0.5) == (np.array(y) > 0.5)) > 0.95


def test_chain_feeds_earlier_probabilities():
    rng = np.random.default_rng(2)
    x = (rng.random((400, 3)) < 0.3).astype(float)
    first = x[:, 0]
    second = np.maximum(x[:, 0], x[:, 1])
    chain = toxicity.train([b"a", b"b", b"c"], ["one", "two"], x, np.column_stack([first, second]))
    assert len(chain.models[1].weights) == 3 + 1 + 1
    assert ((chain(x)[:, 1] > 0.5) == (second > 0.5)).all()


def test_spherical_centres_are_units():
    rng = np.random.default_rng(3)
    points = rng.random((50, 8))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centres, own = language.spherical(points, 3)
    assert np.allclose(np.linalg.norm(centres, axis=1), 1) and set(own) <= {0, 1, 2}


def test_a_document_on_most_rows_leaves_room_for_rare_languages(spark):
    ids = spark.range(1, 50_000).where(~language.held_out(F.col("id")))
    often = ids.orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 20))).first()["id"]
    rows = [(often, "the quick brown fox jumps over the dog", "en")] * 3000
    rows += [(100_000 + i, f"le petit renard numero {i} saute par dessus le chien", "fr") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one, two = language.fit(docs.coalesce(1), bound=40), language.fit(docs.repartition(5), bound=40)
    assert set(one.langs) == {"en", "fr"} and one.langs == two.langs
    assert np.array_equal(one.centers, two.centers)


def test_scores_of_many_short_lines_and_of_long_texts_are_those_of_the_whole(monkeypatch):
    """A megabyte of line breaks is a million passages; they are never held together."""
    rng = np.random.default_rng(4)
    bags = [rng.normal(0, 1, (3, quality.WIDTH)).astype(np.float32) for _ in range(40)]
    model = quality.train(bags, np.arange(40) % 2.0, epochs=2)
    texts = ["\n" * 20_000, "some words\n" * 7_000, "x" * 200_000, None, "short", "é line\n\n" * 2_000 + "end" * 30_000]
    plain = [model.score(quality.passages(t), np.array([0]))[0] for t in texts]
    assert np.allclose(quality.scores_of(model, texts), plain, atol=1e-6)
    held = []
    monkeypatch.setattr(quality, "features", lambda raw: held.append(len(raw)) or np.zeros((max(1, len(raw)), quality.WIDTH), np.float32))
    quality.scores_of(model, ["\n" * 1_000_000])
    assert sum(held) == 1_000_000 and max(held) <= quality.BLOCK_BYTES


def test_attention_by_a_plain_loop():
    """The model's scores, passage by passage in plain Python."""
    import math

    rng = np.random.default_rng(5)
    bags = [rng.normal(0, 2, (int(rng.integers(1, 6)), quality.WIDTH)).astype(np.float32) for _ in range(60)]
    model = quality.train(bags, np.arange(60) % 2.0, epochs=3)
    p = model.parts
    sigmoid = lambda v: 1 / (1 + math.exp(-max(-30, min(30, v))))

    def loop(bag):
        encoded, weights = [], []
        for row in bag:
            x = [max(-6, min(6, (float(v) - m) / s)) for v, m, s in zip(row, model.mean, model.scale)]
            e = [math.tanh(sum(x[i] * p["We"][i, j] for i in range(len(x))) + p["be"][j]) for j in range(len(p["be"]))]
            gate = [
                math.tanh(sum(e[i] * p["V"][i, j] for i in range(len(e)))) * sigmoid(sum(e[i] * p["U"][i, j] for i in range(len(e))))
                for j in range(len(p["w"]))
            ]
            encoded.append(e)
            weights.append(math.exp(sum(g * w for g, w in zip(gate, p["w"]))))
        total = sum(weights)
        z = [sum(w * e[j] for w, e in zip(weights, encoded)) / total for j in range(len(p["c"]))]
        return sigmoid(sum(a * b for a, b in zip(z, p["c"])) + p["c0"][0])

    for bag in bags[:10]:
        assert model.score(bag, np.array([0]))[0] == pytest.approx(loop(bag), abs=1e-6)
        assert model.score_long([bag[:1], bag[1:]] if len(bag) > 1 else [bag]) == pytest.approx(loop(bag), abs=1e-6)


def test_a_sample_is_bounded_in_rows(spark):
    """A labelled document that stands on very many rows counts once."""
    from tableferry.llm.samples import labelled_sample

    docs = spark.range(5_000).select(F.lit(1).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
    docs = docs.unionAll(spark.range(2, 40).select("id", F.lit("text")))
    labels = spark.range(1, 40).select(F.col("id").alias("doc_id"), F.lit(1).alias("label"))
    one = labelled_sample(docs, labels, 100).collect()
    assert len(one) == len({r["doc_id"] for r in one}) <= 100
    assert sorted(map(tuple, one)) == sorted(map(tuple, labelled_sample(docs.repartition(7), labels, 100).collect()))


@pytest.mark.parametrize("text", ["² ½ ① Ⅷ", "12 ٣ !?", "\u0301 \u20dd", "_ __"])
def test_numbers_and_marks_are_no_letters(spark, odd, text):
    docs = spark.createDataFrame([(1, text, None)], "doc_id long, text string, lang string")
    assert language.predict(docs, language.fit(odd)).first()["lang_pred"] == "und"
