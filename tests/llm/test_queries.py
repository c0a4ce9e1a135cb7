"""Every query of the subpackage: against its SQL where there is one; the pipeline's stages."""

import os

import duckdb
import pytest

import corpus_pipeline
from tableferry.llm import decontaminate, quality
from tableferry.llm.common import table
from tableferry.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def plain(frame):
    return sorted((tuple(None if x != x else x for x in row) for row in frame.astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{SF}/{file}'")
    want = con.execute(SQL[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    fixed = lambda f: sorted(map(str, f[columns].convert_dtypes().astype(str).replace({"nan": "<NA>", "None": "<NA>"}).values.tolist()))
    assert fixed(got) == fixed(want)


def test_there_is_a_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages_by_brute_force(spark):
    """Every stage's rows follow from its own input by the operators' plain definitions."""
    docs = table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "ngram_jaccard_join", "decontamination", "bpe"]
    labels, bench = table(spark, SF, "labels"), table(spark, SF, "benchmark")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        after = stage(spark, docs, SF)
        kept = {r["doc_id"] for r in after.collect()}
        if k == 0:
            scores = quality.score(docs, quality.fit(docs, labels)).collect()
            want = {r["doc_id"] for r in scores if r["predicted"] == 1}
        elif k == 1:
            last = {}
            for i, r in before.items():
                text = "".join(c.lower() if c.isascii() else c for c in r["text"] or "")
                last[text] = max(i, last.get(text, i))
            want = set(last.values())
        elif k == 2:
            from tests.llm.test_ngram_join import expected

            want = {c for _, _, c in expected([(i, r["text"]) for i, r in before.items()])}
        elif k == 3:
            from tests.llm.test_decontaminate import edits

            items = [decontaminate.normal(r["text"]) for r in bench.collect()]
            hit = {r["doc_id"] for r in decontaminate.hits(docs, bench).collect()}
            want = set(before) - hit
            # What goes holds an item; what stays holds none, not even whole.
            for i in sorted(hit)[:1]:
                text = decontaminate.normal(before[i]["text"])
                assert any(edits(x, text) <= int(0.1 * len(x) + 1e-9) for x in items)
            assert not any(x in decontaminate.normal(before[i]["text"]) for i in want for x in items)
        else:
            want = set(before)
            assert sorted(after.columns) == ["decoded_sha256", "doc_id", "ids_sha256", "n_tokens"]
        assert kept == want
        if k < 4:
            assert after.columns == docs.columns
            docs = after


def test_pipeline_stages_take_odd_rows(spark, odd, none):
    for given in (odd, none.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, given, SF)
            assert out.columns == given.columns and out.count() <= given.count()
        assert corpus_pipeline.STAGES[-1][1](spark, given, SF).count() == given.count()

