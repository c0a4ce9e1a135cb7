"""One query per operator over its whole table, and the SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers

from tableferry.llm import alignment, bpe, decontaminate, exact_dedup, language, licenses, ngram_join
from tableferry.llm import packing, quality, spelling, substrings, toxicity, warc
from tableferry.llm.common import table


def op1_license_scan(spark, sf_dir):
    """The license of every document, its own or that of the nearest directory."""
    return licenses.scan(licenses.paths(table(spark, sf_dir, "documents")))


def op2_decontaminate(spark, sf_dir):
    """Documents that hold a benchmark item within its error budget."""
    return decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_ngram_join(spark, sf_dir):
    """Every document with its number of shingles and its component of near copies."""
    return ngram_join.linked(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark, sf_dir):
    """Every document with the owner of its text: the largest doc_id of equal texts."""
    return exact_dedup.assign(table(spark, sf_dir, "documents"), keep="largest")


def op5_toxicity(spark, sf_dir):
    """Toxicity of every document, with the probability of each category of the chain."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_substring_dedup(spark, sf_dir):
    """Passages of at least 50 words that repeat, nearly or exactly, in other documents."""
    return substrings.passages(table(spark, sf_dir, "documents"))


def op7_bpe(spark, sf_dir):
    """Token count and digests of the ids and of the decoded text of every document."""
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_language_id(spark, sf_dir):
    """The predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


def op9_quality(spark, sf_dir):
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op10_warc(spark, sf_dir):
    """Every page as read back from normalised WARC archives."""
    return warc.archived(table(spark, sf_dir, "pages"))


def op11_spelling_variants(spark, sf_dir):
    """Every frequent word with the near word that is its form, and the root of that chain."""
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_best_fit_packing(spark, sf_dir):
    """Every piece of every document with its place in a training sequence of 2048 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_cross_alignment(spark, sf_dir):
    """How the tokens of two tokenizers group and link in every document."""
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.linked(table(spark, sf_dir, "documents"), *paths)


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_decontaminate": op2_decontaminate,
    "op3_ngram_join": op3_ngram_join,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_bpe": op7_bpe,
    "op8_language_id": op8_language_id,
    "op9_quality": op9_quality,
    "op10_warc": op10_warc,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_cross_alignment": op13_cross_alignment,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op4_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, {_LOWER} AS t FROM documents)
        WINDOW w AS (PARTITION BY t)
    """,
    "op10_warc": """
        SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha256(h) AS payload_digest,
               CASE WHEN octet_length(encode(h)) >= 100 AND page_id > min(page_id) OVER w
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN octet_length(encode(h)) >= 100 AND page_id > min(page_id) OVER w
                    THEN min(page_id) OVER w END AS refers_to
        FROM (SELECT page_id, coalesce(html, '') AS h FROM pages)
        WINDOW w AS (PARTITION BY h)
    """,
}
