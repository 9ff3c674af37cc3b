"""The registered queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from paperloom.llm import balltree, bpe, html_crf, line_rules, mil_quality, packing, periodic_runs, simhash, source_divergence, token_rollup, token_store, toxicity, url_filter
from paperloom.llm.common import scratch, table

#: Where the public vocabularies are, if not at the installed package's own place.
TOKENIZERS = os.environ.get("PAPERLOOM_TOKENIZERS")


def vocabulary(name: str) -> str:
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = token_store.store_and_read(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "frames")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mil_quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.verdicts(table(spark, sf_dir, "documents"))


def op5_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.top_k(table(spark, sf_dir, "embeddings")).select("query_id", "rank", "vec_id", "score")


def op6_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract(table(spark, sf_dir, "pages"))


def op7_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.grade_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op9_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = (vocabulary("word_bpe_49k.json"), "word_bpe_49k"), (vocabulary("byte_bpe_50k.json"), "byte_bpe_50k")
    return token_rollup.maintained_totals(table(spark, sf_dir, "documents"), scratch(spark, "token-rollup"), old, new)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets by temperature: each source's tokens to the power of 0.7."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0, power=0.7)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.find(table(spark, sf_dir, "documents"), edited=periodic_runs.planted))


#: The rules of ``op13_url_filter`` as (verdict, host, path).
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), [url_filter.Rule(*r) for r in URL_RULES])


QUERIES = {f.__name__: f for f in (op1_token_store, op2_simhash, op3_attention_quality, op4_line_frequency, op5_ball_tree, op6_html_crf, op7_ordinal_toxicity, op8_rank_bpe, op9_token_rollup, op10_packing, op11_source_divergence, op12_periodic_runs, op13_url_filter)}

ORACLE = {
    "op4_line_frequency": r"""
        WITH d AS (
            SELECT doc_id, source, coalesce(text, '') AS text, coalesce('id ' || doc_id, coalesce(text, '')) AS document,
                   list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS w,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '[ \t\n\x0B\f\r]+', '', 'g') <> '') AS l
            FROM documents
        ),
        g AS (
            SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c
            FROM (
                SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
                FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM (SELECT row_number() OVER () AS r, w FROM d))
            )
        ),
        numbered AS (SELECT row_number() OVER () AS r, * FROM d),
        repeats AS (
            SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM g WHERE c > 1) GROUP BY r
        ),
        norm AS (
            SELECT r, source, document, x AS line,
                   regexp_replace(lower(x), '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g') AS n
            FROM (SELECT r, source, document, unnest(l) AS x FROM numbered)
        ),
        hosts AS (SELECT source, count(DISTINCT document) AS docs FROM d GROUP BY source),
        flagged AS (
            SELECT source, n FROM (SELECT source, n, count(DISTINCT document) AS c FROM norm GROUP BY source, n)
            JOIN hosts USING (source) WHERE c > 20 AND c > docs * 0.05
        ),
        lost AS (
            SELECT r, sum(len(list_filter(string_split_regex(line, '[ \t\n\x0B\f\r]+'), lambda w: w <> ''))) AS n
            FROM norm JOIN flagged USING (source, n) GROUP BY r
        ),
        m AS (
            SELECT doc_id, len(w)::BIGINT AS n_words,
                   length(regexp_replace(text, '[ \t\n\x0B\f\r]+', '', 'g'))::BIGINT AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                   (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
                   coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
                   coalesce(lost.n, 0)::BIGINT AS n_removed_words
            FROM numbered LEFT JOIN repeats USING (r) LEFT JOIN lost USING (r)
        )
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
               AND NOT (n_removed_words > 0 AND (n_words - n_removed_words < 50 OR n_words - n_removed_words < 0.5 * n_words)) AS kept
        FROM m
    """,
    "op5_ball_tree": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
    """,
    "op11_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t
            FROM documents
        ),
        o AS (SELECT r, lang, source, unnest(t) AS term FROM d),
        kept AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
        g AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY lang, source, term),
        cell AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
        v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        p AS (
            SELECT lang, source, term, n,
                   1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p
            FROM cell JOIN v USING (lang)
        ),
        whole AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term),
        q AS (
            SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
            FROM whole JOIN v USING (lang)
        ),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
        ),
        both_parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0)::BIGINT AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, value, rank::INTEGER AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts)
        WHERE part = 'pair' OR rank <= 10
    """,
}
