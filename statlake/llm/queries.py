"""Registered queries of the numbered operators: thin calls over the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.llm import decontam, language, licenses, lm, merkle, negatives, packing, quality, simhash, sql, substring, topk, toxicity, warc
from statlake.registered.base import Registry

REGISTRY = Registry()


@REGISTRY.add("op1_latent_decontamination")
def op1_latent_decontamination(t):
    return decontam.contaminated(t.documents, t.benchmark).drop("version")


@REGISTRY.add("op2_quality_discriminant")
def op2_quality_discriminant(t):
    return quality.classify(t.documents, t.labels)


@REGISTRY.add(
    "op3_pivot_top_k",
    """
    WITH v AS (
        SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) for x in embedding] AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM s QUALIFY rank <= 20
    """,
)
def op3_pivot_top_k(t):
    return topk.top_k(t.embeddings)


@REGISTRY.add(
    "op5_warc_round_trip",
    """
    WITH p AS (
        SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
               sha1(coalesce(html, '')) AS payload_digest
        FROM pages
    ), g AS (
        SELECT payload_digest, payload_bytes, max(page_id) AS original
        FROM p WHERE payload_bytes >= 1000 GROUP BY ALL
    )
    SELECT p.page_id, p.payload_bytes, p.payload_digest,
           CASE WHEN g.original > p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN g.original > p.page_id THEN g.original END AS refers_to
    FROM p LEFT JOIN g USING (payload_digest, payload_bytes)
    """,
)
def op5_warc_round_trip(t):
    return warc.round_trip(t.pages)


@REGISTRY.add("op9_toxicity_counterfactual")
def op9_toxicity_counterfactual(t):
    return toxicity.classify(t.documents, t.labels)


@REGISTRY.add("op4_simhash_vantage_trees")
def op4_simhash_vantage_trees(t):
    return simhash.near_duplicates(t.documents)


@REGISTRY.add("op7_exact_complement_packing")
def op7_exact_complement_packing(t):
    return packing.pack(t.documents)


@REGISTRY.add(
    "op6_prefix_suffix_trees",
    r"""
    WITH w AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
    ), windows AS (
        SELECT doc_id, i, array_to_string(words[i : i + 49], ' ') AS content
        FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS i FROM w)
    ), hits AS (
        SELECT doc_id, i FROM windows JOIN (SELECT content, min(doc_id) AS least FROM windows GROUP BY content) USING (content)
        WHERE least < doc_id
    ), gone AS (
        SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS place FROM hits
    ), kept AS (
        SELECT doc_id, word, place FROM (SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS place FROM w)
        ANTI JOIN gone USING (doc_id, place)
    ), texts AS (
        SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text FROM kept GROUP BY doc_id
    )
    SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
        sha256(coalesce(text, '')) AS kept_sha256
    FROM w LEFT JOIN texts USING (doc_id)
    """,
)
def op6_prefix_suffix_trees(t):
    return substring.digests(t.documents)


@REGISTRY.add("op8_byte_gru_language")
def op8_byte_gru_language(t):
    return language.identify(t.documents)


@REGISTRY.add("op10_log_bilinear_scores")
def op10_log_bilinear_scores(t):
    return lm.score(t.documents)


@REGISTRY.add("op11_merkle_manifest", sql.merkle())
def op11_merkle_manifest(t):
    return merkle.verified(t.documents, merkle.every_third_lowered())


@REGISTRY.add(
    "op12_shared_list_negatives",
    """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    ), s AS (
        SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
        FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0
    ), p AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
        vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10
    """,
)
def op12_shared_list_negatives(t):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(t.embeddings.withColumn("label", label))


@REGISTRY.add("op13_positional_licenses", sql.licenses())
def op13_positional_licenses(t):
    return licenses.report(t.documents)
