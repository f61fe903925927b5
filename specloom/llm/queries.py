"""Registered queries of the operators: each applies one to its whole table and derives the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from specloom.llm import bpe, chat, collocations, embeddings, exact_dedup, hnsw, licenses, negatives, packing, pii, simhash, suffixes, toxicity
from specloom.llm.common import table


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.digests(chat.format_chats(rows))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op6_pii_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_bytes(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), anchors=F.col("vec_id") % 50 == 0)


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), queries=F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (
    op1_embedding_near_dedup, op2_exact_dedup, op3_license_scan, op4_chat_format, op5_simhash_near_dedup, op6_pii_sanitise,
    op7_byte_bpe, op8_toxicity, op9_packing, op10_suffix_dedup, op11_collocations, op12_hard_negatives,
    op13_nearest_neighbours)}

ORACLES = {
    # every pair, so this also shows that no link is missed
    "op1_embedding_near_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
          l AS (SELECT a.vec_id AS s, b.vec_id AS d FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            AND list_cosine_similarity(a.e, b.e) >= 0.95),
          r(node, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.d, r.c FROM r JOIN l ON l.s = r.node)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM (SELECT node AS vec_id, min(c) AS component_id FROM r GROUP BY node) AS m
        LEFT JOIN (SELECT s AS vec_id, count(*) AS n FROM l GROUP BY s) AS k USING (vec_id)""",
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op4_chat_format": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -1, x.t, x.r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(t, r)),
        e AS (SELECT *, regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g') AS role_out, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS text_out FROM c)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
          CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
          CAST(sum(length('<|im_start|><|im_sep|><|im_end|>') + length(role_out) + length(text_out)) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op11_collocations": r"""
        WITH w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS ws
            FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents) AS p),
          f AS (SELECT lang, phrase, k, count(*) AS f FROM (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2),
              lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase FROM w, (VALUES (1), (2), (3), (4)) AS s(k)) AS g GROUP BY ALL),
          c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= 30),
          cut AS (SELECT lang, phrase, a, j, array_to_string(ws[1:j], ' ') AS x, array_to_string(ws[j + 1:k], ' ') AS y
            FROM (SELECT *, unnest(range(1, k)) AS j FROM c) AS e),
          s AS (SELECT cut.lang, cut.phrase, a, l.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (l.f + r.f) AS BIGINT) AS score
            FROM cut JOIN f AS l ON l.lang = cut.lang AND l.phrase = x JOIN f AS r ON r.lang = cut.lang AND r.phrase = y
            QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY CAST(2000000 AS HUGEINT) * a // (l.f + r.f), j) = 1),
          inner_ AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS longer
            FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c) AS e) AS e GROUP BY ALL)
        SELECT s.lang, row_number() OVER o AS rank, s.phrase, a, l, r, n, score
        FROM s JOIN (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang) AS t ON t.lang = s.lang
        LEFT JOIN inner_ ON inner_.lang = s.lang AND inner_.phrase = s.phrase WHERE longer IS NULL OR 100 * longer < 80 * a
        WINDOW o AS (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) QUALIFY row_number() OVER o <= 2000""",
    "op12_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
          c AS (SELECT vec_id, label, unnest(e) AS x, unnest(range(len(e))) AS i FROM v),
          s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(sum(a.x * b.x) AS BIGINT) AS score
            FROM c AS a JOIN c AS b ON a.i = b.i AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 GROUP BY ALL),
          p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) QUALIFY row_number() OVER w <= 3""",
    # exact search, so this also shows what the graphs miss
    "op13_nearest_neighbours": """
        WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0)
        SELECT q.vec_id AS query_id, CAST(row_number() OVER w AS INTEGER) AS rank, c.vec_id, list_distance(q.e, c.e) AS score
        FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0
        WINDOW w AS (PARTITION BY q.vec_id ORDER BY list_distance(q.e, c.e), c.vec_id) QUALIFY row_number() OVER w <= 10""",
}
