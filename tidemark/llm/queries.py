"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import auction, chosen, decon, gnat, grace, jump, langid, mix, pii, rans, superkmer, vertical, viterbi
from tidemark.llm.scratch import table


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return superkmer.report(table(spark, folder, "documents"), size=13)


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix.report(table(spark, folder, "documents"))


def op3_rans_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return rans.report(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return chosen.report(table(spark, folder, "documents"))


def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return grace.dedup(table(spark, folder, "documents"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.report(table(spark, folder, "documents"))


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decon.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"), span=10)


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    pieces = viterbi.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return viterbi.with_counts(table(spark, folder, "documents"), pieces)


def op10_jump_shards(spark: SparkSession, folder: str) -> DataFrame:
    return jump.shard_documents(table(spark, folder, "documents"), shards=8)


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    return auction.report(auction.damaged(turns), turns)


def op12_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return vertical.components_of(table(spark, folder, "documents"), shingle=3, percent=90)


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = gnat.prepared(table(spark, folder, "embeddings"), label)
    found = gnat.hard_negatives(vectors, F.col("vec_id") % 50 == 0)
    return found.withColumn("rank", F.col("rank").cast("int"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_mix_sources": op2_mix_sources,
    "op3_rans_tokens": op3_rans_tokens,
    "op4_near_dedup": op4_near_dedup,
    "op5_pii": op5_pii,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_language_id": op7_language_id,
    "op8_decontaminate": op8_decontaminate,
    "op9_token_counts": op9_token_counts,
    "op10_jump_shards": op10_jump_shards,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_ngram_join": op12_ngram_join,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE = {
    "op1_substring_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        places AS (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d WHERE len(ws) >= 13),
        windows AS (SELECT r, doc_id, i, array_to_string(ws[i:i + 12], ' ') AS win FROM places),
        earliest AS (SELECT win, min(doc_id) AS least FROM windows GROUP BY win),
        gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM windows JOIN earliest USING (win) WHERE least < doc_id),
        words AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
        kept AS (SELECT words.r, count(gone.p) AS n_removed,
                        string_agg(word, ' ' ORDER BY words.p) FILTER (WHERE gone.p IS NULL) AS kept
                 FROM words LEFT JOIN gone ON gone.r = words.r AND gone.p = words.p GROUP BY words.r)
        SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN kept ON kept.r = d.r""",
    "op2_mix_sources": mix.report_sql(),
    "op4_near_dedup": r"""
        WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        places AS (SELECT r, ws, least(5, len(ws)) AS n, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS i
                   FROM d WHERE len(ws) > 0),
        sets AS (SELECT DISTINCT r, array_to_string(ws[i:i + n - 1], ' ') AS shingle FROM places),
        sizes AS (SELECT r, count(*) AS n FROM sets GROUP BY r),
        shared AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.r <> y.r
                   GROUP BY x.r, y.r),
        links AS (SELECT a, b FROM shared JOIN sizes p ON p.r = a JOIN sizes q ON q.r = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
        reach AS (SELECT r, r AS other FROM d UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.other)
        SELECT d.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(o.doc_id) AS component_id,
               d.doc_id = min(o.doc_id) AS kept
        FROM d JOIN reach ON reach.r = d.r JOIN d o ON o.r = reach.other LEFT JOIN sizes ON sizes.r = d.r
        GROUP BY d.r, d.doc_id""",
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op8_decontaminate": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
                   FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
              FROM benchmark),
        item_places AS (SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i
                        FROM b WHERE len(ws) > 0),
        item_windows AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS win FROM item_places),
        places AS (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
                   FROM d, (SELECT DISTINCT n FROM item_windows) WHERE len(ws) >= n),
        hits AS (SELECT r, i, w.n, item_id FROM (SELECT r, i, n, array_to_string(ws[i:i + n - 1], ' ') AS win FROM places) p
                 JOIN item_windows w ON w.n = p.n AND w.win = p.win),
        covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
        listed AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                   FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
        SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered ON covered.r = d.r LEFT JOIN listed ON listed.r = d.r""",
    "op12_ngram_join": r"""
        WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        places AS (SELECT r, ws, least(3, len(ws)) AS n, unnest(range(1, len(ws) - least(3, len(ws)) + 2)) AS i
                   FROM d WHERE len(ws) > 0),
        sets AS (SELECT DISTINCT r, array_to_string(ws[i:i + n - 1], ' ') AS shingle FROM places),
        sizes AS (SELECT r, count(*) AS n, sha256(string_agg(shingle, chr(10) ORDER BY shingle)) AS class FROM sets GROUP BY r),
        shared AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.r <> y.r
                   GROUP BY x.r, y.r),
        links AS (SELECT a, b, p.class AS own, q.class AS other FROM shared JOIN sizes p ON p.r = a JOIN sizes q ON q.r = b
                  WHERE 100 * c >= 90 * (p.n + q.n - c)),
        counts AS (SELECT a, count(DISTINCT other) AS n FROM links WHERE own <> other GROUP BY a),
        reach AS (SELECT r, r AS other FROM d UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.other)
        SELECT d.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(o.doc_id) AS component_id,
               coalesce(any_value(counts.n), 0) AS n_links
        FROM d JOIN reach ON reach.r = d.r JOIN d o ON o.r = reach.other LEFT JOIN sizes ON sizes.r = d.r
             LEFT JOIN counts ON counts.a = d.r
        GROUP BY d.r, d.doc_id""",
    "op13_hard_negatives": """
        WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
                   FROM embeddings WHERE label IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))),
        scored AS (SELECT a.vec_id AS anchor_id, e.vec_id AS other, a.label = e.label AS same,
                          list_dot_product(a.v, e.v)::BIGINT AS score
                   FROM e a JOIN e ON e.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0),
        positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
                      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
        SELECT anchor_id, positive_id,
               (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INTEGER AS rank,
               other AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY rank <= 3""",
}
