"""Corpus queries with production parameters over whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import conversations, decontaminate, html_text, interpolation, knn, packing, pii, quality, ranked, repeats, sharding, simhash, toxicity
from gridloom.llm.common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents carry no address: the source is the host, the language a path below it."""
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_text.extract_text(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.size(F.split("text", "\n")).alias("n_lines"))


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark")))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = repeats.drop_runs(docs)
    return out.withColumnsRenamed({"_n_lines": "n_lines", "_n_removed": "n_removed"})


def op10_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = knn.integer_vectors(table(spark, sf_dir, "embeddings"))
    return knn.top_k(vectors.filter("id % 100 = 0"), vectors)


def op11_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.score_documents(table(spark, sf_dir, "documents"))


def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.repair_audit(damaged, present=F.col("here"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_html_text": op3_html_text,
    "op4_pack": op4_pack,
    "op5_pii": op5_pii,
    "op6_toxicity": op6_toxicity,
    "op7_shard": op7_shard,
    "op8_decontaminate": op8_decontaminate,
    "op9_line_dedup": op9_line_dedup,
    "op10_knn": op10_knn,
    "op11_lm_score": op11_lm_score,
    "op12_ranked": op12_ranked,
    "op13_repair": op13_repair,
}
ORACLES: dict[str, str] = {
    "op10_knn": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, d.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.x, d.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v d ON q.vec_id <> d.vec_id
            WHERE q.vec_id % 100 = 0
        )
        SELECT query_id,
               CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM scored
        QUALIFY rank <= 10
    """,
    "op12_ranked": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents WHERE text IS NOT NULL
        ), q AS (
            SELECT item_id, term, count(*) AS times
            FROM (SELECT item_id, unnest(regexp_extract_all(
                             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                  FROM (SELECT DISTINCT item_id, text FROM benchmark))
            GROUP BY item_id, term
        ), whole AS (
            SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0
        ), posting AS (
            SELECT r, any_value(doc_id) AS doc_id, term, count(*) AS tf, any_value(n) AS n
            FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
            WHERE term IN (SELECT term FROM q)
            GROUP BY r, term
        ), weight AS (
            SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM posting, whole GROUP BY term, n_docs
        ), scored AS (
            SELECT q.item_id, p.r, any_value(p.doc_id) AS doc_id,
                   CAST(sum(q.times * v.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * p.n * n_docs) // n_terms)))) AS BIGINT) AS score
            FROM q JOIN posting p USING (term) JOIN weight v USING (term), whole
            GROUP BY q.item_id, p.r
        )
        SELECT item_id,
               CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank,
               doc_id, score
        FROM scored WHERE score > 0
        QUALIFY rank <= 20
    """,
    "op13_repair": r"""
        WITH RECURSIVE keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
            FROM conversations
        ), hashed AS (  -- CRC-32, a byte and then its eight bits at a time
            SELECT *, xor(4294967295, list_reduce(
                       list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(k, ''), lambda c: CAST(ord(c) AS BIGINT))),
                       lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda z: CAST(z AS BIGINT))),
                                                lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS kind
            FROM keyed
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM hashed, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copies(c)
            WHERE kind <> 0
        ), ordered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
        ), placed AS (
            SELECT conv_id, turn, role, text, i,
                   CASE WHEN starts_with(role, 's') THEN 's' WHEN starts_with(role, 'u') THEN 'u'
                        WHEN starts_with(role, 'a') THEN 'a' ELSE 'o' END AS init,
                   CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
            FROM ordered
        ), counted AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (i > 1 AND prev || init NOT IN ('su', 'ua', 'au')) AS illegal
            FROM (SELECT *, lag(init) OVER (PARTITION BY conv_id ORDER BY i) AS prev FROM placed)
            GROUP BY conv_id
        ), inserts(q, put, paid, q2) AS (
            VALUES ('0', '', 0, '0'), ('0', 'I', 5, 'u'), ('0', 'II', 10, 'a'), ('s', '', 0, 's'), ('s', 'I', 5, 'u'),
                   ('s', 'II', 10, 'a'), ('u', '', 0, 'u'), ('u', 'I', 5, 'a'), ('a', '', 0, 'a'), ('a', 'I', 5, 'u')
        ), next(q, symbol) AS (VALUES ('0', 's'), ('0', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')
        ), ops AS (  -- of a row that begins with init: letter, cost and the place it leads to
            SELECT q AS q2, init, must, cut, 'D' AS letter, 2 AS price, q AS q3
            FROM (VALUES ('0'), ('s'), ('u'), ('a')) a(q), (VALUES ('s'), ('u'), ('a'), ('o')) b(init),
                 (VALUES (true), (false)) c(must), (VALUES (true), (false)) d(cut)
            UNION ALL
            SELECT q, init, false, cut, CASE WHEN symbol = init THEN 'K' ELSE 'R' END,
                   CASE WHEN symbol = init THEN 0 ELSE 1 END + CASE WHEN cut THEN 5 ELSE 0 END, symbol
            FROM next, (VALUES ('s'), ('u'), ('a'), ('o')) b(init), (VALUES (true), (false)) d(cut)
            WHERE symbol = init OR symbol <> 's'
        ), walk AS (  -- the cheapest, then least way to each place of the grammar's period after i rows
            SELECT conv_id, CAST(0 AS BIGINT) AS i, '0' AS q, '000000000' AS best FROM counted
            UNION ALL
            SELECT w.conv_id, w.i + 1, o.q3,
                   min(lpad(CAST(CAST(left(w.best, 9) AS BIGINT) + s.paid + o.price AS VARCHAR), 9, '0')
                       || substr(w.best, 10) || s.put || o.letter)
            FROM walk w JOIN placed p ON w.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = w.i + 1
            JOIN inserts s ON s.q = w.q
            JOIN ops o ON o.q2 = s.q2 AND o.init = p.init AND o.must = (p.fault IN ('blank', 'duplicate')) AND o.cut = (p.fault = 'truncated')
            GROUP BY w.conv_id, w.i, o.q3
        ), chosen AS (
            SELECT w.conv_id, min(lpad(CAST(CAST(left(w.best, 9) AS BIGINT) + s.paid AS VARCHAR), 9, '0')
                                  || substr(w.best, 10) || s.put) AS best
            FROM walk w JOIN counted c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND c.n = w.i
            JOIN inserts s ON s.q = w.q AND s.q2 IN ('0', 'a')
            GROUP BY w.conv_id
        ), edits AS (
            SELECT conv_id, step, letter,
                   count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY step) AS i,
                   count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id ORDER BY step) AS made,
                   count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id) % 2 AS odd
            FROM (SELECT conv_id, step, substr(best, 9 + step, 1) AS letter
                  FROM chosen, unnest(range(1, length(best) - 8)) AS t(step))
        ), repaired AS (
            SELECT e.conv_id, string_agg(
                CASE WHEN e.letter = 'K' THEN p.role WHEN (e.made - e.odd) % 2 = 1 THEN 'user' ELSE 'assistant' END
                || ':' || CASE WHEN e.letter = 'I' THEN '' ELSE p.text END, chr(10) ORDER BY e.step) AS whole
            FROM edits e LEFT JOIN placed p ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = e.i AND e.letter <> 'I'
            WHERE e.letter <> 'D'
            GROUP BY e.conv_id
        )
        SELECT a.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
               coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal,
               coalesce(CAST(left(b.best, 9) AS BIGINT), 0) AS cost, coalesce(substr(b.best, 10), '') AS audit,
               sha256(coalesce(r.whole, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) a
        LEFT JOIN counted c ON a.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN chosen b ON a.conv_id IS NOT DISTINCT FROM b.conv_id
        LEFT JOIN repaired r ON a.conv_id IS NOT DISTINCT FROM r.conv_id
    """,
}
