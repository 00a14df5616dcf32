"""Queries of this package on the driver tables, next to their DuckDB SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark.llm.blocks import ready


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.substring_dedup import substring_dedup

    kept = substring_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL_2 = """
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), places AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM texts WHERE len(words) >= 35
), spans AS (
  SELECT doc_id, i, sha256(array_to_string(words[i:i + 34], ' ')) AS span FROM places
), repeated AS (
  SELECT doc_id, i FROM spans WHERE span IN (SELECT span FROM spans GROUP BY span HAVING count(*) > 1)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM repeated
), gone_of AS (
  SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id
)
SELECT t.doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string([words[k] FOR k IN range(1, len(words) + 1)
    IF NOT list_contains(coalesce(gone, []::BIGINT[]), k)], ' ')) AS kept_sha256
FROM texts t LEFT JOIN gone_of g ON t.doc_id = g.doc_id
"""

def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.line_dedup import line_dedup

    kept = line_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL_7 = """
WITH texts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM texts
), keyed AS (
  SELECT doc_id, line, i,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), shared AS (
  SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) > 1
), judged AS (
  SELECT l.doc_id, line, i, keeper IS NOT NULL AND keeper <> l.doc_id AS gone FROM keyed l LEFT JOIN shared s ON l.k = s.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.jaccard_join import jaccard_groups

    return jaccard_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


SQL_9 = """
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, md5_number(s) AS s FROM (
    SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN []::VARCHAR[]
      WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
      ELSE [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)] END) AS s
    FROM texts)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), both_ways AS MATERIALIZED (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, w.b FROM reach r JOIN both_ways w ON r.b = w.a
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id, n
"""

def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from shelfmark.llm.bpe import bpe_decode, bpe_encode

    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe_encode(table(spark, sf_dir, "documents", "doc_id", "text"), path).drop("text")
    return bpe_decode(encoded, path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from shelfmark.llm.packing import pack

    pieces = pack(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.quality_rules import apply_policy, rule_ledger

    judged = apply_policy(rule_ledger(table(spark, sf_dir, "documents", "doc_id", "text")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed"
    )


SQL_5 = """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), places AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM texts WHERE len(words) >= 3
), spans AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS c FROM places
), again AS (
  SELECT doc_id, count(*) AS n_repeat_words FROM (
    SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM spans WHERE c > 1) GROUP BY doc_id
), figures AS (
  SELECT t.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM texts t LEFT JOIN lines l ON l.doc_id = t.doc_id LEFT JOIN again a ON a.doc_id = t.doc_id
), judged AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 12 * n_words THEN 32 ELSE 0 END
    )::BIGINT AS failed FROM figures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed, failed & 3 <> 0 AS base_failed,
  failed = 0 AS kept
FROM judged
"""

def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.topk_search import topk_search

    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk_search(vectors, F.pmod(F.col("vec_id"), F.lit(50)) == 0)


SQL_6 = """
WITH vectors AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    coalesce(list_sum([q.v[i] * c.v[i] FOR i IN range(1, 1 + least(len(q.v), len(c.v)))]), 0)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scores
)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 5
"""

def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.warc import round_trip

    records = round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL_10 = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS f FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND f <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND f <> page_id THEN f END AS refers_to
FROM firsts
"""

def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.toxicity import fit, held_out, toxicity

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    index = fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"), ~held_out())
    scored = toxicity(docs, index)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.lm_scoring import lm_scores

    return lm_scores(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.ranked_search import ranked_search

    return ranked_search(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


SQL_11 = """
WITH texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents
), items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark
), totals AS (
  SELECT count(*) FILTER (len(terms) > 0) AS n, sum(len(terms))::BIGINT AS l FROM texts
), sizes AS (
  SELECT doc_id, 100 - 90 + ((90 * len(terms)::BIGINT * n) // l) AS m FROM texts, totals WHERE l > 0
), held AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM texts) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), totals
), scores AS (
  SELECT item_id, h.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM items i JOIN weights g ON g.term = i.term JOIN held h ON h.term = i.term JOIN sizes s ON s.doc_id = h.doc_id
  GROUP BY item_id, h.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM scores WHERE score > 0
)
SELECT item_id, r::INTEGER AS rank, doc_id, score FROM ranked WHERE r <= 10
"""


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.language_id import language_id, learn

    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    kept_back = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    found = language_id(docs.drop("lang"), learn(docs, ~kept_back))
    return found.select("doc_id", kept_back.alias("held_out"), "lang_pred", "score")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfmark.llm.whitening import fit, whiten

    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return whiten(vectors, fit(vectors))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_bpe": (op1_bpe, None),
    "op2_substring_dedup": (op2_substring_dedup, SQL_2),
    "op3_toxicity": (op3_toxicity, None),
    "op4_packing": (op4_packing, None),
    "op5_quality_rules": (op5_quality_rules, SQL_5),
    "op6_topk_search": (op6_topk_search, SQL_6),
    "op7_line_dedup": (op7_line_dedup, SQL_7),
    "op8_lm_scoring": (op8_lm_scoring, None),
    "op9_ngram_jaccard_join": (op9_ngram_jaccard_join, SQL_9),
    "op10_warc": (op10_warc, SQL_10),
    "op11_ranked_search": (op11_ranked_search, SQL_11),
    "op12_language_id": (op12_language_id, None),
    "op13_whitening": (op13_whitening, None),
    "pipeline": (pipeline, None),
}
