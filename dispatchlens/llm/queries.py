"""The operators as queries over the given tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchlens.llm.decontamination import find_benchmark_passages
from dispatchlens.llm.fingerprints import compare_edited
from dispatchlens.llm.frames import read, text_bytes
from dispatchlens.llm.html_text import extract_main_text
from dispatchlens.llm.lm_scoring import score_documents
from dispatchlens.llm.near_duplicates import link_similar
from dispatchlens.llm.sentence_pieces import encode_pieces
from dispatchlens.llm.sharding import shuffle_into_shards
from dispatchlens.llm.secret_scan import common_words, find_secrets
from dispatchlens.llm.source_audit import divergences
from dispatchlens.llm.substring_dedup import remove_repeats
from dispatchlens.llm.token_alignment import align_tokens
from dispatchlens.llm.token_counts import count_tokens
from dispatchlens.llm.toxicity import learn, score

Query = Callable[[SparkSession, str], DataFrame]


def sentencepiece(
    spark: SparkSession, tables: str, model: str = public_tokenizers.path("piece_bpe_32k.model")
) -> DataFrame:
    docs = read(spark, tables, "documents").select("doc_id", "text")
    return encode_pieces(docs, model).drop("text")


def lm_scoring(spark: SparkSession, tables: str) -> DataFrame:
    docs = read(spark, tables, "documents").select("doc_id", "text")
    by_order = F.col("by_order")
    return score_documents(docs).select(
        "doc_id",
        "n_words",
        "log_score",
        *(F.get(by_order, F.lit(k)).alias(f"n_order{k}") for k in range(4)),
    )


def html_extraction(spark: SparkSession, tables: str) -> DataFrame:
    return extract_main_text(read(spark, tables, "pages")).select(
        "page_id", "url", F.col("main_text").alias("text"), "n_chars"
    )


def substring_dedup(spark: SparkSession, tables: str) -> DataFrame:
    docs = read(spark, tables, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def decontamination(spark: SparkSession, tables: str) -> DataFrame:
    docs = read(spark, tables, "documents").select("doc_id", "text")
    return find_benchmark_passages(docs, read(spark, tables, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def similar_documents(spark: SparkSession, tables: str) -> DataFrame:
    docs = read(spark, tables, "documents").select("doc_id", "text")
    return link_similar(docs).drop("text", "class_key")


def held_out(doc_id: str = "doc_id"):
    """Whether a document's label is kept for checks."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def toxicity(spark: SparkSession, tables: str) -> DataFrame:
    docs = read(spark, tables, "documents").select("doc_id", "text")
    model = learn(docs, read(spark, tables, "labels"), ~held_out())
    scored = score(docs, model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
        F.size("segments").alias("n_segments"),
    )


def sharding(spark: SparkSession, tables: str) -> DataFrame:
    text = F.col("text")
    rows = read(spark, tables, "documents").select(
        "doc_id",
        (text_bytes(text) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
    )
    return shuffle_into_shards(rows).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def token_counts(
    spark: SparkSession, tables: str, vocabulary: str = public_tokenizers.path("word_bpe_49k.json")
) -> DataFrame:
    docs = read(spark, tables, "documents").select("doc_id", "text")
    return count_tokens(docs, vocabulary, keep_prefixes=True).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit", "fitting_chars", "prefix_tokens"
    )


def document_fingerprints(spark: SparkSession, tables: str) -> DataFrame:
    return compare_edited(read(spark, tables, "documents").select("doc_id", "text"))


def token_alignment(
    spark: SparkSession,
    tables: str,
    vocabulary: str = public_tokenizers.path("byte_bpe_50k.json"),
    model: str = public_tokenizers.path("piece_bpe_32k.model"),
) -> DataFrame:
    docs = read(spark, tables, "documents").select("doc_id", "text")
    groups = F.col("groups")
    return align_tokens(docs, vocabulary, model).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        F.when(groups == "", "").otherwise(F.sha2(groups, 256)).alias("groups_sha256"),
    )


def source_divergence(spark: SparkSession, tables: str) -> DataFrame:
    return divergences(read(spark, tables, "documents").select("text", "lang", "source"))


def _listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def secret_scan(spark: SparkSession, tables: str) -> DataFrame:
    docs = read(spark, tables, "documents").select("doc_id", "text")
    spans, base = F.col("spans"), ("assign", "access", "hex")
    return find_secrets(docs, common_words(docs)).select(
        "doc_id",
        *(F.size(_of_kinds(spans, kind)).cast("long").alias(f"n_{kind}") for kind in base),
        F.sha2(_listed(_of_kinds(spans, *base)), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
    )


QUERIES: dict[str, Query] = {
    "op1_sentencepiece": sentencepiece,
    "op2_lm_scoring": lm_scoring,
    "op3_html_extraction": html_extraction,
    "op4_substring_dedup": substring_dedup,
    "op5_decontamination": decontamination,
    "op6_jaccard_join": similar_documents,
    "op7_toxicity": toxicity,
    "op8_sharding": sharding,
    "op9_token_counts": token_counts,
    "op10_fingerprints": document_fingerprints,
    "op11_token_alignment": token_alignment,
    "op12_source_divergence": source_divergence,
    "op13_secret_scan": secret_scan,
}

ORACLES: dict[str, str] = {
    "op2_lm_scoring": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), w AS (
  SELECT doc_id, unnest(ws) AS w3, generate_subscripts(ws, 1) AS i FROM d
), g AS (
  SELECT doc_id, i, w3, lag(w3) OVER p AS w2, lag(w3, 2) OVER p AS w1
  FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY i)
), size AS (
  SELECT count(*) AS n FROM g
), counted AS (
  SELECT doc_id, i, w1, w2,
    count(*) OVER (PARTITION BY w1, w2, w3)
      - count(*) OVER (PARTITION BY doc_id, w1, w2, w3) AS c3,
    count(*) OVER (PARTITION BY w2, w3) - count(*) OVER (PARTITION BY doc_id, w2, w3) AS c2,
    count(*) OVER (PARTITION BY w3) - count(*) OVER (PARTITION BY doc_id, w3) AS c1
  FROM g
), based AS (
  SELECT c.*, CASE WHEN w1 IS NULL THEN 0 ELSE c3 END AS t3,
    CASE WHEN w2 IS NULL THEN 0 ELSE c2 END AS t2, lag(c1) OVER p AS b1, lag(c2) OVER p AS b2
  FROM counted c WINDOW p AS (PARTITION BY doc_id ORDER BY i)
), scored AS (
  SELECT doc_id,
    CASE WHEN t3 > 0 THEN 3 WHEN t2 > 0 THEN 2 WHEN c1 > 0 THEN 1 ELSE 0 END AS k,
    CASE WHEN t3 > 0 THEN CAST(round(ln(t3 / b2) * 1e6) AS BIGINT) ELSE
      CASE WHEN w1 IS NULL THEN 0 ELSE -916291 END +
      CASE WHEN t2 > 0 THEN CAST(round(ln(t2 / b1) * 1e6) AS BIGINT) ELSE
        CASE WHEN w2 IS NULL THEN 0 ELSE -916291 END +
        CAST(round(ln((CASE WHEN c1 > 0 THEN c1 ELSE 0.5 END) / (SELECT n FROM size)::DOUBLE) * 1e6)
          AS BIGINT)
      END
    END AS u
  FROM based
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(coalesce(sum(u), 0) AS BIGINT) / 1e6::DOUBLE AS log_score,
  count(*) FILTER (k = 0) AS n_order0, count(*) FILTER (k = 1) AS n_order1,
  count(*) FILTER (k = 2) AS n_order2, count(*) FILTER (k = 3) AS n_order3
FROM d LEFT JOIN scored USING (doc_id) GROUP BY d.doc_id, ws
""",
    "op4_substring_dedup": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(ws[i : i + 34], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM d)
), repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY h) > 1
), w AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d
), marked AS (
  SELECT w.doc_id, w.i, w.w, max(CASE WHEN r.i IS NULL THEN 0 ELSE 1 END) OVER (
    PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM w LEFT JOIN repeated r ON r.doc_id = w.doc_id AND r.i = w.i
), kept AS (
  SELECT doc_id, sum(gone) AS n, string_agg(w, ' ' ORDER BY i) FILTER (gone = 0) AS t
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op5_decontamination": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), lengths AS (
  SELECT DISTINCT least(len(ws), 10) AS n FROM b WHERE len(ws) > 0
), items AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i : i + n - 1], ' ') AS h
  FROM (SELECT item_id, ws, least(len(ws), 10) AS n, unnest(range(1, greatest(len(ws) - 8, 2))) AS i
        FROM b WHERE len(ws) > 0)
), hits AS (
  SELECT v.doc_id, v.i, v.n, items.item_id
  FROM (SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS h
        FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, lengths)) v
  JOIN items ON items.n = v.n AND items.h = v.h
), words AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
""",
    "op6_jaccard_join": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), nodes AS (
  SELECT t, min(doc_id) AS id, count(*) AS copies,
    regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws
  FROM d GROUP BY t
), shingles AS (
  SELECT DISTINCT id, array_to_string(ws[i : i + 4], ' ') AS s
  FROM (SELECT id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM nodes WHERE len(ws) > 0)
), sizes AS (
  SELECT id, count(*) AS n FROM shingles GROUP BY id
), common AS (
  SELECT a.id AS x, b.id AS y, count(*) AS n FROM shingles a JOIN shingles b USING (s)
  WHERE a.id <> b.id GROUP BY ALL
), links AS (
  SELECT x, y FROM common c JOIN sizes a ON a.id = x JOIN sizes b ON b.id = y
  WHERE c.n / (a.n + b.n - c.n) >= 0.8
), reached AS (
  SELECT id AS x, id AS y FROM nodes
  UNION
  SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y
), classes AS (
  SELECT x, min(y) AS class_id FROM reached GROUP BY x
), counted AS (
  SELECT x, count(*) AS n_similar, sum(copies) AS links
  FROM links JOIN nodes ON nodes.id = y GROUP BY x
)
SELECT d.doc_id, class_id, copies AS n_copies,
  CAST(copies - 1 + coalesce(links, 0) AS BIGINT) AS n_links,
  CAST(coalesce(n_similar, 0) AS BIGINT) AS n_similar_texts
FROM d JOIN nodes USING (t) JOIN classes ON classes.x = nodes.id
LEFT JOIN counted ON counted.x = nodes.id
""",
    "op12_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents
), w AS (
  SELECT i, lang, source, unnest(ws) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS c FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 30
), langs AS (
  SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang
), counted AS (
  SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT lang, source, coalesce(sum(c), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN counted USING (lang, source) GROUP BY ALL
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(x.c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(x.c, 0) + 5)) // (g.n + 5 * l.v) AS p,
    1 + (1000000000::HUGEINT * (k.c + 5)) // (l.n + 5 * l.v) AS q
  FROM groups g JOIN langs l ON l.lang = g.lang JOIN kept k ON k.lang = g.lang
  LEFT JOIN counted x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term
), sums AS (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
  FROM shares x JOIN shares y ON y.lang = x.lang AND y.term = x.term AND y.source <> x.source
  GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM found)
WHERE part = 'pair' OR rank <= 50
""",
}
