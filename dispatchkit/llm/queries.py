"""The registered queries of this folder: name -> (spark, sf_dir) -> DataFrame, and DuckDB SQL
for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (ans, brown_lm, conversation_repair, exact_dedup, fingerprints, jaccard_join, lexical_search, licenses, mixing,
               packing, quality, substring_dedup, url_lists)
from .common import read_table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence family of every document."""
    return licenses.license_scan(read_table(spark, sf_dir, "documents"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix by source weights takes of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return mixing.taken_words(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint digests of every text and its edited text, and how alike they are."""
    f = fingerprints.edited_fingerprints(read_table(spark, sf_dir, "documents"))

    def digest(numbers):
        return F.sha2(F.array_join(F.col(numbers).cast("array<string>"), ","), 256)

    return f.select("doc_id", "n_chars", "edited_sha256", digest("numbers").alias("fingerprint"),
                    digest("edited_numbers").alias("edited_fingerprint"), "near_edited", "near_next")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and near-duplicate component of every document."""
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labelled rows that are not held out."""
    return quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents' token ids, read the files back, and sum up each document."""
    blocks, shared = ans.write_token_files(read_table(spark, sf_dir, "documents"),
                                           vocabulary("word_bpe_49k.json"), end_id=1)
    return ans.documents_of(blocks, shared).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, keeper and digest of every document's normalised text."""
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op8_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries active when it was fetched."""
    pages = read_table(spark, sf_dir, "pages")
    return url_lists.temporal_list_join(url_lists.dated_captures(pages), url_lists.derived_entries(pages))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 1024 ids."""
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a smaller document's 13-word windows repeat."""
    cut = substring_dedup.repeats(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    return cut.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=50)


def op12_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a class-based bigram model."""
    return brown_lm.lm_scores(read_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every damaged conversation."""
    damaged = conversation_repair.damaged(read_table(spark, sf_dir, "conversations"))
    pieces = conversation_repair.repair(damaged, absent_col="absent")
    return conversation_repair.joined(pieces)


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_source_mix": op2_source_mix,
    "op3_fingerprints": op3_fingerprints,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_token_files": op6_token_files,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_url_lists": op8_url_lists,
    "op9_packing": op9_packing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_brown_lm": op12_brown_lm,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE = {
    "op2_source_mix": r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS z,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source),
l AS (
  SELECT *, (sum(z) OVER () * 1.5::DOUBLE - coalesce(sum(2 * z) OVER before, 0))
            / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS lev
  FROM s WINDOW before AS (ORDER BY z * 2 / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, z, least(z * 2::DOUBLE, max(lev) OVER () * w) AS target FROM l),
p AS (
  SELECT d.*, t.z, t.target, CAST(floor(t.target) AS BIGINT) AS q,
         sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, z AS source_size, target,
       CAST(CASE WHEN z = 0 THEN 0
                 ELSE (q // z) * size + greatest(0, least(size, q % z - start)) END AS BIGINT) AS taken
FROM p""",
    "op7_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER g
         AND row_number() OVER (PARTITION BY t, doc_id) = 1 AS kept,
       sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)""",
    "op8_url_lists": r"""
WITH u AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 6) AS INT) % 366 AS INT) AS fetched_on,
         nullif(regexp_replace(lower(regexp_extract(coalesce(url, ''),
           '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.$', ''), '') AS host,
         list_filter(string_split(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/'),
                     lambda x: x <> '') AS segs
  FROM pages),
h AS (SELECT DISTINCT host, string_split(host, '.') AS l,
             CAST('0x' || substr(md5('h:' || host), 1, 6) AS INT) % 4 AS pick FROM u WHERE host IS NOT NULL),
raw AS (
  SELECT DISTINCT 'host' AS kind, host AS pattern, [0, 40] AS steps FROM h WHERE pick = 0
  UNION ALL
  SELECT DISTINCT 'domain', CASE WHEN len(l) > 2 THEN array_to_string(l[2:], '.') ELSE host END, [0] FROM h WHERE pick = 1
  UNION ALL
  SELECT DISTINCT 'prefix', host || '/' || segs[1], [0, 90, 150] FROM u
  WHERE host IS NOT NULL AND len(segs) > 0
    AND CAST('0x' || substr(md5('p:' || host || '/' || segs[1]), 1, 6) AS INT) % 3 = 0),
e AS (
  SELECT kind, pattern, DATE '2024-01-01' + CAST(CAST('0x' || substr(md5(kind || ':' || pattern), 1, 6) AS INT) % 300 AS INT) + s AS listed_on,
         CASE WHEN s IN (0, 150) THEN 'add' ELSE 'remove' END AS action
  FROM (SELECT kind, pattern, unnest(steps) AS s FROM raw)),
hits AS (
  SELECT u.page_id, k.kind, k.pattern, e.listed_on, k.rank
  FROM u, LATERAL (
    SELECT 'host' AS kind, u.host AS pattern, 1000 AS rank
    UNION ALL
    SELECT 'domain', array_to_string(string_split(u.host, '.')[i:], '.'), len(string_split(u.host, '.')) - i + 1
    FROM range(1, 20) r(i) WHERE i <= len(string_split(u.host, '.'))
    UNION ALL
    SELECT 'prefix', u.host || '/' || array_to_string(u.segs[1:i], '/'), 2000 + i FROM range(1, 4) r(i) WHERE i <= len(u.segs)) k
  JOIN e ON e.kind = k.kind AND e.pattern = k.pattern AND e.action = 'add' AND e.listed_on <= u.fetched_on
  WHERE NOT EXISTS (SELECT 1 FROM e x WHERE x.kind = e.kind AND x.pattern = e.pattern
                    AND x.listed_on > e.listed_on AND x.listed_on <= u.fetched_on)),
best AS (SELECT page_id, max(row(rank, kind, pattern, listed_on)) AS b, count(*) AS n_rules FROM hits GROUP BY page_id)
SELECT u.page_id, u.url, u.fetched_on, b IS NOT NULL AS blocked, b[2] AS kind, b[3] AS pattern, b[4] AS valid_from,
       coalesce(n_rules, 0) AS n_rules
FROM u LEFT JOIN best USING (page_id)""",
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLE)
