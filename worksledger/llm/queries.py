"""The operators of this package as queries over the given tables, and SQL where it states them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

import corpus_pipeline
from worksledger.llm import align, bpe, extraction, jaccard, langid, packing, pivots, quality, secrets, suffixes, tokenfile, trie, warc
from worksledger.llm.common import table
from worksledger.session import scratch_path


DATE = "2024-01-01T00:00:00Z"


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = warc.serialise(warc.derivatives(warc.responses(table(spark, sf_dir, "pages"), DATE)))
    return made.withColumn("warc_sha256", F.sha2("warc", 256)).drop("warc")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    tokenfile.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return tokenfile.read(spark, folder, digests=True)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = quality.ledger(table(spark, sf_dir, "documents"))
    base_failed = F.col("fail_bits").bitwiseAND(F.lit(quality.BASE)) != 0
    return kept.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & quality.verdict(quality.POLICIES["v2"])).alias("kept"),
        "fail_bits",
    )


def op5_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=0, size=2048, ids=False
    )
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_gru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    net = langid.fit(documents.where(langid.fold() != 2), "text", "lang", F.xxhash64("doc_id"))
    found = langid.identify(documents.select("doc_id", "text"), net)
    return found.select("doc_id", F.coalesce(langid.fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), words=3, percent=90)


def op9_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return bpe.decode(ids, path, digests=True)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup(table(spark, sf_dir, "documents"), length=400, digests=True)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align.align(table(spark, sf_dir, "documents"), *paths)


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(table(spark, sf_dir, "conversations"))


def _urn(name: str) -> str:
    parts = ", ".join(f"substr(md5({name}), {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'<urn:uuid:' || concat_ws('-', {parts}) || '>'"


def _resolved(text: str) -> str:
    for name, sign in warc.ENTITIES:
        text = f"replace({text}, '{name}', '{sign.replace(chr(39), chr(39) * 2)}')"
    return text


_CRLF = "chr(13) || chr(10)"
OP1_SQL = rf"""
WITH pages_ AS (
  SELECT page_id, url, coalesce(html, '') AS payload, sha256(coalesce(html, '')) AS sha FROM pages
), responses AS (
  SELECT *, {_urn("concat_ws('|', 'response', coalesce(CAST(page_id AS VARCHAR), ''), coalesce(url, ''), sha)")} AS refers_to,
    'HTTP/1.1 200 OK' || {_CRLF} || 'Content-Type: text/html; charset=utf-8' || {_CRLF} || 'Content-Length: ' || strlen(payload) AS source_headers,
    'sha256:' || sha AS source_digest,
    regexp_extract_all(payload, '{warc.LINK}', 1) AS links,
    regexp_replace({_resolved(f"coalesce(regexp_extract(payload, '{warc.TITLE}', 1), '')")}, '[\t\r\n\x0B\f ]+', ' ', 'g') AS title,
    {_resolved(f"regexp_replace(regexp_replace(regexp_replace(payload, '{warc.DROPPED}', '', 'g'), '{warc.LINE_ENDS}', chr(10), 'g'), '{warc.TAG}', '', 'g')")} AS text
  FROM pages_
), records AS (
  SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
    'source-record: ' || refers_to || {_CRLF} || 'source-status: 200' || {_CRLF} || 'source-digest: ' || source_digest || {_CRLF}
      || 'title: ' || title || {_CRLF} || 'outlinks: ' || len(links) || {_CRLF}
      || array_to_string(list_transform(links, lambda x: 'outlink: ' || x || {_CRLF}), '') AS block
  FROM responses
  UNION ALL
  SELECT *, 'conversion', 'text/plain; charset=utf-8',
    regexp_replace(regexp_replace(regexp_replace(text, '[\t\r\x0B\f ]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g')
  FROM responses
), made AS (
  SELECT page_id, record_type, {_urn("concat_ws('|', record_type, refers_to)")} AS record_id, refers_to, url AS target_uri, '{DATE}' AS warc_date,
    source_headers, source_digest, content_type, strlen(block) AS content_length, 'sha256:' || sha256(block) AS block_digest, block
  FROM records
)
SELECT *, sha256('WARC/1.1' || {_CRLF} || 'WARC-Type: ' || record_type || {_CRLF} || 'WARC-Record-ID: ' || record_id || {_CRLF}
  || 'WARC-Refers-To: ' || refers_to || {_CRLF} || coalesce('WARC-Target-URI: ' || target_uri || {_CRLF}, '') || 'WARC-Date: ' || warc_date || {_CRLF}
  || 'WARC-Block-Digest: ' || block_digest || {_CRLF} || 'WARC-Source-Payload-Digest: ' || source_digest || {_CRLF}
  || 'Content-Type: ' || content_type || {_CRLF} || 'Content-Length: ' || content_length || {_CRLF} || {_CRLF} || block || {_CRLF} || {_CRLF}) AS warc_sha256
FROM made
"""

_WORD = r"[^\x20\x09-\x0D]"
OP4_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT r, regexp_extract_all(text, '{_WORD}+') AS w FROM docs
), starts AS (
  SELECT r, w, unnest(range(1, len(w) - 1)) AS k FROM words
), windows AS (
  SELECT r, k, count(*) OVER (PARTITION BY r, w[k], w[k + 1], w[k + 2]) AS seen FROM starts
), repeated AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([k, k + 1, k + 2]) AS p FROM windows WHERE seen > 1) GROUP BY r
), lines AS (
  SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '{_WORD}') GROUP BY r
), measured AS (
  SELECT d.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(d.text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(d.text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(regexp_replace(d.text, '[^A-Z]+', '', 'g')) AS BIGINT) AS n_upper,
    coalesce(l.n, 0) AS n_lines, coalesce(l.dup, 0) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words
  FROM docs d JOIN words w USING (r) LEFT JOIN lines l USING (r) LEFT JOIN repeated p USING (r)
), ledger AS (
  SELECT *, {" + ".join(f"CASE WHEN {test} THEN {1 << k} ELSE 0 END" for k, (_, test) in enumerate(quality.RULES))} AS bits FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (bits & {quality.BASE}) <> 0 AS base_failed,
  (bits & {quality.BASE | quality.POLICIES["v2"].mask}) = 0 AS kept,
  CAST(bits AS BIGINT) AS fail_bits
FROM ledger
"""

OP7_SQL = """
WITH vectors AS (
  SELECT vec_id AS id, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.id AS query_id, q.r AS query_row, c.id AS vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.id % 20 = 0 AND c.r <> q.r AND len(c.v) = len(q.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id) AS rank FROM scores
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

# crc holds the remainders of the 256 bytes; the CRC-32 of an id folds over its digits
OP13_SQL = """
WITH crc AS (
  SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS bytes
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS n)
), own AS (
  SELECT conv_id AS c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (
  SELECT c, t, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
    lambda s, x: xor(s >> 8, bytes[(xor(s, x) & 255) + 1]))) % 6 AS h
  FROM own, crc
), built AS (
  SELECT h.c, list_concat(coalesce(b.t[1:h.h], []), h.t[h.h + 1:]) AS t FROM heads h LEFT JOIN own b ON b.c = h.c - h.c % 100
), prefixes AS (
  SELECT c, t, d, t[1:d] AS p FROM (SELECT c, t, unnest(range(len(t) + 1)) AS d FROM built)
), nodes AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN len(t) = d THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS ends_sha256
  FROM prefixes GROUP BY p, d
), families AS (
  SELECT p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
), weighed AS (
  SELECT n.*, coalesce(f.n_children, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(n.p[d].text) END AS saved
  FROM nodes n LEFT JOIN families f USING (p)
), subtrees AS (
  SELECT p[1:k] AS p, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(d + 1)) AS k FROM weighed) GROUP BY 1
)
SELECT w.conv_id, w.d AS depth, up.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, w.ends_sha256
FROM weighed w JOIN subtrees s USING (p) LEFT JOIN nodes up ON w.d > 0 AND up.p = w.p[1:w.d - 1]
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {f.__name__: f for f in (op1_warc_derivatives, op2_secret_scan, op3_token_file, op4_quality_rules, op5_pattern_packing, op6_gru_language, op7_pivot_top_k, op8_jaccard_join, op9_bpe_roundtrip, op10_suffix_dedup, op11_token_alignment, op12_main_text, op13_conversation_trie)}
    return named | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op1_warc_derivatives": OP1_SQL, "op4_quality_rules": OP4_SQL, "op7_pivot_top_k": OP7_SQL, "op13_conversation_trie": OP13_SQL}
