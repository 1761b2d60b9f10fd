"""WARC derivatives: metadata and plain-text conversion records of response records.

`responses` makes response records of page rows; `derivatives` makes two records of each
response, both of which refer to it (WARC-Refers-To) and keep its target, date, digest and
HTTP header lines: `metadata` (an application/warc-fields block: status, type, title, links,
digests) and `conversion` (the plain text). `serialise` adds the record as written in a file.
Everything is an expression of the engine's own; nothing is shuffled.

Record ids are name-based: equal responses have equal ids, and so have their derivatives, so
that a repeated job or a retried task writes the same records. Repeated rows are converted
row by row. A null payload is an empty one; a null target or date leaves its header out;
header lines may be null. An empty table gives no records.

Conversion: scripts, styles, comments and the head are dropped, block tags end a line,
other tags vanish, named entities of ENTITIES are resolved, blanks are collapsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DROPPED = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<head\b[^>]*>.*?</head\s*>"
LINE_ENDS = r"(?i)</?(?:p|div|br|hr|h[1-6]|li|ul|ol|tr|table|article|section|nav|header|footer|blockquote|pre|title)\b[^>]*>"
TAG = r"<[^>]*>"
TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
LINK = r"(?i)<a\b[^>]*?\bhref=\"([^\"]*)\""
#: In this order; the ampersand last, so that nothing is resolved twice.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]
CRLF = "\r\n"


def urn(name: Column) -> Column:
    """A record id by name."""
    h = F.md5(name)
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def resolve(text: Column) -> Column:
    for name, sign in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(sign))
    return text


def plain_text(html: Column) -> Column:
    text = F.regexp_replace(html, DROPPED, "")
    text = F.regexp_replace(text, LINE_ENDS, "\n")
    text = resolve(F.regexp_replace(text, TAG, ""))
    text = F.regexp_replace(text, r"[\t\r\x0B\f ]+", " ")
    return F.regexp_replace(F.regexp_replace(text, r" ?\n[ \n]*", "\n"), r"^[ \n]+|[ \n]+$", "")


def responses(pages: DataFrame, date: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Response records: source id, record_id, target_uri, warc_date, http_headers, payload, payload_digest."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    name = F.concat_ws("|", F.lit("response"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(url_col), F.lit("")), F.sha2(payload, 256))
    return pages.select(
        F.col(id_col),
        urn(name).alias("record_id"),
        F.col(url_col).alias("target_uri"),
        F.lit(date).alias("warc_date"),
        F.array(
            F.lit("HTTP/1.1 200 OK"),
            F.lit("Content-Type: text/html; charset=utf-8"),
            F.concat(F.lit("Content-Length: "), F.octet_length(payload).cast("string")),
        ).alias("http_headers"),
        payload.alias("payload"),
        digest(payload).alias("payload_digest"),
    )


def derivatives(records: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Two rows per response: id, record_type, record_id, refers_to, target_uri, warc_date,
    source_headers, source_digest, content_type, content_length, block_digest, block."""
    html = F.coalesce("payload", F.lit(""))
    headers = F.array_join(F.coalesce("http_headers", F.array().cast("array<string>")), CRLF)
    title = F.regexp_replace(resolve(F.coalesce(F.regexp_extract(html, TITLE, 1), F.lit(""))), r"[\t\r\n\x0B\f ]+", " ")
    links = F.transform(F.regexp_extract_all(html, F.lit(LINK), F.lit(1)), lambda x: F.concat(F.lit("outlink: "), x))
    fields = F.concat(
        F.array(
            F.concat(F.lit("source-record: "), F.col("record_id")),
            F.concat(F.lit("source-status: "), F.coalesce(F.element_at(F.split(F.get("http_headers", F.lit(0)), " "), 2), F.lit("-"))),
            F.concat(F.lit("source-digest: "), F.coalesce("payload_digest", F.lit("-"))),
            F.concat(F.lit("title: "), title),
            F.concat(F.lit("outlinks: "), F.size(links).cast("string")),
        ),
        links,
    )
    made = F.array(
        F.struct(
            F.lit("metadata").alias("record_type"),
            F.lit("application/warc-fields").alias("content_type"),
            F.concat(F.array_join(fields, CRLF), F.lit(CRLF)).alias("block"),
        ),
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), plain_text(html).alias("block")),
    )
    return records.select(
        id_col, F.col("record_id").alias("refers_to"), "target_uri", "warc_date", headers.alias("source_headers"),
        F.col("payload_digest").alias("source_digest"), F.inline(made),
    ).select(
        id_col,
        "record_type",
        urn(F.concat_ws("|", "record_type", "refers_to")).alias("record_id"),
        "refers_to",
        "target_uri",
        "warc_date",
        "source_headers",
        "source_digest",
        "content_type",
        F.octet_length("block").cast("long").alias("content_length"),
        digest(F.col("block")).alias("block_digest"),
        "block",
    )


def serialise(records: DataFrame) -> DataFrame:
    """records with `warc`: header lines, a blank line, the block, two line ends."""
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(name + ": "), value))
    head = F.concat_ws(
        CRLF,
        F.lit("WARC/1.1"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Refers-To", F.col("refers_to")),
        line("WARC-Target-URI", F.col("target_uri")),
        line("WARC-Date", F.col("warc_date")),
        line("WARC-Block-Digest", F.col("block_digest")),
        line("WARC-Source-Payload-Digest", F.col("source_digest")),
        line("Content-Type", F.col("content_type")),
        line("Content-Length", F.col("content_length").cast("string")),
    )
    return records.withColumn("warc", F.concat(head, F.lit(CRLF * 2), F.col("block"), F.lit(CRLF * 2)))
