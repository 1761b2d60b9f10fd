import hashlib
import re

from worksledger.llm import warc

PAGE = (
    '<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{}</style></head><body><!-- no --><script>var t="</p>";</script>'
    '<h1>Head</h1><p>One &lt;two&gt;\n <b>three</b></p><a class="x" href="/a">link</a><br>end</body></html>'
)
SCHEMA = "page_id long, url string, html string, block string, record_id string, refers_to long"


def made(spark, rows):
    return warc.derivatives(warc.responses(spark.createDataFrame(rows, SCHEMA), "2024-01-01T00:00:00Z"))


def test_two_linked_records_per_response(spark):
    rows = {r["record_type"]: r for r in made(spark, [(1, "http://x/", PAGE, "b", "r", 1)]).collect()}
    meta, text = rows["metadata"], rows["conversion"]
    assert meta["refers_to"] == text["refers_to"] and len({meta["record_id"], text["record_id"], text["refers_to"]}) == 3
    assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", text["record_id"])
    assert text["block"] == "Head\nOne <two>\nthree\nlink\nend"
    assert text["source_headers"].split("\r\n") == ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(PAGE)}"]
    fields = meta["block"].split("\r\n")
    assert "title: A & B" in fields and "outlinks: 1" in fields and "outlink: /a" in fields
    for r in rows.values():
        assert r["source_digest"] == "sha256:" + hashlib.sha256(PAGE.encode()).hexdigest()
        assert r["block_digest"] == "sha256:" + hashlib.sha256(r["block"].encode()).hexdigest()
        assert r["content_length"] == len(r["block"].encode())


def test_serialised_records_can_be_read(spark):
    for r in warc.serialise(made(spark, [(1, "http://x/é", PAGE, None, None, None), (2, None, None, None, None, None)])).collect():
        head, _, rest = r["warc"].partition("\r\n\r\n")
        lines = head.split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        assert lines[0] == "WARC/1.1" and fields["WARC-Refers-To"] == r["refers_to"]
        assert rest.encode()[: int(fields["Content-Length"])].decode() == r["block"] and rest[len(r["block"]) :] == "\r\n\r\n"
        assert ("WARC-Target-URI" in fields) == (r["target_uri"] is not None)


def test_awkward_rows(spark):
    rows = [(None, None, None, None, None, None), (1, "u", "", "", "", 1), (1, "u", "", "", "", 1), (2, "u", "<p>" * 30_000 + "x", None, None, 3), (3, None, "<script>open", None, None, 3)]
    out = made(spark, rows).collect()
    assert len(out) == 2 * len(rows)
    same = [r["record_id"] for r in out if r["page_id"] == 1]
    assert len(set(same)) == 2
    assert {r["block"] for r in out if r["page_id"] == 2 and r["record_type"] == "conversion"} == {"x"}
    assert all(r["block"] == "" for r in out if r["page_id"] is None and r["record_type"] == "conversion")
    assert made(spark, []).count() == 0


def test_headers_given_as_null(spark):
    records = warc.responses(spark.createDataFrame([(1, "u", "<p>a", None, None, None)], SCHEMA), "d").selectExpr(
        "page_id", "record_id", "target_uri", "warc_date", "cast(null as array<string>) http_headers", "payload", "cast(null as string) payload_digest"
    )
    rows = warc.derivatives(records).collect()
    assert all(r["source_headers"] == "" for r in rows) and "source-status: -" in rows[0]["block"]
