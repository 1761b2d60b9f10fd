"""Secrets in source, configuration and prose.

Two layers. The base layer is three patterns (assignments to telling names, access keys,
long hexadecimal runs). The second layer lexes assignments: `name = literal`,
`"name": "literal"`, `export NAME=literal`, joined literals and `name = other_name`. Names
that take their value from another name pass their meaning on to the literal it holds
(constants are propagated, the latest value before the use counts), and every literal is
scored by the most telling name that it reaches and by its own shape. Literals that score
THRESHOLD or more are spans of kind `literal`; base spans always stay.

Spans count code points, ends exclusive. A null text is empty and has no span; repeated
rows are scanned row by row; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worksledger.llm.common import map_texts

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "literal")

#: Parts of a name that tell of a secret, and how strongly.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "privatekey": 1.0, "accesskey": 1.0, "signingkey": 1.0,
    "encryptionkey": 1.0, "auth": 0.6, "authorization": 0.7, "bearer": 0.7, "dsn": 0.5, "cookie": 0.5, "key": 0.3,
}
#: Values that stand in for a secret.
PLACEHOLDER = re.compile(r"(?ai)(?:none|null|nil|true|false|todo|changeme|example|test|xxx+|\*+|your[_-].*|<.*>|\$\{.*\}|%\(.*\)s)\Z")
THRESHOLD = 1.0
SHORTEST = 6

_NAME = r"[A-Za-z_][A-Za-z0-9_-]*(?:\.[A-Za-z_][A-Za-z0-9_-]*)*"
_QUOTED = r"\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'"
PAIR = re.compile(
    rf"""(?<![A-Za-z0-9_.-])(?P<name>{_NAME})["']?[\x20\t]*(?::=|=>|=(?!=)|:(?!//))[\x20\t]*"""
    rf"""(?:(?P<quoted>(?:{_QUOTED})(?:[\x20\t]*\+[\x20\t]*(?:{_QUOTED}))*)|(?P<bare>[^\s"',;()\[\]{{}}]+))"""
)
_LITERAL = re.compile(_QUOTED)
_IDENTIFIER = re.compile(rf"{_NAME}\Z")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base layer, in order."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= SHORTEST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    # a span of one kind may begin where another does; then by kind
    return sorted(found, key=lambda s: (s[0], s[2]))


def name_score(name: str) -> float:
    """How telling a name is: its parts, and pairs of neighbouring parts, are looked up."""
    parts = re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+", name)
    parts = [p.lower() for p in parts]
    return max((SENSITIVE.get(p, 0.0) for p in [*parts, *map("".join, zip(parts, parts[1:]))]), default=0.0)


def shape_score(value: str) -> float:
    """0 to 1 from length, entropy and mix of characters; 0 for what cannot be a secret."""
    if len(value) < SHORTEST or PLACEHOLDER.match(value) or any(c.isspace() for c in value):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = sum(any(test(c) for c in value) for test in (str.islower, str.isupper, str.isdigit)) + any(not c.isalnum() for c in value)
    return min(1.0, 0.15 * kinds + min(n, 32) / 80 + entropy / 12)


def literals(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, name, score) of the literals that are assigned to telling names.

    Assignments are read in order. A literal begins with its own name; each later
    `other = name` adds `other` to the names of the literal that `name` holds then.
    """
    if "=" not in text and ":" not in text:
        return []
    held: dict[str, int] = {}
    chained: list[str] = []  # names that wait for the next literal
    found: list[list] = []
    at = 0
    while m := PAIR.search(text, at):
        name, at = m["name"], m.end()
        if m["quoted"] is not None:
            value = "".join(x[1:-1] for x in _LITERAL.findall(m["quoted"]))
            start, end = m.start("quoted") + 1, m.end("quoted") - 1
        else:
            value, (start, end) = m["bare"], m.span("bare")
            source = value.removeprefix("$").strip("{}")
            if source in held:
                held[name] = held[source]
                if held[source] == len(found):  # itself still without a literal
                    chained.append(name)
                else:
                    entry = found[held[source]]
                    entry[4] = max(entry[4], name_score(name))
                continue
            if _IDENTIFIER.match(value) and PAIR.match(text, m.start("bare")):
                at = m.start("bare")  # a chain: a = b = "literal"
                held[name] = len(found)
                chained.append(name)
                continue
        held[name] = len(found)
        names, chained = [n for n in chained if held[n] == len(found)], []
        found.append([start, end, name, value, max(map(name_score, [name, *names]))])
    return [
        (start, end, name, round(score + shape, 3))
        for start, end, name, value, score in found
        if score >= 0.5 and (shape := shape_score(value)) and score + shape >= THRESHOLD
    ]


def scan(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, str, float]]]:
    return (base_spans(text), literals(text)) if text else ([], [])


SPANS = "array<struct<start:int,end:int,kind:string,base:boolean,name:string,score:double>>"
_SPANS = pa.list_(
    pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("base", pa.bool_()), ("name", pa.string()), ("score", pa.float64())])
)


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and `spans`: all spans in order of start, then kind as listed in KINDS."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column(1).to_pylist():
            base, more = scan(text)
            spans = [(s, e, k, True, None, None) for s, e, k in base] + [(s, e, 3, False, n, x) for s, e, n, x in more]
            rows.append(
                [
                    {"start": s, "end": e, "kind": KINDS[k], "base": b, "name": n, "score": x}
                    for s, e, k, b, n, x in sorted(spans, key=lambda x: (x[0], x[2], x[1]))
                ]
            )
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, _SPANS)], [id_col, "spans"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_texts(df.select(id_col, text_col), f"`{id_col}` {kind}, spans {SPANS}", work)


def mask(text: str | None, by: str = "[SECRET]") -> str | None:
    """The text with each secret, and secrets that overlap, replaced by one mark."""
    if not text:
        return text
    base, more = scan(text)
    out, end = [], 0
    for start, stop in sorted([s[:2] for s in base] + [s[:2] for s in more]):
        if start >= end:
            out += [text[end:start], by]
        end = max(end, stop)
    return "".join([*out, text[end:]]) if out else text


def redact(df: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """df with the secrets in its texts replaced; length_col, if named, is counted again."""
    at = df.columns.index(text_col)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        masked = pa.array([mask(t) for t in batch.column(at).to_pylist()], pa.string())
        return batch.set_column(at, pa.field(text_col, pa.string()), masked)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    out = map_texts(df, schema, work, at)
    if length_col and length_col in df.columns:
        out = out.withColumn(length_col, F.length(text_col).cast(df.schema[length_col].dataType))
    return out


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the digest of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])
    told = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        id_col,
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(told(base), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )
