"""Main text of pages by deducing the template of their host from equivalence classes.

Tokens are elements, told apart by the path of tags, ids and classes above them, and the
runs of text between tags. The occurrence vector of a token says how often it stands in
each page of a host; tokens of one vector form a class. Vectors are never built: each page
contributes a hash of (page, number) to an exclusive or, so that a class is what shares two
64-bit fingerprints, and a host of any size is a map-side aggregate. Classes that hold a
good half of a host's pages, and whose elements hang together under one element of an
enclosing class, are nested into the template. What varies stands in its slots; the
element that holds the article is found among the elements of the class of all pages.

The article is the main slot with its blocks, without what its tags and names mark as
menu, header, footer, sidebar, notice, advert, form, script, style or comment. Text in it
is never left out because it repeats where the element itself says that it is an article.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worksledger.llm.common import landed, map_texts, pieces
from worksledger.llm.markup import BLOCKS, CONTAINERS, MAIN, read

LEAST_PAGES = 3  # of a host with a template of its own
CONSTANT_PAGES = 20  # different pages, for text that all of them repeat to be the template's
SHARE = 0.6  # of the text of an element that one inside it must hold to take its place
FLUSH = 100_000  # tokens that a task holds before it hands them on
BROADCAST_BYTES = 32 << 20  # of host rows; more are joined by a shuffle
SALTS = 16

ELEMENT, TEXT, PAGE = 0, 1, 2
_TOKENS = (
    "host string, token bigint, parent bigint, kind int, label string, pages bigint, total bigint, "
    "va bigint, vb bigint, chars bigint, linked bigint, place bigint"
)


def host(url: Column) -> Column:
    """Lower-case host of a URL; empty when there is none."""
    named = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.coalesce(F.lower(named), F.lit(""))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _hash(text: str, seed: int) -> int:
    return _signed(xxhash.xxh64_intdigest(text, seed & 0xFFFFFFFFFFFFFFFF))


def page_tokens(html: str) -> dict[int, list]:
    """token -> [parent, kind, label, number in the page, characters, those in links, place of the first]."""
    found: dict[int, list] = {}
    for place, (what, e, text) in enumerate(read(html)):
        if what == "text":
            told = " ".join(text.split())
            if told and not e.dropped:
                e.chars += len(told)
                if e.in_link:
                    e.linked += len(told)
                x = found.setdefault(_hash(told, e.path), [e.path, TEXT, None, 0, 0, 0, place])
                x[3] += 1
                x[4] += len(told)
        elif what == "open":
            x = found.setdefault(e.path, [e.parent, ELEMENT, e.label + "!" * bool(e.dropped), 0, 0, 0, place])
            x[3] += 1
        elif what == "close":
            x = found[e.path]
            x[4] += e.chars
            x[5] += e.linked
    return found


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    held: dict[tuple[str, int], list] = {}

    def out() -> pa.RecordBatch:
        rows = [[h, t, *x] for (h, t), x in held.items()]
        held.clear()
        names = [field.split(" ")[0] for field in _TOKENS.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 7]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for piece in pieces(batch, 1):
            for name, html in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                html = html or ""
                tokens = page_tokens(html)
                tokens[0] = [0, PAGE, "", 1, 0, 0, 0]  # the page itself: the vector of ones
                tokens[_hash(html, 1)] = [0, PAGE, "copy", 1, 0, 0, 0]  # equal pages share this one
                for token, (parent, kind, label, n, chars, linked, place) in tokens.items():
                    x = held.get((name, token))
                    if x is None:
                        x = held[name, token] = [parent, kind, label, 0, 0, 0, 0, 0, 0, 0]
                    seen = f"{part},{number},{n}"
                    x[3] += 1
                    x[4] += n
                    x[5] ^= _hash(seen, 2)
                    x[6] ^= _hash(seen, 3)
                    x[7] += chars
                    x[8] += linked
                    x[9] += place
                number += 1
            if len(held) >= FLUSH:
                yield out()
    if held:
        yield out()


def occurrences(df: DataFrame) -> DataFrame:
    """Tokens of each host with the fingerprints of their occurrence vectors; df has host and html.

    Only tokens in at least half of the pages of a host of LEAST_PAGES or more come back:
    at most twice as many as its pages have tokens on average, for a host of any size.
    """
    rows = df.select("host", F.col("html").cast("string").alias("html")).mapInArrow(_token_rows, _TOKENS)
    summed = ("pages", "total", "chars", "linked", "place")
    every = rows.groupBy("host", "token").agg(
        *[F.min(c).alias(c) for c in ("parent", "kind", "label")],
        *[F.sum(c).alias(c) for c in summed],
        *[F.bit_xor(c).alias(c) for c in ("va", "vb")],
    )
    every = landed(every.where((F.col("pages") > 1) | (F.col("kind") == PAGE)), "occurrences")
    copies = every.where((F.col("kind") == PAGE) & (F.col("label") == "copy")).groupBy("host").agg(F.count("*").alias("different"))
    sizes = every.where(F.col("token") == 0).select("host", F.col("pages").alias("of"), F.col("va").alias("one_a"), F.col("vb").alias("one_b"))
    sizes = sizes.where(F.col("of") >= LEAST_PAGES).join(copies, "host")
    return every.where(F.col("kind") != PAGE).join(sizes, "host").where(2 * F.col("pages") >= F.col("of"))


_TEMPLATE = (
    "host string, content bigint, content_label string, constants array<bigint>, "
    "template array<struct<token:bigint,parent:bigint,label:string,class:int,pages:bigint>>"
)


def classes(tokens: pd.DataFrame) -> pd.DataFrame:
    """Tokens with the number of their valid class (0: that of all pages, each once; -1: none).

    A class is valid when its elements that hang outside it hang under one element, and
    that element is of a valid class: so classes nest and never straddle each other.
    """
    keys = list(zip(tokens["va"], tokens["vb"]))
    number = {(tokens["one_a"].iloc[0], tokens["one_b"].iloc[0]): 0}
    of = np.array([number.setdefault(k, len(number)) for k in keys])
    elements = tokens["kind"].to_numpy() == ELEMENT
    path, parent = tokens["token"].to_numpy(), tokens["parent"].to_numpy()
    class_of = {p: c for p, c, e in zip(path, of, elements) if e}
    hangs: dict[int, set[int]] = {}
    for p, c in zip(parent, of):
        if class_of.get(p) != c:
            hangs.setdefault(c, set()).add(p)
    valid: dict[int, bool] = {}

    def is_valid(c: int) -> bool:
        chain = []
        while c not in valid:  # up the classes; a cycle is no nesting
            chain.append(c)
            valid[c] = False
            under = hangs.get(c, set())
            if c == 0 or under <= {0}:
                valid[c] = True
            elif len(under) == 1 and next(iter(under)) in class_of:
                c = class_of[next(iter(under))]
        for x in reversed(chain):
            valid[x] = valid[x] or (len(hangs.get(x, ())) == 1 and next(iter(hangs[x])) in class_of and valid[class_of[next(iter(hangs[x]))]])
        return valid[chain[0]] if chain else valid[c]

    return tokens.assign(**{"class": [c if is_valid(c) else -1 for c in of]})


def main_element(elements: list[tuple[int, int, str, bool, int, int]]) -> tuple[int, str] | None:
    """(path, label) of the element that holds the article.

    elements: (path, parent, label, once in each page, characters, those in links). The
    longest article or main element, if any has text; else from the body inwards as long as
    one container inside holds SHARE of the text that stands outside links.
    """
    text = {p: chars - linked for p, _, _, _, chars, linked in elements}
    kept = [x for x in elements if not x[2].endswith("!")]

    def tag(label: str) -> str:
        return label.split("#")[0].split(".")[0]

    named = [x for x in kept if tag(x[2]) in MAIN and x[4] > 0]
    if named:
        best = max(named, key=lambda x: (tag(x[2]) == "article", x[4], -x[0]))
        return best[0], best[2]
    below: dict[int, list] = {}
    for x in kept:
        if x[3] and tag(x[2]) in CONTAINERS:
            below.setdefault(x[1], []).append(x)
    bodies = [x for x in kept if tag(x[2]) == "body"] or [x for x in kept if tag(x[2]) == "html"]
    if not bodies:
        return None
    now = max(bodies, key=lambda x: (text[x[0]], -x[0]))
    while inside := below.get(now[0]):
        best = max(inside, key=lambda x: (text[x[0]], -x[0]))
        if text[best[0]] < SHARE * text[now[0]] or text[best[0]] == 0:
            break
        now = best
    return now[0], now[2]


def _deduce(tokens: pd.DataFrame) -> pd.DataFrame:
    """Template and main slot of one host."""
    found = classes(tokens.sort_values(["place", "token"], kind="stable"))
    inside = found[found["class"] >= 0]
    elements = inside[inside["kind"] == ELEMENT]
    constant = inside[(inside["kind"] == TEXT) & (inside["class"] == 0)]
    fixed = constant.groupby("parent")["chars"].sum().to_dict() if found["different"].iloc[0] >= LEAST_PAGES else {}
    parent_of = dict(zip(elements["token"], elements["parent"]))
    less: dict[int, int] = {}  # text that does not vary is no slot: not counted in any element above it
    for path, chars in fixed.items():
        while path in parent_of:
            less[path] = less.get(path, 0) + chars
            path = parent_of[path]
    rows = [
        (p, q, label, c == 0, chars - less.get(p, 0), linked)
        for p, q, label, c, chars, linked in elements[["token", "parent", "label", "class", "chars", "linked"]].itertuples(index=False)
    ]
    main = main_element(rows)
    constants: list[int] = []
    if main and not main[1].startswith(("article", "main")) and found["different"].iloc[0] >= CONSTANT_PAGES:
        constants = constant["token"].tolist()
    template = [
        {"token": t, "parent": p, "label": label.rstrip("!"), "class": c, "pages": n}
        for t, p, label, c, n in elements[["token", "parent", "label", "class", "pages"]].itertuples(index=False)
    ]
    return pd.DataFrame(
        {
            "host": [tokens["host"].iloc[0]],
            "content": pd.array([main[0] if main else None], "Int64"),
            "content_label": [main[1] if main else None],
            "constants": [constants],
            "template": [template],
        }
    )


def templates(df: DataFrame) -> DataFrame:
    """One row per host of LEAST_PAGES pages or more of (url, html): its template, nested by
    parent and in the order of the pages, and the element that holds the article."""
    tokens = occurrences(df.select(host(F.col("url")).alias("host"), "html"))
    return tokens.groupBy("host").applyInPandas(_deduce, _TEMPLATE)


def page_text(html: str, content: int | None, constants: frozenset[int] = frozenset()) -> str | None:
    """Blocks of the elements with this path, joined; None when the page has no such element with text."""
    blocks: list[str] = []
    parts: list[str] = []
    depth = 0

    def end_block() -> None:
        if parts:
            told = " ".join("".join(parts).split())
            if told:
                blocks.append(told)
            parts.clear()

    for what, e, text in read(html):
        if what == "open":
            if e.path == content and not e.dropped or depth:
                depth += 1
            if e.tag in BLOCKS or e.dropped:
                end_block()
        elif what == "close":
            if e.tag in BLOCKS or e.dropped:
                end_block()
            if depth:
                depth -= 1
        elif what == "break":
            parts.append(" ")
            if text == "hr":
                end_block()
        elif depth and not e.dropped:
            if not constants or _hash(" ".join(text.split()), e.path) not in constants:
                parts.append(text)
    end_block()
    return "\n\n".join(blocks) if blocks else None


def own_element(html: str) -> int | None:
    """The element that holds the article, by the page alone."""
    rows = [
        (t, parent, label, n == 1, chars, linked)
        for t, (parent, kind, label, n, chars, linked, _) in page_tokens(html).items()
        if kind == ELEMENT
    ]
    main = main_element(rows)
    return main[0] if main else None


def main_text(html: str, content: int | None, constants: frozenset[int] = frozenset()) -> str:
    """By the template of the host; a page that does not fit it, or without one, by itself.

    Text without any element is one block.
    """
    text = page_text(html, content, constants) if content is not None else None
    if text is None:
        alone = own_element(html)
        if alone is not None:
            text = page_text(html, alone)
        elif "<" not in html:
            text = " ".join(html.split())
    return text or ""


def _extract(batch: pa.RecordBatch) -> pa.RecordBatch:
    content, constants = batch.column(3).to_pylist(), batch.column(4).to_pylist()
    texts = [
        main_text(html or "", c, frozenset(k or ()))
        for html, c, k in zip(batch.column(1).to_pylist(), content, constants)
    ]
    sizes = pa.array([len(t) for t in texts], pa.int64())
    columns = [batch.column(0), batch.column(2), pa.array(texts, pa.string()), sizes]
    return pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def extract(df: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(page_id, url, text, n_chars) of (page_id, url, html): the main text of each page.

    Blocks are trimmed, with character references decoded and each run of white space one
    space, and joined by two line feeds; a line break inside a block is white space. A page
    without main text, or null, has an empty text. Pages whose URL is null or names no host
    are a host of their own. Pages that repeat are pages of their own. Other columns are
    not read. Rows of hosts are broadcast up to broadcast_bytes; beyond that they are joined
    by a shuffle in which each host is dealt over SALTS keys.
    """
    pages = df.select("page_id", "html", "url", host(F.col("url")).alias("host"))
    hosts = landed(templates(df).select("host", "content", "constants"), "templates")
    size = hosts.agg(F.sum(F.length("host") + 64 + 16 * F.size("constants"))).first()[0] or 0
    if size <= broadcast_bytes:
        joined = pages.join(F.broadcast(hosts), "host", "left")
    else:
        salt = F.pmod(F.xxhash64("page_id", "html"), F.lit(SALTS)).cast("int")
        dealt = hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = pages.withColumn("salt", salt).join(dealt.hint("shuffle_hash"), ["host", "salt"], "left")
    narrow = joined.select("page_id", "html", "url", "content", "constants")
    return map_texts(narrow, "page_id bigint, url string, text string, n_chars bigint", _extract)
