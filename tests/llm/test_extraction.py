from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from worksledger.llm import extraction, markup

SCHEMA = "page_id long, url string, html string, host string, content string, salt int, text string"


def made(spark, rows):
    return spark.createDataFrame([(*r, "h", "c", 1, "t") for r in rows], SCHEMA).repartition(3)


def texts(df, **options):
    return {r["page_id"]: r["text"] for r in extraction.extract(df, **options).collect()}


def paragraphs(seed, n=4, words=25):
    return [cases.prose(seed * 100 + k, words) for k in range(n)]


FURNITURE = (
    '<header class="site-header"><a href="/">Home of things</a></header><nav><ul><li><a href="/a">A</a></li></ul></nav>'
    '<div class="cookie-banner">We use cookies</div><aside>Popular now</aside><form><input name=q><button>Find</button></form>'
)
AFTER = '<section id="comments"><h2>Comments</h2><article class="comment"><p>First! what a long comment this is, really</p></article></section><footer>&copy; 2024</footer>'


def semantic(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{FURNITURE}<article>{body}</article>{AFTER}<script>var a='<p>no</p>';</script></body></html>"


def bare(k, body):
    """No article element: divs whose classes say nothing."""
    return (
        f'<html><body><div class="x1"><div class="x2"><a href="/{k}">Part {k}</a> <a href="/b">Other part</a></div>'
        f'<div class="x3" id="entry-{k + 100}"><div class="x9">Printed for you on this fine machine</div>{body}</div></div>'
        '<div class="x4">All rights remain with somebody</div></body></html>'
    )


def test_blocks_references_and_white_space():
    page = semantic("<h1>A &amp; B&lt;c&gt;</h1><p>one\n  two<br>three&nbsp;<b>fo</b>ur<p>five <!-- no --> six<ul><li>x<li>y</ul><div class=ad>buy</div>end")
    want = ["A & B<c>", "one two three four", "five six", "x", "y", "end"]
    assert extraction.main_text(page, None) == "\n\n".join(want)


@pytest.mark.parametrize(
    "html, want",
    [
        ("", ""), ("plain  text ", "plain text"), ("<article>", ""), ("<p>only</p>", ""), ("<html><p>only</p></html>", "only"),
        ("<body><article><p>cut of", "cut of"), ("<body><article><p>a</p><p class=\"x", "a"), ("<article><b><p>x</b>y</article>z", "xy"),
        ("<main><script>if (a</b) '<p>'</script>x</main>", "x"), ("<main>a<script>open", "a"), ("<article>1 < 2 & 3</article>", "1 < 2 & 3"),
        ("<ARTICLE>Up<P>per</ARTICLE>", "Up\n\nper"), ("<article><article class=comment>no</article>yes</article>", "yes"),
        ('<div class="with-sidebar"><article>kept</article></div>', "kept"), ("<article><table><tr><td>a<td>b</table></article>", "a\n\nb"),
        ("<article><header><h1>T</h1></header>x<footer>by</footer></article>", "T\n\nx"), ('<article title="a>b">q</article>', "q"),
        ("<article><p>one</p></span></nav><p>two</p></article>", "one\n\ntwo"), ("<article>x<p hidden>no</p></article>", "x"),
    ],
)
def test_odd_pages(html, want):
    assert extraction.main_text(html, None) == want


def test_deep_and_long_pages():
    assert extraction.main_text("<article>" + "<b>" * 30_000 + "x" + "</article>", None) == "x"
    assert extraction.main_text("<article>" + "<p>y" * 30_000, None).count("y") == 30_000
    assert extraction.main_text('<a "' * 20_000 + "<article>z</article>", None) in ("z", "")


def test_pages_of_one_host_and_of_many(spark):
    bodies = {k: "".join(f"<p>{p}</p>" for p in paragraphs(k)) for k in range(40)}
    rows = [(k, f"http://www.one.org/{k}" if k % 2 else f"https://h{k}.net:80/x", semantic(b)) for k, b in bodies.items()]
    rows += [(100, None, semantic("<p>no address</p>")), (101, "nonsense", None), (1, "http://www.one.org/1", rows[1][2]), (None, "http://www.one.org/", "")]
    df = made(spark, rows)
    want = {k: "\n\n".join(paragraphs(k)) for k in bodies} | {100: "no address", 101: "", None: ""}
    assert texts(df) == want
    assert texts(df, broadcast_bytes=0) == want
    assert extraction.extract(df).count() == len(rows)
    sizes = extraction.extract(df).where(F.col("n_chars") != F.char_length("text")).count()
    assert sizes == 0 and extraction.extract(made(spark, [])).count() == 0


def test_template_without_telling_names(spark):
    rows = [(k, f"http://bare.org/{k}", bare(k, "".join(f"<p>{p}</p>" for p in paragraphs(k)))) for k in range(30)]
    df = made(spark, rows)
    (host,) = extraction.templates(df).collect()
    assert host["content_label"] == "div#entry-0.x3"
    labels = {t["label"]: t["class"] for t in host["template"]}
    assert labels["div.x4"] == labels["div.x2"] == 0 and labels["p"] > 0 and labels["a"] not in (0, labels["p"])
    # what all pages repeat inside the slot is the template's, what stands around it is not the article
    assert texts(df) == {k: "\n\n".join(paragraphs(k)) for k in range(30)}


def test_text_that_all_copies_repeat_stays(spark):
    page = semantic("<p>" + cases.prose(1, 50) + "</p>")
    rows = [(k, "http://copies.org/", page) for k in range(30)]
    assert set(texts(made(spark, rows)).values()) == {cases.prose(1, 50)}
    shared = [(k, "http://line.org/", bare(k, f"<p>{cases.prose(9, 20)}</p><p>{cases.prose(k, 30)}</p>")) for k in range(10)]
    got = texts(made(spark, shared))
    assert all(cases.prose(9, 20) in got[k] and cases.prose(k, 30) in got[k] for k in range(10))


def test_occurrence_classes_are_those_of_the_vectors(spark):
    r = random.Random(4)
    pages = ["".join(f"<{t}>{r.choice('uvw')}</{t}>" * r.randint(0, 3) for t in ("h2", "h3", "pre", "dl")) for _ in range(9)]
    pages.append(pages[0])
    df = made(spark, [(k, "http://v.org/", f"<body>{p}</body>") for k, p in enumerate(pages)])
    vectors, support = {}, {}
    for k, p in enumerate(pages):
        for token, (_, _, _, n, *_) in extraction.page_tokens(f"<body>{p}</body>").items():
            vectors.setdefault(token, [0] * len(pages))[k] = n
    support = {t: sum(n > 0 for n in v) for t, v in vectors.items()}
    found = extraction.occurrences(df.select(extraction.host(F.col("url")).alias("host"), "html")).collect()
    assert {x["token"] for x in found} == {t for t, n in support.items() if 2 * n >= len(pages)}
    assert all(x["pages"] == support[x["token"]] and x["total"] == sum(vectors[x["token"]]) for x in found)
    for x in found:
        for y in found:
            assert (vectors[x["token"]] == vectors[y["token"]]) == ((x["va"], x["vb"]) == (y["va"], y["vb"]))


def test_classes_nest():
    root, a, b, c = (1, 1), (2, 2), (3, 3), (4, 4)
    rows = [  # token, parent, vector: c hangs under elements of two classes and is no part of a template
        (10, 0, root), (11, 10, root), (12, 11, a), (13, 12, a), (14, 13, b), (15, 14, c), (16, 11, c),
    ]
    tokens = pd.DataFrame([{"token": t, "parent": p, "kind": 0, "va": v[0], "vb": v[1], "one_a": 1, "one_b": 1} for t, p, v in rows])
    found = dict(zip(tokens["token"], extraction.classes(tokens)["class"]))
    assert found[10] == found[11] == 0 and found[12] == found[13] > 0 and found[14] > 0 and found[15] == found[16] == -1


def test_paths_are_stable():
    (e,) = {e.path for what, e, _ in markup.read('<div id="a1" class="z b2 c345">') if what == "open"}
    assert e == markup.path_of(0, "div#a1.b2.c0.z")
