import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import cases
from tests.llm.test_jaccard import family
from worksledger.llm import suffixes


def brute(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(x[k : k + length] for _, x in raw for k in range(len(x) - length + 1))
    out = []
    for i, x in raw:
        gone = np.zeros(len(x), bool)
        for k in range(len(x) - length + 1):
            if seen[x[k : k + length]] > 1:
                gone[k : k + length] = True
        edge = np.diff(np.pad(gone.astype(int), 1))
        kept = np.frombuffer(x, np.uint8)[~gone].tobytes()
        out.append(str((i, len(x), list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())), kept)))
    return sorted(out)


def check(spark, rows, length=400):
    df = cases.frame(spark, [t for _, t in rows], [i for i, _ in rows])
    got = suffixes.dedup(df, length).collect()
    assert sorted(str((r["doc_id"], r["n_bytes"], [(s["start"], s["stop"]) for s in r["removed"]], bytes(r["kept"]))) for r in got) == brute(rows, length)


def corpus():
    texts = [t for seed, size, words, edits in ((1, 30, 200, 6), (2, 5, 500, 40), (3, 3, 90, 1)) for t in family(seed, size, words, edits)]
    passage = cases.prose(50, 75)
    texts += [cases.prose(k, 30) + passage[: 380 + 3 * k] + cases.prose(k + 100, 20) for k in range(25)]
    texts += ["Ating. " * 150, "x" * 999, "xy" * 450, "Ating. " * 90 + passage, passage * 3]
    texts += ["é" * 300 + passage, "日本" * 150 + "é" * 201]
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [512, 2])
def test_as_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    check(spark, corpus())


def test_awkward_rows(spark):
    df = cases.awkward(spark)
    check(spark, [(r["doc_id"], r["text"]) for r in df.collect()])
    assert suffixes.dedup(cases.empty(spark), 400).count() == 0
    assert suffixes.dedup(cases.empty(spark), 400, keep_columns=True).columns == cases.empty(spark).columns


def test_digests_and_columns(spark):
    df = cases.awkward(spark)
    full = {str((r["doc_id"], r["n_bytes"], sum(s["stop"] - s["start"] for s in r["removed"]), len(r["removed"]), hashlib.sha256(r["kept"]).hexdigest(), bytes(r["kept"]).decode(errors="ignore"))) for r in suffixes.dedup(df, 400).collect()}
    assert {str(tuple(r)) for r in suffixes.dedup(df, 400, digests=True).collect()} == full
    cut = suffixes.dedup(df, 400, keep_columns=True)
    assert cut.columns == df.columns and cut.count() == df.count()
    texts = {(r["doc_id"], r["text"]) for r in cut.collect()}
    assert (0, None) in texts and (4, "Two words") in texts and (5, "") in texts


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=3, max_size=3), max_size=60))
def test_multikey_sort_orders(rows):
    keys = np.array(rows, np.uint64).reshape(-1, 3)
    assert keys[suffixes.multikey_sort(keys)].tolist() == sorted(keys.tolist())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=30).map(lambda b: bytes(x % 3 for x in b)), min_size=2, max_size=20))
def test_common_prefixes(strings):
    keys, lengths = suffixes._matrix(strings, 30)
    order = suffixes.multikey_sort(keys)
    ranked = [strings[k] for k in order]
    assert ranked == sorted(strings)
    common = suffixes._common(keys, lengths, order)
    for k in range(1, len(ranked)):
        a, b = ranked[k - 1], ranked[k]
        assert common[k] == next((j for j in range(min(len(a), len(b))) if a[j] != b[j]), min(len(a), len(b)))


def brute_words(texts, words):
    """What is left of each text, by runs of non-blanks."""
    found = [[m.span() for m in re.finditer(r"[^ \t\n\v\f\r]+", t or "")] for t in texts]
    names = [[t[a:b] for a, b in spans] for t, spans in zip(texts, found)]
    seen = Counter(tuple(w[k : k + words]) for w in names for k in range(len(w) - words + 1))
    out = []
    for t, spans, w in zip(texts, found, names):
        lost = {j for k in range(len(w) - words + 1) if seen[tuple(w[k : k + words])] > 1 for j in range(k, k + words)}
        gone = [False] * len(t or "")
        for j in lost:  # with the blanks up to the next word, if that goes too
            a, b = spans[j][0], spans[j + 1][0] if j + 1 in lost else spans[j][1]
            gone[a:b] = [True] * (b - a)
        out.append("".join(c for c, g in zip(t, gone) if not g) if t is not None else None)
    return out


def planted():
    """Passages of 48 to 60 short and longer words, each in two texts of unlike words, once with other blanks."""
    texts = []
    for n in range(48, 61):
        for lexicon in ("a bc d ef ghi j kl m no é", "passage contains several rather lengthy expressions repeated éèê"):
            r = random.Random(f"{n}{lexicon}")
            passage = [r.choice(lexicon.split(" ")) + str(r.randrange(30)) for _ in range(n)]
            for blank in (" ", "\n  "):
                own = [f"{r.randrange(10**6)}w" for _ in range(r.randrange(20, 90))]
                at = r.randrange(len(own))
                texts.append(" ".join(own[:at]) + " " + blank.join(passage) + " " + " ".join(own[at:]))
    return texts


@pytest.mark.parametrize("hot", [512, 2])
def test_words_as_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    texts = planted() + [t for _, t in corpus() if not any("぀" <= c <= "鿿" for c in t)] + [None, "", " \n ", "w " * 50, "v " * 51, "u " * 52, "z" * 5000]
    got = cases.by_id(suffixes.dedup(cases.frame(spark, texts), 51, keep_columns=True, words=True), "text")
    want = brute_words(texts, 51)
    assert [got[k][0] for k in range(len(texts))] == want
    assert [len(a) < len(t) for a, t in zip(want, planted())] == [n > 50 for n in range(48, 61) for _ in range(4)]


def test_characters_without_blanks_are_words(spark):
    r = random.Random(3)
    letters = [chr(c) for lo, hi in ((0x4E00, 0x9F00), (0x3042, 0x3090), (0x0E01, 0x0E2E), (0x20000, 0x20100)) for c in r.sample(range(lo, hi), 40)]
    passage, short = ("".join(r.choice(letters) for _ in range(n)) for n in (51, 50))
    texts = ["one " + passage + "two", "three" + passage, "four " + short + "five", "six" + short]
    got = cases.by_id(suffixes.dedup(cases.frame(spark, texts), 51, keep_columns=True, words=True), "text")
    assert [got[k][0] for k in range(4)] == ["one two", "three", *texts[2:]]
