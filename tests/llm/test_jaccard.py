import random

import numpy as np
import pyarrow as pa
from tests.llm import cases
from worksledger.llm import jaccard

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def grams(text, words):
    w = (text or "").encode().translate(LOWER).split()
    return {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()


def brute(rows, words, percent):
    """Component and set size of each row, in order; nodes are ids."""
    sets = [grams(t, words) for _, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if None not in (rows[a][0], rows[b][0]) and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(rows[a][0]), root(rows[b][0])
                up[max(x, y)] = min(x, y)
    return sorted(str((i, len(s), None if i is None else root(i))) for (i, _), s in zip(rows, sets))


def check(spark, rows, words, percent):
    df = cases.frame(spark, [t for _, t in rows], [i for i, _ in rows])
    got = jaccard.join(df, words, percent).collect()
    assert sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got) == brute(rows, words, percent)


def family(seed, size, words, edits):
    r, base = random.Random(seed), cases.prose(seed, words)
    out = [base]
    for _ in range(size):
        text = base.split(" ")
        for _ in range(r.randint(0, edits)):
            text[r.randrange(len(text))] = f"w{r.randrange(10**6)}"
        out.append(" ".join(text))
    return out


def test_as_brute_force(spark):
    texts = [t for seed, size, n, edits in ((1, 12, 120, 6), (2, 25, 60, 3), (3, 8, 400, 30), (4, 6, 12, 2)) for t in family(seed, size, n, edits)]
    common = cases.prose(77, 30)
    texts += [cases.prose(k, 40) + " " + common for k in range(100, 120)]
    rows = [(k, t) for k, t in enumerate(texts)]
    random.Random(0).shuffle(rows)
    check(spark, rows, 3, 90)


def test_chains_are_one_component(spark):
    words = cases.prose(9, 200).split(" ")
    chain = [" ".join(words[4 * k : 4 * k + 120]) for k in range(15)]
    check(spark, list(enumerate([*chain, *family(6, 20, 50, 4)])), 5, 80)


def test_awkward_rows(spark):
    df = cases.awkward(spark)
    check(spark, [(r["doc_id"], r["text"]) for r in df.collect()], 3, 90)
    assert jaccard.join(cases.empty(spark), 3, 90).count() == 0


def test_sets_by_their_definition():
    texts = [*cases.TEXTS, "A b", "a B", "É é", "x" * 500 + " y", "x" * 500 + " z", "\x0ba\x0cb\x0bc", "a b c a b c a"]
    for words in (3, 5):
        sets = jaccard.shingle_sets(pa.array(texts, pa.string()), words)
        assert [len(s) for s in sets] == [len(grams(t, words)) for t in texts]
        for a in range(len(texts)):
            for b in range(a):
                assert len(np.intersect1d(sets[a], sets[b])) == len(grams(texts[a], words) & grams(texts[b], words))


def test_blocked_product_keeps_what_reaches_the_bound():
    r = np.random.default_rng(4)
    sets = [np.unique(r.integers(0, 2**63, 40).astype(np.uint64) * np.uint64(2)) for _ in range(8)]
    sets = [np.unique(np.concatenate([a[: 5 * k], b])) for k, (a, b) in enumerate(zip(sets, sets[::-1]))] + [np.zeros(0, np.uint64)]
    left, right = (x.ravel() for x in np.meshgrid(np.arange(9), np.arange(9)))
    overlap = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(left, right)])
    for need in (1, 5, 20, 40):
        assert jaccard.overlaps(sets, left, right, np.full(81, need)).tolist() == np.flatnonzero(overlap >= need).tolist()


def test_classes_of_one_id_share_a_component(spark):
    a, b, c, d = (cases.prose(k, 60) for k in range(70, 74))
    rows = [(1, a), (2, b), (9, a), (9, b), (9, ""), (3, cases.edited(b, 5)), (4, c), (5, d), (7, c), (8, d), (8, c), (6, None), (6, "  ")]
    got = jaccard.join(cases.frame(spark, [t for _, t in rows], [i for i, _ in rows]), 3, 80).collect()
    assert sorted({(r["doc_id"], r["component_id"]) for r in got}) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (7, 4), (8, 4), (9, 1)]
    assert len(got) == len(rows)
