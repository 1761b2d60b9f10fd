from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tests.llm import cases
from tests.llm.test_tokens import odd_texts
from worksledger.llm import align, common

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def tokens(text, libraries):
    """(ids, bytes) of both libraries, token by token."""
    a, b = libraries
    bs = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(x): x for x in bs}
    for x in range(256):
        if x not in bs:
            signs[chr(256 + len(signs) - len(bs))] = x
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(signs[c] for c in a.id_to_token(k)) for k in ids_a]
    bytes_b = [
        bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in ids_b
    ]
    return ids_a, bytes_a, ids_b, bytes_b


def brute(rows, libraries):
    per, held = [], Counter()
    for doc_id, text in rows:
        ids_a, bytes_a, ids_b, bytes_b = tokens(text, libraries) if text else ([], [], [], [])
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            ids_a, bytes_a, ids_b, bytes_b = [], [], [], []
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
        links, j = [], 0
        for i, (k, end) in enumerate(zip(ids_a, ends_a)):
            start = end - len(bytes_a[i])
            while ends_b[j] <= start:
                j += 1
            m = j
            while m < len(ids_b) and ends_b[m] - len(bytes_b[m]) < end:
                links.append((k, ids_b[m]))
                m += 1
        cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        told, x, y = [], 0, 0
        for cut in cuts:
            u, v = int(np.searchsorted(ends_a, cut, "right")), int(np.searchsorted(ends_b, cut, "right"))
            told.append(",".join(map(str, ids_a[x:u])) + "|" + ",".join(map(str, ids_b[y:v])))
            x, y = u, v
        sha = hashlib.sha256(";".join(told).encode()).hexdigest() if told else ""
        per.append((doc_id, len(ids_a), len(ids_b), len(cuts), links, sha))
        held.update(set(links))
    top = Counter()
    for (k, _), n in held.items():
        top[k] = max(top[k], n)
    return sorted(
        (
            (d, na, nb, g, len(links), sum(held[x] == top[x[0]] for x in links), sum(held[x] for x in links), sha)
            for d, na, nb, g, links, sha in per
        ),
        key=str,
    )


@pytest.mark.parametrize("steps", [1, 2, 7, 1000])
def test_merge_path_is_the_plain_merge(steps):
    r = random.Random(steps)
    for _ in range(60):
        end = r.randint(1, 60)
        a, b = ({*r.sample(range(1, end + 1), r.randint(0, end)), end} for _ in range(2))
        a, b = np.array(sorted(a)), np.array(sorted(b))
        want, group = [], 0
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                if (a[i - 1] if i else 0) < y and (b[j - 1] if j else 0) < x:
                    want.append((i, j, sum(c < min(x, y) for c in set(a) & set(b))))
        assert list(zip(*(v.tolist() for v in align.merge_path(a, b, steps)))) == want
    assert all(len(x) == 0 for x in align.merge_path(np.zeros(0, int), np.zeros(0, int), steps))


def test_pieces_of_the_models_are_those_of_whole_texts(libraries):
    texts = [t for t in [*odd_texts(200), *cases.TEXTS, "a  b   c ", "  x", "<s>a</s> ▁x ▁", "a\x00b", "﻿x​"] if t]
    for side, encode in zip(align.sides(A, B), (lambda t: libraries[0].encode(" " + t, add_special_tokens=False).ids, libraries[1].encode)):
        ids, counts = side.lexicon.encode([" " + t for t in texts])
        ends = np.cumsum(counts)
        assert [ids[e - c : e].tolist() for e, c in zip(ends, counts)] == [encode(t) for t in texts]


def test_awkward_rows(spark, libraries, monkeypatch):
    df = cases.awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert sorted(map(tuple, align.align(df, A, B).collect()), key=str) == brute(rows, libraries)
    assert align.align(cases.empty(spark), A, B).count() == 0


def test_odd_texts_in_small_blocks(spark, libraries, monkeypatch):
    texts = [*odd_texts(60), "a ▁ b", "▁", "x▁y", " ", "日本語 の 文章", "é" * 500]
    df = cases.frame(spark, texts)
    a, b = align.sides(A, B)
    got = align.align_texts(pa.array(texts), a, b, steps=3)
    want = {d: (na, nb, g, n) for d, na, nb, g, n, *_ in brute(list(enumerate(texts)), libraries)}
    assert {k: tuple(int(got[c][k]) for c in ("n_a", "n_b", "n_groups", "n_links")) for k in range(len(texts))} == want
    assert want[texts.index("x▁y")] == (0, 0, 0, 0)  # B spells this sign as a space
    assert sorted(map(tuple, align.align(df, A, B).collect()), key=str) == brute(list(enumerate(texts)), libraries)


def test_a_full_lexicon_starts_again(monkeypatch):
    monkeypatch.setattr(align, "MOST_BYTES", 300)
    a, b = align.sides(A, B)
    texts = pa.array([cases.prose(3, 50), cases.prose(4, 50)])
    want = align.align_texts(texts, a, b)
    again = [align.align_texts(texts.slice(k, 1), a, b) for k in range(2)]
    assert [x["told"][0] for x in again] == want["told"] and b.lexicon.held < 2000


def test_blocks_are_written_a_few_at_a_time(spark, libraries, monkeypatch, tmp_path):
    monkeypatch.setattr(align, "BLOCK_BYTES", 1)
    monkeypatch.setattr(align, "PIECE_BYTES", 1)
    monkeypatch.setattr(common, "scratch_path", lambda spark, name: str(tmp_path / name))
    rows = [(k, cases.prose(k, 30)) for k in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted(map(tuple, align.align(df, A, B).collect()), key=str) == brute(rows, libraries)
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "aligned").glob("*.parquet")]
    assert sum(f.num_rows for f in files) == 9
    assert max(f.row_group(k).num_rows for f in files for k in range(f.num_row_groups)) <= 2
