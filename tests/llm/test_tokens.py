import base64
import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm import cases
from worksledger.llm import bpe, common, lexicon, packing, tokenfile
from worksledger.session import scratch_path

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def library(path):
    return Tokenizer.from_file(path)  # as it is loaded: names of special tokens are these tokens


@pytest.fixture(scope="module")
def plain():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n=400):
    r = random.Random(3)
    signs = " \n\t\r\x0b\xa0 　\x1c\x85abcdeéßñö日本語中文0123'sStT,.!?#_-\U0001f600́Ωж"
    special = ["<|endoftext|>", "a<|endoftext|>b <|", " x <|endoftext|> y<|startoftext|><|endoftext|>|>", "<|end<|endoftext|>\xa0<|ENDOFTEXT|>", "don't we'll.'s ''ll x.'y a1b2.3,4 É.é's"]
    return [*special, *("".join(r.choice(signs) for _ in range(r.randint(0, 200))) for _ in range(n))]


@pytest.mark.parametrize("path, split", [(BYTES, lexicon.spaced_pieces), (WORDS, lexicon.words)])
def test_pieces_give_the_ids_of_the_whole_text(path, split):
    texts = [*odd_texts(), *cases.TEXTS]
    ids, counts = lexicon.library_lexicon(path, split).encode(texts)
    ends = np.cumsum(counts)
    expected = [x.ids for x in library(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [ids[e - c : e].tolist() for e, c in zip(ends, counts)] == expected


def test_a_full_table_starts_again(monkeypatch):
    monkeypatch.setattr(lexicon, "LIMIT", 50)
    texts = [cases.prose(k, 40) for k in range(6)]
    lex = lexicon.Lexicon(lexicon.library_lexicon(BYTES, lexicon.spaced_pieces).encode_pieces, lexicon.spaced_pieces)
    expected = [x.ids for x in library(BYTES).encode_batch(texts, add_special_tokens=False)]
    for text, want in zip(texts, expected):
        assert lex.encode([text])[0].tolist() == want


@pytest.mark.parametrize("path, split", [(BYTES, lexicon.spaced_pieces), (WORDS, lexicon.words)])
def test_marks_as_ordinary_text(path, split):
    texts, plainly = odd_texts(50), Tokenizer.from_file(path)
    plainly.encode_special_tokens = True
    ids, counts = lexicon.library_lexicon(path, split, marks=False).encode(texts)
    expected = [x.ids for x in plainly.encode_batch(texts, add_special_tokens=False)]
    assert [ids[e - c : e].tolist() for e, c in zip(np.cumsum(counts), counts)] == expected


@pytest.mark.parametrize("sign", ["\xa0", "\u65e5"])
def test_long_pieces_are_bounded_by_their_size(monkeypatch, sign):
    monkeypatch.setattr(lexicon, "LIMIT_CHARS", 3000)
    lex = lexicon.Lexicon(lexicon.library_lexicon(BYTES, lexicon.spaced_pieces).encode_pieces, lexicon.spaced_pieces)
    for k in range(12):
        text = sign.join(cases.prose(k, 150).split(" "))
        assert lex.encode([text])[0].tolist() == library(BYTES).encode(text, add_special_tokens=False).ids
        assert lex.held <= 3000 + len(text)


class Counting(lexicon._Places):
    """Counts what is looked up."""

    asked = 0

    def __getitem__(self, piece):
        self.asked += 1
        return super().__getitem__(piece)


@pytest.mark.parametrize("path, split", [(BYTES, lexicon.spaced_pieces), (WORDS, lexicon.words)])
def test_equal_pieces_are_looked_up_once(path, split):
    lex = lexicon.Lexicon(lexicon.library_lexicon(path, split).encode_pieces, split)
    lex.places = Counting()
    texts = [cases.prose(k % 3, 200) for k in range(60)]
    ids, counts = lex.encode(texts)
    assert lex.places.asked == len(lex.places) < 1000
    expected = [x.ids for x in library(path).encode_batch(texts, add_special_tokens=False)]
    assert [ids[e - c : e].tolist() for e, c in zip(np.cumsum(counts), counts)] == expected


@pytest.mark.parametrize("text", ["one\xa0two three four ", "\u65e5 one two\u3000 three", "a1b2 c3 ' d'e.f"])
def test_rare_blanks_and_signs_leave_other_pieces_apart(text):
    lex = lexicon.Lexicon(lexicon.library_lexicon(BYTES, lexicon.spaced_pieces).encode_pieces, lexicon.spaced_pieces)
    texts = [text * 50, text]
    for t in texts:
        assert lex.encode([t])[0].tolist() == library(BYTES).encode(t, add_special_tokens=False).ids
    assert max(map(len, lex.places)) < len(text)


def test_every_short_text_of_kinds_gives_the_ids_of_the_library():
    signs = ["a", "s", "1", ".", "'", " ", "\n", "\xa0", "\u3000", "\x1c", "é", "÷", "\u65e5"]
    texts = ["".join(x) for n in range(1, 5) for x in itertools.product(signs, repeat=n)]
    ids, counts = lexicon.library_lexicon(BYTES, lexicon.spaced_pieces).encode(texts)
    expected = [x.ids for x in library(BYTES).encode_batch(texts, add_special_tokens=False)]
    assert [ids[e - c : e].tolist() for e, c in zip(np.cumsum(counts), counts)] == expected
    ids, counts = lexicon.library_lexicon(WORDS, lexicon.words).encode(texts)
    expected = [x.ids for x in library(WORDS).encode_batch(texts, add_special_tokens=False)]
    assert [ids[e - c : e].tolist() for e, c in zip(np.cumsum(counts), counts)] == expected


def test_a_table_emptied_by_another_stage_is_built_again():
    first = lexicon.library_lexicon(BYTES, lexicon.spaced_pieces)
    common.forget()
    again = lexicon.library_lexicon(BYTES, lexicon.spaced_pieces)
    assert again is not first
    assert again.encode(["one two"])[0].tolist() == first.encode(["one two"])[0].tolist()


def test_matrices_encode_as_the_library(plain):
    r = random.Random(5)
    long = ["a" * 3000, "ab" * 800, "".join(r.choice("etaoinshrdlu") for _ in range(3000)), " " * 700, "\n" * 90 + "x"]
    texts = [*odd_texts(), *long, *(t for t in cases.TEXTS if t)]
    ids, counts = bpe.lexicon(RANKS, public_tokenizers.PATTERN).encode(texts)
    ends = np.cumsum(counts)
    assert [ids[e - c : e].tolist() for e, c in zip(ends, counts)] == [plain.encode_ordinary(t) for t in texts]


def test_bpe_round_trip_of_awkward_rows(spark, plain):
    df = cases.awkward(spark)
    ids = bpe.encode(df, RANKS, public_tokenizers.PATTERN)
    back = bpe.decode(ids, RANKS).collect()
    assert sorted(map(str, ((r["doc_id"], bytes(r["decoded"])) for r in back))) == sorted(
        str((r["doc_id"], (r["text"] or "").encode())) for r in df.collect()
    )
    digests = bpe.decode(ids, RANKS, digests=True).collect()
    want = []
    for r in df.collect():
        tokens = plain.encode_ordinary(r["text"] or "")
        told = hashlib.sha256(",".join(map(str, tokens)).encode()).hexdigest()
        want.append((r["doc_id"], len(tokens), told, hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, digests))) == sorted(map(str, want))
    assert bpe.decode(bpe.encode(cases.empty(spark), RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1).flatmap(lambda x: st.integers(0, 63).map(lambda s: x >> s)), max_size=300), st.integers(1, 60))
def test_simple8b_round_trip(ids, times):
    ids = np.array(ids * times, np.uint64)
    words, block_words = tokenfile.pack(ids)
    assert block_words.sum() == len(words)
    assert (tokenfile.unpack(words, block_words, len(ids)) == ids).all()


def test_simple8b_packs_by_width():
    assert len(tokenfile.pack(np.zeros(60, int))[0]) == 1
    assert len(tokenfile.pack(np.full(6, 1023))[0]) == 1
    assert len(tokenfile.pack(np.array([2**60]))[0]) == 2  # an escape


def test_token_files_of_awkward_rows(spark):
    df = cases.awkward(spark)
    folder = scratch_path(spark, "tokens")
    tokenfile.write(df, folder, BYTES, end_id=2)
    rows = sorted(tokenfile.read(spark, folder).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    at = 0
    for r in rows:
        assert r["start"] == at
        at += len(r["ids"])
    encode = lambda t: [*library(BYTES).encode(t or "", add_special_tokens=False).ids, 2]
    want = sorted(str((r["doc_id"], encode(r["text"]))) for r in df.collect())
    assert sorted(str((r["doc_id"], r["ids"])) for r in rows) == want
    digests = {r["start"]: (r["n_tokens"], r["ids_crc32"]) for r in tokenfile.read(spark, folder, digests=True).collect()}
    assert digests == {r["start"]: (len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in rows}
    nothing = scratch_path(spark, "tokens")
    tokenfile.write(cases.empty(spark), nothing, BYTES, end_id=2)
    assert tokenfile.read(spark, nothing).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
def test_plan_places_every_piece_once(counts):
    histogram = np.zeros(65, np.int64)
    for length, n in counts.items():
        histogram[length] = n
    placed = np.zeros(65, np.int64)
    for lengths, n in packing.plan(histogram, 64, grain=16):
        assert 0 < sum(lengths) <= 64 and n > 0
        for length in lengths:
            placed[length] += n
    assert (placed == histogram).all()


def test_plan_is_close_to_the_least():
    r = np.random.default_rng(0)
    histogram = np.bincount(np.minimum(2048, np.exp(r.normal(6.4, 0.9, 20_000)).astype(int) + 1), minlength=2049)
    used = sum(n for _, n in packing.plan(histogram, 2048))
    assert used <= 1.01 * (histogram * np.arange(2049)).sum() / 2048


def test_nnls_meets_its_conditions():
    r = np.random.default_rng(2)
    columns = packing.patterns(24, 3, np.ones(25, bool))
    target = r.integers(0, 90, 25).astype(float)
    x = packing.nnls(columns, target)
    a = np.zeros((25, len(columns)))
    for j, column in enumerate(columns):
        for row in column[column >= 0]:
            a[row, j] += 1
    gradient = a.T @ (target - a @ x)
    assert (x >= 0).all() and gradient.max() < 1e-6 and abs(gradient[x > 0]).max() < 1e-6


def test_packing_of_awkward_rows(spark):
    df, size = cases.awkward(spark), 256
    rows = packing.pack(df, WORDS, 0, size).collect()
    want = []
    for r in df.collect():
        ids = [*library(WORDS).encode(r["text"] or "", add_special_tokens=False).ids, 0]
        want += [str((r["doc_id"], k // size, k, ids[k : k + size])) for k in range(0, len(ids), size)]
    assert sorted(str((r["doc_id"], r["piece"], r["start"], r["ids"])) for r in rows) == sorted(want)
    by = {}
    for r in rows:
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    assert packing.pack(cases.empty(spark), WORDS, 0, size).count() == 0


def test_sequences_hold_their_pieces_in_order(spark):
    packed = packing.pack(cases.frame(spark), WORDS, 0, 128).cache()
    held = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert held[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]
