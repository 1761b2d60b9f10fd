"""Alignment of two tokenizers' tokens by merging their ends.

The byte offsets where the tokens of A and those of B end are two ascending lists. Their
merge visits every pair of overlapping tokens once, and an end that both lists hold cuts
the text into groups. The merge runs by merge paths: diagonals at equal distances cross the
path at places that a binary search finds, so that the path falls into independent pieces
of equal work, whatever the lengths of the texts; all pieces advance together, one step of
each at a time, and what crosses their boundaries is stitched by adding up their cuts.

Counts of linked pairs come from one row per pair and block of texts, not per link: each
block names its distinct pairs once and its texts refer to them by number.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from worksledger.llm.common import give_back, joined_bytes, landed, pieces, ragged
from worksledger.llm.lexicon import Lexicon, library_lexicon, spaced_pieces

STEPS = 256  # of the merge in one piece
BLOCK_BYTES = 4 << 20  # of text whose pairs are counted together
BLOCKS_TOGETHER = 2  # that a writer or reader of Parquet holds
PIECE_BYTES = 1 << 20  # of text encoded together
#: What a worker remembers of each vocabulary before it starts again.
MOST_PIECES, MOST_BYTES = 300_000, 8 << 20


def merge_path(a_ends: np.ndarray, b_ends: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping tokens (i, j) in the order of the text, and the group of each.

    Ends ascend strictly and the last ones agree. Step s of the merge stands before tokens
    i of A and s - i of B and passes the one that ends first, A's when both end together.
    """
    n_a, n_b = len(a_ends), len(b_ends)
    total = n_a + n_b
    if not total:
        return (np.zeros(0, np.int64),) * 3
    diagonal = np.arange(0, total, steps)
    low, high = np.maximum(diagonal - n_b, 0), np.minimum(diagonal, n_a)
    while (open_ := low < high).any():  # the first i whose end lies beyond the B tokens passed
        middle = (low + high) >> 1
        passed = open_ & (a_ends[np.minimum(middle, n_a - 1)] <= b_ends[np.clip(diagonal - 1 - middle, 0, n_b - 1)])
        low = np.where(passed, middle + 1, low)
        high = np.where(open_ & ~passed, middle, high)
    i, j = low.copy(), diagonal - low
    a = np.concatenate([a_ends, [np.iinfo(np.int64).max]])
    b = np.concatenate([b_ends, [np.iinfo(np.int64).max]])
    a_starts, b_starts = np.concatenate([[0], a_ends]), np.concatenate([[0], b_ends])
    shape = (min(steps, total), len(diagonal))
    at_i, at_j = np.empty(shape, np.int64), np.empty(shape, np.int64)
    linked, cut = np.empty(shape, bool), np.empty(shape, bool)
    for s in range(shape[0]):
        end_a, end_b = a[i], b[j]
        at_i[s], at_j[s] = i, j
        linked[s] = (a_starts[i] < end_b) & (b_starts[j] < end_a) & (i < n_a) & (j < n_b)
        cut[s] = linked[s] & (end_a == end_b)
        first_a = (end_a <= end_b) & (i < n_a)
        i = np.where(first_a, i + 1, i)
        j = np.where(first_a, j, np.minimum(j + 1, n_b))
    # stitch: a piece begins in the group that the cuts before it have reached
    inside = np.cumsum(cut, axis=0) - cut
    before = np.cumsum(cut.sum(axis=0))
    group = inside + np.concatenate([[0], before[:-1]])
    keep = linked.T  # piece after piece, each in its order
    return at_i.T[keep], at_j.T[keep], group.T[keep]


class _Bounded(Lexicon):
    """A lexicon that starts again beyond a number of pieces or of their bytes."""

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.places) > MOST_PIECES or self.held > MOST_BYTES:
            self.clear()
        return super().encode(texts)


class Side:
    """One tokenizer: ids of texts, and the bytes of each id."""

    def __init__(self, lexicon: Lexicon, tokens: list[bytes]):
        self.lexicon = lexicon
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.told = {sign: np.array([f"{k}{sign}" for k in range(len(tokens))], object) for sign in ",|;"}

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[np.repeat(self.start[ids], self.size[ids]) + ragged(self.size[ids])]


def _whole(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data), bool)
    out[edges[edges < len(data)]] = True
    return out


def _behind_spaces(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    out = _whole(data, edges)
    out[1:] |= (data[1:] == 32) & (data[:-1] != 32)
    return out


def byte_level(path: str) -> Side:
    """A byte-level BPE file of the tokenizers library."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    signs = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in set(shown))}
    tokens = [b""] * (max(vocabulary.values()) + 1)
    for token, k in vocabulary.items():
        tokens[k] = bytes(map(signs.__getitem__, token)) if all(c in signs for c in token) else token.encode()
    return Side(_Bounded(library_lexicon(path, spaced_pieces, marks=False).encode_pieces, spaced_pieces), tokens)


def sentence_pieces(path: str) -> Side:
    """A sentencepiece model whose pieces hold no space behind another character."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    named = [model.id_to_piece(k) for k in range(model.get_piece_size())]
    tokens = [bytes([int(p[3:5], 16)]) if model.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(named)]
    lone = [model.piece_to_id("▁")]
    apart = all(re.fullmatch("▁*[^▁]*", p) for p in named)

    def encode(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # the model itself adds the first space of what it is given, unless that is nothing
        ids = model.encode([p.removeprefix(" ") for p in parts], num_threads=1)
        ids = [x or lone for x in ids]
        flat = np.fromiter((k for x in ids for k in x), np.int64)
        return flat, np.array([len(x) for x in ids], np.int64)

    return Side(_Bounded(encode, _behind_spaces if apart else _whole), tokens)


_SIDES: dict[tuple[str, str], tuple[Side, Side]] = {}


def sides(a_path: str, b_path: str) -> tuple[Side, Side]:
    """Both tokenizers, once for each worker."""
    if (a_path, b_path) not in _SIDES:
        _SIDES[a_path, b_path] = byte_level(a_path), sentence_pieces(b_path)
    return _SIDES[a_path, b_path]


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over runs of counts values each."""
    ends = np.concatenate([[0], np.cumsum(values)])
    bounds = np.concatenate([[0], np.cumsum(counts)])
    return np.diff(ends[bounds])


def align_texts(texts: pa.Array, a: Side, b: Side, steps: int = STEPS) -> dict[str, np.ndarray]:
    """Per text: n_a, n_b, n_groups, n_links, told (its groups); per text and linked pair: doc, pair, times."""
    raw, offsets = joined_bytes(pa.array([" " + t if t else "" for t in texts.to_pylist()], pa.string()))
    spaced = [" " + t if t else "" for t in texts.to_pylist()]
    n, size = len(spaced), np.diff(offsets)
    ids, counts = zip(*(side.lexicon.encode(spaced) for side in (a, b)))
    good = size > 0
    for side, x, c in zip((a, b), ids, counts):
        good &= _sums(side.size[x], c) == size
    for side, x, c in zip((a, b), ids, counts):  # those of the right lengths, byte by byte
        differs = side.bytes_of(x[np.repeat(good, c)]) != raw[np.repeat(good, size)]
        good[np.flatnonzero(good)[_sums(differs, size[good]) > 0]] = False
    ids = [x[np.repeat(good, c)] for x, c in zip(ids, counts)]
    counts = [np.where(good, c, 0) for c in counts]
    docs = [np.repeat(np.arange(n), c) for c in counts]
    i, j, group = merge_path(np.cumsum(a.size[ids[0]]), np.cumsum(b.size[ids[1]]), steps)
    out = {"n_a": counts[0], "n_b": counts[1], "n_links": np.bincount(docs[0][i], minlength=n)}
    of_a, of_b = np.zeros(len(ids[0]), np.int64), np.zeros(len(ids[1]), np.int64)
    of_a[i], of_b[j] = group, group
    last_a = np.append(of_a[1:] != of_a[:-1], True)[: len(of_a)]
    last_b = np.append(of_b[1:] != of_b[:-1], True)[: len(of_b)]
    out["n_groups"] = np.bincount(docs[0][last_a], minlength=n)
    # the text of the groups: A's tokens of a group, then B's
    b_before = np.flatnonzero(np.append(True, last_b[:-1]))[of_a] if len(of_a) else of_a
    a_through = np.flatnonzero(last_a)[of_b] + 1 if len(of_b) else of_b
    told = np.empty(len(of_a) + len(of_b), object)
    told[np.arange(len(of_a)) + b_before] = np.where(last_a, a.told["|"][ids[0]], a.told[","][ids[0]])
    told[np.arange(len(of_b)) + a_through] = np.where(last_b, b.told[";"][ids[1]], b.told[","][ids[1]])
    told, ends = told.tolist(), np.cumsum(counts[0] + counts[1])
    out["told"] = ["".join(told[e - k : e])[:-1] for e, k in zip(ends, counts[0] + counts[1])]
    keys, out["times"] = np.unique((docs[0][i] << 33) | (ids[0][i] * len(b.size) + ids[1][j]), return_counts=True)
    out["doc"], out["pair"] = keys >> 33, keys & ((1 << 33) - 1)
    return out


_LISTS = "doc_id: int64, n_a: int64, n_b: int64, n_groups: int64, n_links: int64, groups_sha256: string, n_pairs: int32"


def _blocks(a_path: str, b_path: str, make: Callable[[str, str], tuple[Side, Side]]) -> Callable:
    """Texts to one row per block: per-text lists, distinct pairs, and which text has which how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = make(a_path, b_path)
        first, number = TaskContext.get().partitionId() << 32, 0
        rows: dict[str, list] = {name.split(":")[0]: [] for name in _LISTS.split(", ")}
        pairs, times, held = [], [], 0

        def block() -> pa.RecordBatch:
            pair = np.concatenate(pairs) if pairs else np.zeros(0, np.int64)
            distinct, at = np.unique(pair, return_inverse=True)
            columns = {"block": pa.array([first + number], pa.int64())}
            for spec in _LISTS.split(", "):
                name, kind = spec.split(": ")
                columns[name] = pa.array([pa.array(rows[name], kind)], pa.list_(pa.type_for_alias(kind)))
                rows[name].clear()
            # one value each for Spark, which moves them and never looks into them
            columns["place"] = pa.array([at.astype("<i4").tobytes()])
            columns["times"] = pa.array([np.concatenate(times).astype("<i4").tobytes() if times else b""])
            for name, x in (("pair", distinct), ("docs", np.bincount(at, minlength=len(distinct)))):
                columns[name] = pa.array([pa.array(x, pa.int64())], pa.list_(pa.int64()))
            pairs.clear()
            times.clear()
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            for piece in pieces(batch, 1, PIECE_BYTES):
                got = align_texts(piece.column(1), a, b)
                rows["doc_id"] += piece.column(0).to_pylist()
                for name in ("n_a", "n_b", "n_groups", "n_links"):
                    rows[name] += got[name].tolist()
                rows["groups_sha256"] += [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in got["told"]]
                rows["n_pairs"] += np.bincount(got["doc"], minlength=piece.num_rows).tolist()
                pairs.append(got["pair"])
                times.append(got["times"].astype(np.int32))
                held += piece.column(1).nbytes
                if held >= BLOCK_BYTES:
                    yield block()
                    number, held = number + 1, 0
        if rows["doc_id"]:
            yield block()
        give_back()

    return run


_BLOCK = (
    "block bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
    "groups_sha256 array<string>, n_pairs array<int>, place binary, times binary, pair array<bigint>, docs array<bigint>"
)
_RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _scored(block: pa.Table, counted: pa.Table) -> pa.Table:
    """The texts of one block, with the corpus-wide counts of its pairs."""
    place, times = (np.frombuffer(block.column(c)[0].as_buffer(), "<i4") for c in ("place", "times"))
    row = {name: block.column(name).combine_chunks()[0].values for name in block.column_names if name not in ("block", "place", "times")}
    order = np.argsort(counted.column("pair").to_numpy())  # the order of the block's own pairs
    n, best = (counted.column(c).to_numpy()[order].astype(np.int64) for c in ("n", "is_best"))
    per_text = row["n_pairs"].to_numpy(zero_copy_only=False)
    made = {"n_best": _sums(times * best[place], per_text), "count_sum": _sums(times * n[place], per_text)}
    names = [field.split(" ")[0] for field in _RESULT.split(", ")]
    return pa.table({name: pa.array(made[name]) if name in made else row[name] for name in names})


def pair_counts(blocks: DataFrame, b_size: int) -> DataFrame:
    """(pair, n, is_best): texts that hold a linked pair of ids, and whether no other of its A id is in more.

    The window is over the pairs of one A id, at most as many as B has ids.
    """
    each = blocks.select(F.explode(F.arrays_zip("pair", "docs")).alias("x"))
    counts = each.groupBy(F.col("x.pair").alias("pair")).agg(F.sum("x.docs").alias("n"))
    of_a = Window.partitionBy(F.expr(f"pair div {b_size}"))
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(of_a)).alias("is_best"))


def align(df: DataFrame, a_path: str, b_path: str, make: Callable[[str, str], tuple[Side, Side]] = sides) -> DataFrame:
    """One row per row of (doc_id, text): its alignment and how common its links are.

    A encodes space + text, B the text to which it adds the space itself; names of special
    tokens are plain text. Rows whose text is null or empty, or whose tokens of A or B do
    not spell space + text, have no tokens: zeros and an empty groups_sha256. Each row is
    a document of its own in the counts, also where ids or texts repeat; a null doc_id is
    kept. Other columns are not read. An empty table gives no rows.
    """
    narrow = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = landed(narrow.mapInArrow(_blocks(a_path, b_path, make), _BLOCK), "aligned", BLOCKS_TOGETHER)
    from sentencepiece import SentencePieceProcessor

    counts = pair_counts(blocks, SentencePieceProcessor(model_file=b_path).get_piece_size())
    asked = blocks.select(F.col("block").alias("of"), F.explode("pair").alias("pair")).join(counts, "pair")
    return blocks.drop("pair", "docs").groupBy("block").cogroup(asked.groupBy("of")).applyInArrow(_scored, _RESULT)
