"""Byte-level BPE in padded matrices.

Distinct pre-tokens are put in matrices by length (4, 8, 16, .. bytes wide), one row
each. A round looks at all rows of a matrix together: every row merges its leftmost pair
of least rank and closes the gap; rows without a pair that is a token leave. Pairs are
found in a hash table in numpy. Rows beyond LONG bytes are run alone, where a round
merges all equal pairs as far as that cannot change the outcome.

A null text is empty: no ids, nothing decoded. Repeated rows are encoded row by row, an
empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from worksledger.llm.common import GOLDEN, U64, map_texts, ragged
from worksledger.llm.lexicon import Lexicon, spaced_pieces

LONG = 256
NONE = np.int32(2**31 - 1)


class PairTable:
    """(left id, right id) to merged id: open addressing with linear probing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys) + 1).bit_length())
        size = 1 << self.bits
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, NONE, np.int32)
        left, probe = np.arange(len(keys)), self._slot(keys)
        self.longest = 0
        while len(left):
            # of the keys that want a free slot, the last written stays; the rest go on
            free = self.keys[probe] == -1
            self.keys[probe[free]] = keys[left[free]]
            stays = self.keys[probe] == keys[left]
            self.values[probe[stays]] = values[left[stays]]
            left, probe = left[~stays], (probe[~stays] + 1) & (size - 1)
            self.longest += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(U64) * GOLDEN) >> U64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, NONE where there is none; negative ids have none."""
        shape, left, right = left.shape, left.ravel(), right.ravel()
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        keys = np.where((left < 0) | (right < 0), np.int64(-2), keys)
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.values[slot], NONE)
        open_ = np.flatnonzero((held != keys) & (held != -1) & (keys >= 0))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & (len(self.keys) - 1)
            held, want = self.keys[slot], keys[open_]
            hit = held == want
            out[open_[hit]] = self.values[slot[hit]]
            on = ~hit & (held != -1)
            open_, slot = open_[on], slot[on]
        return out.reshape(shape)


class Vocabulary:
    """Tokens by rank, from a file of base64 tokens and ranks."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        ranks = self.ranks
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (a << 32 | b, rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if (a := ranks.get(token[:k])) is not None and (b := ranks.get(token[k:])) is not None
        ]
        keys, values = (np.array(x, np.int64) for x in zip(*pairs))
        self.pairs = PairTable(keys, values.astype(np.int32))
        n = max(ranks.values()) + 1
        tokens, texts = [b""] * n, [f"{k},".encode() for k in range(n)]
        for token, rank in ranks.items():
            tokens[rank] = token
        self.bytes, self.decimals = Strings(tokens), Strings(texts)

    def encode(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids per pre-token)."""
        whole = np.fromiter((self.ranks.get(t, -1) for t in tokens), np.int32, len(tokens))
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        counts = np.where(lengths > 0, 1, 0)
        parts: list[tuple[np.ndarray, np.ndarray]] = []  # rows, and their ids padded with -1
        rest, width, least = np.flatnonzero((whole < 0) & (lengths > 0)), 4, 0
        while len(rest):
            rows = rest[(lengths[rest] > least) & (lengths[rest] <= width)]
            rest = rest[lengths[rest] > width]
            if width > LONG:
                for r in rows:
                    ids = self._long(self.byte_id[np.frombuffer(tokens[r], np.uint8)])
                    parts.append((np.array([r]), ids[None]))
                    counts[r] = len(ids)
            else:
                step = max(1, (1 << 20) // width)
                for k in range(0, len(rows), step):
                    some = rows[k : k + step]
                    ids = self._matrix([tokens[r] for r in some], width)
                    parts.append((some, ids))
                    counts[some] = (ids >= 0).sum(axis=1)
            least, width = width, width * 2
        starts = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int32)
        single = (whole >= 0) & (lengths > 0)
        out[starts[single]] = whole[single]
        for rows, ids in parts:
            kept = ids >= 0
            out[np.repeat(starts[rows], counts[rows]) + ragged(counts[rows])] = ids[kept]
        return out, counts

    def _matrix(self, tokens: list[bytes], width: int) -> np.ndarray:
        """Rows of ids, padded with -1 at the end."""
        raw = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in tokens), np.uint8).reshape(len(tokens), width)
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        ids = np.where(np.arange(width) < lengths[:, None], self.byte_id[raw], -1).astype(np.int32)
        done = np.full_like(ids, -1)
        place = np.arange(len(ids))
        merged = self.pairs.find(ids[:, :-1], ids[:, 1:])
        columns = np.arange(width)
        while len(ids):
            at = merged.argmin(axis=1)  # the leftmost of the least
            rows = np.arange(len(ids))
            best = merged[rows, at]
            over = best == NONE
            if over.any():
                done[place[over], : ids.shape[1]] = ids[over]
                ids, merged, place, at, best = ids[~over], merged[~over], place[~over], at[~over], best[~over]
                if not len(ids):
                    break
                rows = np.arange(len(ids))
            ids[rows, at] = best
            w = ids.shape[1]
            if w == 2:
                done[place, 0] = best
                break
            # close the gap: what follows the merged pair moves one to the left
            shift = columns[: w - 1] + (columns[: w - 1] > at[:, None])
            ids = np.take_along_axis(ids, shift, axis=1)
            gap = columns[: w - 2] + (columns[: w - 2] >= at[:, None])
            merged = np.take_along_axis(merged, gap, axis=1)
            right = np.flatnonzero(at < w - 2)
            merged[right, at[right]] = self.pairs.find(ids[right, at[right]], ids[right, at[right] + 1])
            left = np.flatnonzero(at > 0)
            merged[left, at[left] - 1] = self.pairs.find(ids[left, at[left] - 1], ids[left, at[left]])
        return done

    def _long(self, ids: np.ndarray) -> np.ndarray:
        """One pre-token of any length, by its byte ids."""
        while len(ids) > 1:
            merged = self.pairs.find(ids[:-1], ids[1:])
            best = merged.min()
            if best == NONE:
                break
            at = np.flatnonzero(merged == best)
            run = np.arange(len(at)) - np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, np.arange(len(at)), 0))
            at = at[run % 2 == 0]  # of overlapping pairs, from the left, every other
            after = self._merge(ids, at, best)
            # a new pair of still lower rank would have come before the next of these
            new = at - np.arange(len(at))
            lower = self.pairs.find(after[:-1], after[1:]) < best
            before = np.where(new > 0, lower[np.maximum(new - 1, 0)] if len(lower) else False, False)
            behind = np.where(new < len(lower), lower[np.minimum(new, max(len(lower) - 1, 0))] if len(lower) else False, False)
            early = np.flatnonzero(before | behind)
            ids = self._merge(ids, at[: early[0] + 1], best) if len(early) else after
        return ids

    @staticmethod
    def _merge(ids: np.ndarray, at: np.ndarray, best: int) -> np.ndarray:
        out = ids.copy()
        out[at] = best
        return np.delete(out, at + 1)


class Strings:
    """Byte strings by number, joined for runs of numbers."""

    def __init__(self, strings: list[bytes]):
        self.counts = np.fromiter(map(len, strings), np.int64, len(strings))
        self.starts = np.cumsum(self.counts) - self.counts
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def join(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the bytes of all ids after one another, the place where each ends, from 0)."""
        counts = self.counts[ids]
        return self.data[np.repeat(self.starts[ids], counts) + ragged(counts)], np.concatenate([[0], np.cumsum(counts)])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def lexicon(path: str, pattern: str) -> Lexicon:
    """Pieces between blanks, cut by the pattern and encoded; one for each worker."""
    import regex

    # the pattern's blanks as Unicode has them, whatever the library counts as such
    space = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    inside = regex.sub(r"\[\^\\s", lambda _: "[^" + space, pattern)
    cut = regex.compile(inside.replace(r"\S", f"[^{space}]").replace(r"\s", f"[{space}]"))
    vocab = vocabulary(path)

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [cut.findall(x) for x in pieces]
        tokens = list({t: None for found in split for t in found})
        place = {t: k for k, t in enumerate(tokens)}
        ids, counts = vocab.encode([t.encode() for t in tokens])
        starts = np.cumsum(counts) - counts
        at = np.fromiter((place[t] for found in split for t in found), np.int64)
        ends = np.concatenate([[0], np.cumsum(counts[at])])
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in split])]).astype(np.int64)
        return ids[np.repeat(starts[at], counts[at]) + ragged(counts[at])], np.diff(ends[bounds])

    return Lexicon(encode, spaced_pieces)


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and `ids`, the tokens of each text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, counts = lexicon(path, pattern).encode(batch.column(1))
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))], [id_col, "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return map_texts(df.select(id_col, text_col), f"`{id_col}` {kind}, ids array<int>", work)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids", digests: bool = False) -> DataFrame:
    """id and `decoded`, the bytes of the tokens.

    With digests, in place of the bytes: `n_tokens`, and the SHA-256 of the ids as
    decimals with commas (`ids_sha256`) and of the bytes (`decoded_sha256`).
    """

    def run(batches):
        vocab = vocabulary(path)
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                batch = whole.slice(k, 256)
                lists = batch.column(1)
                offsets = lists.offsets.to_numpy()
                ids = lists.values.to_numpy()[offsets[0] : offsets[-1]]
                bounds = offsets - offsets[0]
                data, ends = vocab.bytes.join(ids)
                texts = [data[ends[a] : ends[b]].tobytes() for a, b in zip(bounds, bounds[1:])]
                if not digests:
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], [id_col, "decoded"])
                    continue
                digits, ends = vocab.decimals.join(ids)
                told = [digits[ends[a] : max(ends[a], ends[b] - 1)] for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in told]),
                        pa.array([hashlib.sha256(x).hexdigest() for x in texts]),
                    ],
                    [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = df.schema[id_col].dataType.simpleString()
    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "decoded binary"
    return df.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, {columns}")
