"""Encode texts through the distinct pieces that they consist of.

Pieces are cut where no token can cross: at blanks, and where a letter, a digit and a sign
meet. The cuts are found in the bytes of many texts at once, and equal pieces are brought
together before they are looked up; each distinct piece is encoded once and remembered.
The table of a Python worker is bounded: beyond LIMIT pieces, or LIMIT_CHARS characters in
them (texts without blanks are long pieces), it starts again.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from worksledger.llm.common import TABLES, joined_bytes

#: Pieces that one worker remembers, about.
LIMIT = 1_200_000
#: Characters of the pieces that one worker remembers, about.
LIMIT_CHARS = 16_000_000

#: Kinds of bytes. RARE is white space beyond ASCII, and the ASCII separators that only some
#: libraries count as such; LATIN and WIDE are first bytes that may belong to letters and to RARE.
OTHER, RARE, LETTER, DIGIT, SIGN, BLANK, SPACE, LATIN, WIDE = range(9)
_KIND = np.zeros(256, np.uint8)
for _signs, _kind in (
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", LETTER),
    (b"0123456789", DIGIT),
    (b".,;:!?|#$%&*()[]{}/=+<>@^_~\"`-", SIGN),
    (b"\t\n\x0b\x0c\r", BLANK),
    (b" ", SPACE),
    (b"\x1c\x1d\x1e\x1f", RARE),
    (b"\xc3", LATIN),
    (b"\xc2\xe1\xe2\xe3", WIDE),
):
    _KIND[list(_signs)] = _kind
_WIDE_SPACE = re.compile(r"[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: The first three bytes of each such character as one number; of those with two bytes, only these.
_SPACES = np.unique([int.from_bytes(chr(c).encode().ljust(3, b"\0"), "big") for c in range(0x3001) if _WIDE_SPACE.match(chr(c))])

#: A piece of one kind, a space before it or not, is one pre-token of the byte-level pattern.
_ONE_KIND = re.compile(r" ?(?:[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+|[0-9]+|[.,;:!?|#$%&*()\[\]{}/=+<>@^_~\"`\-]+)")
#: The characters that stand for bytes in byte-level vocabularies: those that show, and others from 256 on.
_BYTE_SIGNS = np.arange(256, dtype="<u4")
_HIDDEN = [b for b in range(256) if b not in {*range(33, 127), *range(161, 173), *range(174, 256)}]
_BYTE_SIGNS[_HIDDEN] = np.arange(256, 256 + len(_HIDDEN))

#: (bytes of texts, where they begin) to a mark on each byte with which a piece begins.
Split = Callable[[np.ndarray, np.ndarray], np.ndarray]


def kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each byte of well-formed UTF-8: one of OTHER to SPACE."""
    kind = _KIND[data]
    first = np.flatnonzero(kind >= LATIN)
    if len(first):
        latin = first[kind[first] == LATIN]
        wide = first[kind[first] == WIDE]
        kind[first] = OTHER
        latin = latin[(data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7)]  # signs of multiplication and division
        kind[latin] = kind[latin + 1] = LETTER
        third = np.where(data[wide] == 0xC2, 0, data[np.minimum(wide + 2, len(data) - 1)]).astype(np.int64)
        code = (data[wide].astype(np.int64) << 16) | (data[wide + 1].astype(np.int64) << 8) | third
        wide = wide[np.isin(code, _SPACES)]
        kind[wide] = kind[wide + 1] = RARE
        wide = wide[data[wide] != 0xC2]
        kind[wide + 2] = RARE
    return kind


def _parts(kind: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pairs of neighbours: both kinds, which are blank, and where a piece begins with the second in any case."""
    before, after = kind[:-1], kind[1:]
    blank = kind >= BLANK
    first = (before != after) & (before >= LETTER) & (after >= LETTER) & ~blank[:-1] & ~blank[1:]
    # blanks that follow others than RARE
    return before, after, blank[:-1], blank[1:], first | (blank[1:] & ~blank[:-1] & (before != RARE))


def spaced_pieces(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Pieces, blanks included, whose own pre-tokens are together those of the text.

    The last of several blanks is a piece or, if it is a space, begins the next one. Beside
    RARE nothing is cut, as it may be part of the blanks.
    """
    out = np.zeros(len(data), bool)
    if len(data):
        before, after, blank, blank_after, first = _parts(kinds(data))
        begins = ~blank_after & (after != RARE)
        last = blank & begins
        last[edges[(edges > 0) & (edges < len(data))] - 1] = False
        out[1:] = first | ((before == BLANK) & begins)
        out[:-1] |= last
        out[edges[edges < len(data)]] = True
    return out


def words(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Pieces with and without blanks apart, for vocabularies that drop white space."""
    out = np.zeros(len(data), bool)
    if len(data):
        _, _, blank, blank_after, first = _parts(kinds(data))
        out[1:] = first | (blank & ~blank_after)
        out[edges[edges < len(data)]] = True
    return out


class _Places(dict):
    """Numbers pieces in the order in which they are first asked for."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = place = len(self)
        self.new.append(piece)
        return place


class Lexicon:
    """ids of pieces by table; encode(list of pieces) gives all ids and their number per piece.

    Each of the marks in a text is a piece of its own, what stands between them is split.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], split: Split, marks: Sequence[str] = ()):
        self.encode_pieces, self.split, self.marks = encode, split, tuple(marks)
        # of two that begin together the library takes the longer
        self.cut = re.compile(b"|".join(re.escape(m.encode()) for m in sorted(marks, key=len, reverse=True)))
        self.clear()

    def clear(self) -> None:
        self.places, self.held = _Places(), 0
        self.ids, self.starts, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self) -> None:
        if self.places.new:
            self.held += sum(map(len, self.places.new))
            ids, counts = self.encode_pieces(self.places.new)
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
            self.places.new = []

    def _begins(self, texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where pieces begin, in the bytes of all texts."""
        spans = []
        for k in sorted({int(k) for mark in self.marks for k in pc.indices_nonzero(pc.match_substring(texts, mark).fill_null(False)).to_numpy()}):
            found = self.cut.finditer(data[offsets[k] : offsets[k + 1]].tobytes())
            spans += [(offsets[k] + m.start(), offsets[k] + m.end()) for m in found]
        first = self.split(data, np.unique(np.concatenate([offsets, np.array(spans, np.int64).ravel()])))
        for a, b in spans:
            first[a + 1 : b] = False
        return np.flatnonzero(first)

    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids per text); a null text has none."""
        if len(self.places) > LIMIT or self.held > LIMIT_CHARS:
            self.clear()
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        data, offsets = joined_bytes(texts)
        begins = self._begins(texts, data, offsets)
        bounds = np.append(begins, len(data))
        pieces = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(bounds), pa.py_buffer(data)).dictionary_encode()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False)
        at = np.fromiter(map(self.places.__getitem__, distinct), np.int64, len(distinct))
        self._learn()
        which = pieces.indices.to_numpy()
        counts = self.counts[at][which]
        ends = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids[np.repeat(self.starts[at][which] - ends[:-1], counts) + np.arange(ends[-1])]
        return ids, np.diff(ends[np.searchsorted(begins, offsets)])


_KNOWN: dict[tuple[str, str, bool], Lexicon] = {}
TABLES.append(_KNOWN)


def _is_byte_level(tokenizer) -> bool:
    """Whether pre-tokens are those of the byte-level pattern, cut from the text as it is."""
    if tokenizer.normalizer is not None or tokenizer.pre_tokenizer is None:
        return False
    state = json.loads(tokenizer.pre_tokenizer.__getstate__())
    return state.get("type") == "ByteLevel" and state.get("use_regex") and not state.get("add_prefix_space")


def library_lexicon(path: str, split: Split, marks: bool = True) -> Lexicon:
    """Of a vocabulary file of the tokenizers library; one for each worker and file.

    marks: names of added tokens in a text are these tokens, as the library has it unless
    told otherwise; else they are ordinary text.
    """
    key = (path, split.__name__, marks)
    if key not in _KNOWN:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        joined = single = Tokenizer.from_file(path)
        if not marks:
            single = Tokenizer.from_file(path)
            single.encode_special_tokens = True
        added = list(joined.get_added_tokens_decoder().values())
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added):
            raise ValueError(f"{path} has added tokens that depend on what stands beside them")
        names = [t.content for t in added]
        mark = "<|endoftext|>"
        mark_id = joined.token_to_id(mark)

        signs = ["<|", *names]
        tokenize = joined.model.tokenize if _is_byte_level(joined) else None

        def safe_ones(pieces: list[str]) -> list[bool]:
            """Which hold nothing that could be taken for a part of a special token."""
            together = "\n".join(pieces)
            if mark_id is not None and not any(x in together for x in signs):
                return [True] * len(pieces)
            return [mark_id is not None and not any(x in piece for x in signs) for piece in pieces]

        # each of these gives all ids and their number per piece

        def of_one_kind(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            """Pieces that are one pre-token each, by the library's model alone."""
            raw = np.frombuffer("\n".join(pieces).encode(), np.uint8)
            shown = _BYTE_SIGNS[raw].tobytes().decode("utf-32-le").split(chr(_BYTE_SIGNS[10]))
            tokens = [tokenize(x) for x in shown]
            return np.array([t.id for x in tokens for t in x], np.int32), np.array([len(x) for x in tokens])

        def together(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            """Many pieces in one call, with a special token behind each of them."""
            runs = [mark.join(pieces[k : k + 1000]) + mark for k in range(0, len(pieces), 1000)]
            flat = np.concatenate([np.asarray(x.ids, np.int32) for x in joined.encode_batch_fast(runs, add_special_tokens=False)])
            return flat[flat != mark_id], np.diff(np.flatnonzero(flat == mark_id), prepend=-1) - 1

        def alone(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            found = [x.ids for x in single.encode_batch_fast(pieces, add_special_tokens=False)]
            return np.array([k for x in found for k in x], np.int32), np.array([len(x) for x in found])

        def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            safe = np.array([x for k in range(0, len(pieces), 1000) for x in safe_ones(pieces[k : k + 1000])], bool)
            simple = np.array([tokenize is not None and _ONE_KIND.fullmatch(x) is not None for x in pieces], bool)
            ways = {of_one_kind: safe & simple, together: safe & ~simple, alone: ~safe}
            found = {way: way([pieces[k] for k in np.flatnonzero(which)]) for way, which in ways.items() if which.any()}
            counts = np.zeros(len(pieces), np.int64)
            for way, (_, n) in found.items():
                counts[ways[way]] = n
            ids = np.empty(int(counts.sum()), np.int32)
            for way, (some, _) in found.items():
                ids[np.repeat(ways[way], counts)] = some
            return ids, counts

        _KNOWN[key] = Lexicon(encode, split, names if marks else ())
    return _KNOWN[key]
