"""Pack token sequences by patterns fitted with non-negative least squares.

1. Tokenise and cut: pieces of at most `size` tokens, written once. Each piece carries
   its rank among the pieces of its length in its task.
2. Plan on the histogram of lengths, which has `size` numbers however many documents
   there are: enumerate patterns of up to DEPTH lengths (rounded up to GRAIN steps) that
   fill a sequence, fit their repeat counts to the histogram by non-negative least squares,
   round, and fill the sequences' gaps and the rest by best fit, longest first, in bulk.
3. Place: a piece of length l and rank r gets the r-th place that the plan has for l.

A null text is empty: its end id alone. An empty table gives an empty result. Repeated
rows are packed row by row; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from worksledger.llm.common import forget, give_back, landed, pieces
from worksledger.llm.lexicon import library_lexicon, words

#: Text that is encoded at a time; its pieces, ids and batches are several times as large.
SLICE_BYTES = 1 << 20
DEPTH = 3
GRAIN = 256

Group = tuple[tuple[int, ...], int]  # lengths of a sequence, and how many sequences have them


def nnls(columns: np.ndarray, target: np.ndarray, most: int = 400) -> np.ndarray:
    """x >= 0 that minimises |A x - target|, by an active set (Lawson and Hanson).

    columns: for each column of A the rows of its ones, -1 for none; a row named twice
    counts twice.
    """
    m, k = columns.shape
    n = len(target)
    used = columns >= 0

    def dense(which: np.ndarray) -> np.ndarray:
        a = np.zeros((n, len(which)))
        for j in range(k):
            on = used[which, j]
            np.add.at(a, (columns[which[on], j], np.flatnonzero(on)), 1.0)
        return a

    x, active = np.zeros(m), np.zeros(0, np.int64)
    norms = np.sqrt(np.maximum(used.sum(axis=1), 1))
    residual = target.astype(float)
    scale = max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(most):
        gain = (np.where(used, residual[columns], 0).sum(axis=1)) / norms
        gain[active] = -np.inf
        new = int(gain.argmax()) if m else -1
        if new < 0 or gain[new] <= 1e-9 * scale:
            break
        active = np.append(active, new)
        while True:
            a = dense(active)
            gram = a.T @ a
            gram.flat[:: len(active) + 1] += 1e-10
            z = np.linalg.solve(gram, a.T @ target)
            if (z > 1e-9).all():
                break
            now, down = x[active], z <= 1e-9
            step = np.min(now[down] / np.maximum(now[down] - z[down], 1e-12))
            now = now + step * (z - now)
            x[active] = np.maximum(now, 0)
            keep = x[active] > 1e-9
            x[active[~keep]] = 0
            if keep.all():
                keep[np.flatnonzero(down)[0]] = False
                x[active[~keep]] = 0
            active = active[keep]
            if not len(active):
                return x
        x[active] = z
        residual = target - a @ z
    return x


def patterns(grain: int, depth: int, there: np.ndarray) -> np.ndarray:
    """All ways to fill `grain` steps with 1 to `depth` lengths that occur, longest first; -1 pads."""
    out = []

    def extend(chosen: list[int], left: int, most: int) -> None:
        if left == 0:
            out.append(chosen + [-1] * (depth - len(chosen)))
        elif len(chosen) + 1 == depth:
            if left <= most and there[left]:
                out.append([*chosen, left])
        else:
            slots = depth - len(chosen)
            for length in range(min(most, left), max(1, -(-left // slots)) - 1, -1):
                if there[length]:
                    extend([*chosen, length], left - length, length)

    extend([], grain, grain)
    return np.array(out, np.int64).reshape(-1, depth)


def plan(histogram: np.ndarray, size: int, grain: int = GRAIN, depth: int = DEPTH) -> list[Group]:
    """Groups of equal sequences for a histogram (pieces by length, index 0 unused)."""
    left = histogram.astype(np.int64).copy()
    step = -(-size // grain)
    grain = size // step  # so that a full pattern fits
    coarse = np.zeros(grain + 2)
    for length in np.flatnonzero(left):
        coarse[-(-length // step)] += left[length]
    coarse = coarse[: grain + 1]
    open_: dict[int, list[list]] = defaultdict(list)  # by room left: [lengths, sequences]
    columns = patterns(grain, depth, coarse > 0)
    repeats = np.floor(nnls(columns, coarse) + 0.5).astype(np.int64) if len(columns) else np.zeros(0, np.int64)
    for c in np.argsort(-repeats, kind="stable"):
        need = [int(g) for g in columns[c] if g >= 0]
        n = int(min([repeats[c], *(sum(left[(g - 1) * step + 1 : g * step + 1]) // need.count(g) for g in need)]))
        if n <= 0:
            continue
        # exact lengths: of all but the last the longest first, equal runs together; the
        # last is the longest that the room left by the others takes
        runs = []
        for g in need[:-1]:
            run, want = [], n
            for length in range(min(g * step, size), (g - 1) * step, -1):
                take = int(min(want, left[length]))
                if take:
                    run.append([length, take])
                    left[length] -= take
                    want -= take
            runs.append(run)
        while n:
            lengths = tuple(run[0][0] for run in runs)
            room = size - sum(lengths)
            last = room
            while last and not left[last]:
                last -= 1
            take = min([n, *(run[0][1] for run in runs), *([int(left[last])] if last else [])])
            left[last] -= take if last else 0
            if last or lengths:
                open_[room - last].append([(*lengths, last) if last else lengths, take])
            n -= take
            for run in runs:
                run[0][1] -= take
                if not run[0][1]:
                    run.pop(0)
    # best fit, longest first: the least room that is enough
    for length in range(size, 0, -1):
        n = int(left[length])
        room = length
        while n:
            while room <= size and not open_.get(room):
                room += 1
            if room > size:
                most = size // length  # new sequences, as many of this length in each as fit
                whole, rest = divmod(n, most)
                if whole:
                    open_[size - most * length].append([(length,) * most, whole])
                if rest:
                    open_[size - rest * length].append([(length,) * rest, 1])
                break
            group = open_[room][-1]
            take = min(n, group[1])
            group[1] -= take
            if not group[1]:
                open_[room].pop()
            open_[room - length].append([(*group[0], length), take])
            n -= take
    return [(tuple(lengths), n) for groups in open_.values() for lengths, n in groups]


def places(groups: list[Group]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: first rank of each run of places, its first sequence, and the offset in it."""
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    ranks: dict[int, int] = defaultdict(int)
    sequence = 0
    for lengths, n in groups:
        offset = 0
        for length in lengths:
            found[length].append((ranks[length], sequence, offset))
            ranks[length] += n
            offset += length
        sequence += n
    return {length: tuple(np.array(x, np.int64) for x in zip(*rows)) for length, rows in found.items()}


PIECES = "piece int, start long, length long, ids array<int>, ids_crc32 long, part int, rank long"


def tokenise(df: DataFrame, vocabulary: str, end_id: int, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents, written once: id, piece, start, length, ids and their CRC,
    and the rank of each among those of its length in its part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in batches:
            for some in pieces(batch, 1, SLICE_BYTES):
                ids, counts = library_lexicon(vocabulary, words).encode(some.column(1))
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id)
                counts = counts + 1
                ends = np.cumsum(counts)
                cut = -(-counts // size)
                doc = np.repeat(np.arange(len(counts)), cut)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(cut) - cut, cut)
                length = np.minimum(size, counts[doc] - piece * size)
                at = (ends - counts)[doc] + piece * size
                rank = np.empty(len(doc), np.int64)
                order = np.argsort(length, kind="stable")
                values, first, n = np.unique(length[order], return_index=True, return_counts=True)
                rank[order] = np.arange(len(doc)) - np.repeat(first, n) + np.repeat(seen[values], n)
                seen[values] += n
                sums = [zlib.crc32(ids[a : a + b].astype("<u4")) for a, b in zip(at, length)]
                offsets = pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0).take(pa.array(doc)),
                        pa.array(piece, pa.int32()),
                        pa.array(piece * size, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                        pa.array(sums, pa.int64()),
                        pa.array(np.full(len(doc), part), pa.int32()),
                        pa.array(rank, pa.int64()),
                    ],
                    [id_col, *(x.split()[0] for x in PIECES.split(", "))],
                )
        give_back()

    kind = df.schema[id_col].dataType.simpleString()
    return landed(df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {PIECES}"), "pieces")


def place(cut: DataFrame, size: int) -> DataFrame:
    """cut, with `sequence_id` and `offset` in place of part and rank."""
    counts = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = landed(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "bases")
    histogram = np.zeros(size + 1, np.int64)
    for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect():  # `size` rows at most
        histogram[r.length] = r.n
    spots = places(plan(histogram, size))
    rows = {c: k for k, c in enumerate(cut.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()  # the texts are encoded
        give_back()
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "nth"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            values, first = np.unique(length[order], return_index=True)
            for value, some in zip(values, np.split(order, first[1:])):
                ranks, sequences, offsets = spots[int(value)]
                run_ = np.searchsorted(ranks, rank[some], side="right") - 1
                sequence[some] = sequences[run_] + rank[some] - ranks[run_]
                offset[some] = offsets[run_]
            kept = batch.select([c for c in batch.schema.names if c != "nth"])
            yield kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    nth = cut.join(bases.select("part", "length", "base"), ["part", "length"]).withColumn("nth", F.col("rank") + F.col("base"))
    nth = nth.select(*[c for c in rows if c not in ("part", "rank")], "nth")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nth.schema if f.name != "nth")
    return nth.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack(
    df: DataFrame, vocabulary: str, end_id: int, size: int, id_col: str = "doc_id", text_col: str = "text", ids: bool = True
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids (unless ids=False), ids_crc32, sequence_id, offset."""
    cut = tokenise(df, vocabulary, end_id, size, id_col, text_col)
    return place(cut if ids else cut.drop("ids"), size)


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence, its pieces in order of offset; a sequence is bounded by its size."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
