"""Token ids in word-aligned files.

Coding: Simple-8b. A 64-bit word has a selector in its upper 4 bits; the other 60 hold as
many ids as fit at one width (COUNTS ids of WIDTHS bits). Selector ESCAPE says that the
next word is one id in full, for ids that need more than 60 bits. Ids are coded in blocks
of BLOCK; the number of words of each block is stored, so that blocks can be found, and
decoded side by side, without reading those before.

Files: Parquet rows, each a chunk of whole documents with their lengths, the words and
the block table. Shards (one for each task) and the chunks in them follow ascending
document ids; a second small table has the number of ids in each shard. Files are written
by Spark, so that retried tasks leave nothing behind and any store will do.

A null text is empty and gets the end id alone. Rows with one id are kept side by side,
ordered by a hash of their texts; a null id comes first. An empty table gives empty files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worksledger.llm.common import U64, pieces
from worksledger.llm.lexicon import library_lexicon, spaced_pieces

COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = 60 // COUNTS
ESCAPE = 15
BLOCK = 4096
#: Ids of a chunk, beyond which the next document begins another one.
CHUNK = 1 << 18


#: Bits of each number below 2 ** 16.
_BITS = np.repeat(np.arange(17), [1, *(1 << np.arange(16))]).astype(np.int8)


def widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id."""
    most = int(ids.max(initial=0))
    if most < 1 << 16:
        return _BITS[ids]
    rest, out = ids.astype(U64), np.zeros(len(ids), np.int8)
    for step in (32, 16):
        if most >= 1 << step:
            over = rest >= U64(1) << U64(step)
            out += over.astype(np.int8) * np.int8(step)
            rest = np.where(over, rest >> U64(step), rest)
    return out + _BITS[rest]


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, words of each block). Each word takes as many of the next ids as it can."""
    ids = np.ascontiguousarray(ids)
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    if not n:
        return np.zeros(0, U64), np.zeros(0, np.int32)
    # a block is followed by 60 zeros
    row = BLOCK + 60
    padded = np.zeros((blocks, row), ids.dtype)
    full = n // BLOCK
    padded[:full, :BLOCK] = ids[: full * BLOCK].reshape(full, BLOCK)
    if full < blocks:
        padded[full, : n - full * BLOCK] = ids[full * BLOCK :]
    flat = padded.ravel()
    bits = widths(flat).reshape(padded.shape)
    # the widest of the next c ids, for each c of the table, from windows of powers of two
    windows = {1: bits}
    for size in (2, 4, 8, 16, 32):
        half = windows[size // 2]
        windows[size] = np.maximum(half[:, : -(size // 2)], half[:, size // 2 :])
    # fewer ids get more bits each: the selector is the number of those that do not fit
    selector = np.zeros((blocks, row), np.int8)
    for count, width in zip(COUNTS.tolist(), WIDTHS.tolist()):
        size = min(1 << (count.bit_length() - 1), 32)
        w = windows[size]
        selector[:, :BLOCK] += np.maximum(w[:, :BLOCK], w[:, count - size :][:, :BLOCK]) > width
    selector[selector == len(COUNTS)] = ESCAPE
    selector = selector.ravel()
    # one word of every block at a time; a block that is through stays at its last place
    base = np.arange(blocks) * row
    ends = base + np.minimum(BLOCK, n - BLOCK * np.arange(blocks))
    behind = np.append(COUNTS, [1, 1])[selector]
    behind += np.arange(blocks * row)
    np.minimum(behind, np.repeat(ends, row), out=behind)
    steps = [base]
    while (steps[-1] < ends).any():
        for _ in range(16):
            steps.append(behind[steps[-1]])
    places = np.stack(steps, axis=1)
    there = places < ends[:, None]
    at = places[there]
    of = np.repeat(np.arange(blocks), there.sum(axis=1))
    chosen = selector[at]
    size = np.where(chosen == ESCAPE, 2, 1)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), U64)
    for s in np.unique(chosen).tolist():
        hit = np.flatnonzero(chosen == s)
        froms = at[hit]
        if s == ESCAPE:
            words[place[hit]] = U64(ESCAPE) << U64(60)
            words[place[hit] + 1] = flat[froms]
            continue
        word = np.full(len(hit), U64(s) << U64(60))
        for k in range(COUNTS[s]):
            word |= flat[froms + k].astype(U64) << U64(k * WIDTHS[s])
        words[place[hit]] = word
    return words, np.bincount(of, weights=size, minlength=blocks).astype(np.int32)


def unpack(words: np.ndarray, block_words: np.ndarray, n: int) -> np.ndarray:
    """The n ids of all blocks."""
    if not n:
        return np.zeros(0, U64)
    block = np.repeat(np.arange(len(block_words)), block_words)
    selector = (words >> U64(60)).astype(np.int64)
    # the word behind an escape is data; escapes of one block are told apart in order
    data = np.zeros(len(words), bool)
    marked = np.flatnonzero(selector == ESCAPE)
    last = -2
    for k in marked:  # rare: ids of more than 60 bits
        if k != last + 1 or not data[last + 1]:
            data[k + 1] = True
            last = k
    heads = np.flatnonzero(~data)
    selector, block = selector[heads], block[heads]
    count = np.where(selector == ESCAPE, 1, COUNTS[np.minimum(selector, 13)])
    before = np.cumsum(count) - count
    first = np.searchsorted(block, np.arange(len(block_words)))
    start = before - before[first][block] + block * BLOCK
    out = np.zeros(len(block_words) * BLOCK + 60, U64)
    for s in np.unique(selector):
        hit = np.flatnonzero(selector == s)
        if s == ESCAPE:
            out[start[hit]] = words[heads[hit] + 1]
            continue
        mask = (U64(1) << U64(WIDTHS[s])) - U64(1)
        for k in range(COUNTS[s]):
            # what lies beyond the end of a block is padding
            inside = start[hit] + k < (block[hit] + 1) * BLOCK
            out[start[hit][inside] + k] = (words[heads[hit][inside]] >> U64(k * WIDTHS[s])) & mask
    return out[:n]


_CHUNK = pa.schema(
    [
        ("shard", pa.int32()),
        ("chunk", pa.int32()),
        ("start", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int32())),
        ("block_words", pa.list_(pa.int32())),
        ("words", pa.binary()),
    ]
)
CHUNK_COLUMNS = "shard int, chunk int, start long, doc_ids array<bigint>, lengths array<int>, block_words array<int>, words binary"


def write(df: DataFrame, folder: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode the texts and write them below folder, in ascending order of ids."""
    ordered = (
        df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("id", "tie")
        .sortWithinPartitions("id", "tie")
        .select("id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chunk, start = TaskContext.get().partitionId(), 0, 0
        names, lengths, parts, size = [], [], [], 0

        def row() -> pa.RecordBatch:
            words, block_words = pack(np.concatenate(parts))
            values = [shard, chunk, start, names, lengths, block_words.tolist(), words.tobytes()]
            return pa.RecordBatch.from_pylist([dict(zip(_CHUNK.names, values))], _CHUNK)

        for batch in batches:
            for piece in pieces(batch, 1):
                ids, counts = library_lexicon(vocabulary, spaced_pieces).encode(piece.column(1))
                ends = np.cumsum(counts)
                for name, a, b in zip(piece.column(0).to_pylist(), ends - counts, ends):
                    if size and size + b - a + 1 > CHUNK:
                        yield row()
                        chunk, start = chunk + 1, start + size
                        names, lengths, parts, size = [], [], [], 0
                    names.append(name)
                    lengths.append(int(b - a + 1))
                    parts += [ids[a:b], np.array([end_id], np.int32)]
                    size += int(b - a + 1)
        if size:
            yield row()

    ordered.mapInArrow(run, CHUNK_COLUMNS).write.parquet(f"{folder}/chunks")
    written = df.sparkSession.read.schema(CHUNK_COLUMNS).parquet(f"{folder}/chunks")
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    written.groupBy("shard").agg(F.sum(total).alias("n_ids")).coalesce(1).write.parquet(f"{folder}/shards")


def read(spark: SparkSession, folder: str, digests: bool = False) -> DataFrame:
    """doc_id, `start` (ids of all documents before) and `ids`, from the files.

    With digests, `n_tokens` and `ids_crc32` in place of the ids.
    """
    base, bases = 0, {}
    # one row for each task of the writer
    for shard, n in sorted((r.shard, r.n_ids) for r in spark.read.schema("shard int, n_ids long").parquet(f"{folder}/shards").collect()):
        bases[shard], base = base, base + n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard, _, start, names, lengths, block_words, words = (c[k].as_py() for c in batch.columns)
                counts = np.array(lengths, np.int64)
                ids = unpack(np.frombuffer(words, U64), np.array(block_words), int(counts.sum())).astype(np.uint32)
                ends = np.cumsum(counts)
                columns = [pa.array(names, pa.int64()), pa.array(bases[shard] + start + ends - counts, pa.int64())]
                if digests:
                    sums = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(ends - counts, ends)]
                    columns += [pa.array(counts, pa.int64()), pa.array(sums, pa.int64())]
                else:
                    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64), pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", *(["n_tokens", "ids_crc32"] if digests else ["ids"])])

    chunks = spark.read.schema(CHUNK_COLUMNS).parquet(f"{folder}/chunks")
    return chunks.mapInArrow(run, "doc_id long, start long, " + ("n_tokens long, ids_crc32 long" if digests else "ids array<bigint>"))
