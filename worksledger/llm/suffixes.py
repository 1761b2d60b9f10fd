"""Exact removal of repeated byte strings with a sparse suffix array.

A byte goes if it lies in a string of `length` bytes that also starts anywhere else. Every
window of that length is decided, but not every suffix is sorted:

1. Anchors. A window's anchor is its least k-gram by hash (the leftmost of equals), so equal
   windows have equal anchors at equal offsets. Windows with one anchor and offsets in one
   chunk form a record; they share a core, the bytes that all of them hold. Records with
   different cores, or at different chunks, have no window in common.
2. Contents. Records are counted by (core, content). Equal records are repeated as a
   whole; a core with one record is not repeated at all. Of each content of the other
   cores one record goes on.
3. Suffix sort. Records are range-partitioned by the leading bytes of their cores, at
   splitters that the engine samples. A bucket sorts its suffixes (core and what follows) by
   multikey quicksort over 8-byte words, and likewise what precedes the cores, backwards.
   Neighbours' common prefixes give, for each offset, classes of equal windows. Splitters
   never part equal cores, so no window is repeated across the boundary of two buckets;
   the first and last suffix of each bucket need no further look.
4. Hot cores. A core with more than HOT contents is not brought to one bucket: its records
   are cut into smaller chunks, whose cores are longer and rarer, and go through 2 again;
   at chunks of one window, counting decides.

With `words`, the length counts words and a span is of whole words: each word becomes an
8-byte hash, the method runs over these bytes, and of the repeated windows those that begin
at a word count. Words are runs of other bytes than ASCII blanks; a character of a script
written without blanks (WITHOUT_BLANKS) is a word of its own. Letter case counts, the blanks
between words do not; those between two words that go, go too.

A null text is empty. Repeated rows are documents like others: they repeat each other.
Rows are told apart by id and a hash of the text, so an id may be null or occur twice. An
empty table gives an empty result, texts shorter than `length` stay whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worksledger.llm.common import GOLDEN, U64, joined_bytes, landed, map_texts, mix64, ragged

KGRAM = 16
CHUNKS = (128, 16, 1)
HOT = 512
#: Records of a bucket, about.
BUCKET = 40_000
BITMAP = 26
#: Bytes of text at a time; each takes about a hundred of working memory.
PIECE = 1 << 20

_SALTS = mix64(np.arange(1, 257, dtype=U64)) | U64(1)
#: Code points of Thai and Lao, Myanmar, Khmer, kana and Han.
WITHOUT_BLANKS = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3041, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
#: Bytes of the hash of a word.
WORD = 8
Read = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
RECORD = "fp long, cfp long, id long, b long, p long, low int, high int, chunk int"


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as one number; places near the end see zeros."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    n = len(data) + 8
    out = np.empty(-(-n // 8) * 8, U64)
    for j in range(8):
        part = padded[j : j + (len(padded) - j) // 8 * 8].view("<u8")
        view = out[j::8]
        view[: min(len(view), len(part))] = part[: len(view)]
        view[len(part) :] = 0
    return out[:n]


_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word begins and ends, and the number of the first word of each text (one more at the end)."""
    inside = ~_BLANK[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = offsets[:-1][np.diff(offsets) > 0]
    first[at] = inside[at]
    wide = np.flatnonzero(data >= 0xE0)  # characters of three or four bytes
    if len(wide):
        a, b, c, d = (np.append(data, [0, 0, 0]).astype(np.int64)[wide + k] for k in range(4))
        four = a >= 0xF0
        point = (a & 15) << 12 | (b & 63) << 6 | c & 63
        point[four] = ((a & 7) << 18 | (b & 63) << 12 | (c & 63) << 6 | d & 63)[four]
        alone = np.any([(low <= point) & (point <= high) for low, high in WITHOUT_BLANKS], axis=0)
        after = (wide + np.where(four, 4, 3))[alone]
        after = after[after < len(data)]
        first[wide[alone]] = True
        first[after] = inside[after]
    start, place = np.flatnonzero(first), np.flatnonzero(inside)
    rank = np.searchsorted(place, start)
    return start, start + np.diff(np.append(rank, len(place))), np.searchsorted(start, offsets)


def joined_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Like joined_bytes, of the hashes of the words."""
    data, offsets = joined_bytes(texts)
    start, stop, edges = word_bounds(data, offsets)
    words, length = _words(data), stop - start
    out = mix64(length.astype(U64) * GOLDEN)
    live = np.arange(len(start))
    j = 0
    while len(live):
        left = np.minimum(length[live] - j, 8).astype(U64)
        x = words[start[live] + j] & (U64(0xFFFFFFFFFFFFFFFF) >> (U64(64) - U64(8) * left))
        out[live] = mix64((out[live] ^ x) * _SALTS[0])
        j += 8
        live = live[length[live] > j]
    return out.astype("<u8").view(np.uint8), edges.astype(np.int64) * WORD


def _span_hash(words: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from start on; spans have 8 bytes or more."""
    out = length.astype(U64) * GOLDEN
    whole = length // 8
    for j in range(int(whole.max(initial=0))):
        live = np.flatnonzero(whole > j) if j >= int(whole.min()) else slice(None)
        x = words[start[live] + 8 * j]
        x ^= x >> U64(29)
        out[live] = mix64(out[live] + x * _SALTS[j % 256]) if j % 64 == 63 else out[live] + x * _SALTS[j % 256]
    x = words[start + length - 8]
    return mix64(out + (x ^ (x >> U64(31))) * _SALTS[255])


def anchors(data: np.ndarray, words: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window) of each run of windows with one anchor."""
    span = length - KGRAM + 1
    n = len(data) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    grams = mix64(words[: len(data) - KGRAM + 1] * _SALTS[0] + words[8 : 8 + len(data) - KGRAM + 1] * _SALTS[1])
    least = (grams & U64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=U64)
    size = 1
    while size * 2 <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:n], least[span - size : span - size + n])
    anchor = (least & U64(0xFFFFFFFF)).astype(np.int64)
    # windows within one document
    room = np.maximum(0, np.diff(offsets) - length + 1)
    starts = np.repeat(offsets[:-1], room) + ragged(room)
    anchor = anchor[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return anchor[first], starts[first], starts[last[: len(first)]]


def chunked(anchor: np.ndarray, low: np.ndarray, high: np.ndarray, chunk: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of offsets low..high before an anchor, cut at multiples of chunk: (run, low, high, chunk number)."""
    parts = high // chunk - low // chunk + 1
    run = np.repeat(np.arange(len(anchor)), parts)
    number = low[run] // chunk + ragged(parts)
    return run, np.maximum(low[run], number * chunk), np.minimum(high[run], (number + 1) * chunk - 1), number


def _hashes(words: np.ndarray, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, number: np.ndarray, chunk: int, length: int):
    core = _span_hash(words, anchor - number * chunk, np.full(len(anchor), length - chunk + 1))
    content = _span_hash(words, anchor - high, high - low + length)
    core = mix64(core + number.astype(U64) * _SALTS[2])
    content = mix64(content + (low.astype(U64) << U64(32)) + high.astype(U64))
    return pa.array(core.view(np.int64)), pa.array(content.view(np.int64))


def records(docs: DataFrame, length: int, read: Read = joined_bytes) -> DataFrame:
    """The records of all texts (id, b, text), at the widest chunks."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        data, offsets = read(batch.column(2))
        words = _words(data)
        anchor, first, last = anchors(data, words, offsets, length)
        if not len(anchor):
            return None
        run, low, high, number = chunked(anchor, anchor - last, anchor - first, CHUNKS[0])
        anchor = anchor[run]
        doc = np.searchsorted(offsets, anchor, side="right") - 1
        take = pa.array(doc)
        return pa.RecordBatch.from_arrays(
            [
                *_hashes(words, anchor, low, high, number, CHUNKS[0], length),
                batch.column(0).take(take),
                batch.column(1).take(take),
                pa.array(anchor - offsets[doc]),
                pa.array(low.astype(np.int32)),
                pa.array(high.astype(np.int32)),
                pa.array(number.astype(np.int32)),
            ],
            [x.split()[0] for x in RECORD.split(", ")],
        )

    return map_texts(docs, RECORD, work, 2, PIECE)


_LIST = "array<struct<p:bigint,low:int,high:int,chunk:int,fp:bigint,k:bigint>>"


def _with_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """id, b, text and the list of the chosen records of each text; one text of equal ones."""
    lists = chosen.groupBy("id", "b").agg(F.collect_list(F.struct("p", "low", "high", "chunk", "fp", "k")).alias("list"))
    lists = landed(lists, "lists")
    texts = near(docs, lists.select("id", "b"), keep=True).groupBy("id", "b").agg(F.first("text").alias("text"))
    return texts.join(lists, ["id", "b"])


def _listed(batch: pa.RecordBatch, read: Read) -> tuple[np.ndarray, ...]:
    """Bytes, offsets, row and fields of the records of a batch of _with_texts."""
    data, offsets = read(batch.column(2))
    lists = batch.column(3)
    bounds = lists.offsets.to_numpy()
    values = lists.values.slice(bounds[0], bounds[-1] - bounds[0])
    row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
    fields = [values.field(j).to_numpy() for j in range(6)]
    return data, offsets, row, *fields


def finer(texts: DataFrame, before: int, chunk: int, length: int, read: Read = joined_bytes) -> DataFrame:
    """The listed records, cut into smaller chunks."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets, row, p, low, high, _, _, _ = _listed(batch, read)
        words, anchor = _words(data), p + offsets[row]
        run, low, high, number = chunked(anchor, low.astype(np.int64), high.astype(np.int64), chunk)
        take = pa.array(row[run])
        return pa.RecordBatch.from_arrays(
            [
                *_hashes(words, anchor[run], low, high, number, chunk, length),
                batch.column(0).take(take),
                batch.column(1).take(take),
                pa.array(p[run]),
                pa.array(low.astype(np.int32)),
                pa.array(high.astype(np.int32)),
                pa.array(number.astype(np.int32)),
            ],
            [x.split()[0] for x in RECORD.split(", ")],
        )

    return map_texts(texts, RECORD, work, 2, PIECE)


SUFFIX = "lead binary, fp long, chunk int, low int, high int, k long, id long, b long, p long, bytes binary"


def suffixes(texts: DataFrame, chunk: int, length: int, read: Read = joined_bytes) -> DataFrame:
    """The listed records with their bytes, and the first bytes of their cores."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets, row, p, low, high, number, fp, k = _listed(batch, read)
        anchor, raw = p + offsets[row], data.tobytes()
        core = anchor - number * chunk
        lead = [raw[a : a + 16] for a in core]
        content = [raw[a - h : a - l + length] for a, l, h in zip(anchor, low, high)]
        take = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(lead, pa.binary()), pa.array(fp), pa.array(number, pa.int32()), pa.array(low, pa.int32()), pa.array(high, pa.int32()),
                pa.array(k), batch.column(0).take(take), batch.column(1).take(take), pa.array(p), pa.array(content, pa.binary()),
            ],
            [x.split()[0] for x in SUFFIX.split(", ")],
        )

    return map_texts(texts, SUFFIX, work, 2, PIECE)


def multikey_sort(keys: np.ndarray) -> np.ndarray:
    """The order of the rows of a matrix of words, by multikey quicksort.

    All open segments are parted together in a round: each by the word of its middle
    row at its depth, into less, equal and greater; equal parts go on with the next word.
    """
    n, depth = keys.shape
    order = np.arange(n)
    begin, end, at = (np.array([x]) for x in (0, n, 0)) if n > 1 else (np.zeros(0, np.int64),) * 3
    while len(begin):
        sizes = end - begin
        place = np.repeat(begin, sizes) + ragged(sizes)
        segment = np.repeat(np.arange(len(begin)), sizes)
        word = keys[order[place], at[segment]]
        pivot = keys[order[(begin + end) // 2], at]
        side = (word > pivot[segment]).astype(np.int64) - (word < pivot[segment])
        moved = np.argsort(segment * 3 + side + 1, kind="stable")
        order[place] = order[place[moved]]
        parts = np.bincount(segment * 3 + side + 1, minlength=3 * len(begin)).reshape(-1, 3)
        ends = begin[:, None] + np.cumsum(parts, axis=1)
        begins = ends - parts
        deeper = np.stack([at, at + 1, at], axis=1)
        on = (parts > 1) & (deeper < depth)
        begin, end, at = begins[on], ends[on], deeper[on]
    return order


def _matrix(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of big-endian words, padded with zeros and ended by the length; and the lengths."""
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    padded = -(-width // 8) * 8
    raw = np.frombuffer(b"".join(s.ljust(padded, b"\0") for s in strings), ">u8").reshape(len(strings), padded // 8)
    return np.concatenate([raw.astype(U64), lengths[:, None].astype(U64)], axis=1), lengths


def _common(keys: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix, in bytes, of each row in order with the one before; -1 for the first."""
    a, b = keys[order[:-1], :-1], keys[order[1:], :-1]
    differ = a != b
    word = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1] if a.ndim == 2 else 0)
    inside = np.minimum(word, max(a.shape[1] - 1, 0))
    rows = np.arange(len(a))
    x = a[rows, inside] ^ b[rows, inside] if a.shape[1] else np.zeros(len(a), U64)
    same = np.zeros(len(a), np.int64)
    for j in range(7, -1, -1):  # leading bytes that agree
        same = np.where(x < U64(1) << U64(8 * (8 - j)) if j else np.ones(len(a), bool), np.maximum(same, j), same)
    lcp = np.minimum(word * 8 + np.where(word < a.shape[1], same, 0), np.minimum(lengths[order[:-1]], lengths[order[1:]]))
    return np.concatenate([[-1], lcp])


def repeated_windows(strings: list[bytes], number: np.ndarray, low: np.ndarray, high: np.ndarray, chunk: int, length: int) -> np.ndarray:
    """(records, chunk) flags: the window at offset number * chunk + j before the anchor occurs in another record."""
    n = len(strings)
    core = length - chunk + 1
    first = number * chunk
    left = high - first  # bytes before the core
    behind = [number[k].tobytes() + s[left[k] :] for k, s in enumerate(strings)]  # chunks apart
    ahead = [s[: left[k]][::-1] for k, s in enumerate(strings)]
    keys, lengths = _matrix(behind, 8 + core + chunk - 1)
    order = multikey_sort(keys)
    lcp = _common(keys, lengths, order) - 8
    keys, lengths = _matrix(ahead, chunk - 1)
    order_left = multikey_sort(keys)
    lcp_left = _common(keys, lengths, order_left)
    flags = np.zeros((n, chunk), bool)
    right_id, left_id = np.empty(n, np.int64), np.empty(n, np.int64)
    for j in range(chunk):
        valid = np.flatnonzero((low - first <= j) & (j <= high - first))
        if len(valid) < 2:
            continue
        right_id[order] = np.cumsum(lcp < core + chunk - 1 - j)
        left_id[order_left] = np.cumsum(lcp_left < j)
        key = right_id[valid] * (n + 1) + left_id[valid]
        by = np.argsort(key, kind="stable")
        same = key[by[1:]] == key[by[:-1]]
        flags[valid[by[1:][same]], j] = True
        flags[valid[by[:-1][same]], j] = True
    return flags


SPAN = "id long, b long, start long, stop long"


def bucket_spans(rows: DataFrame, buckets: int, chunk: int, length: int) -> DataFrame:
    """Repeated spans of the records of `suffixes` that occur once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = list(batches)
        if not kept:
            return
        table = pa.Table.from_batches(kept)
        get = lambda name: table.column(name).to_numpy()
        number, low, high, k = (get(c).astype(np.int64) for c in ("chunk", "low", "high", "k"))
        flags = repeated_windows(table.column("bytes").to_pylist(), number, low, high, chunk, length)
        flags[k > 1] = False  # known as a whole
        edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, begin = np.nonzero(edge == 1)
        stop = np.nonzero(edge == -1)[1]
        # offsets begin..stop-1 before the anchor; the largest offset starts first
        base = get("p")[row] - number[row] * chunk
        take = pa.array(row)
        ids, b = (table.column(c).combine_chunks().take(take) for c in ("id", "b"))
        yield pa.RecordBatch.from_arrays([ids, b, pa.array(base - stop + 1), pa.array(base - begin + length)], ["id", "b", "start", "stop"])

    return rows.repartitionByRange(buckets, "lead", "fp").mapInArrow(run, SPAN)


def near(docs: DataFrame, keys: DataFrame, keep: bool) -> DataFrame:
    """Rows of docs whose (id, b) may be among keys, or those that surely are not.

    A bitmap of fixed size tells; at worst it lets all through.
    """
    bit = F.pmod(F.xxhash64("id", "b"), F.lit(1 << BITMAP)) + 1
    spots = keys.select(bit.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits"))
    flat = np.zeros((1 << BITMAP) // 8 + 8192, np.uint8)
    for r in spots.collect():  # 2**BITMAP bits at most
        flat[(r.k - 1) * len(r.bits) : r.k * len(r.bits)] = np.frombuffer(bytes(r.bits), np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(flat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = batch.column(batch.schema.get_field_index("spot")).to_numpy() - 1
            hit = (shared.value[s >> 3] >> (s & 7) & 1).astype(bool)
            yield batch.filter(pa.array(hit if keep else ~hit)).drop_columns(["spot"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.withColumn("spot", bit).mapInArrow(run, schema)


def repeated_spans(docs: DataFrame, length: int, read: Read = joined_bytes) -> DataFrame:
    """Spans (id, b, start, stop) whose union is what goes, of docs with id, b and text, in the bytes that read gives."""
    spark = docs.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key, parts, rows = ["fp", "cfp"], [], records(docs, length, read)
    for level, chunk in enumerate(CHUNKS):
        rows = landed(rows, "records")
        contents = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("k"))
        cores = contents.groupBy("fp").agg(F.count(F.lit(1)).alias("contents"), F.max("k").alias("most"))
        live = cores.where((F.col("contents") > 1) | (F.col("most") > 1)).select("fp", "contents")
        live = landed(contents.join(live, "fp").where((F.col("k") > 1) | (F.col("contents") > 1)), "contents")
        hits = landed(rows.join(live, key), "hits")
        whole = hits.where(F.col("k") > 1)
        parts.append(whole.select("id", "b", (F.col("p") - F.col("high")).alias("start"), (F.col("p") - F.col("low") + length).alias("stop")))
        if chunk == 1:
            break
        # one record of each content
        several = hits.where(F.col("contents") > 1)
        one = several.groupBy("fp", "cfp").agg(
            F.min(F.struct("id", "b", "p", "low", "high", "chunk")).alias("r"), F.max("k").alias("k"), F.max("contents").alias("contents")
        )
        one = landed(one.select("fp", "k", "contents", "r.*"), "heads")
        cold = one.where(F.col("contents") <= HOT)
        n = cold.count()
        if n:
            buckets = max(least, -(-n // BUCKET))
            texts = _with_texts(docs, cold)
            parts.append(landed(bucket_spans(suffixes(texts, chunk, length, read), buckets, chunk, length), "spans"))
        hot = one.where(F.col("contents") > HOT)
        if not hot.limit(1).count():
            break
        rows = finer(_with_texts(docs, hot), chunk, CHUNKS[level + 1], length, read)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def dedup(df: DataFrame, length: int, id_col: str = "doc_id", text_col: str = "text", digests: bool = False, keep_columns: bool = False, words: bool = False) -> DataFrame:
    """id, n_bytes, `removed` (spans of bytes, in order and apart) and `kept` (what is left).

    digests: n_removed, n_spans, kept_sha256 and, as text, what is left (without characters cut
    in two) in place of the last two. keep_columns: df
    with its text cut instead (characters cut in two go) and rows left as they are. words: length counts words, see above.
    """
    whole = df.withColumn("__id", F.coalesce(F.col(id_col).cast("long"), F.lit(-1))).withColumn("__b", F.xxhash64(text_col))
    docs = whole.select(F.col("__id").alias("id"), F.col("__b").alias("b"), F.col(text_col).alias("text"))
    if words:  # all windows of a span are repeated; it is cut to those that begin at a word
        raw = repeated_spans(docs, length * WORD, joined_words)
        begin, last = F.ceil(F.col("start") / WORD), F.floor((F.col("stop") - length * WORD) / WORD)
        spans = raw.where(begin <= last).select("id", "b", begin.alias("start"), (last + length).alias("stop"))
    else:
        spans = repeated_spans(docs, length)
    spans = spans.groupBy("id", "b").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    spans = landed(spans, "removed")
    columns = df.columns if keep_columns else [id_col, text_col]
    every = whole.select(F.col("__id").alias("id"), F.col("__b").alias("b"), F.struct(*columns).alias("row"))
    hit = near(every, spans.select("id", "b"), keep=True).join(spans, ["id", "b"], "left").select("row.*", F.col("spans").alias("__spans"))
    clean = near(every, spans.select("id", "b"), keep=False).select("row.*", F.lit(None).cast("array<struct<start:bigint,stop:bigint>>").alias("__spans"))
    at = columns.index(text_col)

    def cut(text: str | None, found: list | None) -> tuple[list[tuple[int, int]], bytes, int]:
        raw = (text or "").encode()
        runs: list[list[int]] = []
        for s in found or []:
            if runs and s["start"] <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], s["stop"])
            else:
                runs.append([s["start"], s["stop"]])
        if words and runs:
            begins, ends, _ = word_bounds(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            runs = [[int(begins[a]), int(ends[b - 1])] for a, b in runs]
        out, end = [], 0
        for start, stop in runs:
            out.append(raw[end:start])
            end = stop
        return [tuple(r) for r in runs], b"".join([*out, raw[end:]]) if runs else raw, len(raw)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        results = [cut(t, s) for t, s in zip(batch.column(at).to_pylist(), batch.column(len(columns)).to_pylist())]
        if keep_columns:
            old = batch.column(at).to_pylist()
            texts = [r[1].decode(errors="ignore") if r[0] else t for r, t in zip(results, old)]
            return batch.select(columns).set_column(at, text_col, pa.array(texts, pa.string()))
        sizes = pa.array([r[2] for r in results], pa.int64())
        if digests:
            values = [
                pa.array([r[2] - len(r[1]) for r in results], pa.int64()),
                pa.array([len(r[0]) for r in results], pa.int64()),
                pa.array([hashlib.sha256(r[1]).hexdigest() for r in results]),
                pa.array([r[1].decode(errors="ignore") for r in results], pa.string()),
            ]
            return pa.RecordBatch.from_arrays([batch.column(0), sizes, *values], [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        removed = pa.array([[{"start": a, "stop": b} for a, b in r[0]] for r in results], kind)
        return pa.RecordBatch.from_arrays([batch.column(0), sizes, removed, pa.array([r[1] for r in results], pa.binary())], [id_col, "n_bytes", "removed", "kept"])

    if keep_columns:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    else:
        last = "n_removed long, n_spans long, kept_sha256 string, text string" if digests else "removed array<struct<start:bigint,stop:bigint>>, kept binary"
        schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, n_bytes long, {last}"
    return map_texts(hit.union(clean), schema, work, at)
