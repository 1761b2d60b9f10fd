"""Jaccard join over word n-grams, as a blocked sparse matrix product.

A document is the set of its n-grams (64-bit hashes), a row of the incidence matrix.
Equal sets are one class, and only classes are compared. Two sets link if
100 * |x & y| >= percent * |x | y|.

1. Candidates. Under one order of all n-grams, linked sets share an n-gram among the first
   n - ceil(percent n / 100) + 1 of each. The order is by a table of document counts
   (hashed to 2**SKETCH counters, over all documents), the rarest first, so that common
   n-grams bring few candidates together. Any order gives the same result.
2. Star round. Each n-gram that several sets have among their first names one of them, the
   one whose rarest n-gram is most common (the original of a family of edited copies); every
   other is compared with it alone. Links give components, by label propagation.
3. Full round. N-grams whose sets are all in one component by now are done. Of the rest,
   all pairs across components are candidates that share one of the first n-grams that
   their two sizes leave, unless the sizes, or bitmaps of their shared n-grams (which
   bound how many they can have in common), rule them out.
4. Product. Candidate pairs meet their texts, and the overlaps of a block of pairs are
   accumulated over blocks of columns; a pair goes as soon as what is left of its columns
   cannot reach the overlap that its sizes ask for.

Pairs within a component are not compared, as they cannot change it; no other link is
missed. Texts null or without words have empty sets, which link with nothing. Rows that
share an id are one document with several texts: they share a component. Rows without an
id have no component (null) and link with nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worksledger.llm.common import GOLDEN, U64, forget, give_back, joined_bytes, landed, map_texts, mix64, pieces, ragged

SKETCH = 20
#: Bytes of text whose words are hashed together; some fifty times as much is held meanwhile.
SLICE = 1 << 20
#: Counters of a row in which a task hands on its part of the table.
LANES = 64
#: Bits, as a power of two, of the bitmap that tells which texts a round needs.
BITMAP = 26
COLUMN_BLOCKS = 8
#: Words of the bitmap of a set's shared first n-grams.
SIGNATURE = 4

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TABLE = mix64(np.arange(64 * 256, dtype=U64) * GOLDEN + U64(1)).reshape(64, 256)
_SALTS = mix64(np.arange(1, 65, dtype=U64)) | U64(1)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, number of words per text); ASCII letters count as lower case."""
    data, offsets = joined_bytes(texts)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = offsets[:-1][np.diff(offsets) > 0]
    first[at] = inside[at]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, U64), np.zeros(len(offsets) - 1, np.int64)
    place = np.flatnonzero(inside)
    rank = np.searchsorted(place, starts)
    lengths = np.diff(np.append(rank, len(place)))
    depth = np.arange(len(place)) - np.repeat(rank, lengths)
    parts = _TABLE[depth & 63, _LOWER[data[place]]] * (2 * (depth >> 6) + 1).astype(U64)
    hashes = mix64(np.add.reduceat(parts, rank) + lengths.astype(U64) * GOLDEN)
    return hashes, np.diff(np.searchsorted(starts, offsets))


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The distinct n-grams of each text, sorted; of fewer words, the whole sequence as one."""
    hashes, counts = word_hashes(texts)
    grams = np.zeros(max(0, len(hashes) - words + 1), U64)
    for k in range(words):
        grams += hashes[k : k + len(grams)] * _SALTS[k]
    grams = mix64(grams)
    out, at = [], 0
    for n in counts:
        if n >= words:
            out.append(np.unique(grams[at : at + n - words + 1]))
        elif n:
            out.append(mix64((hashes[at : at + n] * _SALTS[:n]).sum(dtype=U64, keepdims=True) + U64(n)))
        else:
            out.append(np.zeros(0, U64))
        at += n
    return out


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def needed(n: Column, m: Column, percent: int) -> Column:
    """The least overlap of sets of these sizes that link."""
    return F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent) - F.lit(1e-9)).cast("long")


def _sizes_fit(n: Column, m: Column, percent: int) -> Column:
    return F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m)


def document_sets(docs: DataFrame, words: int) -> DataFrame:
    """id, size `n` and two fingerprints of each document's set."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column(1), words)
        a = np.array([s.sum(dtype=U64) for s in sets], U64).view(np.int64)
        b = np.array([mix64(s ^ GOLDEN).sum(dtype=U64) for s in sets], U64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(a), pa.array(b)], ["id", "n", "fa", "fb"])

    return map_texts(docs, "id long, n long, fa long, fb long", work, size=SLICE)


def count_table(docs: DataFrame, words: int) -> np.ndarray:
    """Documents by hashed n-gram, over all documents; 2**SKETCH counters."""
    size = 1 << SKETCH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        total = np.zeros(size, np.int64)
        for batch in batches:
            for piece in pieces(batch, 1, SLICE):
                sets = shingle_sets(piece.column(1), words)
                total += np.bincount((np.concatenate(sets) >> U64(64 - SKETCH)).astype(np.int64), minlength=size)
        give_back()
        if total.any():
            lanes = total.reshape(-1, LANES)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(lanes)), pa.int32()), *(pa.array(lanes[:, k]) for k in range(LANES))], ["row", *(f"c{k}" for k in range(LANES))])

    parts = docs.mapInArrow(run, "row int, " + ", ".join(f"c{k} long" for k in range(LANES)))
    rows = parts.groupBy("row").agg(*(F.sum(f"c{k}").alias(f"c{k}") for k in range(LANES))).toArrow()
    out = np.zeros((size // LANES, LANES), np.int64)
    for k in range(LANES):
        out[rows.column("row").to_numpy(), k] = rows.column(f"c{k}").to_numpy()
    return out.ravel()


def first_grams(docs: DataFrame, counts: np.ndarray, words: int, percent: int) -> DataFrame:
    """The first n-grams of each set: gram, node, n, pos, and `rarest`, the count of the set's rarest."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # of fixed size

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        table, parts = shared.value, []
        for node, grams in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), words)):
            if len(grams):
                seen = table[(grams >> U64(64 - SKETCH)).astype(np.int64)]
                order = np.lexsort((grams, seen))[: prefix_length(len(grams), percent)]
                parts.append((grams[order], node, len(grams), seen[order[0]]))
        k = np.array([len(p[0]) for p in parts], np.int64)
        column = lambda j: pa.array(np.repeat(np.array([p[j] for p in parts], np.int64), k))
        grams = np.concatenate([p[0] for p in parts]).view(np.int64) if parts else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(grams), column(1), column(2), pa.array(ragged(k)), column(3)], ["gram", "node", "n", "pos", "rarest"])

    return map_texts(docs, "gram long, node long, n long, pos long, rarest long", work, size=SLICE)


def only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs whose id is among ids (a column `id`, distinct).

    A bitmap of fixed size is applied in the scan first, so that few other texts are shuffled.
    """
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << BITMAP)) + 1
    spots = ids.select(bit("id").alias("b")).groupBy(F.bitmap_bucket_number("b").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits"))
    words = {r.k: bytes(r.bits) for r in spots.collect()}  # 2**BITMAP bits at most
    if not words:
        return docs.limit(0)
    per = 8 * len(next(iter(words.values())))
    flat = np.zeros((1 << BITMAP) // 8 + per, np.uint8)
    for k, bits in words.items():
        flat[(k - 1) * per // 8 : k * per // 8] = np.frombuffer(bits, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(flat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = batch.column(batch.schema.get_field_index("spot")).to_numpy() - 1
            hit = shared.value[b >> 3] >> (b & 7) & 1
            yield batch.filter(pa.array(hit.astype(bool))).drop_columns(["spot"])
        give_back()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    near = docs.withColumn("spot", bit("id")).mapInArrow(run, schema)
    return near.join(ids, "id", "left_semi")


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Of pairs of rows of the incidence matrix, those whose overlap reaches `need`.

    Columns are cut in blocks by hash; counts are added block after block.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    cuts = [U64((1 << 64) * k // COLUMN_BLOCKS) for k in range(1, COLUMN_BLOCKS)]
    edges = np.array([np.concatenate([[0], np.searchsorted(s, cuts), [len(s)]]) for s in sets], np.int64).reshape(len(sets), COLUMN_BLOCKS + 1)
    flat = np.concatenate(sets) if sets else np.zeros(0, U64)
    starts = np.cumsum(sizes) - sizes
    count, live = np.zeros(len(left), np.int64), np.arange(len(left))
    for k in range(COLUMN_BLOCKS):
        rows = np.unique(np.concatenate([left[live], right[live]]))
        width = edges[rows, k + 1] - edges[rows, k]
        cells = np.repeat(starts[rows] + edges[rows, k], width) + ragged(width)
        columns = np.unique(flat[cells], return_inverse=True)[1].astype(np.int64)
        n_columns = int(columns.max(initial=-1)) + 1
        # cells of the block as row * columns + column, in order
        keys = np.sort(np.repeat(rows, width) * n_columns + columns)
        at = np.searchsorted(rows, left[live])
        offset = np.cumsum(width) - width
        own = np.repeat(offset[at], width[at]) + ragged(width[at])
        of = np.repeat(np.arange(len(live)), width[at])
        want = right[live][of] * n_columns + columns[own]
        spot = np.searchsorted(keys, want)
        hit = keys[np.minimum(spot, len(keys) - 1)] == want if len(keys) else np.zeros(0, bool)
        count[live] += np.bincount(of[hit], minlength=len(live))
        rest = np.minimum(sizes[left[live]] - edges[left[live], k + 1], sizes[right[live]] - edges[right[live], k + 1])
        live = live[count[live] + rest >= need[live]]
    return live


def linked(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (x, y) whose sets link, by their texts."""
    ends = pairs.select(F.col("x").alias("id")).union(pairs.select("y")).distinct()
    texts = landed(only(docs, ends).select("id", "text"), "texts")
    both = pairs.join(texts.toDF("x", "x_text"), "x").join(texts.toDF("y", "y_text"), "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 512):
                batch = whole.slice(k, 512)
                x, y = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("x_text", "y_text"))
                row = {t: j for j, t in enumerate(dict.fromkeys([*x, *y]))}
                sets = shingle_sets(pa.array(list(row), pa.string()), words)
                left, right = (np.array([row[t] for t in side], np.int64) for side in (x, y))
                sizes = np.array([len(s) for s in sets], np.int64)
                total = sizes[left] + sizes[right]
                hit = overlaps(sets, left, right, np.maximum(1, -(-percent * total // (100 + percent))))
                yield batch.select(["x", "y"]).take(pa.array(hit))
        give_back()

    return both.select("x", "y", "x_text", "y_text").mapInArrow(run, "x long, y long")


def components(links: DataFrame) -> DataFrame:
    """node and comp (the least node it is linked with, over any number of links), of all nodes with links.

    Labels take the least label of their neighbours, then the label of their label.
    """
    edges = landed(links.select(F.col("x").alias("a"), F.col("y").alias("b")).union(links.select("y", "x")).distinct(), "edges")
    labels = landed(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("comp")), "labels")
    while True:
        near = edges.join(labels.toDF("b", "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = step.join(labels.toDF("comp", "above"), "comp").select("node", F.least("comp", "above").alias("comp"), "old")
        labels = landed(jump, "labels")
        moved = labels.where(F.col("comp") != F.col("old")).limit(1).count()
        labels = labels.select("node", "comp")
        if not moved:
            return labels


def join(df: DataFrame, words: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: id, n_shingles, component_id (the smallest id reachable by links)."""
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    named = docs.where(F.col("id").isNotNull())
    sets = landed(document_sets(docs, words), "sets")
    key = ["n", "fa", "fb"]
    classes = landed(sets.where((F.col("n") > 0) & F.col("id").isNotNull()).groupBy(*key).agg(F.min("id").alias("node")), "classes")
    # an id with several texts links the heads of all their classes
    several = sets.where(F.col("id").isNotNull()).groupBy("id").agg(F.min(F.struct(*key)).alias("low"), F.max(F.struct(*key)).alias("high")).where("low != high")
    several = landed(sets.join(several.select("id"), "id", "left_semi").select("id", *key).distinct(), "several")
    nodes = several.join(classes, key).select("id", "node")
    same = nodes.join(nodes.groupBy("id").agg(F.min("node").alias("x")), "id").where("x < node").select("x", F.col("node").alias("y")).distinct()
    heads = classes.select(F.col("node").alias("id")).distinct()
    # a document stands for its class; other documents of the class stay out of what follows
    counts = count_table(named, words)
    firsts = first_grams(named, counts, words, percent).join(heads.withColumnRenamed("id", "node"), "node", "left_semi")
    firsts = landed(firsts, "firsts")
    pivot = F.max_by(F.struct("node", "n"), F.struct("rarest", -F.col("node")))
    groups = firsts.groupBy("gram").agg(F.count(F.lit(1)).alias("k"), pivot.alias("pivot")).where(F.col("k") > 1)
    shared = landed(firsts.join(groups, "gram").select("gram", "node", "n", "pos", "pivot"), "shared")

    def prefix(n: str) -> Column:
        return F.col(n) - F.ceil(F.lit(percent) * F.col(n) / 100 - F.lit(1e-9)) + 1

    def fitting(pairs: DataFrame) -> DataFrame:
        """Distinct pairs, of rows x, n, y, m per shared n-gram, that may reach the overlap they need."""
        found = pairs.groupBy("x", "n", "y", "m").agg(F.count(F.lit(1)).alias("k"))
        most = F.col("k") + F.greatest(F.col("n") - prefix("n"), F.col("m") - prefix("m"))
        return found.where(most >= needed(F.col("n"), F.col("m"), percent)).select("x", "y")

    star = shared.select(F.col("node").alias("x"), "n", F.col("pivot.node").alias("y"), F.col("pivot.n").alias("m"))
    star = star.where((F.col("x") != F.col("y")) & _sizes_fit(F.col("n"), F.col("m"), percent))
    tried = landed(fitting(star).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "star")
    links = landed(linked(named, tried, words, percent).union(same), "links")
    comps = components(links)

    bit = F.pmod(F.xxhash64("gram"), F.lit(64 * SIGNATURE))
    lanes = [F.when(F.floor(bit / 64) == k, F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))) for k in range(SIGNATURE)]
    signs = shared.groupBy("node").agg(F.count(F.lit(1)).alias("more"), *(F.coalesce(F.bit_or(x), F.lit(0)).alias(f"s{k}") for k, x in enumerate(lanes)))
    # n-grams that fell on a bit already set
    signs = signs.withColumn("more", F.col("more") - sum(F.bit_count(f"s{k}") for k in range(SIGNATURE)))
    at = shared.drop("pivot").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")).join(signs, "node")
    at = landed(at, "labelled")
    open_ = at.groupBy("gram").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("gram")
    some = at.join(open_, "gram", "left_semi")
    right = some.withColumnsRenamed({"node": "y", "n": "m", "pos": "at", "comp": "other", "more": "more_y", **{f"s{k}": f"t{k}" for k in range(SIGNATURE)}})
    need = needed(F.col("n"), F.col("m"), percent)
    common = sum(F.bit_count(F.col(f"s{k}").bitwiseAND(F.col(f"t{k}"))) for k in range(SIGNATURE)) + F.least("more", "more_y")
    across = some.withColumnRenamed("node", "x").join(right, "gram").where(
        (F.col("x") < F.col("y")) & (F.col("comp") != F.col("other")) & _sizes_fit(F.col("n"), F.col("m"), percent)
        & (F.col("pos") <= F.col("n") - need) & (F.col("at") <= F.col("m") - need)
        & (common + F.greatest(F.col("n") - prefix("n"), F.col("m") - prefix("m")) >= need)
    )
    rest = landed(across.select("x", "y").distinct().join(tried, ["x", "y"], "left_anti"), "pairs")
    more = landed(linked(named, rest, words, percent), "links")
    if more.limit(1).count():
        comps = components(links.union(more))
    labels = classes.join(comps, "node", "left").select(*key, F.coalesce("comp", "node").alias("component"))
    out = sets.join(labels, key, "left")
    if several.limit(1).count():  # rows with an empty set too share the component of their id's others
        own = several.join(labels, key).groupBy("id").agg(F.min("component").alias("own"))
        out = out.join(own, "id", "left").withColumn("component", F.coalesce("own", "component"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))
