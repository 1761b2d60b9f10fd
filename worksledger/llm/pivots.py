"""Exact top-k by inner product, with a table of distances to pivots.

Vectors are blocked. For each block the distances of its vectors to the pivots are
computed once. Distances to pivots fix where a vector lies in the space that the pivots
span, and how far from it; so two vectors are at least as far apart as the distance within
that space and the difference of their distances from it make, which is the greatest lower
bound that these distances allow, and at least |d(q,p) - d(x,p)| for every pivot p. It
bounds the inner product from above, as <q,x> = (|q|^2 + |x|^2 - d(q,x)^2) / 2, and is one
matrix product for a block. Every query begins with the k-th score that it reaches in the
sample; candidates of greater bounds are evaluated in the order of their bounds, a slice at
a time, until the next bound lies below the k-th score: then no candidate left can enter,
nor tie. Pivots are drawn by farthest-first from a bounded sample (SAMPLE vectors); sample
and pivots change the work, never the result.

Query blocks meet every candidate block, which is what an exact search over a stated query
set has to do; each pair of blocks sends on k rows per query at most, and these are merged
by a window over the query. Query blocks go in groups of GROUP_BYTES, and a candidate block
is sent to each group once, not to each block. Vectors are whole numbers here, so scores are
exact.

Each length is searched among its own rows, so that no vector changes the result of those
of another length; empty vectors score 0 with each other. Vectors that are null, or hold a
null or non-finite component, take no part, neither as query nor as candidate; nor do rows
without an id. Vectors with a component too large for scores of 64 bits (`wide`) are left
out of pivots and bounds and scored in whole numbers of any size, with every other.

Each query row is ranked by itself against all other rows: only the row itself is left out.
Rows that repeat an id are candidates of their own, of each other too; a query id that
occurs n times has n results under that id. Ties go to the smaller id. Empty tables give
empty results.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worksledger.llm.common import landed, mix64

SAMPLE = 4096
PIVOTS = 48
#: Vectors of a block of candidates and of queries.
BLOCK = 8192
QUERY_BLOCK = 2048
#: Candidates of the first slice; each next one is twice as large.
SLICE = 256
#: Queries whose bounds are computed together.
TOGETHER = 128
#: Directions of the pivots in which they spread less than this share of the largest distance are left out.
SPREAD = 1e-3
#: Candidate blocks of one group of query blocks are dealt over so many keys.
SALTS = 64
#: Numbers of the query blocks of one group, which a task holds while candidate blocks pass.
GROUP_BYTES = 8 << 20
#: Components from here on make a vector wide, or fewer where a sum of products could leave 62 bits.
RANGE = 1 << 25


def quantised(df: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """id, `row` (a number of its own), `v`, and whether a floor(scale * component) is `wide`, of usable vectors only."""
    usable = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.forall(
        vector_col, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf"))), F.lit(False))
    )
    least = F.least(F.lit(float(RANGE)), F.sqrt(F.lit(2.0**62) / F.greatest(F.size(vector_col), F.lit(1))))
    wide = F.exists(vector_col, lambda x: F.abs(F.lit(float(scale)) * x.cast("double")) >= least - 1)
    kind = df.schema[vector_col].dataType
    v = F.col(vector_col) if kind.simpleString() == "array<float>" else F.col(vector_col).cast("array<double>")
    return df.where(usable).select(F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), wide.alias("wide"), v.alias("v"))


def whole_numbers(parts: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * part) as Python's integers."""
    out = np.empty(parts.shape, object)
    for at, x in np.ndenumerate(parts):
        y = scale * float(x)
        out[at] = math.floor(y) if math.isfinite(y) else scale * int(x)
    return out


def _blocks(df: DataFrame, size: int, scale: int) -> DataFrame:
    """Packed blocks of up to `size` vectors of one length: n, dim, wide, ids, rows, and the numbers row by row.

    The numbers are quantised, those of wide vectors are not yet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = pc.list_value_length(batch.column(3)).to_numpy().astype(np.int64)
            kind = dims * 2 + batch.column(2).to_numpy(zero_copy_only=False)
            for one in np.unique(kind):
                of = np.flatnonzero(kind == one)
                for k in range(0, len(of), size):
                    part = batch.take(pa.array(of[k : k + size]))
                    numbers = part.column(3).flatten().to_numpy().astype("<f8")
                    if one % 2 == 0:
                        numbers = np.floor(scale * numbers).astype("<i4")
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([part.num_rows], pa.int32()), pa.array([one // 2], pa.int32()), pa.array([bool(one % 2)]),
                            *(pa.array([part.column(c).to_numpy().astype("<i8").tobytes()]) for c in (0, 1)), pa.array([numbers.tobytes()]),
                        ],
                        ["n", "dim", "wide", "ids", "rows", "numbers"],
                    )

    return df.select("id", "row", "wide", "v").mapInArrow(run, "n int, dim int, wide boolean, ids binary, rows binary, numbers binary")


def farthest_first(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots that lie far apart; the first is the sample's longest vector."""
    if not len(sample):
        return sample
    chosen = [int((sample**2).sum(axis=1).argmax())]
    near = np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
        if near.max() == 0:
            break
        chosen.append(int(near.argmax()))
    return sample[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean, rows by pivots."""
    squares = (x**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1) - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(squares, 0))


def products(queries: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly: in floating point where no sum can leave 53 bits."""
    if len(queries) and len(x):
        most = float((queries.astype(np.float64) ** 2).sum(axis=1).max()) * float((x.astype(np.float64) ** 2).sum(axis=1).max())
        if most < 2.0**104:
            return (queries.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return queries.astype(np.int64) @ x.astype(np.int64).T


def sampled(vectors: DataFrame, scale: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length, about SAMPLE vectors in all and their rows; wide ones are none of them.

    Rows are drawn by hash at the rate that leaves SAMPLE of them, so that the tasks together
    hand the driver about that many, however many tasks there are.
    """
    narrow = vectors.where(~F.col("wide"))
    share = SAMPLE / max(narrow.count(), 1)
    if share < 1:
        narrow = narrow.where(F.pmod(F.xxhash64("id", "row"), F.lit(1 << 30)) < F.lit(round(share * (1 << 30))))
    found: dict[int, list] = {}
    for r in _blocks(narrow, BLOCK, scale).collect():
        x = np.frombuffer(r["numbers"], "<i4").reshape(r["n"], r["dim"]).astype(np.float64)
        found.setdefault(r["dim"], []).append((x, np.frombuffer(r["rows"], "<i8")))
    out = {}
    for dim, parts in sorted(found.items()):
        x, rows = (np.concatenate(side) for side in zip(*parts))
        order = np.argsort(mix64(rows.astype(np.uint64)))  # the order of files does not count
        out[dim] = x[order], rows[order]
    return out


def _groups(query_blocks: DataFrame) -> tuple[Column, Column]:
    """The group of each query block, and the groups that a candidate block meets: those of its length.

    The driver sees a length and a number for each query block.
    """
    group_of: dict[int, int] = {}
    groups: dict[int, list[int]] = {}
    held: dict[int, int] = {}
    for r in query_blocks.select("dim", "block", F.octet_length("numbers").alias("size")).orderBy("block").collect():
        if r["dim"] not in groups or held[r["dim"]] + r["size"] > GROUP_BYTES:
            groups.setdefault(r["dim"], []).append(sum(map(len, groups.values())))
            held[r["dim"]] = 0
        held[r["dim"]] += r["size"]
        group_of[r["block"]] = groups[r["dim"]][-1]
    own = F.from_json(F.lit(json.dumps(group_of)), "map<string,int>")[F.col("block").cast("string")]
    return own, F.from_json(F.lit(json.dumps(groups)), "map<string,array<int>>")[F.col("dim").cast("string")]


class Bounds:
    """Upper bounds of inner products, by the distances of both sides to the pivots."""

    def __init__(self, pivots: np.ndarray, *sides: np.ndarray):
        spread = pivots[1:] - pivots[0]
        turn, size, _ = np.linalg.svd(spread, full_matrices=False) if len(spread) else (np.zeros((0, 0)), np.zeros(0), None)
        tables = [distances(side, pivots) for side in sides]
        kept = size > SPREAD * max((t.max(initial=0) for t in tables), default=0)
        onto = turn[:, kept] / size[kept]
        squares, origin = (spread**2).sum(axis=1), float((pivots[0] ** 2).sum())
        self.sides = []
        for side, table in zip(sides, tables):
            first = table[:, 0] ** 2
            within = ((squares + first[:, None] - table[:, 1:] ** 2) / 2) @ onto
            off = np.sqrt(np.maximum(first - (within**2).sum(axis=1), 0))
            norms = (side**2).sum(axis=1)
            self.sides.append((np.column_stack([within, off]), (norms + origin - first) / 2, norms))
        self.origin = origin

    def upper(self, some: slice) -> np.ndarray:
        """Rows `some` of the first side by all of the second."""
        (q, q_first, q_norms), (x, x_first, x_norms) = self.sides
        bounds = q[some] @ x.T
        bounds += (q_first[some] - self.origin)[:, None] + x_first
        # rounding must not cut a candidate off
        bounds += 1e-6 * (q_norms[some][:, None] + x_norms + self.origin + 1.0)
        return bounds


def search(
    queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, pivots: np.ndarray, k: int,
    query_rows: np.ndarray | None = None, rows: np.ndarray | None = None, floors: np.ndarray | None = None,
) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """For each query: its id, the ids and scores of its best k in this block, and how many were evaluated.

    The query's own row is told by the numbers of the rows, or by the ids if there are none.
    Candidates below the query's floor, if there is one, are left out.
    """
    if rows is None:
        query_rows, rows = query_ids, ids
    bounds = Bounds(pivots, queries, x)
    short = float((queries**2).sum(axis=1).max(initial=0)) * float((x**2).sum(axis=1).max(initial=0)) < 2.0**104
    exact, whole = (x, queries) if short else (x.astype(np.int64), queries.astype(np.int64))
    for j in range(len(queries)):
        if j % TOGETHER == 0:
            block = bounds.upper(slice(j, j + TOGETHER))
        upper = block[j % TOGETHER]
        floor = -np.inf if floors is None else floors[j]
        left = np.flatnonzero((upper >= floor) & (rows != query_rows[j]))
        best_ids, best, seen, size = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, SLICE
        while len(left):
            if len(left) > size:  # the next slice of greatest bounds
                at = np.argpartition(-upper[left], size - 1)
                some, left = left[at[:size]], left[at[size:]]
            else:
                some, left = left, left[:0]
            seen += len(some)
            scores = (exact[some] @ whole[j]).astype(np.int64)
            high = scores >= (best[-1] if len(best) == k else floor)
            best, best_ids = np.concatenate([best, scores[high]]), np.concatenate([best_ids, ids[some[high]]])
            first = np.lexsort((best_ids, -best))[:k]
            best, best_ids = best[first], best_ids[first]
            if len(best) == k:
                left = left[upper[left] >= best[-1]]
            size *= 2
        yield int(query_ids[j]), best_ids, best, seen


def search_wide(
    queries: np.ndarray, query_rows: np.ndarray, x: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int
) -> Iterator[tuple[list[int], list[int]]]:
    """For each query: ids and scores of its best k in this block, in Python's integers."""
    for q, own in zip(queries, query_rows):
        scores = x @ q if len(q) else [0] * len(ids)
        best = heapq.nsmallest(k, ((-s, int(i)) for s, i, r in zip(scores, ids, rows) if r != own))
        yield [i for _, i in best], [-s for s, _ in best]


def _ordered(score: int) -> tuple[int | None, int, str | None]:
    """The score if it has 64 bits; else a number and a string, both ordered as the scores are, 0 and null for the others."""
    if -(1 << 63) <= score < 1 << 63:
        return score, 0, None
    digits = str(abs(score))
    if score > 0:
        return None, len(digits), digits
    return None, -len(digits), digits.translate(str.maketrans("0123456789", "9876543210"))


def top_k(
    df: DataFrame, is_query: Column, k: int, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", text_scores: bool = False
) -> DataFrame:
    """query_id, rank (from 1), id of the candidate, score, for the rows where is_query holds.

    A score beyond 64 bits is null, its rank is right; text_scores: all scores in full, as text.
    """
    vectors = landed(quantised(df, scale, id_col, vector_col), "vectors")
    samples = sampled(vectors, scale)
    pivots = {dim: farthest_first(x, PIVOTS) for dim, (x, _) in samples.items()}
    shared = df.sparkSession.sparkContext.broadcast(samples)  # about SAMPLE vectors
    candidates = _blocks(vectors, BLOCK, scale)
    asked = vectors.where(is_query)

    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors = []
            for r in batch.to_pylist():
                x, rows = shared.value.get(r["dim"], (np.zeros((0, r["dim"])), np.zeros(0, np.int64)))
                out = np.full(r["n"], -np.inf)
                if not r["wide"] and len(x) > k:
                    q, own = np.frombuffer(r["numbers"], "<i4").reshape(r["n"], r["dim"]), np.frombuffer(r["rows"], "<i8")
                    for j in range(0, len(q), TOGETHER):
                        scores = products(q[j : j + TOGETHER], x)
                        scores[own[j : j + TOGETHER, None] == rows] = np.iinfo(np.int64).min
                        out[j : j + TOGETHER] = np.partition(scores, -k, axis=1)[:, -k]
                floors.append(out.tobytes())
            yield batch.append_column("floors", pa.array(floors, pa.binary()))

    made = _blocks(asked, QUERY_BLOCK, scale)
    seeds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made.schema) + ", floors binary"
    query_blocks = landed(made.mapInArrow(seeded, seeds).withColumn("block", F.monotonically_increasing_id()), "queries")
    own, met = _groups(query_blocks)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>"))
    # a merge join: the size that Spark expects of the queries leaves out their SALTS copies, which must not be broadcast
    pairs = (
        candidates.withColumn("salt", F.pmod(F.xxhash64("ids", "rows"), F.lit(SALTS)))
        .withColumn("group", F.explode(met))
        .drop("dim")
        .withColumnsRenamed({c: f"c_{c}" for c in ("n", "wide", "ids", "rows", "numbers")})
        .join(query_blocks.withColumn("group", own).drop("block").withColumn("salt", salts).hint("merge"), ["group", "salt"])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda name, r: batch.column(batch.schema.get_field_index(name))[r].as_py()
            for r in range(batch.num_rows):
                dim = get("dim", r)
                (ids, rows, x), (q_ids, q_rows, q) = (
                    (
                        np.frombuffer(get(f"{side}ids", r), "<i8"),
                        np.frombuffer(get(f"{side}rows", r), "<i8"),
                        np.frombuffer(get(f"{side}numbers", r), "<f8" if get(f"{side}wide", r) else "<i4").reshape(get(f"{side}n", r), dim),
                    )
                    for side in ("c_", "")
                )
                if get("c_wide", r) or get("wide", r):
                    x, q = (whole_numbers(a, scale if a.dtype == "<f8" else 1) for a in (x, q))
                    found = list(search_wide(q, q_rows, x, ids, rows, k))
                    parts = [_ordered(s) for f in found for s in f[1]]
                    score, size, digits = (pa.array([p[j] for p in parts], t) for j, t in enumerate((pa.int64(), pa.int32(), pa.string())))
                    near = [np.array(f[0], np.int64) for f in found]
                else:
                    x, some = x.astype(np.float64), pivots.get(dim, np.zeros((1, dim)))
                    found = list(search(q.astype(np.float64), q_ids, x, ids, some, k, q_rows, rows, np.frombuffer(get("floors", r), "<f8")))
                    near = [f[1] for f in found]
                    score = pa.array(np.concatenate([f[2] for f in found]), pa.int64())
                    size, digits = pa.array(np.zeros(len(score), np.int32)), pa.nulls(len(score), pa.string())
                counts = [len(n) for n in near]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(q_rows, counts)), pa.array(np.repeat(q_ids, counts)), pa.array(np.concatenate(near)), score, size, digits],
                    ["query_row", "query_id", "id", "score", "size", "digits"],
                )

    near = pairs.mapInArrow(run, "query_row long, query_id long, id long, score long, size int, digits string")
    order = Window.partitionBy("query_row").orderBy(F.col("size").desc(), F.col("digits").desc(), F.col("score").desc(), "id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    if text_scores:
        digits = F.when(F.col("size") < 0, F.concat(F.lit("-"), F.translate("digits", "0123456789", "9876543210"))).otherwise(F.col("digits"))
        ranked = ranked.withColumn("score", F.coalesce(digits, F.col("score").cast("string")))
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
