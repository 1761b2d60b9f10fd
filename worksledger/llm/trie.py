"""Prefix trie of conversations by collapsing whole sequences.

A conversation is rebuilt from the first h turns of the conversation its hundred begins
with (h by the CRC-32 of its id) and its own turns after its first h. Identical rebuilt
conversations become one weighted sequence with the list of those that end there;
sequences that are no proper prefix of another, found by an anti-join, are the leaves;
the prefixes of the sequences, weighted, are the nodes of the trie.

Texts never move: a turn is a 128-bit digest and a number of characters, and a prefix is
a polynomial of the digests in two 64-bit lanes, so that prefixes of all depths are running
sums (``running.along``). Two sequences count as equal when their lanes do. Nothing is
collected by conversation, sequence or node: a conversation of any length, a turn that all
begin with, and a sequence that very many end with spread over tasks. Only the digest of an
end list is made in one stream, as SHA-256 has it, from chunks of joined ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worksledger.llm.common import landed
from worksledger.llm.running import along, longs, powers

FAMILY = 100  # conversations of a hundred share the beginning of its first one
MOST_HEAD = 5  # the CRC-32 modulo 6 is at most this
#: Multipliers of the two lanes, odd; any others would do.
LANES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
CHUNK = 4096  # ids of an end list in one row
WIDE_NODES = 1000  # nodes with the most children are joined apart
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _digests(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, a, b, chars) of the rows that have a conv_id."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    sha = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    lane = [F.conv(F.substring(sha, at, 16), 16, -10).cast("bigint") for at in (1, 17)]
    return df.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        lane[0].alias("a"),
        lane[1].alias("b"),
        F.char_length(text).cast("bigint").alias("chars"),
    )


def head_turns(conv_id: Column) -> Column:
    """How many turns of a conversation come from the first of its hundred."""
    return (F.crc32(conv_id.cast("string")) % (MOST_HEAD + 1)).cast("bigint")


def _wrapped(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return longs(batch.column(batch.schema.get_field_index(name))).view(np.uint64)


def _with(batch: pa.RecordBatch, columns: dict[str, np.ndarray], drop: tuple[str, ...]) -> pa.RecordBatch:
    kept = {n: c for n, c in zip(batch.schema.names, batch.columns) if n not in drop}
    kept |= {n: pa.array(np.ascontiguousarray(x).view(np.int64)) for n, x in columns.items()}
    return pa.RecordBatch.from_arrays(list(kept.values()), names=list(kept))


def _inverse_powers(lane: int) -> np.ndarray:
    inverse = pow(LANES[lane], -1, 1 << 64)
    return np.array([pow(inverse, k, 1 << 64) for k in range(MOST_HEAD + 1)], np.uint64)


def _conversations(placed: DataFrame) -> DataFrame:
    """One row per conversation: its length, its head, and what turns own prefixes into rebuilt ones.

    With F the polynomial of the original turns, the rebuilt prefix that ends at original
    turn i > h is P = k + lane ** -cut * F(i), where cut is what h exceeds the head by.
    """
    point = F.struct("a_run", "b_run", "chars")
    heads = [F.max(F.when(F.col("row") == k, point)).alias(f"at{k}") for k in range(1, MOST_HEAD + 1)]
    each = placed.groupBy("conv_id").agg(F.max("row").alias("n"), F.max_by(point, "row").alias("end"), *heads)
    each = landed(each, "conversations")
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    points = F.array(*[f"at{k}" for k in range(1, MOST_HEAD + 1)])
    firsts = each.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("base"), F.col("n").alias("base_n"), points.alias("points")
    )
    joined = each.withColumn("base", base).withColumn("h", head_turns(F.col("conv_id"))).join(firsts, "base", "left")
    n_head = F.least("h", F.coalesce("base_n", F.lit(0)))
    joined = joined.withColumn("head", F.slice(F.coalesce("points", F.array()), 1, n_head.cast("int")))

    def lane(column: Column, field: str, alias: str) -> Column:
        return F.coalesce(column[field], F.lit(0)).alias(alias)

    last = F.try_element_at("head", F.lit(-1))
    own = F.when(F.col("h") > 0, F.try_element_at(points, F.greatest("h", F.lit(1)).cast("int")))
    flat = joined.select(
        "conv_id", "n", "h", "head", F.size("head").cast("bigint").alias("n_head"),
        lane(last, "a_run", "head_a"), lane(last, "b_run", "head_b"),
        lane(own, "a_run", "own_a"), lane(own, "b_run", "own_b"),
        lane(F.col("end"), "a_run", "end_a"), lane(F.col("end"), "b_run", "end_b"),
    )
    schema = (
        "conv_id bigint, n bigint, h bigint, head array<struct<a_run:bigint,b_run:bigint,chars:bigint>>, n_head bigint, "
        "k_a bigint, k_b bigint, depth bigint, a bigint, b bigint"
    )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, h, n_head = (longs(batch.column(k)) for k in (1, 2, 4))
            made, tails = {}, {}
            for k, x in enumerate("ab"):
                shift = _inverse_powers(k)[h - n_head]
                made[f"k_{x}"] = _wrapped(batch, f"head_{x}") - shift * _wrapped(batch, f"own_{x}")
                through = made[f"k_{x}"] + shift * _wrapped(batch, f"end_{x}")
                tails[x] = np.where(n > h, through, _wrapped(batch, f"head_{x}"))
            made["depth"] = n_head + np.maximum(n - h, 0)
            yield _with(batch, made | tails, ("head_a", "head_b", "own_a", "own_b", "end_a", "end_b"))

    return landed(flat.mapInArrow(solve, schema), "rebuilt")


def end_lists(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): digest of the ascending conv_ids that end at a sequence.

    Ranges of (sequence, id) are joined to chunks of text where they lie, so that the
    stream of a sequence has a row per CHUNK ids and not one per id.
    """
    key = ["depth", "a", "b"]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, a, b, ids = (longs(c) for c in batch.columns)
            new = np.concatenate([[True], (d[1:] != d[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, len(ids)))
            cuts = np.concatenate([np.arange(s, s + n, CHUNK) for s, n in zip(starts, sizes)])
            told = ids.astype(str).tolist()
            texts = [",".join(told[x:y]) for x, y in zip(cuts, np.append(cuts[1:], len(ids)))]
            columns = [pa.array(x[cuts]) for x in (d, a, b, ids)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*key, "first", "told"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, done = None, None, []
        for batch in batches:
            for *name, told in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4))):
                if name != now:
                    if now is not None:
                        done.append((*now, sha.hexdigest()))
                    now, sha = name, hashlib.sha256(told.encode())
                else:
                    sha.update(b"," + told.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=[*key, "ends_sha256"])
                done = []
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, sha.hexdigest())], names=[*key, "ends_sha256"])

    by = [*key, "conv_id"]
    told = (
        ends.select(*by).repartitionByRange(*by).sortWithinPartitions(*by)
        .mapInArrow(chunks, "depth bigint, a bigint, b bigint, first bigint, told string")
    )
    streams = told.repartition(*key).sortWithinPartitions(*key, "first")
    return streams.mapInArrow(digest, "depth bigint, a bigint, b bigint, ends_sha256 string")


def _prefixes(placed: DataFrame, sequences: DataFrame) -> DataFrame:
    """Every prefix of every sequence, the textless one included, with that of its parent.

    (rep, weight, d, a, b, parent_a, parent_b, chars, depth); depth is the sequence's own.
    """
    told = ["rep", "weight", "d", "a", "b", "parent_a", "parent_b", "chars", "depth"]
    zero = F.lit(0).cast("bigint")
    in_head = sequences.select("rep", "weight", "depth", "head", F.posexplode(F.sequence(zero, F.col("n_head"))).alias("k", "d"))

    def at(place: Column, field: str) -> Column:
        return F.coalesce(F.when(place > 0, F.try_element_at("head", F.greatest(place, F.lit(1)).cast("int")))[field], zero)

    d = F.col("d")
    head = in_head.select(
        "rep", "weight", "d", at(d, "a_run").alias("a"), at(d, "b_run").alias("b"),
        at(d - 1, "a_run").alias("parent_a"), at(d - 1, "b_run").alias("parent_b"), at(d, "chars").alias("chars"), "depth",
    )
    joined = placed.join(
        sequences.select(F.col("rep").alias("conv_id"), "weight", "depth", "h", "n_head", "k_a", "k_b"), "conv_id"
    ).where(F.col("row") > F.col("h"))
    flat = joined.select(
        F.col("conv_id").alias("rep"), "weight", "row", "a", "b", "a_run", "b_run", "chars", "depth", "h", "n_head", "k_a", "k_b"
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, h, n_head = (longs(batch.column(batch.schema.get_field_index(x))) for x in ("row", "h", "n_head"))
            made = {"d": row + n_head - h}
            for k, x in enumerate("ab"):
                made[x] = _wrapped(batch, f"k_{x}") + _inverse_powers(k)[h - n_head] * _wrapped(batch, f"{x}_run")
                made[f"parent_{x}"] = made[x] - _wrapped(batch, x) * powers(LANES[k], made["d"])
            out = _with(batch, made, ("row", "a", "b", "a_run", "b_run", "h", "n_head", "k_a", "k_b"))
            yield out.select(told)

    own = flat.mapInArrow(place, ", ".join(f"{x} bigint" for x in told))
    return landed(head.unionByName(own), "prefixes")


def _with_parents(nodes: DataFrame) -> DataFrame:
    """nodes with n_children and parent_conv_id; the few widest parents are joined apart."""
    child_of = [(F.col("depth") - 1).alias("p_depth"), F.col("parent_a").alias("p_a"), F.col("parent_b").alias("p_b")]
    up = ["p_depth", "p_a", "p_b"]
    counts = nodes.where(F.col("depth") > 0).groupBy(*child_of).agg(F.count("*").alias("n_children"))
    parents = landed(
        nodes.join(counts, [nodes.depth == counts.p_depth, nodes.a == counts.p_a, nodes.b == counts.p_b], "left")
        .drop(*up).withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))),
        "nodes",
    )
    named = parents.where(F.col("n_children") > 0).select(
        F.col("depth").alias("p_depth"), F.col("a").alias("p_a"), F.col("b").alias("p_b"),
        F.col("conv_id").alias("parent_conv_id"), "n_children",
    )
    wide = named.orderBy(F.col("n_children").desc(), *up).limit(WIDE_NODES).drop("n_children")
    below = parents.withColumns({"p_depth": F.col("depth") - 1, "p_a": F.col("parent_a"), "p_b": F.col("parent_b")})
    found = below.join(F.broadcast(wide), up, "left")
    easy = F.col("parent_conv_id").isNotNull() | (F.col("depth") == 0)
    rest = found.where(~easy).drop("parent_conv_id").join(named.drop("n_children"), up)
    return found.where(easy).unionByName(rest).drop(*up)


def trie(df: DataFrame) -> DataFrame:
    """Nodes of the prefix trie of the rebuilt conversations of (conv_id, turn, role, text).

    A node is a distinct sequence of the first d rebuilt turns; its members are the rebuilt
    conversations that start with it. Returns conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    Turns are ordered by turn, nulls first, then by role and by the digest of the row;
    repeated rows are turns of their own. A null role or text is empty. Rows without a
    conv_id belong to no conversation; % is that of SQL, which for negative ids takes the
    sign of the id. A rebuilt conversation without turns is a member of the root alone.
    An empty table gives no node. Columns beyond the four are not read.
    """
    placed = along(_digests(df), "conv_id", ["turn", "role", "a", "b"], dict(zip("ab", LANES)), keep=["chars"])
    conversations = _conversations(placed)
    one = F.struct("conv_id", "h", "n_head", "k_a", "k_b", "head")
    sequences = conversations.groupBy("depth", "a", "b").agg(F.min(one).alias("one"), F.count("*").alias("weight"))
    sequences = landed(
        sequences.select(
            "depth", "a", "b", "weight", F.col("one.conv_id").alias("rep"), "one.h", "one.n_head", "one.k_a", "one.k_b", "one.head"
        ),
        "sequences",
    )
    prefixes = _prefixes(placed, sequences)
    proper = prefixes.where(F.col("d") < F.col("depth")).select(F.col("d").alias("depth"), "a", "b").distinct()
    leaves = sequences.join(proper, ["depth", "a", "b"], "left_anti").select("rep", F.lit(1).cast("bigint").alias("leaf"))
    nodes = landed(
        prefixes.groupBy(F.col("d").alias("depth"), "a", "b").agg(
            F.min("rep").alias("conv_id"),
            F.sum("weight").alias("n_convs"),
            F.max("parent_a").alias("parent_a"),
            F.max("parent_b").alias("parent_b"),
            ((F.sum("weight") - 1) * F.max("chars")).alias("saved"),
        ),
        "weighted",
    )
    # A node belongs to its smallest member, for which its nodes are the lower end of the path. Below a
    # node therefore lies all that belongs to the sequences through it, without what its own has above it.
    above = along(nodes, "conv_id", ["depth"], {"saved": 1}, keep=["depth"])
    owned = nodes.groupBy("conv_id").agg(F.sum("saved").alias("owned")).withColumnRenamed("conv_id", "rep")
    told = sequences.select("rep").join(leaves, "rep", "left").join(owned, "rep", "left").na.fill(0)
    through = prefixes.join(told, "rep").groupBy(F.col("d").alias("depth"), "a", "b")
    through = through.agg(F.sum("leaf").alias("n_leaves"), F.sum("owned").alias("owned"))
    upper = above.select("conv_id", "depth", (F.col("saved_run") - F.col("saved")).alias("upper"))
    full = nodes.join(through, ["depth", "a", "b"]).join(upper, ["conv_id", "depth"])
    full = full.join(end_lists(conversations), ["depth", "a", "b"], "left")
    return _with_parents(full).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("owned") - F.col("upper")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"),
    )
