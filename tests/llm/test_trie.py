from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from worksledger.llm import running, trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, a string, weight long, `row` int"


def brute(rows):
    """Nodes by their turns, from the rows (conv_id, turn, role, text)."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = (*own.get(base, [])[:h], *turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = set()
    for node, inside in members.items():
        below = [x for x in members if x[: len(node)] == node]
        childless = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in members)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        ends = ",".join(map(str, sorted(c for c in inside if len(built[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        children = sum(len(x) == len(node) + 1 for x in below)
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.add((min(inside), len(node), parent, len(inside), children, len(childless), saved, sha))
    assert len(out) == len(members)
    return sorted(out, key=str)


def made(spark, rows, parts=3):
    full = [(*r, 1, "x", 2, 3) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def found(df):
    return sorted(map(tuple, trie.trie(df).collect()), key=str)


def conversations(seed, n=60, words=3):
    r = random.Random(seed)
    rows = []
    for c in [*range(n), *range(180, 180 + n // 2), *range(305, 311), -3, -100, -150]:
        for turn in range(r.randint(1, 9)):
            rows.append((c, turn, r.choice(["user", "assistant"][turn % 2 :][:1]), r.choice("abc"[:words]) * r.randint(1, 2)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_are_those_of_brute_force(spark, seed):
    rows = conversations(seed)
    assert found(made(spark, rows)) == brute(rows)


def test_awkward_rows(spark):
    rows = [
        (None, 1, "user", "nobody's"),
        (0, None, None, None), (0, None, "user", "é𝄞"), (0, 3, "user", ""), (0, 1, "", "x" * 50_000),
        (1, 1, "user", "one turn"), (2, 5, None, "a"), (2, 5, None, "a"), (2, 5, None, "a"), (7, 1, "user", None),
        (110, 1, "user", "no first of its hundred"), (110, 2, "user", "b"), (110, 3, "user", "c"), (110, 4, "user", "d"),
        (110, 5, "user", "e"), (110, 6, "user", "f"), (110, 7, "user", "g"), (-5, 1, "u", "v"), (2**40, 1, "u", "w"),
    ]
    assert found(made(spark, rows)) == brute(rows)
    assert found(made(spark, [])) == []
    assert found(made(spark, [(None, 1, "a", "b")])) == []


def test_one_long_conversation_and_one_large_group(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 7)
    monkeypatch.setattr(trie, "WIDE_NODES", 2)
    rows = [(0, t, "user", f"t{t % 3}") for t in range(300)]
    rows += [(c, t, "user", f"s{t}") for c in range(1000, 1400) for t in range(7)]
    rows += [(c, t, "user", f"s{t if t < 6 else c}") for c in range(2000, 2020) for t in range(7)]
    spread = made(spark, rows, 5)
    assert found(spread) == brute(rows)


def test_running_sums_cross_ranges(spark):
    df = spark.range(5000).select(F.lit(3).cast("long").alias("k"), "id", (F.col("id") * 977 - 10**6).alias("v"), F.col("id").alias("w"))
    df = df.union(spark.range(7).selectExpr("id % 2 * 9 as k", "id", "id + 5 as v", "id as w"))
    base = 0x9E3779B97F4A7C15
    rows = running.along(df, "k", ["id"], {"v": 1, "w": base}, keep=["id"]).collect()
    assert len(rows) == 5007
    runs, place = {}, {}
    for r in sorted(rows, key=lambda r: (r["k"], r["id"])):
        place[r["k"]] = n = place.get(r["k"], 0) + 1
        a, b = runs.get(r["k"], (0, 0))
        runs[r["k"]] = a, b = a + r["v"], b + r["w"] * pow(base, n, 2**64)
        assert (r["row"], r["v_run"], r["w_run"]) == (n, a, running.signed(b))


def test_negative_ids_take_the_remainder_of_sql(spark):
    assert spark.sql("SELECT -150L - -150L % 100").first()[0] == -100
