"""Places and running sums along keys, whatever share of the rows one key holds.

Rows are sorted in ranges of (key, order), so that a key of any size spreads over many
tasks. Each task counts and sums its own rows; what a key held in the ranges before is
added afterwards, from one record per range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worksledger.llm.common import landed

_WORD = 1 << 64


def signed(x: int) -> int:
    x %= _WORD
    return x - _WORD if x >= _WORD >> 1 else x


def powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo 2**64."""
    out, square = np.ones(len(exponents), np.uint64), base % _WORD
    left = exponents.astype(np.int64).copy()
    while len(left) and left.max() > 0:
        out = np.where(left & 1, out * np.uint64(square), out)
        left >>= 1
        square = square * square % _WORD
    return out


def longs(column: pa.Array) -> np.ndarray:
    return np.ascontiguousarray(column.to_numpy(zero_copy_only=False)).astype(np.int64, copy=False)


def along(df: DataFrame, key: str, order: list[str], sums: dict[str, int], keep: list[str] = ()) -> DataFrame:
    """(key, keep.., the columns of sums, `row`, `<name>_run` for each of sums).

    row is the place of a row in its key by order, nulls first, from 1; rows that tie are
    placed in any order. sums maps bigint columns to odd bases: the running sum up to row
    r is the sum of value * base ** row modulo 2**64 (base 1: the plain sum). The key is
    a bigint and no column but those of order may hold nulls.
    """
    names = [key, *dict.fromkeys([*keep, *sums])]
    runs = [f"{name}_run" for name in sums]
    salt = "__salt"  # deals rows that repeat over all ranges
    by = [key, *order, salt]
    ranged = df.withColumn(salt, F.rand(7)).repartitionByRange(*by).sortWithinPartitions(*by).select(*names)
    types = {f.name: f.dataType.simpleString() for f in ranged.schema}
    schema = ", ".join([*(f"`{n}` {types[n]}" for n in names), "row bigint", *(f"`{r}` bigint" for r in runs), "part int"])
    at = [names.index(name) for name in sums]
    bases = list(sums.values())

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count, totals = TaskContext.get().partitionId(), None, 0, [np.uint64(0)] * len(bases)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys, here = longs(batch.column(0)), np.arange(n)
            new = np.concatenate([[last is None or keys[0] != last], keys[1:] != keys[:-1]])
            first = np.maximum.accumulate(np.where(new, here, -1))
            row = np.where(first >= 0, here - first, here + count) + 1
            out = []
            for k, base in enumerate(bases):
                values = longs(batch.column(at[k])).view(np.uint64)
                sofar = np.cumsum(values if base == 1 else values * powers(base, row))
                before = np.where(first > 0, sofar[first - 1], np.where(first < 0, np.uint64(0) - totals[k], np.uint64(0)))
                out.append(sofar - before)
            last, count, totals = keys[-1], int(row[-1]), [x[-1] for x in out]
            made = [pa.array(row), *(pa.array(x.view(np.int64)) for x in out), pa.array(np.full(n, part, np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*names, "row", *runs, "part"])

    parts = landed(ranged.mapInArrow(local, schema), "running")
    ends = parts.groupBy("part").agg(F.min(key).alias("first"), F.max(F.struct(key, "row", *runs)).alias("last"))
    carried: dict[int, tuple[int, int, list[int]]] = {}
    held = None  # key, rows and sums at the end of the range before
    for found in sorted(ends.collect(), key=lambda r: r["part"]):
        tail = (found["last"][0], found["last"][1], list(found["last"][2:]))
        if held is not None and found["first"] == held[0]:
            carried[found["part"]] = held
            if tail[0] == held[0]:
                sums_ = [signed(a + pow(b, held[1], _WORD) * x) for a, b, x in zip(held[2], bases, tail[2])]
                tail = (tail[0], held[1] + tail[1], sums_)
        held = tail
    if not carried:
        return parts.drop("part")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_run = len(names) + 1
        for batch in batches:
            keys, part = longs(batch.column(0)), longs(batch.column(len(names) + 1 + len(runs)))
            row = longs(batch.column(len(names))).copy()
            out = [longs(batch.column(first_run + k)).view(np.uint64).copy() for k in range(len(runs))]
            for p in np.unique(part).tolist():
                if p in carried:
                    held_key, rows, totals = carried[p]
                    where = (part == p) & (keys == held_key)
                    row[where] += rows
                    for k, base in enumerate(bases):
                        out[k][where] = out[k][where] * np.uint64(pow(base, rows, _WORD)) + np.uint64(totals[k] % _WORD)
            made = [pa.array(row), *(pa.array(x.view(np.int64)) for x in out)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *made], names=[*names, "row", *runs])

    return parts.mapInArrow(add, schema.rsplit(",", 1)[0])
