"""Rank indexes: which row of a table stands at a rank of an order.

An index is the sort of a table, written once: for each row its rank, as sort partition and
position, and the place of the row in its file. How many rows the partitions before hold is
kept with it, one number per sort partition. Any page is then an interval of ranks: a few
rows of the index, and the files that they name. Pages of one order share one sort.
"""

from __future__ import annotations

import atexit
from bisect import bisect_right
from collections import OrderedDict
from collections.abc import Sequence
from contextlib import suppress
from dataclasses import dataclass
from itertools import accumulate

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from worksledger.session import remove, scratch_path, sized_for, stored_bytes

PLACE = ["_in_file", "_at_row"]
_RANK = "_rank"
_PARTITION_BITS = 33  # monotonically_increasing_id: partition << 33 | row
# Indexes that a process keeps; the one used longest ago is removed with its files.
MOST_INDEXES = 16
# Plans in which a row of the result is a row of a file.
_ROW_BY_ROW = {"Project", "Filter", "SubqueryAlias", "LogicalRelation", "View"}


def located(df: DataFrame) -> DataFrame | None:
    """df with the file and the row that each of its rows was read from, if it has such."""
    plan = df._jdf.queryExecution().analyzed()
    while plan is not None:
        below = plan.children()
        if plan.nodeName().split(" ")[0] not in _ROW_BY_ROW or below.size() > 1:
            return None
        plan = below.head() if below.size() else None
    try:
        file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
        return df.select("*", file.alias(PLACE[0]), row.alias(PLACE[1]))
    except AnalysisException:
        return None


def keyed(df: DataFrame, order: Sequence[Column], kept: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """Columns `kept` and the sort keys as columns of their own, and the order by those.

    Spark evaluates the expressions of an order above the shuffle, which then moves every
    column that they name, and in rows that a task sorts; here only the values are, each once.
    """
    column = df.sparkSession._jvm.org.apache.spark.sql.Column
    found, keys, by = [], [], []
    for part in order:
        node, how = part._jc.node(), ("Ascending", "NullsFirst")
        key = part._jc
        if node.getClass().getSimpleName() == "SortOrder":
            key = column(node.child())
            how = node.sortDirection().toString(), node.nullOrdering().toString()
        if any(key.equals(other) for other in found):
            continue  # ordered by it already
        name = f"_key{len(found)}"
        found.append(key)
        keys.append(type(part)(key).alias(name))
        by.append(getattr(F.col(name), _ORDERS["Desc" in how[0], "Last" in how[1]])())
    return df.select(*kept, *keys), by


_ORDERS = {
    (False, False): "asc_nulls_first",
    (False, True): "asc_nulls_last",
    (True, False): "desc_nulls_first",
    (True, True): "desc_nulls_last",
}


def fetch(df: DataFrame, places: Sequence[Row]) -> DataFrame:
    """The rows at these places, in this order; only their files are opened."""
    if not places:
        return df.limit(0)
    ranked = [(*place, rank) for rank, place in enumerate(places)]
    wanted = df.sparkSession.createDataFrame(ranked, f"{PLACE[0]} string, {PLACE[1]} bigint, {_RANK} int")
    files = sorted({place[0] for place in places})
    found = located(df.filter(F.col("_metadata.file_path").isin(files)))
    joined = found.join(F.broadcast(wanted), PLACE)  # as many rows as the page
    return joined.orderBy(_RANK).select(*df.columns)


@dataclass(frozen=True)
class RankIndex:
    """Places of the rows of one table in one order (or the rows, where they have no place)."""

    path: str
    by_place: bool
    parts: tuple[int, ...]
    through: tuple[int, ...]  # rows up to and with each sort partition

    @classmethod
    def build(cls, df: DataFrame, order: Sequence[Column]) -> RankIndex:
        spark = df.sparkSession
        path = scratch_path(spark, "ranks")
        placed = located(df)
        kept = PLACE if placed is not None else df.columns
        narrow, by = keyed(df if placed is None else placed, order, kept)
        ranked = narrow.orderBy(*by).select(*kept, F.monotonically_increasing_id().alias(_RANK))
        with sized_for(spark, stored_bytes(df), sorts=True):
            ranked.write.parquet(path)
        part = F.shiftright(_RANK, _PARTITION_BITS).cast("int").alias("part")
        sizes = sorted(spark.read.parquet(path).groupBy(part).agg(F.count("*").alias("n")).collect())
        return cls(path, placed is not None, tuple(r.part for r in sizes), tuple(accumulate(r.n for r in sizes)))

    @property
    def rows(self) -> int:
        return self.through[-1] if self.through else 0

    def _place(self, rank: int) -> int:
        """The index's own number of the row at a rank."""
        k = bisect_right(self.through, rank)
        before = self.through[k - 1] if k else 0
        return (self.parts[k] << _PARTITION_BITS) + rank - before

    def page(self, df: DataFrame, start: int, size: int) -> DataFrame:
        """Rows start .. start + size - 1 of the table that the index was built from."""
        end = min(start + size, self.rows)
        if start >= end:
            return df.limit(0)
        rank = F.col(_RANK)
        stored = df.sparkSession.read.parquet(self.path)
        rows = stored.filter(rank.between(self._place(start), self._place(end - 1))).orderBy(rank)
        if self.by_place:
            return fetch(df, rows.select(*PLACE).collect())
        # the page outlives the index, so it holds its rows
        return df.sparkSession.createDataFrame(rows.drop(_RANK).collect(), df.schema)


_INDEXES: OrderedDict[tuple, tuple[SparkSession, RankIndex]] = OrderedDict()


def index_of(df: DataFrame, order: Sequence[Column]) -> RankIndex:
    """The index of a table in an order, built when it is first asked for.

    A table is known by its plan and its files: files that change come with other names.
    """
    context = df.sparkSession.sparkContext
    files = hash(tuple(sorted(df.inputFiles())))
    key = (context.applicationId, df.orderBy(*order).semanticHash(), tuple(df.columns), files)
    if key not in _INDEXES:
        _INDEXES[key] = (df.sparkSession, RankIndex.build(df, order))
        while len(_INDEXES) > MOST_INDEXES:
            _remove(*_INDEXES.popitem(last=False)[1])
    _INDEXES.move_to_end(key)
    return _INDEXES[key][1]


def forget_indexes() -> None:
    """Remove all indexes and their files."""
    while _INDEXES:
        _remove(*_INDEXES.popitem()[1])


def _remove(spark: SparkSession, index: RankIndex) -> None:
    if spark.sparkContext._jsc is not None:  # not after the session has stopped
        remove(spark, index.path)


@atexit.register
def _at_exit() -> None:
    with suppress(Exception):  # the session may be gone
        forget_indexes()
