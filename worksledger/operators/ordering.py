"""Top-k, user-chosen sorting and paging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worksledger import constants as C
from worksledger.functions import null_display, scale_units, truncate_text
from worksledger.operators import ranks
from worksledger.operators.filters import ProjectFilter, apply_filter, search
from worksledger.session import sized_for, stored_bytes

# Up to this many leading rows a page is a bounded top-k; beyond it, see below.
DEEP_PAGE_ROWS = 1_000
_GROUPS = 256
_GROUP = "_partition_group"
_RANK = "_rank_in_group"


def _largest_first(metric: str, tie_breakers: Sequence[str]) -> list[Column]:
    ties = [F.col(c).asc_nulls_last() for c in tie_breakers]
    return [F.col(metric).desc_nulls_last(), *ties]


def top_k(df: DataFrame, metric: str, k: int, tie_breakers: Sequence[str]) -> DataFrame:
    """The k largest groups of an aggregate; ties are cut in a fixed order."""
    return df.orderBy(*_largest_first(metric, tie_breakers)).limit(k)


def top_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of a table with any number of partitions.

    ``orderBy().limit(k)`` sends k rows from every task to one place, which for a
    table of a million splits is more than one place can take. Here the tasks'
    leading rows are merged in a bounded number of groups first, each of which
    hands on k rows; both steps are map-side limits as in ``dedup_latest``. Spark plans
    them up to a k that the session sets; beyond it the plain limit, which is one on the
    map side as well, is better than a shuffle of the table.
    """
    most = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > most:
        return df.orderBy(*order).limit(k)
    in_group = Window.partitionBy(_GROUP).orderBy(*order)
    leading = (
        df.withColumn(_GROUP, F.spark_partition_id() % _GROUPS)
        .withColumn(_RANK, F.row_number().over(in_group))
        .filter(F.col(_RANK) <= k)
    )
    return leading.drop(_GROUP, _RANK).orderBy(*order).limit(k)


def explore(
    df: DataFrame,
    selected: ProjectFilter | None = None,
    term: str = "",
    k: int = C.EXPLORER_ROWS,
    tie_breakers: Sequence[str] = ("global_id",),
) -> DataFrame:
    """The k most expensive projects among those selected and found."""
    found = search(apply_filter(df, selected), term)
    needed = found.select(*dict.fromkeys([*C.EXPLORER_COLUMNS, *tie_breakers]))
    order = _largest_first("contract_cost", tie_breakers)
    return top_rows(needed, order, k).select(*C.EXPLORER_COLUMNS)


def explorer_cells(explored: DataFrame) -> DataFrame:
    """Explorer rows as shown: shortened text, cost in millions, dash for NULL."""
    cut = {c: truncate_text(c, n).alias(c) for c, n in C.EXPLORER_CELL_CHARS.items()}
    return explored.select(
        cut["project_description"],
        null_display("region").alias("region"),
        null_display("province").alias("province"),
        cut["contractor"],
        scale_units("contract_cost", "million").alias("cost_millions"),
        "infra_year",
        cut["type_of_work"],
    )


def sort_order(
    df: DataFrame, col: str, direction: str = "desc", tie_breakers: Sequence[str] = ()
) -> list[Column]:
    """Order of a table a user sorts by one column.

    Missing values come last in both directions, text is compared by language
    rules without case, everything else by value.
    """
    if direction not in ("asc", "desc"):
        raise ValueError(f"direction must be 'asc' or 'desc', not {direction!r}")
    is_text = isinstance(df.schema[col].dataType, T.StringType)
    key = F.collate(F.col(col), "UNICODE_CI") if is_text else F.col(col)
    first = key.asc_nulls_last() if direction == "asc" else key.desc_nulls_last()
    return [first, *[F.col(c).asc_nulls_last() for c in tie_breakers], *_whole_row(df)]


def _whole_row(df: DataFrame) -> list[Column]:
    """Ends an order: two hashes of the row, of 64 bits each. Rows that still tie are equal rows.

    They also deal the rows of one value over all tasks of a sort.
    """
    plain = [f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]
    return [F.xxhash64(*plain), F.xxhash64(F.lit(1), *reversed(plain))]


def sort_table(
    df: DataFrame, col: str, direction: str = "desc", tie_breakers: Sequence[str] = ()
) -> DataFrame:
    return df.orderBy(*sort_order(df, col, direction, tie_breakers))


def toggle(col: str, sorted_by: str | None, direction: str) -> tuple[str, str]:
    """Column and direction after a click: a new column starts descending."""
    if col != sorted_by:
        return col, "desc"
    return col, "asc" if direction == "desc" else "desc"


def paginate(
    df: DataFrame,
    order: Sequence[Column],
    page: int,
    size: int = C.PAGE_SIZE,
    deep_from: int = DEEP_PAGE_ROWS,
) -> DataFrame:
    """Rows of one zero-based page of the ordered table.

    The order is completed by the whole row, so that pages never repeat or leave out a
    row, on whichever way they are found: up to ``deep_from`` rows by a bounded top-k,
    further down in the rank index of the table and order. Of a table of stored files
    only the sort keys and the places of the rows are moved; the rows of the page are
    then read from their files.
    """
    order = [*order, *_whole_row(df)]
    start = page * size
    if start + size > deep_from:
        return ranks.index_of(df, order).page(df, start, size)
    placed = ranks.located(df)
    if placed is None:
        return top_rows(df, order, start + size).orderBy(*order).offset(start)
    narrow, by = ranks.keyed(placed, order, ranks.PLACE)
    found = top_rows(narrow, by, start + size).orderBy(*by).offset(start)
    with sized_for(df.sparkSession, stored_bytes(df), sorts=True):
        places = found.select(*ranks.PLACE).collect()  # as many as the page
    return ranks.fetch(df, places)


def page_count(df: DataFrame, size: int = C.PAGE_SIZE) -> DataFrame:
    """Number of records and of pages."""
    return df.agg(F.count("*").alias("records")).withColumn(
        "pages", F.ceil(F.col("records") / size).cast("bigint")
    )
