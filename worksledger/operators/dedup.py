"""Latest edit per key, required fields, duplicate keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worksledger.functions import strip_spaces

_RANK = "_edit_rank"


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    tie_breakers: Sequence[Column] = (),
    normalise_key: bool = False,
) -> DataFrame:
    """Keep the newest row per key; rows without ``order_col`` count as oldest.

    Spark ranks within every input partition before the shuffle and forwards one
    row per key and partition, so a key holding a third of the table is cut down
    on the map side and never gathers in one task. ``tie_breakers`` must order
    rows of equal age completely, or reruns may choose differently.
    Keys are compared as stored; ``normalise_key`` compares them stripped.
    """
    parts = [strip_spaces(k) if normalise_key else F.col(k) for k in keys]
    newest = Window.partitionBy(*parts).orderBy(F.col(order_col).desc_nulls_last(), *tie_breakers)
    return df.withColumn(_RANK, F.row_number().over(newest)).filter(F.col(_RANK) == 1).drop(_RANK)


def in_parts(df: DataFrame, keys: Sequence[Column | str], n: int, normalise_key: bool = False) -> list[DataFrame]:
    """n tables of the rows of df, those of one key in one of them; each reads df again.

    What an operator does key by key it does to the parts one after another, with an nth of
    the rows in its shuffles. Rows without a key are those of one key.
    """
    if n == 1:
        return [df]
    parts = [strip_spaces(k) if normalise_key else k for k in keys]
    part = F.pmod(F.xxhash64(*parts), F.lit(n))
    return [df.where(part == k) for k in range(n)]


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows in which all the columns are present (blank text is present)."""
    return df.filter(reduce(and_, [F.col(c).isNotNull() for c in cols]))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Every key value that occurs more than once, with its row count."""
    return df.groupBy(key).agg(F.count("*").alias("copies")).filter("copies > 1")
