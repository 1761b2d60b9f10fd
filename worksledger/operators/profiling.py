"""Profiles of the raw and of the clean table; each one pass, none collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worksledger import constants as C
from worksledger.functions import exact_avg, exact_sum, percent, round_half, to_int
from worksledger.operators.ordering import top_k


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def null_profile(df: DataFrame, cols: Sequence[str] = C.NULL_PROFILE_COLUMNS) -> DataFrame:
    """Missing values per column: (column, nulls, pct)."""
    counted = df.agg(
        F.count("*").alias("total"),
        *[(F.count("*") - F.count(c)).alias(c) for c in cols],
    )
    return counted.unpivot("total", list(cols), "column", "nulls").select(
        "column", "nulls", percent("nulls", "total", 1).alias("pct")
    )


def value_distribution(df: DataFrame, col: str, k: int = C.TOP_DISTRIBUTION) -> DataFrame:
    """The k most frequent values with their share of all rows, NULLs included.

    The number of all rows is a scalar subquery that reads no column.
    """
    total = row_count(df).scalar()
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("projects"))
    return top_k(counts, "projects", k, [col]).select(
        col, "projects", percent("projects", total, 1).alias("pct")
    )


def numeric_profile(
    df: DataFrame, year: str = "InfraYear", cost: str = "ContractCost", budget: str = "ABC"
) -> DataFrame:
    """Ranges of the raw numbers; the average skips missing costs."""
    return df.agg(
        to_int(F.min(year)).alias("min_year"),
        to_int(F.max(year)).alias("max_year"),
        F.min(cost).alias("min_cost"),
        F.max(cost).alias("max_cost"),
        exact_avg(cost).alias("avg_cost"),
        F.min(budget).alias("min_budget"),
        F.max(budget).alias("max_budget"),
    )


def duplicate_profile(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and their difference (rows without a key count)."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct(key).alias("unique_keys"),
    ).withColumn("duplicates", F.col("total_rows") - F.col("unique_keys"))


def rows_removed(raw: DataFrame, clean: DataFrame) -> DataFrame:
    return (
        row_count(raw)
        .withColumnRenamed("rows", "raw_rows")
        .withColumn("clean_rows", row_count(clean).scalar())
        .withColumn("rows_removed", F.col("raw_rows") - F.col("clean_rows"))
    )


def _totals_in_billions(clean: DataFrame, dimension: str) -> DataFrame:
    return clean.groupBy(dimension).agg(
        F.count("*").alias("projects"),
        round_half(exact_sum("contract_cost") / 1e9, 2).alias("total_cost_billions"),
    )


def cost_category_distribution(clean: DataFrame) -> DataFrame:
    return _totals_in_billions(clean, "cost_category").orderBy(
        F.col("total_cost_billions").desc_nulls_last(), F.col("cost_category").asc_nulls_last()
    )


def year_distribution(clean: DataFrame) -> DataFrame:
    dated = clean.filter(F.col("infra_year").isNotNull())
    return _totals_in_billions(dated, "infra_year").orderBy("infra_year")


def completeness(clean: DataFrame, flags: Sequence[str] = C.COMPLETENESS_FLAGS) -> DataFrame:
    """Rows for which each flag is true: (flag, rows, pct)."""
    counted = clean.agg(
        F.count("*").alias("total"), *[F.count_if(F.col(f)).alias(f) for f in flags]
    )
    return counted.unpivot("total", list(flags), "flag", "rows").select(
        "flag", "rows", percent("rows", "total", 1).alias("pct")
    )
