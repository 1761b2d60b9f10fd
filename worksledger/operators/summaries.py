"""The four summary tables.

All group on one dimension with map-side partial aggregation, so a dimension
value holding a third of the rows reaches the shuffle as one partial row per
task. The single COUNT(DISTINCT) of a table is planned by Spark as a grouping on
(dimension, value) first, which spreads a hot dimension value as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worksledger import constants as C
from worksledger.functions import (
    exact_avg,
    exact_sum,
    merged_avg,
    merged_sum,
    round_half,
    sum_parts,
)
from worksledger.operators.ordering import top_k

_DAYS = "duration_days"
_COST = "contract_cost"


def summary_by_region(clean: DataFrame) -> DataFrame:
    return (
        clean.groupBy("region")
        .agg(
            F.count("*").alias("total_projects"),
            F.count_distinct("contractor").alias("unique_contractors"),
            round_half(exact_sum(_COST), 2).alias("total_contract_cost"),
            round_half(exact_avg(_COST), 2).alias("avg_contract_cost"),
            round_half(exact_sum("approved_budget"), 2).alias("total_approved_budget"),
            F.min("infra_year").alias("earliest_year"),
            F.max("infra_year").alias("latest_year"),
        )
        .orderBy(F.col("total_contract_cost").desc_nulls_last(), F.col("region").asc_nulls_last())
    )


def summary_by_work_type(clean: DataFrame) -> DataFrame:
    """Projects without a type of work form a group of their own."""
    return (
        clean.groupBy("type_of_work")
        .agg(
            F.count("*").alias("total_projects"),
            round_half(exact_sum(_COST), 2).alias("total_cost"),
            round_half(exact_avg(_COST), 2).alias("avg_cost"),
            round_half(exact_avg("cost_efficiency_ratio"), 4).alias("avg_efficiency"),
        )
        .orderBy(F.col("total_projects").desc(), F.col("type_of_work").asc_nulls_last())
    )


def summary_by_year(clean: DataFrame) -> DataFrame:
    """Counts two kinds of distinct values, hence grouped in two steps.

    In one step Spark would write every row three times before aggregating; here
    that happens to the (year, region, contractor) groups only.
    """
    groups = (
        clean.filter(F.col("infra_year").isNotNull())
        .groupBy("infra_year", "region", "contractor")
        .agg(
            F.count("*").alias("projects"),
            *sum_parts(_COST),
            F.sum(_DAYS).alias("days"),
            F.count(_DAYS).alias("timed"),
        )
    )
    return (
        groups.groupBy("infra_year")
        .agg(
            F.sum("projects").alias("total_projects"),
            F.count_distinct("region").alias("regions_covered"),
            F.count_distinct("contractor").alias("unique_contractors"),
            round_half(merged_sum(_COST), 2).alias("total_cost"),
            round_half(merged_avg(_COST), 2).alias("avg_cost"),
            round_half(
                F.when(F.sum("timed") > 0, F.sum("days") / F.sum("timed")), 0
            ).alias("avg_duration_days"),
        )
        .orderBy("infra_year")
    )


def contractor_totals(clean: DataFrame) -> DataFrame:
    """One row per named contractor."""
    return (
        clean.filter("has_contractor")
        .groupBy("contractor")
        .agg(
            F.count("*").alias("total_projects"),
            F.count_distinct("region").alias("regions_active"),
            round_half(exact_sum(_COST), 2).alias("total_contract_value"),
            round_half(exact_avg(_COST), 2).alias("avg_contract_value"),
            F.min("infra_year").alias("first_year"),
            F.max("infra_year").alias("last_year"),
        )
    )


def summary_top_contractors(clean: DataFrame, k: int = C.TOP_CONTRACTORS) -> DataFrame:
    return top_k(contractor_totals(clean), "total_projects", k, ["contractor"])
