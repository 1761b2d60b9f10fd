"""Answers to the interactive questions: KPIs, breakdowns, facets, series.

Each takes the clean table or its cube (``cube.cube``), with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worksledger import constants as C
from worksledger.functions import (
    merged_avg,
    merged_sum,
    percent,
    round_half,
    scale_units,
    truncate_text,
)
from worksledger.operators.cube import cost_parts, projects, total_cost
from worksledger.operators.filters import ProjectFilter, apply_filter, drill_down
from worksledger.operators.ordering import top_k

_COST = "contract_cost"


def kpi_overview(df: DataFrame, selected: ProjectFilter | None = None) -> DataFrame:
    """One row, also for an empty selection (then 0 projects and NULL costs).

    Grouped by (region, contractor) first, so that the two distinct counts
    multiply those groups and not the rows.
    """
    chosen = apply_filter(df, selected)
    groups = chosen.groupBy("region", "contractor").agg(
        projects(chosen).alias("projects"), *cost_parts(chosen)
    )
    return groups.agg(
        F.coalesce(F.sum("projects"), F.lit(0)).alias("total_projects"),
        round_half(merged_sum(_COST), 0).alias("total_cost"),
        round_half(merged_avg(_COST), 0).alias("avg_cost"),
        F.count_distinct("contractor").alias("unique_contractors"),
        F.count_distinct("region").alias("regions"),
    )


def _breakdown(df: DataFrame, dimension: str, cost: str, *more: Column) -> DataFrame:
    return df.groupBy(dimension).agg(
        projects(df).alias("projects"), round_half(total_cost(df), 0).alias(cost), *more
    )


def by_year(df: DataFrame, selected: ProjectFilter | None = None) -> DataFrame:
    dated = apply_filter(df, selected).filter(F.col("infra_year").isNotNull())
    return _breakdown(dated, "infra_year", "total_cost").orderBy("infra_year")


def by_work_type(
    df: DataFrame, selected: ProjectFilter | None = None, k: int = C.TOP_WORK_TYPES
) -> DataFrame:
    counted = _breakdown(apply_filter(df, selected), "type_of_work", "total_cost")
    return top_k(counted, "projects", k, ["type_of_work"])


def by_cost_category(df: DataFrame, selected: ProjectFilter | None = None) -> DataFrame:
    return _breakdown(apply_filter(df, selected), "cost_category", "total_cost").orderBy(
        F.col("total_cost").desc_nulls_last(), F.col("cost_category").asc_nulls_last()
    )


def by_region(
    df: DataFrame, selected: ProjectFilter | None = None, order: str = "projects"
) -> DataFrame:
    """Ordered by ``projects`` on screen, by ``total_cost`` in the export."""
    return _breakdown(apply_filter(df, selected), "region", "total_cost").orderBy(
        F.col(order).desc_nulls_last(), F.col("region").asc_nulls_last()
    )


def by_province(
    df: DataFrame,
    selected: ProjectFilter | None = None,
    region: str | None = None,
    k: int = C.TOP_PROVINCES,
) -> DataFrame:
    counted = _breakdown(
        drill_down(df, selected, region),
        "province",
        "total_cost",
        F.count_distinct("contractor").alias("contractors"),
    )
    return top_k(counted, "projects", k, ["province"])


def by_contractor(
    df: DataFrame, selected: ProjectFilter | None = None, k: int = C.TOP_CONTRACTORS_SCREEN
) -> DataFrame:
    """Projects without a contractor stay a group here, unlike in the summary."""
    counted = _breakdown(apply_filter(df, selected), "contractor", "total_value")
    return top_k(counted, "projects", k, ["contractor"])


def share_of_total(df: DataFrame, value_col: str, bounded: bool = False) -> DataFrame:
    """Adds ``share_pct``: each value as per cent of the sum over these rows.

    The sum is a scalar subquery, which works for any number of rows. Callers
    that hold a result of known small size (a top 8, the cost classes) pass
    ``bounded`` and get one window over it, so that the input is read once.
    """
    if bounded:
        total = F.sum(value_col).over(Window.partitionBy())
    else:
        total = df.agg(F.sum(value_col)).scalar()
    return df.withColumn("share_pct", percent(value_col, total, 1))


def facet_values(
    df: DataFrame, col: str, drop_null: bool = False, descending: bool = False
) -> DataFrame:
    """Distinct values of a filter dimension, NULL last."""
    kept = df.filter(F.col(col).isNotNull()) if drop_null else df
    c = F.col(col)
    return (
        kept.select(col)
        .distinct()
        .orderBy(c.desc_nulls_last() if descending else c.asc_nulls_last())
    )


def facets(df: DataFrame) -> dict[str, DataFrame]:
    """The four filter dimensions in the order each is offered."""
    return {
        "region": facet_values(df, "region"),
        "infra_year": facet_values(df, "infra_year", drop_null=True, descending=True),
        "type_of_work": facet_values(df, "type_of_work", drop_null=True),
        "cost_category": facet_values(df, "cost_category"),
    }


# --- series for charts --------------------------------------------------------


def year_series(df: DataFrame, selected: ProjectFilter | None = None) -> DataFrame:
    """Projects and cost in billions per year."""
    return by_year(df, selected).select(
        "infra_year", "projects", scale_units("total_cost", "billion").alias("cost_billions")
    )


def work_type_shares(
    df: DataFrame, selected: ProjectFilter | None = None, **top: int
) -> DataFrame:
    """Shares among the types shown (k of them), not among all projects."""
    shown = by_work_type(df, selected, **top).select("type_of_work", "projects")
    return share_of_total(shown, "projects", bounded=True)


def cost_category_shares(df: DataFrame, selected: ProjectFilter | None = None) -> DataFrame:
    classes = by_cost_category(df, selected).select("cost_category", "total_cost")
    return share_of_total(classes, "total_cost", bounded=True).withColumn(
        "cost_billions", scale_units("total_cost", "billion")
    )


def region_bars(df: DataFrame, selected: ProjectFilter | None = None) -> DataFrame:
    return by_region(df, selected).select(F.col("region").alias("label"), "projects")


def province_bars(
    df: DataFrame, selected: ProjectFilter | None = None, region: str | None = None, **top: int
) -> DataFrame:
    return by_province(df, selected, region, **top).select(F.col("province").alias("label"), "projects")


def contractor_bars(
    df: DataFrame, selected: ProjectFilter | None = None, **top: int
) -> DataFrame:
    label = truncate_text("contractor", C.CONTRACTOR_LABEL_CHARS)
    return by_contractor(df, selected, **top).select(label.alias("label"), "projects")
