"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parity.tables import Given, given, raw_attributes
from worksledger import constants as C
from worksledger import functions as fn
from worksledger.operators import (
    breakdowns,
    cleaning,
    dedup,
    filters,
    layout,
    ordering,
    profiling,
    quality,
    summaries,
)
from worksledger.plans.jobs import Ingested, Transformed, export, ingest, publish, transform, verify
from worksledger.session import parts_for, remove, scratch_path, sized_for, stored_bytes
from worksledger.operators.quality import file_sizes
from worksledger.sinks import (
    dataset_sizes,
    export_csv,
    export_parquet,
    manifest,
    materialise_parts,
    write_manifest,
)
from worksledger.sources import describe_schema, read_geojson, read_parquet, register_views

Query = Callable[[Given], DataFrame]

# What the given tables can be expected to meet.
EXPECTED = quality.Thresholds(
    row_bounds=(1, 10**15), year_bounds=(1992, 2026), region_bounds=(2, 20), min_output_bytes=1
)
SELECTED = filters.ProjectFilter(region="ASIA", work_type="STANDARD")
BY_YEAR = filters.ProjectFilter(year=1999)
TERM = "ED r%g"
SOURCE = "given tables"
# Stored bytes of the tables whose features are text at a time, and the most parts.
TEXT_PART_BYTES = 16 * 1024 * 1024
MOST_TEXT_PARTS = 32


# --- sources and sinks --------------------------------------------------------


def _read_geojson(g: Given) -> DataFrame:
    return read_geojson(g.spark, g.features, layout="lines").drop("geometry")


def _read_geojson_splits(g: Given) -> DataFrame:
    """The same features, held by collections, through the reader for those of any size.

    Their text is some 35 times the tables, so that of large tables is written, read and
    removed in parts; what was read is kept.
    """
    size = stored_bytes(g.source)
    n = parts_for(size, TEXT_PART_BYTES, MOST_TEXT_PARTS)
    if n == 1:
        return read_geojson(g.spark, g.collections, layout="splits").drop("geometry")

    def read() -> Iterator[DataFrame]:
        for part in g.source_parts(n):
            texts = g.collections_of(part)
            yield read_geojson(g.spark, texts, layout="splits").drop("geometry")
            remove(g.spark, texts)

    return materialise_parts(read(), scratch_path(g.spark, "features_read")).table


def _read_parquet(g: Given) -> DataFrame:
    return profiling.row_count(read_parquet(g.spark, f"{g.sf_dir}/lineitem.parquet"))


def _register_views(g: Given) -> DataFrame:
    assert g.summaries
    names = register_views(g.spark, g.base_dir)
    counted = [f"SELECT '{n}' AS view_name, count(*) AS rows FROM {n}" for n in names]
    return g.spark.sql(" UNION ALL ".join(counted))


def _export_parquet(g: Given) -> DataFrame:
    return export_parquet({"copy": g.clean}, scratch_path(g.spark, "export"))["copy"]


def _export_csv(g: Given) -> DataFrame:
    path = scratch_path(g.spark, "csv")
    rows = g.clean.select("global_id", *C.EXPLORER_COLUMNS)
    export_csv(rows, path)
    back = g.spark.read.csv(path, escape='"', schema=rows.schema)
    return back.where(~F.col("global_id").eqNullSafe("global_id"))  # the one header of all parts


def _published(g: Given) -> dict[str, DataFrame]:
    return {C.CLEAN_FILE: g.clean, **g.summaries}


def _manifest(g: Given) -> DataFrame:
    return (
        manifest(_published(g), SOURCE)
        .select("pipeline_version", "source", F.inline("files"))
        .select("pipeline_version", "source", "name", "rows", "description")
    )


def _dataset_sizes(g: Given) -> DataFrame:
    assert g.summaries
    paths = {name: f"{g.base_dir}/{name}" for name in C.VIEWS.values()}
    return dataset_sizes(g.spark, paths, f"{g.sf_dir}/lineitem.parquet")


def _dataset_sizes_checked(g: Given) -> DataFrame:
    """What must hold of sizes, which differ from run to run: the total adds up, its percentage is by formula."""
    sizes = _dataset_sizes(g)
    parts = sizes.filter("name <> 'total'").agg(F.sum("bytes")).scalar()
    source = file_sizes(g.spark, f"{g.sf_dir}/lineitem.parquet").agg(F.sum("length")).scalar()
    is_total = F.col("name") == "total"
    smaller = F.round((source - F.col("bytes")) / source * 100, 1)
    return sizes.select(
        "name",
        (F.col("bytes") > 0).alias("positive"),
        F.when(is_total, F.col("bytes") == parts).otherwise(True).alias("adds_up"),
        F.when(is_total, F.abs(F.col("pct_smaller") - smaller) < 0.11).otherwise(F.col("pct_smaller").isNull()).alias("pct_by_formula"),
    )


# --- expressions --------------------------------------------------------------


def _on_raw(**exprs: object) -> Query:
    return lambda g: g.raw.select("GlobalID", *[e.alias(n) for n, e in exprs.items()])


def _clean_text(g: Given) -> DataFrame:
    text = C.IDENTIFIER_COLUMNS | C.LOCATION_COLUMNS | C.DETAIL_COLUMNS | C.OFFICE_COLUMNS
    return fn.clean_text(g.raw, text | {"FundingYear": "funding_year"})


def _zero_fill(g: Given) -> DataFrame:
    return g.raw.select(
        "GlobalID",
        fn.coalesce_zero("ABC").alias("approved_budget"),
        fn.coalesce_zero("ContractCost").alias("contract_cost"),
        fn.cost_variance("ContractCost", "ABC").alias("cost_variance"),
    )


def _bucketize(g: Given) -> DataFrame:
    label = fn.bucketize("ContractCost", C.COST_CLASSES, C.COST_CLASS_ABOVE, C.COST_CLASS_UNKNOWN)
    return g.raw.select("GlobalID", label.alias("cost_category"))


def _cast_int(g: Given) -> DataFrame:
    return g.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fn.to_int(F.col("l_quantity") / 2).alias("half_quantity"),
        fn.to_int("l_extendedprice").alias("price"),
    )


def _round_half(g: Given) -> DataFrame:
    net = F.col("l_extendedprice") * F.col("l_discount")
    return g.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fn.round_half(net, 2).alias("rounded_2"),
        fn.round_half(F.col("l_quantity") / 2, 0).alias("rounded_0"),
        fn.round_half(F.col("l_extendedprice") / F.col("l_quantity"), 4).alias("rounded_4"),
    )


def _try_date(g: Given) -> DataFrame:
    return g.raw.select(
        "GlobalID",
        fn.try_date("StartDate").alias("start_date"),
        fn.try_date("CompletionDateActual").alias("actual_completion_date"),
    )


def _duration_days(g: Given) -> DataFrame:
    days = fn.duration_days(fn.try_date("StartDate"), fn.try_date("CompletionDateActual"))
    return g.raw.select("GlobalID", days.alias("duration_days"))


def _in_bounding_box(g: Given) -> DataFrame:
    return g.raw.select("GlobalID", fn.in_bbox("Latitude", "Longitude").alias("inside"))


def _quality_flags(g: Given) -> DataFrame:
    flagged = cleaning.quality_flags(g.raw)
    return flagged.select(
        "GlobalID", "has_cost_data", "has_contractor", "has_start_date", "has_completion_date"
    )


def _truncate_text(g: Given) -> DataFrame:
    return g.table("documents").select("doc_id", fn.truncate_text("text", 60).alias("label"))


def _scale_units(g: Given) -> DataFrame:
    return g.clean.select(
        "global_id",
        fn.scale_units("contract_cost", "billion").alias("billions"),
        fn.scale_units("contract_cost", "million").alias("millions"),
    )


def _null_display(g: Given) -> DataFrame:
    return g.clean.select(
        "global_id",
        fn.null_display("type_of_work").alias("type_of_work"),
        fn.null_display("start_date").alias("start_date"),
        fn.null_display("infra_year").alias("infra_year"),
    )


def _dedup_latest(g: Given) -> DataFrame:
    """The newest edits; those of a large table are chosen and written in parts, by key."""
    size = stored_bytes(g.raw)
    n = parts_for(size)
    chosen = [
        dedup.dedup_latest(part, [cleaning.KEY], cleaning.EDITED, cleaning.default_tie_breakers())
        for part in dedup.in_parts(g.raw, [cleaning.KEY], n)
    ]
    if n == 1:
        return chosen[0]
    with sized_for(g.spark, size // n, sorts=True):
        return materialise_parts(chosen, scratch_path(g.spark, "newest")).table


def _filter_clustered(g: Given) -> DataFrame:
    """The selection of filter_projects from a clustered copy of the clean table."""
    path = scratch_path(g.spark, "clustered")
    layout.write_clustered(g.clean, path, layout.files_by_size(g.clean))
    chosen = filters.ProjectFilter("ASIA", "1999", "STANDARD", C.COST_CLASSES[2][1])
    return layout.read_clustered(g.spark, path, chosen).select(*g.clean.columns)


# --- sorting and paging -------------------------------------------------------


def _sort_table(g: Given) -> DataFrame:
    """Explorer result sorted by contractor; the position proves the order."""
    shown = ordering.explore(g.clean)
    ties = ["project_id", "contract_cost"]
    order = ordering.sort_order(shown, "contractor", "desc", ties)
    # 500 rows at most, so one window over all of them is fine
    position = F.row_number().over(Window.orderBy(*order)).cast("bigint")
    return ordering.sort_table(shown, "contractor", "desc", ties).withColumn("position", position)


def _paginate(g: Given, **kwargs: int) -> DataFrame:
    order = ordering.sort_order(g.clean, "project_description", "asc", ["global_id"])
    page = ordering.paginate(g.clean, order, page=3, size=15, **kwargs)
    return page.select("global_id", "project_description", "contract_cost")


# --- quality ------------------------------------------------------------------


def _checks(g: Given) -> DataFrame:
    core = quality.table_checks(g.clean, EXPECTED)
    return core.unionByName(
        quality.summary_total_matches(g.clean, g.summaries[C.REGION_FILE])
    ).unionByName(quality.summary_years_complete(g.clean, g.summaries[C.YEAR_FILE]))


@lru_cache(maxsize=4)
def _ingested(g: Given) -> Ingested:
    return ingest(g.spark, g.features, scratch_path(g.spark, "ingest"), layout="lines")


@lru_cache(maxsize=4)
def _transformed(g: Given) -> Transformed:
    return transform(g.source, scratch_path(g.spark, "transform"), attributes=raw_attributes())


@lru_cache(maxsize=4)
def _exported(g: Given) -> dict[str, DataFrame]:
    return export(_published(g), scratch_path(g.spark, "export"), SOURCE)


def _verify(g: Given) -> DataFrame:
    """All checks on a published folder; sizes vary, so without the details."""
    write_manifest(manifest(_published(g), SOURCE), f"{g.base_dir}/{C.MANIFEST_FILE}")
    checks = verify(g.clean, g.summaries, g.base_dir, expected=EXPECTED)
    return checks.select("check_group", "check_name", "passed")


def _publish(g: Given) -> DataFrame:
    report = publish(
        g.spark,
        g.features,
        scratch_path(g.spark, "publish"),
        SOURCE,
        layout="lines",
        expected=EXPECTED,
    )
    return report.select(
        "status", "promoted", "rows", "checks_total", "checks_passed", "failures", "score"
    )


def _project_explorer(g: Given) -> DataFrame:
    return ordering.explore(g.clean, BY_YEAR, TERM)


def _explorer_cells(g: Given) -> DataFrame:
    return ordering.explorer_cells(ordering.explore(g.clean))


_QUERIES: dict[str, Query] = {
    # sources and sinks
    "read_geojson": _read_geojson,
    "read_geojson_splits": _read_geojson_splits,
    "read_parquet": _read_parquet,
    "register_views": _register_views,
    "describe_schema": lambda g: describe_schema(g.clean),
    "export_parquet_roundtrip": _export_parquet,
    "export_csv_roundtrip": _export_csv,
    "manifest": _manifest,
    "dataset_sizes": _dataset_sizes,
    "dataset_sizes_checked": _dataset_sizes_checked,
    # expressions
    "clean_text": _clean_text,
    "zero_fill": _zero_fill,
    "safe_ratio": lambda g: g.raw.select(
        "GlobalID", fn.safe_ratio("ContractCost", "ABC").alias("ratio")
    ),
    "bucketize": _bucketize,
    "cast_int": _cast_int,
    "round_half": _round_half,
    "try_date": _try_date,
    "duration_days": _duration_days,
    "in_bounding_box": _in_bounding_box,
    "quality_flags": _quality_flags,
    "truncate_text": _truncate_text,
    "scale_units": _scale_units,
    "null_display": _null_display,
    # cleaning
    "projects_raw": lambda g: g.raw,
    "dedup_latest": _dedup_latest,
    "essential_fields": lambda g: cleaning.latest_projects(g.raw),
    "clean_projects": lambda g: cleaning.clean_projects(g.raw),
    "duplicate_keys": lambda g: dedup.duplicate_keys(g.raw, cleaning.KEY),
    # profiles
    "row_count": lambda g: profiling.row_count(g.clean),
    "null_profile": lambda g: profiling.null_profile(g.raw),
    "value_distribution": lambda g: profiling.value_distribution(g.raw, "Region"),
    "numeric_profile": lambda g: profiling.numeric_profile(g.raw),
    "duplicate_profile": lambda g: profiling.duplicate_profile(g.raw, cleaning.KEY),
    "rows_removed": lambda g: profiling.rows_removed(g.raw, g.clean),
    "cost_category_distribution": lambda g: profiling.cost_category_distribution(g.clean),
    "year_distribution": lambda g: profiling.year_distribution(g.clean),
    "completeness": lambda g: profiling.completeness(g.clean),
    # summaries
    "summary_by_region": lambda g: summaries.summary_by_region(g.clean),
    "summary_by_work_type": lambda g: summaries.summary_by_work_type(g.clean),
    "summary_by_year": lambda g: summaries.summary_by_year(g.clean),
    "contractor_totals": lambda g: summaries.contractor_totals(g.clean),
    "summary_top_contractors": lambda g: summaries.summary_top_contractors(g.clean),
    # interactive questions
    "filter_projects": lambda g: filters.filter_projects(
        g.clean, "ASIA", "1999", "STANDARD", C.COST_CLASSES[2][1]
    ),
    "filter_projects_clustered": _filter_clustered,
    "search_projects": lambda g: filters.search(g.clean, TERM).select(
        "global_id", *C.EXPLORER_COLUMNS
    ),
    "drill_down": lambda g: filters.drill_down(g.clean, BY_YEAR, "EUROPE"),
    "kpi_overview": lambda g: breakdowns.kpi_overview(g.clean),
    "kpi_overview_filtered": lambda g: breakdowns.kpi_overview(g.clean, SELECTED),
    "by_year": lambda g: breakdowns.by_year(g.clean, SELECTED),
    "by_work_type_top8": lambda g: breakdowns.by_work_type(g.clean),
    "by_cost_category": lambda g: breakdowns.by_cost_category(g.clean, SELECTED),
    "by_region": lambda g: breakdowns.by_region(g.clean),
    "by_region_export": lambda g: breakdowns.by_region(g.clean, BY_YEAR, "total_cost"),
    "by_province_drill_down": lambda g: breakdowns.by_province(g.clean, BY_YEAR, "EUROPE"),
    "by_contractor_top25": lambda g: breakdowns.by_contractor(g.clean),
    "by_contractor_export": lambda g: breakdowns.by_contractor(g.clean, SELECTED, 100),
    "share_of_total": lambda g: breakdowns.share_of_total(
        breakdowns.by_region(g.clean), "projects"
    ),
    "facet_region": lambda g: breakdowns.facets(g.clean)["region"],
    "facet_year": lambda g: breakdowns.facets(g.clean)["infra_year"],
    "facet_work_type": lambda g: breakdowns.facets(g.clean)["type_of_work"],
    "facet_cost_category": lambda g: breakdowns.facets(g.clean)["cost_category"],
    "project_explorer": _project_explorer,
    "explorer_cells": _explorer_cells,
    "top_k": lambda g: ordering.top_k(
        summaries.contractor_totals(g.clean), "total_contract_value", 20, ["contractor"]
    ),
    "top_rows": lambda g: ordering.top_rows(
        g.clean.select("global_id", "cost_variance"),
        [F.col("cost_variance").desc_nulls_last(), F.col("global_id").asc_nulls_last()],
        20,
    ),
    "sort_table_desc": _sort_table,
    "paginate_page3": _paginate,
    "paginate_deep": lambda g: _paginate(g, deep_from=0),
    "page_count": lambda g: ordering.page_count(g.clean),
    "year_series": lambda g: breakdowns.year_series(g.clean),
    "share_of_work_type": lambda g: breakdowns.work_type_shares(g.clean),
    "share_of_cost_category": lambda g: breakdowns.cost_category_shares(g.clean),
    "region_bars": lambda g: breakdowns.region_bars(g.clean),
    "province_bars": lambda g: breakdowns.province_bars(g.clean, None, "AFRICA"),
    "contractor_bars": lambda g: breakdowns.contractor_bars(g.clean),
    # the same questions to the cube
    "cube_kpi_overview": lambda g: breakdowns.kpi_overview(g.cube),
    "cube_kpi_overview_filtered": lambda g: breakdowns.kpi_overview(g.cube, SELECTED),
    "cube_by_year": lambda g: breakdowns.by_year(g.cube, SELECTED),
    "cube_by_work_type_top8": lambda g: breakdowns.by_work_type(g.cube),
    "cube_by_cost_category": lambda g: breakdowns.by_cost_category(g.cube, SELECTED),
    "cube_by_region": lambda g: breakdowns.by_region(g.cube),
    "cube_by_province_drill_down": lambda g: breakdowns.by_province(g.cube, BY_YEAR, "EUROPE"),
    "cube_by_contractor_top25": lambda g: breakdowns.by_contractor(g.cube),
    "cube_facet_work_type": lambda g: breakdowns.facets(g.cube)["type_of_work"],
    "cube_year_series": lambda g: breakdowns.year_series(g.cube),
    # quality
    "quality_checks_core": _checks,
    "quality_report": lambda g: quality.quality_report(_checks(g)),
    # jobs
    "ingest_job": lambda g: _ingested(g).profile["nulls"],
    "ingest_job_regions": lambda g: _ingested(g).profile["regions"],
    "ingest_job_numbers": lambda g: _ingested(g).profile["numbers"],
    "transform_job": lambda g: _transformed(g).summaries[C.YEAR_FILE],
    "transform_job_clean": lambda g: _transformed(g).clean,
    "transform_job_regions": lambda g: _transformed(g).summaries[C.REGION_FILE],
    "transform_job_work_types": lambda g: _transformed(g).summaries[C.WORK_TYPE_FILE],
    "transform_job_contractors": lambda g: _transformed(g).summaries[C.CONTRACTOR_FILE],
    "transform_job_cost_categories": lambda g: _transformed(g).profile["cost_categories"],
    "transform_job_completeness": lambda g: _transformed(g).profile["completeness"],
    "export_job": lambda g: _exported(g)[C.CONTRACTOR_FILE],
    "export_job_clean": lambda g: _exported(g)[C.CLEAN_FILE],
    "export_job_regions": lambda g: _exported(g)[C.REGION_FILE],
    "export_job_years": lambda g: _exported(g)[C.YEAR_FILE],
    "verify_job": _verify,
    "publish_report": _publish,
}


def _bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(given(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(query) for name, query in _QUERIES.items()}
