"""Data-quality checks.

A check on the clean table is an aggregate plus a verdict over it. ``run_checks``
puts the aggregates of any number of checks into one pass over the table. All
checks return rows of (check_group, check_name, passed, detail).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from worksledger import constants as C
from worksledger.functions import percent
from worksledger.operators.dedup import duplicate_keys
from worksledger.operators.profiling import row_count


class QualityError(RuntimeError):
    """Raised by ``enforce`` when a check failed."""


@dataclass(frozen=True)
class Thresholds:
    """What the checks expect of a dataset."""

    row_bounds: tuple[int, int] = C.ROW_COUNT_RANGE
    zero_null_columns: Sequence[str] = C.ZERO_NULL_COLUMNS
    required_columns: Sequence[str] = C.REQUIRED_COLUMNS
    year_bounds: tuple[int, int] = C.YEAR_RANGE
    out_of_bounds_pct: float = C.MAX_OUT_OF_BOUNDS_PCT
    ratio_bounds: tuple[float, float] = C.RATIO_RANGE
    extreme_ratio_pct: float = C.MAX_EXTREME_RATIO_PCT
    region_bounds: tuple[int, int] = C.REGION_COUNT_RANGE
    over_budget_factor: float = C.OVER_BUDGET_FACTOR
    over_budget_pct: float = C.MAX_OVER_BUDGET_PCT
    min_output_bytes: int = C.MIN_OUTPUT_BYTES


@dataclass(frozen=True)
class Check:
    group: str
    name: str
    passed: Column
    detail: Column
    metrics: Mapping[str, Column] = field(default_factory=dict)


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate checks in a single aggregation of ``df``."""
    metrics: dict[str, Column] = {}
    for check in checks:
        metrics.update(check.metrics)
    if not metrics:  # decided without looking at the rows
        return _verdicts(df.sparkSession.range(1), checks)
    return _verdicts(df.agg(*[m.alias(name) for name, m in metrics.items()]), checks)


def _verdicts(one_row: DataFrame, checks: Sequence[Check]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(c.group).alias("check_group"),
            F.lit(c.name).alias("check_name"),
            F.coalesce(c.passed, F.lit(False)).alias("passed"),
            c.detail.alias("detail"),
        )
        for c in checks
    ]
    return one_row.select(F.inline(F.array(*rows)))


def _says(template: str, *names: str) -> Column:
    return F.format_string(template, *[F.col(n) for n in names])


# --- completeness -------------------------------------------------------------


def row_count_range(bounds: tuple[int, int] = C.ROW_COUNT_RANGE) -> Check:
    return Check(
        "completeness",
        "row_count_range",
        F.col("rows").between(*bounds),
        _says("rows: %d", "rows"),
        {"rows": F.count("*")},
    )


def zero_nulls(cols: Sequence[str] = C.ZERO_NULL_COLUMNS) -> list[Check]:
    """No NULL in the columns; an empty table has none."""
    return [
        Check(
            "completeness",
            f"zero_nulls:{c}",
            F.col(f"null_{c}") == 0,
            _says("nulls: %d", f"null_{c}"),
            {f"null_{c}": F.count_if(F.col(c).isNull())},
        )
        for c in cols
    ]


def required_columns(clean: DataFrame, cols: Sequence[str] = C.REQUIRED_COLUMNS) -> list[Check]:
    """Decided from the schema alone."""
    present = set(clean.columns)
    return [
        Check("completeness", f"required_column:{c}", F.lit(c in present), F.lit(""))
        for c in cols
    ]


# --- accuracy -----------------------------------------------------------------


def no_negative_costs() -> Check:
    negative = (F.col("contract_cost") < 0) | (F.col("approved_budget") < 0)
    return Check(
        "accuracy",
        "no_negative_costs",
        F.col("negative_costs") == 0,
        _says("negative: %d", "negative_costs"),
        {"negative_costs": F.count_if(negative)},
    )


def year_range(bounds: tuple[int, int] = C.YEAR_RANGE) -> Check:
    """Fails as well when no project has a year."""
    return Check(
        "accuracy",
        "year_range",
        (F.col("min_year") >= bounds[0]) & (F.col("max_year") <= bounds[1]),
        _says("years: %s-%s", "min_year", "max_year"),
        {"min_year": F.min("infra_year"), "max_year": F.max("infra_year")},
    )


def _share_check(
    group: str, name: str, base: Column, bad: Column, limit_pct: float
) -> Check:
    """Share of bad rows, rounded to two decimals before it meets the limit."""
    part, whole = f"{name}_bad", f"{name}_all"
    pct = F.coalesce(percent(part, whole, 2), F.lit(0.0))
    return Check(
        group,
        name,
        pct < limit_pct,
        F.format_string("%d of %d (%.2f%%)", F.col(part), F.col(whole), pct),
        {part: F.count_if(base & bad), whole: F.count_if(base)},
    )


def coords_out_of_bounds(limit_pct: float = C.MAX_OUT_OF_BOUNDS_PCT) -> Check:
    located = F.col("longitude").isNotNull() & F.col("latitude").isNotNull()
    outside = ~F.col("is_valid_coordinates")
    return _share_check("accuracy", "coords_out_of_bounds", located, outside, limit_pct)


def extreme_ratio(
    bounds: tuple[float, float] = C.RATIO_RANGE, limit_pct: float = C.MAX_EXTREME_RATIO_PCT
) -> Check:
    ratio = F.col("cost_efficiency_ratio")
    return _share_check(
        "accuracy", "extreme_ratio", ratio.isNotNull(), ~ratio.between(*bounds), limit_pct
    )


# --- consistency --------------------------------------------------------------


def distinct_regions(bounds: tuple[int, int] = C.REGION_COUNT_RANGE) -> Check:
    return Check(
        "consistency",
        "distinct_regions",
        F.col("regions").between(*bounds),
        _says("regions: %d", "regions"),
        {"regions": F.count_distinct("region")},
    )


def over_budget(
    factor: float = C.OVER_BUDGET_FACTOR, limit_pct: float = C.MAX_OVER_BUDGET_PCT
) -> Check:
    budget = F.col("approved_budget")
    return _share_check(
        "consistency", "over_budget", budget > 0, F.col("contract_cost") > budget * factor, limit_pct
    )


def no_duplicate_keys(clean: DataFrame, key: str = "project_component_id") -> DataFrame:
    """On the stripped key, so it can fire although edits were merged before."""
    repeated = duplicate_keys(clean, key).agg(F.count("*").alias("repeated"))
    check = Check(
        "consistency",
        "no_duplicate_keys",
        F.col("repeated") == 0,
        _says("duplicated keys: %d", "repeated"),
    )
    return _verdicts(repeated, [check])


# --- written files ------------------------------------------------------------


def file_sizes(spark: SparkSession, path: str) -> DataFrame | None:
    """Lengths of the files below a path, from the listing; None without a file."""
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(path)
            .select("length")
        )
        return None if files.isEmpty() else files
    except AnalysisException:  # no such path
        return None


def outputs_exist(spark: SparkSession, out_dir: str, names: Sequence[str]) -> DataFrame:
    checks = [
        Check(
            "files",
            f"output_exists:{n}",
            F.lit(file_sizes(spark, f"{out_dir}/{n}") is not None),
            F.lit(""),
        )
        for n in names
    ]
    return _verdicts(spark.range(1), checks)


def min_output_size(
    spark: SparkSession, path: str, min_bytes: int = C.MIN_OUTPUT_BYTES
) -> DataFrame | None:
    """None, so no check at all, when the dataset is absent."""
    files = file_sizes(spark, path)
    if files is None:
        return None
    check = Check(
        "files",
        "min_output_size",
        F.col("bytes") > min_bytes,
        _says("bytes: %d", "bytes"),
        {"bytes": F.sum("length")},
    )
    return run_checks(files, [check])


def first_line(error: Exception) -> str:
    """An error's type, and the first line of its text if it has any."""
    text = str(error).strip().splitlines()
    return f"{type(error).__name__}: {text[0]}" if text else type(error).__name__


def round_trip(spark: SparkSession, path: str, rows: int) -> DataFrame:
    """Rows read back equal rows written; an unreadable dataset fails."""
    try:
        read = spark.read.parquet(path).count()
        passed, detail = read == rows, f"read: {read}, written: {rows}"
    except Exception as error:  # any read error is the finding
        passed, detail = False, first_line(error)
    check = Check("files", "round_trip", F.lit(passed), F.lit(detail))
    return _verdicts(spark.range(1), [check])


# --- across tables ------------------------------------------------------------


def _same(name: str, measured: DataFrame, expected: DataFrame) -> DataFrame:
    """Compare two one-value tables."""
    both = measured.toDF("measured").withColumn("expected", expected.scalar())
    check = Check(
        "cross_table",
        name,
        F.col("measured") == F.col("expected"),
        _says("summary: %d, table: %d", "measured", "expected"),
    )
    return _verdicts(both, [check])


def summary_total_matches(clean: DataFrame, region_summary: DataFrame) -> DataFrame:
    return _same(
        "summary_total_matches", region_summary.agg(F.sum("total_projects")), row_count(clean)
    )


def summary_years_complete(clean: DataFrame, year_summary: DataFrame) -> DataFrame:
    return _same(
        "summary_years_complete", row_count(year_summary), clean.agg(F.count_distinct("infra_year"))
    )


# --- together -----------------------------------------------------------------


def table_checks(clean: DataFrame, expected: Thresholds = Thresholds()) -> DataFrame:
    """All checks on the clean table: one fused pass, one grouping by key."""
    fused = run_checks(
        clean,
        [
            row_count_range(expected.row_bounds),
            *zero_nulls(expected.zero_null_columns),
            *required_columns(clean, expected.required_columns),
            no_negative_costs(),
            year_range(expected.year_bounds),
            coords_out_of_bounds(expected.out_of_bounds_pct),
            extreme_ratio(expected.ratio_bounds, expected.extreme_ratio_pct),
            distinct_regions(expected.region_bounds),
            over_budget(expected.over_budget_factor, expected.over_budget_pct),
        ],
    )
    return fused.unionByName(no_duplicate_keys(clean))


def quality_report(checks: DataFrame) -> DataFrame:
    """Totals, score in per cent and the names of the failed checks."""
    failed_name = F.when(~F.col("passed"), F.col("check_name"))
    return checks.agg(
        F.count("*").alias("total"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.array_join(F.array_sort(F.collect_list(failed_name)), ", ").alias("failures"),
    ).withColumn("score", percent("passed", "total", 1))


def enforce(checks: DataFrame) -> None:
    """Raise when any check failed."""
    report = quality_report(checks).first()
    if report["failed"]:
        raise QualityError(f"{report['failed']} of {report['total']} failed: {report['failures']}")
