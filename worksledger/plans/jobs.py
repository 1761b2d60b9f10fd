"""The batch jobs: ingest, transform, export, verify, and all four in order."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worksledger import constants as C
from worksledger.operators import profiling, quality, summaries
from worksledger.operators.cleaning import KEY, CleaningRules, clean_parts, clean_projects
from worksledger.operators.cube import cube
from worksledger.operators.quality import Thresholds
from worksledger.schemas import RAW_SCHEMA
from worksledger.session import parts_for, sized_for, stored_bytes
from worksledger.sinks import dataset_sizes, export_parquet, manifest, materialise, materialise_parts, write_manifest
from worksledger.sinks.tables import Landed
from worksledger.sources import describe_schema, read_geojson

# Neighbouring rows share these, which is what the interactive filters test.
CLUSTER_BY = ("region", "infra_year", "type_of_work")
CUBE_FILE = "cube.parquet"
SIZES_FILE = "sizes.json"

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("run_dir", T.StringType()),
        T.StructField("promoted", T.BooleanType()),
        T.StructField("rows", T.LongType()),
        T.StructField("checks_total", T.LongType()),
        T.StructField("checks_passed", T.LongType()),
        T.StructField("checks_failed", T.LongType()),
        T.StructField("failures", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("duration_sec", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Ingested:
    raw: DataFrame
    rows: int
    profile: dict[str, DataFrame]


@dataclass(frozen=True)
class Transformed:
    clean: DataFrame
    rows: int | None
    summaries: dict[str, DataFrame]
    profile: dict[str, DataFrame]


def ingest(
    spark: SparkSession,
    src: str,
    out: str,
    schema: T.StructType | str = RAW_SCHEMA,
    layout: str = "collection",
) -> Ingested:
    """Land the source as Parquet at ``out``; profiles are lazy tables."""
    with sized_for(spark, _bytes_below(spark, src)):
        raw, rows = materialise(read_geojson(spark, src, schema, layout), out)
    return Ingested(raw, rows, raw_profile(raw))


def raw_profile(raw: DataFrame) -> dict[str, DataFrame]:
    return {
        "schema": describe_schema(raw),
        "row_count": profiling.row_count(raw),
        "nulls": profiling.null_profile(raw),
        "regions": profiling.value_distribution(raw, "Region"),
        "numbers": profiling.numeric_profile(raw),
    }


def transform(
    raw: DataFrame,
    land_at: str | None = None,
    rules: CleaningRules = CleaningRules(),
    attributes: Mapping[str, Column] | None = None,
) -> Transformed:
    """Clean table, summaries and profiles.

    ``attributes`` are the raw attributes as expressions over the columns of ``raw``,
    where those have other names (see ``clean_projects``).

    With ``land_at`` the clean table is written there first and everything else
    reads the columns it needs from Parquet; without, all stay one lazy plan each. A
    large table is cleaned and written in parts, by key.
    """
    if land_at:
        clean, rows = land_clean(raw, land_at, rules, attributes)
    else:
        clean, rows = clean_projects(raw, rules, attributes), None
    records = raw.select(*[e.alias(n) for n, e in attributes.items()]) if attributes else raw
    return Transformed(clean, rows, summary_tables(clean), clean_profile(records, clean))


def land_clean(
    raw: DataFrame,
    path: str,
    rules: CleaningRules = CleaningRules(),
    attributes: Mapping[str, Column] | None = None,
) -> Landed:
    """The clean table written at ``path``."""
    size = stored_bytes(raw)
    n = parts_for(size)
    with sized_for(raw.sparkSession, size // n, sorts=True):
        return materialise_parts(clean_parts(raw, n, rules, attributes), path, CLUSTER_BY)


def summary_tables(clean: DataFrame) -> dict[str, DataFrame]:
    return {
        C.REGION_FILE: summaries.summary_by_region(clean),
        C.WORK_TYPE_FILE: summaries.summary_by_work_type(clean),
        C.YEAR_FILE: summaries.summary_by_year(clean),
        C.CONTRACTOR_FILE: summaries.summary_top_contractors(clean),
    }


def clean_profile(raw: DataFrame, clean: DataFrame) -> dict[str, DataFrame]:
    return {
        "duplicates": profiling.duplicate_profile(raw, KEY),
        "rows_removed": profiling.rows_removed(raw, clean),
        "cost_categories": profiling.cost_category_distribution(clean),
        "years": profiling.year_distribution(clean),
        "completeness": profiling.completeness(clean),
    }


def export(
    tables: Mapping[str, DataFrame], out_dir: str, source: str, source_path: str | None = None
) -> dict[str, DataFrame]:
    """Write the tables, the manifest and the sizes of both; returns the tables read back."""
    spark = next(iter(tables.values())).sparkSession
    with sized_for(spark, sum(map(stored_bytes, tables.values()))):
        written = export_parquet(tables, out_dir)
    write_manifest(manifest(written, source), f"{out_dir.rstrip('/')}/{C.MANIFEST_FILE}")
    _write_sizes(spark, written, out_dir, source_path)
    return written


def _write_sizes(spark: SparkSession, names: Iterable[str], out_dir: str, source_path: str | None) -> None:
    base = out_dir.rstrip("/")
    sizes = dataset_sizes(spark, {name: f"{base}/{name}" for name in names}, source_path)
    sizes.coalesce(1).write.mode("overwrite").json(f"{base}/{SIZES_FILE}")  # a row per table


def verify(
    clean: DataFrame,
    summaries_by_file: Mapping[str, DataFrame],
    out_dir: str,
    rows: int | None = None,
    expected: Thresholds = Thresholds(),
) -> DataFrame:
    """All checks: 30 rows, 29 when the main dataset is missing.

    ``rows`` is the number of rows written, as counted while writing; without it
    the clean table is counted.
    """
    spark = clean.sparkSession
    base = out_dir.rstrip("/")
    main = f"{base}/{C.CLEAN_FILE}"
    counted = clean.count() if rows is None else rows
    parts = [
        quality.table_checks(clean, expected),
        quality.outputs_exist(spark, base, [*C.VIEWS.values(), C.MANIFEST_FILE]),
        quality.min_output_size(spark, main, expected.min_output_bytes),
        quality.round_trip(spark, main, counted),
        quality.summary_total_matches(clean, summaries_by_file[C.REGION_FILE]),
        quality.summary_years_complete(clean, summaries_by_file[C.YEAR_FILE]),
    ]
    return reduce(DataFrame.unionByName, [p for p in parts if p is not None])


def publish(
    spark: SparkSession,
    src: str,
    out: str,
    source: str = "",
    schema: T.StructType | str = RAW_SCHEMA,
    layout: str = "collection",
    rules: CleaningRules = CleaningRules(),
    expected: Thresholds = Thresholds(),
    promote: str = "on_pass",
) -> DataFrame:
    """Run the four stages; returns a one-row report and never raises.

    Every run writes to a folder of its own below ``out/runs``. Promotion appends
    a line to ``out/promoted`` naming that folder (see ``published_dir``): nothing
    is copied or replaced, readers keep the previous run until the line is there,
    and a run that dies half-way is never seen. ``promote="always"`` publishes
    whatever the checks say, ``"on_pass"`` only a run without a failed check.
    """
    if promote not in ("always", "on_pass"):
        raise ValueError(f"promote must be 'always' or 'on_pass', not {promote!r}")
    started = time.time()
    base = out.rstrip("/")
    run_dir = f"{base}/runs/{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"
    values: dict[str, object] = {"run_dir": run_dir, "promoted": False}
    try:
        with sized_for(spark, _bytes_below(spark, src)):
            landed = ingest(spark, src, f"{run_dir}/raw", schema, layout)
            result = transform(landed.raw, f"{run_dir}/{C.CLEAN_FILE}", rules)
            written = export_parquet(result.summaries, run_dir)
            with sized_for(spark, stored_bytes(result.clean), sorts=True):
                materialise(cube(result.clean), f"{run_dir}/{CUBE_FILE}", CLUSTER_BY)
            export_parquet(landed.profile | result.profile, f"{run_dir}/profile")
            tables = {C.CLEAN_FILE: result.clean, **written}
            write_manifest(manifest(tables, source), f"{run_dir}/{C.MANIFEST_FILE}")
            _write_sizes(spark, tables, run_dir, src)
            checks = materialise(
                verify(result.clean, written, run_dir, result.rows, expected), f"{run_dir}/checks"
            ).table
            report = quality.quality_report(checks).first()
        passed = report["failed"] == 0
        values |= {
            "status": "SUCCESS" if passed else "FAILED",
            "rows": result.rows,
            "checks_total": report["total"],
            "checks_passed": report["passed"],
            "checks_failed": report["failed"],
            "failures": report["failures"],
            "score": report["score"],
        }
        if passed or promote == "always":
            _promote(spark, base, run_dir)
            values["promoted"] = True
    except Exception as error:  # a failed stage is a failed run, reported as such
        values |= {"status": "FAILED", "error": quality.first_line(error)}
    values["duration_sec"] = round(time.time() - started, 1)
    row = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in REPORT_SCHEMA]
    return spark.range(1).select(*row)


def _bytes_below(spark: SparkSession, path: str) -> int:
    files = quality.file_sizes(spark, path)
    return files.agg(F.sum("length")).first()[0] if files is not None else 0


def _promote(spark: SparkSession, base: str, run_dir: str) -> None:
    line = spark.range(1).select(
        F.lit(run_dir).alias("run_dir"), F.current_timestamp().alias("promoted_at")
    )
    line.write.mode("append").parquet(f"{base}/promoted")


def published_dir(spark: SparkSession, out: str) -> str:
    """The folder of the run promoted last, to hand to ``register_views``."""
    lines = spark.read.parquet(f"{out.rstrip('/')}/promoted")
    return lines.agg(F.max_by("run_dir", "promoted_at")).first()[0]
