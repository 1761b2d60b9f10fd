"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder with the given tables (default /root/testdata/sf0.1)
BENCH_CPUS    local task slots (default 8)

The ``land_`` entries write the derived tables the way the jobs do (and the records
as GeoJSON); the other queries read those, once each, to the last row and column.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from parity.queries import queries  # noqa: E402
from parity.tables import given  # noqa: E402
from worksledger import session  # noqa: E402

HEADLINE = [
    "dedup_latest",
    "clean_projects",
    "null_profile",
    "value_distribution",
    "numeric_profile",
    "duplicate_profile",
    "completeness",
    "summary_by_region",
    "summary_by_work_type",
    "summary_by_year",
    "summary_top_contractors",
    "kpi_overview",
    "kpi_overview_filtered",
    "by_year",
    "by_work_type_top8",
    "by_cost_category",
    "by_region",
    "by_province_drill_down",
    "by_contractor_top25",
    "facet_work_type",
    "cube_kpi_overview_filtered",
    "cube_by_province_drill_down",
    "cube_by_contractor_top25",
    "search_projects",
    "project_explorer",
    "sort_table_desc",
    "paginate_page3",
    "paginate_deep",
    "quality_checks_core",
    "export_csv_roundtrip",
    "read_geojson",
    "read_geojson_splits",
    "publish_report",
]


def timed(work: Callable[[], object]) -> float:
    started = time.perf_counter()
    work()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        session.builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = given(spark, sf_dir)
    seconds = {"land_raw": timed(lambda: tables.raw), "land_clean": timed(lambda: tables.clean)}
    seconds["land_summaries"] = timed(lambda: tables.summaries)
    seconds["land_features"] = timed(lambda: tables.features)
    seconds["land_collections"] = timed(lambda: tables.collections)
    seconds["land_cube"] = timed(lambda: tables.cube)
    every = queries()
    for name in HEADLINE:
        seconds[name] = timed(
            lambda name=name: every[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
