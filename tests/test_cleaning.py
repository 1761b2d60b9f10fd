from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import BASE, column, plan_text
from worksledger.operators import cleaning, dedup
from worksledger.schemas import CLEAN_SCHEMA, RAW_SCHEMA


def test_clean_schema(raw_rows):
    clean = cleaning.clean_projects(raw_rows({}))
    assert [(f.name, f.dataType) for f in clean.schema.fields] == [
        (f.name, f.dataType) for f in CLEAN_SCHEMA.fields
    ]
    assert len(clean.columns) == 34


def test_newest_edit_wins_and_missing_date_is_oldest(raw_rows):
    raw = raw_rows(
        {"EditDate": "2024-01-01", "GlobalID": "old"},
        {"EditDate": "2024-02-01", "GlobalID": "new"},
        {"EditDate": None, "GlobalID": "undated"},
    )
    assert column(cleaning.clean_projects(raw), "global_id") == ["new"]


def test_newest_edit_without_region_drops_the_project(raw_rows):
    raw = raw_rows({"EditDate": "2024-01-01"}, {"EditDate": "2024-02-01", "Region": None})
    assert cleaning.clean_projects(raw).count() == 0


def test_keys_are_compared_as_stored(raw_rows):
    raw = raw_rows(
        {"ProjectComponentID": "A1", "GlobalID": "a"}, {"ProjectComponentID": "A1 ", "GlobalID": "b"}
    )
    assert column(cleaning.clean_projects(raw), "project_component_id") == ["A1", "A1"]
    assert cleaning.clean_projects(raw, cleaning.CleaningRules(normalise_key=True)).count() == 1


def test_blank_region_is_kept_and_missing_key_is_not(raw_rows):
    raw = raw_rows({"Region": ""}, {"ProjectComponentID": None, "GlobalID": "x"})
    assert column(cleaning.clean_projects(raw), "region") == [""]


def test_ties_do_not_depend_on_partitioning(raw_rows):
    raw = raw_rows(*[{"GlobalID": f"G{i:02d}", "ContractCost": float(i)} for i in range(40)])
    for parts in (1, 3, 8):
        assert column(cleaning.clean_projects(raw.repartition(parts)), "global_id") == ["G00"]


def test_derived_columns(raw_rows):
    row = cleaning.clean_projects(
        raw_rows(
            {"ContractCost": None, "ABC": 5.0, "StartDate": "2021/03/05", "Contractor": "  ",
             "CompletionDateActual": "2021-03-01T10:00:00Z", "Province": " Upper",
             "InfraYear": 2020.7}
        )
    ).first()
    assert row.cost_variance == -5.0 and row.contract_cost == 0.0
    assert row.cost_efficiency_ratio is None and row.cost_category == "Unknown"
    assert row.duration_days == -4 and row.infra_year == 2021
    assert row.province == "Upper" and row.contractor == ""
    flags = (row.has_cost_data, row.has_contractor, row.has_start_date, row.has_completion_date)
    assert flags == (False, False, True, True)


def test_rules_can_be_changed(raw_rows):
    rules = cleaning.CleaningRules(
        cost_classes=((10.0, "low"),), cost_class_above="high", lat_range=(50, 60), lon_range=(0, 9)
    )
    row = cleaning.clean_projects(raw_rows({"Latitude": 55.0, "Longitude": 5.0}), rules).first()
    assert (row.cost_category, row.is_valid_coordinates) == ("high", True)


def test_quality_flags_agree_with_the_clean_table(raw_rows):
    raw = raw_rows({}, {"ProjectComponentID": "C2", "ContractCost": -1.0, "StartDate": "n/a"})
    names = ["has_cost_data", "has_contractor", "has_start_date", "has_completion_date"]
    flagged = sorted(map(tuple, cleaning.quality_flags(raw).select(*names).collect()))
    assert flagged == sorted(map(tuple, cleaning.clean_projects(raw).select(*names).collect()))


def test_duplicate_keys(raw_rows):
    raw = raw_rows({}, {}, {"ProjectComponentID": "C2"})
    rows = dedup.duplicate_keys(raw, "ProjectComponentID").collect()
    assert [tuple(r) for r in rows] == [("C1", 2)]


def test_plan_ranks_before_the_shuffle_and_stays_in_the_jvm(spark, raw_rows, tmp_path):
    path = str(tmp_path / "raw")
    raw_rows({}).write.parquet(path)
    plan = plan_text(cleaning.clean_projects(spark.read.parquet(path)))
    assert "Partial" in plan.split("Exchange hashpartitioning", 1)[1]
    assert plan.count("Exchange") == 1
    assert "IsNotNull(ProjectComponentID)" in plan and "IsNotNull(Region)" not in plan
    assert "Python" not in plan


@pytest.mark.parametrize("hot_share", [0.34, 0.9])
def test_a_dominating_key_is_reduced_on_the_map_side(spark, hot_share):
    """One key with a third of all rows: every task forwards one row of it."""
    n = 6000
    hot = F.col("id") < int(n * hot_share)
    own = {
        "ProjectComponentID": F.when(hot, "hot").otherwise(F.concat(F.lit("c"), "id")),
        "GlobalID": F.format_string("G%06d", "id"),
        "EditDate": F.format_string("%06d", "id"),
    }
    raw = spark.range(0, n, 1, 8).select(
        *[
            own.get(f.name, F.lit(BASE.get(f.name))).cast(f.dataType).alias(f.name)
            for f in RAW_SCHEMA.fields
        ]
    )
    clean = cleaning.clean_projects(raw)
    assert clean.count() == n - int(n * hot_share) + 1
    newest = clean.filter("project_component_id = 'hot'").first()
    assert newest.global_id == f"G{int(n * hot_share) - 1:06d}"
