"""Profiles and summaries on a table small enough to work out by hand."""

from __future__ import annotations

import pytest

from tests.conftest import column
from worksledger.operators import profiling, summaries
from worksledger.operators.cleaning import KEY, clean_projects


@pytest.fixture(scope="module")
def raw(raw_rows):
    return raw_rows(
        {"ProjectComponentID": "C1", "ContractCost": 1e6, "ABC": 2e6},
        {"ProjectComponentID": "C2", "ContractCost": None, "ABC": 4e6, "Contractor": "Beta"},
        {"ProjectComponentID": "C3", "ContractCost": 3e6, "Region": "South", "TypeofWork": None},
        {"ProjectComponentID": "C4", "ContractCost": 2e6, "InfraYear": None, "Contractor": " "},
        {"ProjectComponentID": "C4", "ContractCost": 9e6, "EditDate": "2020-01-01"},
        {"ProjectComponentID": None, "Region": None, "Longitude": None},
    )


@pytest.fixture(scope="module")
def clean(raw):
    return clean_projects(raw)


def test_null_profile(raw):
    rows = {r.column: (r.nulls, r.pct) for r in profiling.null_profile(raw).collect()}
    assert rows["Region"] == (1, 16.7) and rows["Municipality"] == (6, 100.0)
    assert rows["Province"] == (0, 0.0) and len(rows) == 9


def test_value_distribution_counts_missing_in_the_total(raw):
    rows = [tuple(r) for r in profiling.value_distribution(raw, "Region").collect()]
    assert rows == [("North", 4, 66.7), ("South", 1, 16.7)]
    assert profiling.value_distribution(raw, "Region", k=1).count() == 1


def test_numeric_profile_average_skips_missing_costs(raw):
    row = profiling.numeric_profile(raw).first()
    assert (row.min_year, row.max_year) == (2020, 2020)
    assert (row.min_cost, row.max_cost, row.avg_cost) == (1e6, 9e6, 3.2e6)
    assert (row.min_budget, row.max_budget) == (2e6, 4e6)


def test_duplicates_include_missing_keys(raw):
    assert tuple(profiling.duplicate_profile(raw, KEY).first()) == (6, 4, 2)


def test_rows_removed(raw, clean):
    assert tuple(profiling.rows_removed(raw, clean).first()) == (6, 4, 2)


def test_clean_profiles(clean):
    years = [tuple(r) for r in profiling.year_distribution(clean).collect()]
    assert years == [(2020, 3, 0.0)]
    assert sum(column(profiling.cost_category_distribution(clean), "projects")) == 4
    flags = {r.flag: (r.rows, r.pct) for r in profiling.completeness(clean).collect()}
    assert flags["has_cost_data"] == (3, 75.0) and flags["has_contractor"] == (3, 75.0)
    assert flags["is_valid_coordinates"] == (4, 100.0) and len(flags) == 5


def test_region_summary_counts_missing_cost_as_zero(clean):
    rows = {r.region: r for r in summaries.summary_by_region(clean).collect()}
    north = rows["North"]
    assert (north.total_projects, north.unique_contractors) == (3, 3)
    assert (north.total_contract_cost, north.avg_contract_cost) == (3e6, 1e6)
    assert north.total_approved_budget == 8e6
    assert (north.earliest_year, north.latest_year) == (2020, 2020)


def test_work_type_summary_keeps_a_group_without_type(clean):
    rows = {r.type_of_work: r for r in summaries.summary_by_work_type(clean).collect()}
    assert set(rows) == {"Dike", None}
    assert rows["Dike"].avg_efficiency == 0.75 and rows[None].avg_efficiency == 1.5


def test_year_summary(clean):
    (row,) = summaries.summary_by_year(clean).collect()
    assert (row.infra_year, row.total_projects, row.regions_covered) == (2020, 3, 2)
    assert (row.unique_contractors, row.total_cost, row.avg_cost) == (2, 4e6, 1333333.33)
    assert row.avg_duration_days == 60.0


def test_contractors_need_a_name(clean):
    rows = [tuple(r)[:3] for r in summaries.summary_top_contractors(clean).collect()]
    assert rows == [("Acme", 2, 2), ("Beta", 1, 1)]
    assert summaries.summary_top_contractors(clean, k=1).count() == 1


def test_summaries_of_nothing(clean):
    nothing = clean.filter("false")
    for table in (summaries.summary_by_region, summaries.summary_by_year):
        assert table(nothing).count() == 0
    assert profiling.null_profile(nothing, ["region"]).first().pct is None


def test_summary_counts_add_up_to_the_table(spark):
    from parity.tables import given
    from tests.conftest import SMALL

    clean = given(spark, SMALL).clean
    n = clean.count()
    for table in (summaries.summary_by_region, summaries.summary_by_work_type):
        assert sum(column(table(clean), "total_projects")) == n
    assert sum(column(profiling.cost_category_distribution(clean), "projects")) == n
