from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_text
from worksledger.operators import quality as q
from worksledger.operators.cleaning import clean_projects
from worksledger.operators.summaries import summary_by_region, summary_by_year
from worksledger.schemas import CLEAN_SCHEMA


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], CLEAN_SCHEMA)


def rows_like(spark, n, **columns):
    """n clean rows; unnamed columns are NULL."""
    return spark.range(n).select(
        *[
            columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in CLEAN_SCHEMA.fields
        ]
    )


def verdict(df, *checks):
    return {r.check_name: (r.passed, r.detail) for r in q.run_checks(df, checks).collect()}


def test_empty_table(empty):
    got = verdict(
        empty,
        q.row_count_range(),
        *q.zero_nulls(),
        q.year_range(),
        q.coords_out_of_bounds(),
        q.extreme_ratio(),
        q.over_budget(),
    )
    assert got["row_count_range"] == (False, "rows: 0")
    assert got["zero_nulls:region"] == (True, "nulls: 0")
    assert not got["year_range"][0]
    assert got["coords_out_of_bounds"] == (True, "0 of 0 (0.00%)")
    assert got["extreme_ratio"][0] and got["over_budget"][0]


def test_row_count_bounds_are_inclusive(spark):
    ten = rows_like(spark, 10)
    assert verdict(ten, q.row_count_range((10, 12)))["row_count_range"][0]
    assert verdict(ten, q.row_count_range((8, 10)))["row_count_range"][0]
    assert not verdict(ten, q.row_count_range((11, 12)))["row_count_range"][0]


def test_zero_nulls_finds_them(spark):
    df = rows_like(spark, 5, region=F.when(F.col("id") > 1, F.lit("N")))
    assert verdict(df, *q.zero_nulls(["region"]))["zero_nulls:region"] == (False, "nulls: 2")


def test_required_columns(empty):
    got = verdict(empty.drop("latitude"), *q.required_columns(empty.drop("latitude")))
    assert len(got) == 9
    assert not got["required_column:latitude"][0] and got["required_column:longitude"][0]


def test_all_years_missing_fails(spark):
    assert not verdict(rows_like(spark, 3), q.year_range())["year_range"][0]
    inside = rows_like(spark, 3, infra_year=F.lit(2015) + F.col("id"))
    assert verdict(inside, q.year_range())["year_range"] == (True, "years: 2015-2017")
    assert not verdict(inside, q.year_range((2016, 2026)))["year_range"][0]


def test_share_is_rounded_before_it_meets_the_limit(spark):
    """4.996 % becomes 5.00 % and fails; 4.99 % passes."""
    bad = F.col("id") < 1249
    df = rows_like(
        spark, 25_000, longitude=F.lit(1), latitude=F.lit(1), is_valid_coordinates=~bad
    )
    assert verdict(df, q.coords_out_of_bounds())["coords_out_of_bounds"] == (
        False, "1249 of 25000 (5.00%)"
    )
    fewer = df.withColumn("is_valid_coordinates", F.lit(True)).limit(10)
    assert verdict(fewer, q.coords_out_of_bounds())["coords_out_of_bounds"][0]


def test_missing_coordinates_do_not_count(spark):
    df = rows_like(spark, 4, longitude=F.lit(1), is_valid_coordinates=F.lit(False))
    assert verdict(df, q.coords_out_of_bounds())["coords_out_of_bounds"] == (True, "0 of 0 (0.00%)")


def test_ratio_and_budget(spark):
    df = rows_like(
        spark,
        4,
        cost_efficiency_ratio=F.when(F.col("id") == 0, 2.01)
        .when(F.col("id") == 1, 2.0)
        .when(F.col("id") == 2, 0.1),
        contract_cost=F.lit(3.0),
        approved_budget=F.when(F.col("id") == 0, 1.9).when(F.col("id") == 1, 2.0).otherwise(0.0),
    )
    got = verdict(df, q.extreme_ratio(), q.over_budget(), q.no_negative_costs())
    assert got["extreme_ratio"] == (False, "1 of 3 (33.33%)")
    assert got["over_budget"] == (False, "1 of 2 (50.00%)")
    assert got["no_negative_costs"][0]
    negative = df.withColumn("approved_budget", F.lit(-1.0))
    assert verdict(negative, q.no_negative_costs())["no_negative_costs"] == (False, "negative: 4")


def test_duplicates_are_found_on_the_stripped_key(raw_rows):
    clean = clean_projects(
        raw_rows({"ProjectComponentID": "A1"}, {"ProjectComponentID": "A1 ", "GlobalID": "b"})
    )
    row = q.no_duplicate_keys(clean).first()
    assert (row.passed, row.detail) == (False, "duplicated keys: 1")


def test_regions(spark):
    df = rows_like(spark, 9, region=(F.col("id") % 6).cast("string"))
    assert verdict(df, q.distinct_regions())["distinct_regions"] == (True, "regions: 6")


def test_summaries_are_compared_with_the_table(raw_rows):
    clean = clean_projects(raw_rows({}, {"ProjectComponentID": "C2", "InfraYear": 2019.0}))
    assert q.summary_total_matches(clean, summary_by_region(clean)).first().passed
    assert q.summary_years_complete(clean, summary_by_year(clean)).first().passed
    short = summary_by_year(clean).filter("infra_year > 2019")
    row = q.summary_years_complete(clean, short).first()
    assert (row.passed, row.detail) == (False, "summary: 1, table: 2")
    assert not q.summary_total_matches(clean.limit(1), summary_by_region(clean)).first().passed


def test_file_checks(spark, tmp_path):
    out = str(tmp_path)
    spark.range(1000).write.parquet(f"{out}/there")
    got = {r.check_name: r.passed for r in q.outputs_exist(spark, out, ["there", "gone"]).collect()}
    assert got == {"output_exists:there": True, "output_exists:gone": False}
    assert q.min_output_size(spark, f"{out}/gone") is None
    assert not q.min_output_size(spark, f"{out}/there").first().passed
    assert q.min_output_size(spark, f"{out}/there", 10).first().passed
    assert q.round_trip(spark, f"{out}/there", 1000).first().passed
    assert q.round_trip(spark, f"{out}/there", 999).first().detail == "read: 1000, written: 999"
    assert not q.round_trip(spark, f"{out}/gone", 1).first().passed


def test_a_corrupt_file_is_a_failed_check(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"not parquet at all")
    assert not q.round_trip(spark, str(tmp_path / "bad"), 1).first().passed


def test_every_threshold_can_be_changed(raw_rows):
    clean = clean_projects(raw_rows({"ContractCost": 9e6}, {"ProjectComponentID": "C2"}))
    strict = q.table_checks(clean).filter("not passed").collect()
    assert {r.check_name for r in strict} == {
        "row_count_range", "extreme_ratio", "distinct_regions", "over_budget"
    }
    loose = q.Thresholds(
        row_bounds=(1, 5), extreme_ratio_pct=60.0, region_bounds=(1, 1), over_budget_factor=5.0
    )
    assert q.table_checks(clean, loose).filter("not passed").count() == 0


def test_report_and_enforce(spark):
    checks = spark.createDataFrame(
        [("g", "b", False, ""), ("g", "a", False, ""), ("g", "c", True, "")],
        "check_group string, check_name string, passed boolean, detail string",
    )
    row = q.quality_report(checks).first()
    assert (row.total, row.passed, row.failed, row.failures) == (3, 1, 2, "a, b")
    assert row.score == 33.3
    with pytest.raises(q.QualityError, match="2 of 3 failed: a, b"):
        q.enforce(checks)
    q.enforce(checks.filter("passed"))


def test_checks_on_the_table_share_one_pass(spark, tmp_path, raw_rows):
    path = str(tmp_path / "clean")
    clean_projects(raw_rows({})).write.parquet(path)
    plan = plan_text(q.table_checks(spark.read.parquet(path)))
    assert plan.count("FileScan parquet") == 2  # the fused checks and the grouping by key
    assert "Expand" not in plan
