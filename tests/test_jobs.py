from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import BASE
from worksledger import constants as C
from worksledger.__main__ import main
from worksledger.operators import breakdowns
from worksledger.operators.quality import QualityError, Thresholds, enforce
from worksledger.plans import jobs
from worksledger.session import shared_folder, sized_for
from worksledger.sources import register_views

LOOSE = Thresholds(row_bounds=(1, 10**9), region_bounds=(1, 20), min_output_bytes=1)


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """300 edits of 200 components as one feature per line."""
    own = {
        "ProjectComponentID": F.concat(F.lit("C"), F.col("id") % 200),
        "GlobalID": F.format_string("G%04d", "id"),
        "EditDate": F.format_string("2024-%04d", "id"),
        "Region": F.concat(F.lit(" R"), F.col("id") % 3),
    }
    values = {k: own.get(k, F.lit(v)) for k, v in BASE.items()}
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*[v.alias(k) for k, v in values.items()]).alias("properties"),
    )
    path = str(tmp_path_factory.mktemp("source") / "features")
    spark.range(300).select(F.to_json(feature)).write.text(path)
    return path


def test_all_stages(spark, source, tmp_path):
    out = str(tmp_path)
    report = jobs.publish(spark, source, out, "here", layout="lines", expected=LOOSE).first()
    assert (report.status, report.error) == ("SUCCESS", None)
    assert (report.rows, report.checks_total, report.checks_passed) == (200, 30, 30)
    assert report.promoted and report.score == 100.0
    run_dir = jobs.published_dir(spark, out)
    assert run_dir == report.run_dir
    register_views(spark, run_dir)
    assert spark.sql("SELECT count(*) AS n FROM flood_control").first().n == 200
    assert spark.read.parquet(f"{run_dir}/{C.REGION_FILE}").count() == 3
    assert spark.read.parquet(f"{run_dir}/profile/duplicates").first().duplicates == 100
    files = spark.read.json(f"{run_dir}/{C.MANIFEST_FILE}").select(F.inline("files")).collect()
    assert [f.rows for f in files] == [200, 3, 1, 1, 1]
    sizes = {r.name: r.bytes for r in spark.read.json(f"{run_dir}/{jobs.SIZES_FILE}").collect()}
    assert sizes.pop("total") == sum(sizes.values()) and set(sizes) == set(C.VIEWS.values())
    cube = spark.read.parquet(f"{run_dir}/{jobs.CUBE_FILE}")
    assert tuple(breakdowns.kpi_overview(cube).first()) == tuple(breakdowns.kpi_overview(spark.table("flood_control")).first())


def test_a_failed_check_keeps_the_previous_run(spark, source, tmp_path):
    out = str(tmp_path)
    first = jobs.publish(spark, source, out, layout="lines", expected=LOOSE).first()
    second = jobs.publish(spark, source, out, layout="lines").first()
    assert second.status == "FAILED" and not second.promoted and second.error is None
    assert second.failures == "distinct_regions, min_output_size, row_count_range"
    assert jobs.published_dir(spark, out) == first.run_dir
    with pytest.raises(QualityError):
        enforce(spark.read.parquet(f"{second.run_dir}/checks"))
    third = jobs.publish(spark, source, out, layout="lines", promote="always").first()
    assert third.status == "FAILED" and third.promoted
    assert jobs.published_dir(spark, out) == third.run_dir


def test_an_exception_is_reported(spark, tmp_path):
    report = jobs.publish(spark, str(tmp_path / "nowhere"), str(tmp_path / "out")).first()
    assert report.status == "FAILED" and report.error and not report.promoted
    assert report.checks_total is None


def test_promote_is_checked(spark):
    with pytest.raises(ValueError, match="promote"):
        jobs.publish(spark, "a", "b", promote="never")


def test_stages_run_on_their_own(spark, source, tmp_path):
    out = str(tmp_path)
    landed = jobs.ingest(spark, source, f"{out}/raw", layout="lines")
    assert landed.rows == 300 and landed.profile["row_count"].first().rows == 300
    assert landed.profile["schema"].count() == 27
    result = jobs.transform(landed.raw)
    assert result.rows is None
    written = jobs.export({C.CLEAN_FILE: result.clean, **result.summaries}, out, "here")
    checks = jobs.verify(written[C.CLEAN_FILE], written, out, expected=LOOSE)
    assert checks.count() == 30 and checks.filter("not passed").count() == 0
    again = jobs.export({C.CLEAN_FILE: result.clean, **result.summaries}, out, "here")
    assert again[C.CLEAN_FILE].count() == 200


def test_without_the_main_dataset_one_check_is_skipped(spark, source, tmp_path):
    out = str(tmp_path)
    raw = jobs.ingest(spark, source, f"{out}/raw", layout="lines").raw
    result = jobs.transform(raw)
    checks = jobs.verify(result.clean, result.summaries, f"{out}/empty", expected=LOOSE)
    assert checks.count() == 29
    assert {r.check_name for r in checks.filter("not passed").collect()} >= {"round_trip"}


def test_shuffles_follow_the_input_size(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with sized_for(spark, 100 * 1024**3):
        assert int(spark.conf.get(name)) == 400
        with sized_for(spark, 10 * 1024**2):
            assert int(spark.conf.get(name)) == 400
    assert spark.conf.get(name, None) is None
    splits = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(splits)
    with sized_for(spark, 100 * 1024**4):
        assert int(spark.conf.get(name)) == 50_000
        assert int(spark.conf.get(splits)) == -(-100 * 1024**4 // 200_000)
    assert spark.conf.get(splits) == before


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_command_line(spark, source, tmp_path):
    raw, work, out = (str(tmp_path / n) for n in ("raw", "work", "out"))
    assert main(["ingest", source, raw, "--layout", "lines"]) == 0
    assert main(["transform", raw, work]) == 0
    assert main(["export", work, out, "--source", "here"]) == 0
    assert main(["verify", out, "--min-rows", "1"]) == 1  # three regions, small files
    assert spark.read.parquet(f"{out}/{C.CLEAN_FILE}").count() == 200
    published = str(tmp_path / "published")
    always = ["--layout", "lines", "--promote", "always"]
    assert main(["publish", source, published, *always]) == 1
    assert jobs.published_dir(spark, published)
