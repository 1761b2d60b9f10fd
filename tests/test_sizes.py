"""What grows with the tables: shuffled columns, sorted rows of a task, files on disk."""

from __future__ import annotations

import json
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parity import tables
from tests.conftest import SMALL, plan_text
from worksledger.operators import layout, ordering, ranks
from worksledger.operators.cleaning import CleaningRules, clean_projects, default_tie_breakers
from worksledger.plans.jobs import transform
from worksledger.session import SORTED_BYTES, conf_bytes, sized_for


@pytest.fixture(scope="module")
def given(spark):
    return tables.Given(spark, SMALL)


@pytest.mark.parametrize("kind", ["plain", "normalised", "ties"])
def test_attributes_computed_late_give_the_same_rows(given, kind):
    ties = default_tie_breakers() if kind == "ties" else None
    rules = CleaningRules(normalise_key=kind == "normalised", tie_breakers=ties)
    late = clean_projects(given.source, rules, tables.raw_attributes())
    want = clean_projects(given.lazy_raw, rules)
    assert late.schema == want.schema
    assert sorted(late.collect(), key=str) == sorted(want.collect(), key=str)


def test_the_choice_of_edits_shuffles_source_columns(given):
    plan = plan_text(clean_projects(given.source, attributes=tables.raw_attributes()))
    above, below = plan.split("Exchange hashpartitioning(_ProjectComponentID", 1)
    assert "District " in above and "District " not in below


def test_transform_takes_attributes(given, tmp_path):
    done = transform(given.source, str(tmp_path / "clean"), attributes=tables.raw_attributes())
    plain = transform(given.lazy_raw)
    assert done.rows == plain.clean.count()
    for name in ("duplicates", "rows_removed"):
        assert done.profile[name].collect() == plain.profile[name].collect()


def test_sorts_get_small_splits_and_partitions(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(n) for n in names]
    with sized_for(spark, 1024**3):
        assert [spark.conf.get(n) for n in names] == before
        with sized_for(spark, 1024**3, sorts=True):
            assert all(conf_bytes(spark, n) <= SORTED_BYTES for n in names)
            partitions = int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum"))
            assert 1024**3 / partitions <= SORTED_BYTES
    assert [spark.conf.get(n) for n in names] == before


def test_a_large_table_is_not_dealt_out_again(spark, tmp_path):
    spark.range(20_000).select(F.randstr(200, F.lit(1)).alias("x")).coalesce(1).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert tables._spread(stored).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    cost = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(cost)
    spark.conf.set(cost, "64k")
    try:
        assert "Exchange" not in plan_text(tables._spread(stored))
    finally:
        spark.conf.set(cost, before)


def test_paging_sorts_keys_and_places_only(given, spark):
    clean = given.clean
    order = ordering.sort_order(clean, "project_description", "asc", ["global_id"])
    narrow, by = ranks.keyed(ranks.located(clean), [*order, *ordering._whole_row(clean)], ranks.PLACE)
    assert len(narrow.columns) == len(ranks.PLACE) + 4  # text, id, two hashes; each once
    shuffled = plan_text(narrow.orderBy(*by)).split("Exchange rangepartitioning", 1)
    assert "contractor" in shuffled[1] and "contractor" not in shuffled[0]
    got = [r["_in_file"] + str(r["_at_row"]) for r in narrow.orderBy(*by).collect()]
    want = ranks.located(clean).orderBy(*order).select(*ranks.PLACE).collect()
    assert got == [r["_in_file"] + str(r["_at_row"]) for r in want]


@pytest.mark.parametrize("how", ["asc_nulls_first", "asc_nulls_last", "desc_nulls_first", "desc_nulls_last", "asc", "desc"])
def test_keys_keep_their_direction(spark, how):
    df = spark.createDataFrame([(1, 3), (2, None), (3, 1), (4, 2)], "id int, x int")
    order = [getattr(F.col("x"), how)(), F.col("id")]
    narrow, by = ranks.keyed(df, order, ["id"])
    assert [r.id for r in narrow.orderBy(*by).collect()] == [r.id for r in df.orderBy(*order).collect()]


def test_clustered_files_follow_the_size(given, monkeypatch, tmp_path):
    slots = given.spark.sparkContext.defaultParallelism
    assert layout.files_by_size(given.clean) == slots
    monkeypatch.setattr(layout, "SORTED_BYTES", 20_000)
    files = layout.files_by_size(given.clean)
    assert files > slots
    layout.write_clustered(given.clean, str(tmp_path / "c"), files)
    assert len(list((tmp_path / "c" / "data").glob("*.parquet"))) > slots


def test_features_are_compressed(given):
    assert all(f.suffix == ".gz" for f in Path(given.features).glob("part-*"))


def test_collections_are_written_without_a_shuffle(given):
    texts = [f.read_text() for f in Path(given.collections).glob("part-*")]
    found = [json.loads(t)["features"] for t in texts]
    assert sum(map(len, found)) == given.lazy_raw.count() and len(found) > 1


def test_a_collection_of_many_batches_or_none():
    def written(*batches):
        out = tables._as_collection(pa.RecordBatch.from_pydict({"value": pa.array(b, pa.string())}) for b in batches)
        return json.loads("".join(v + "}" for b in out for v in b.column(0).to_pylist()))["features"]

    assert written(['{"a":1}', '{"a":"ñ"}'], [], ['{"a":3}']) == [{"a": 1}, {"a": "ñ"}, {"a": 3}]
    assert written() == written([]) == []
