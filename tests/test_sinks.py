from __future__ import annotations

import csv
import json
from pathlib import Path

import pytest

from tests.conftest import column
from worksledger import constants as C
from worksledger.sinks import (
    create_table,
    current_table,
    dataset_sizes,
    drop_versions,
    export_csv,
    export_parquet,
    manifest,
    materialise,
    replace_table,
    write_manifest,
)
from worksledger.sources import describe_schema, register_views


def csv_text(path):
    return "".join(p.read_text(encoding="utf-8") for p in sorted(Path(path).glob("part-*")))


def test_csv_quotes_only_what_needs_it(spark, tmp_path):
    rows = [
        ("a,b", 12345678.0, None),
        ('says "x"', 0.5, 3),
        ("two\nlines", None, 4),
        ("  padded ", 1e21, 5),
        ("", -0.25, 6),
        (None, 3.0, 7),
        ("plain; text's", 100.0, 8),
    ]
    df = spark.createDataFrame(rows, "name string, cost double, n int").coalesce(1)
    path = str(tmp_path / "out")
    assert export_csv(df, path)
    assert csv_text(path) == (
        "name,cost,n\n"
        '"a,b",12345678,\n'
        '"says ""x""",0.5,3\n'
        '"two\nlines",,4\n'
        "  padded ,1e+21,5\n"
        ",-0.25,6\n"
        ",3,7\n"
        "plain; text's,100,8\n"
    )
    with_reader = list(csv.reader(csv_text(path).splitlines(keepends=True)))
    assert len(with_reader) == 8


def test_no_rows_no_file(spark, tmp_path):
    path = tmp_path / "none"
    assert not export_csv(spark.range(0), str(path))
    assert not path.exists()


def test_top_k_export_is_one_part(spark, tmp_path):
    path = str(tmp_path / "top")
    export_csv(spark.range(1000).repartition(7).orderBy("id").limit(100), path)
    assert len(list(Path(path).glob("part-*"))) == 1
    assert csv_text(path).splitlines() == ["id", *map(str, range(100))]


def test_many_parts_are_one_csv_with_one_header(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("worksledger.sinks.csv.ONE_PART_ROWS", 10)
    path = str(tmp_path / "all")
    # the first partitions of the data are empty
    df = spark.range(0, 5000, 1, 9).where("id >= 2000").selectExpr("id", "concat('x,', id) AS `a,b`")
    assert export_csv(df, path)
    assert len(list(Path(path).glob("part-*"))) > 3
    want = ["id,\"a,b\"", *(f'{k},"x,{k}"' for k in range(2000, 5000))]
    assert csv_text(path) == "".join(f"{x}\n" for x in want)


def test_csv_computes_its_rows_once_and_keeps_the_old_file(spark, tmp_path):
    path, seen = str(tmp_path / "once"), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(0, 100, 1, 4).mapInArrow(count, "id long")
    assert export_csv(df, path) and seen.value == 100
    before = csv_text(path)
    assert not export_csv(df.where("id < 0"), path) and csv_text(path) == before
    assert export_csv(spark.range(1), path) and csv_text(path) == "id\n0\n"
    assert [p.name for p in tmp_path.iterdir()] == ["once"]


def test_a_table_is_replaced_as_a_whole(spark, tmp_path):
    base = str(tmp_path / "t")
    assert replace_table(spark.range(10), base).rows == 10
    dying = spark.range(0, 100, 1, 5).selectExpr("if(id > 90, raise_error('lost'), id) AS id")
    with pytest.raises(Exception, match="lost"):
        replace_table(dying, base)
    assert current_table(spark, base).count() == 10
    old = current_table(spark, base)
    # computed from itself, and the old version can still be read
    assert replace_table(old.union(old), base, ["id"]).rows == 20
    assert (current_table(spark, base).count(), old.count()) == (20, 10)
    assert drop_versions(spark, base) == 1 and current_table(spark, base).count() == 20
    assert drop_versions(spark, base) == 0


def test_materialise_counts_and_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    assert materialise(spark.range(10), path).rows == 10
    table, rows = materialise(spark.range(20).repartition(3), path, ["id"])
    assert rows == 20 and table.count() == 20
    assert all(".snappy." in p.name for p in Path(path).glob("part-*"))


def test_catalog_tables_are_replaced(spark):
    assert create_table(spark.range(5), "works_raw").rows == 5
    table, rows = create_table(spark.range(7).selectExpr("id", "id % 2 AS odd"), "works_raw", ["odd"])
    assert (rows, table.count(), spark.table("works_raw").columns) == (7, 7, ["id", "odd"])
    spark.sql("DROP TABLE works_raw")


def test_exported_order_is_stored_order(spark, tmp_path):
    ordered = spark.range(50).repartition(5).orderBy("id")
    back = export_parquet({"a": ordered, "b": spark.range(3)}, str(tmp_path))
    assert [r.id for r in back["a"].collect()] == list(range(50))
    assert back["b"].count() == 3


def test_manifest(spark, tmp_path):
    path = str(tmp_path / "m.json")
    tables = {C.CLEAN_FILE: spark.range(7), C.REGION_FILE: spark.range(2)}
    write_manifest(manifest(tables, "somewhere"), path)
    written = json.loads(csv_text(path))
    assert written["pipeline_version"] == "1.0.0" and written["source"] == "somewhere"
    assert written["generated_at"].endswith("Z")
    assert written["files"] == [
        {"name": C.CLEAN_FILE, "rows": 7, "description": "Full cleaned dataset"},
        {"name": C.REGION_FILE, "rows": 2, "description": "Aggregated by region"},
    ]


def test_sizes_against_the_source(spark, tmp_path):
    for name, n in (("a", 100), ("b", 5000)):
        spark.range(n).write.parquet(str(tmp_path / name))
    (tmp_path / "source.json").write_text("x" * 1_000_000)
    paths = {n: str(tmp_path / n) for n in ("a", "b", "gone")}
    got = {r.name: r for r in dataset_sizes(spark, paths, str(tmp_path / "source.json")).collect()}
    on_disk = {n: sum(p.stat().st_size for p in (tmp_path / n).glob("part-*")) for n in "ab"}
    assert {n: got[n].bytes for n in "ab"} == on_disk and set(got) == {"a", "b", "total"}
    total = sum(on_disk.values())
    assert got["total"].bytes == total
    assert got["total"].pct_smaller == round((1 - total / 1_000_000) * 100, 1)
    without = dataset_sizes(spark, paths, str(tmp_path / "nothing"))
    assert column(without.filter("name = 'total'"), "pct_smaller") == [None]
    assert dataset_sizes(spark, {"gone": paths["gone"]}).count() == 0


def test_views_can_be_queried_and_replaced(spark, tmp_path):
    for n in (3, 4):
        base = str(tmp_path / str(n))
        export_parquet({file: spark.range(n) for file in C.VIEWS.values()}, base)
        names = register_views(spark, base + "/")
        assert names == list(C.VIEWS) and len(names) == 5
        assert spark.sql(f"SELECT count(*) AS n FROM {names[0]}").first().n == n


def test_describe_schema(spark):
    df = spark.createDataFrame([], "a string not null, b array<int>")
    assert [tuple(r) for r in describe_schema(df).collect()] == [
        ("a", "string", "NO"), ("b", "array<int>", "YES")
    ]
