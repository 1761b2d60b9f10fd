from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from worksledger.sources import read_geojson

SCHEMA = T.StructType([T.StructField("Name", T.StringType()), T.StructField("Cost", T.DoubleType())])


def feature(name, cost, **more):
    return {
        "type": "Feature",
        "properties": {"Name": name, "Cost": cost, "Extra": [1]} | more,
        "geometry": {"type": "Point", "coordinates": [120.5, 10.25]},
    }


FEATURES = [
    feature("plain", 1.5),
    feature('says "Feature" and, [brackets] {too}', 2.0),
    feature("line\nbreak ñ ₱", None),
    {"type": "Feature", "properties": {"Name": "no place"}, "geometry": None},
]
COLLECTION = {"type": "FeatureCollection", "name": "works", "features": FEATURES}
WANT = sorted(((f["properties"]["Name"], f["properties"].get("Cost")) for f in FEATURES), key=str)


def write(tmp_path, text, name="works.geojson"):
    (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path / name)


def found(df):
    return sorted(((r.Name, r.Cost) for r in df.collect()), key=str)


COMPACT = json.dumps(COLLECTION, separators=(",", ":"), ensure_ascii=False)
PRETTY = json.dumps(COLLECTION, indent=2)
PER_LINE = (
    '{"type": "FeatureCollection", "name": "works", "features": [\n'
    + ",\n".join(json.dumps(f) for f in FEATURES)
    + "\n]}"
)
HEAD_ON_FIRST = (
    '{"type":"FeatureCollection","features":['
    + ",\n".join(json.dumps(f) for f in FEATURES)
    + "]}"
)
NDJSON = "\n".join(json.dumps(f) for f in FEATURES)


@pytest.mark.parametrize("text", [COMPACT, PRETTY, PER_LINE, HEAD_ON_FIRST])
@pytest.mark.parametrize("layout", ["collection", "splits"])
def test_collections_of_any_formatting(spark, tmp_path, text, layout):
    path = write(tmp_path, text)
    df = read_geojson(spark, path, SCHEMA, layout=layout)
    assert found(df) == WANT
    assert df.columns == ["Name", "Cost", "geometry"]
    places = {r.Name: r.geometry for r in df.collect()}
    assert json.loads(places["plain"]) == FEATURES[0]["geometry"] and places["no place"] is None


@pytest.mark.parametrize("text", [NDJSON, PER_LINE, HEAD_ON_FIRST])
def test_lines(spark, tmp_path, text):
    df = read_geojson(spark, write(tmp_path, text), SCHEMA, layout="lines")
    assert found(df) == WANT


def test_splits_lose_nothing_at_split_borders(spark, tmp_path):
    many = [feature(f"n{i}", float(i)) for i in range(3000)]
    path = write(tmp_path, json.dumps({"type": "FeatureCollection", "features": many}))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7001b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = read_geojson(spark, path, SCHEMA, layout="splits")
        assert df.rdd.getNumPartitions() > 20
        assert found(df) == sorted(((f"n{i}", float(i)) for i in range(3000)), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


ODD_FEATURES = [
    [{"properties": {"Name": "late type"}, "geometry": None, "type": "Feature"}],
    [{"properties": {"Name": "late type"}, "type": "Feature", "geometry": None}] * 2,
    [feature("x", 1.0, Kind="Feature")],
    [feature("a", 1.0), {"properties": {"Name": "no type"}, "geometry": None}, feature("b", 2.0)],
    [feature("a", 1.0), {"id": 7} | feature("b", 2.0)],
    [feature("deep", 1.0, properties={"features": [{"properties": {}}, [[{}]]]})],
    [feature('quote " and \\', 1.0, Tail="\\"), feature("}{][", 2.0), {}, {"geometry": {"type": "Point", "coordinates": []}}],
    [feature("x" * 900, 1.0)] * 2,
]
AROUND = [
    lambda fs: {"type": "FeatureCollection", "features": fs},
    lambda fs: {"features": fs, "type": "FeatureCollection", "bbox": [1, [2]], "crs": {"features": [{"a": 1}], "b": "]}"}},
    lambda fs: {"links": [{"features": [{}]}, {}], "name": 'the \\"features\\": [', "features": fs, "more": [[{}, {}], []]},
]


def small_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", f"{size}b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


@pytest.fixture
def splits_of(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: small_splits(spark, size)
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("around", range(len(AROUND)))
def test_splits_give_the_rows_of_whole_documents(spark, tmp_path, splits_of, around, indent):
    """Any order of members, at any border of splits."""
    for k, features in enumerate(ODD_FEATURES):
        text = json.dumps(AROUND[around](features), indent=indent)
        write(tmp_path, text + "\n" * (k % 2), f"{k}.json")
    want = sorted(map(str, read_geojson(spark, str(tmp_path), SCHEMA).collect()))
    assert len(want) == sum(map(len, ODD_FEATURES))
    for size in (10**9, 1009, 211):
        splits_of(size)
        assert sorted(map(str, read_geojson(spark, str(tmp_path), SCHEMA, layout="splits").collect())) == want


BROKEN = [
    "          ", "some text", "[ [ ] , [ ] ]", '{"type": "x"}', '{"features":null}', '{"features":[null]}', '{"features":[1]}', '{"features":[{},]}', '{"features":[{}{}]}',
    '{"features":[,{}]}', '{"features":[{}],}', '{"features":[{}]', '{"features":[{}]}}', '{"features":[{}]} {"features":[{}]}',
    '{"features":[{"properties":{"Cost":"many"}}]}', '{"features":[{"properties":{"Name":"a}]}', '{"features":[{} "x"]}', '{"a":{"features":[{}]}}',
    '{"features":{"features":[{}]}}', '["features":[{}]]', '{"features":[{"a":]}}',
]


@pytest.mark.parametrize("text", BROKEN)
def test_what_is_no_collection_is_refused_by_both(spark, tmp_path, splits_of, text):
    path = write(tmp_path, text)
    for layout in ("collection", "splits"):
        with pytest.raises(Exception, match="FeatureCollection|MALFORMED"):
            read_geojson(spark, path, SCHEMA, layout=layout).collect()
    splits_of(max(7, len(text) // 3))
    with pytest.raises(Exception, match="FeatureCollection|MALFORMED"):
        read_geojson(spark, path, SCHEMA, layout="splits").collect()


def test_a_file_without_a_byte_has_no_features(spark, tmp_path):
    for layout in ("collection", "splits", "lines"):
        assert read_geojson(spark, write(tmp_path, ""), SCHEMA, layout=layout).count() == 0


def test_a_byte_order_mark_and_trailing_blanks(spark, tmp_path):
    path = write(tmp_path, "\ufeff" + COMPACT + " \n\n ")
    for layout in ("collection", "splits"):
        assert found(read_geojson(spark, path, SCHEMA, layout=layout)) == WANT


def test_bare_features_in_splits(spark, tmp_path, splits_of):
    one = write(tmp_path, json.dumps(FEATURES[0]) + "\n", "one.json")
    assert found(read_geojson(spark, one, SCHEMA, layout="splits")) == [("plain", 1.5)]
    many = write(tmp_path, NDJSON + "\n", "many.json")
    splits_of(61)
    assert found(read_geojson(spark, many, SCHEMA, layout="splits")) == WANT
    comma = write(tmp_path, NDJSON.replace("\n", ",\n"), "comma.json")
    with pytest.raises(Exception, match="MALFORMED"):
        read_geojson(spark, comma, SCHEMA, layout="splits").collect()


@pytest.mark.parametrize("text", [COMPACT, PRETTY])
def test_lines_refuse_other_layouts(spark, tmp_path, text):
    with pytest.raises(Exception, match="one feature per line"):
        read_geojson(spark, write(tmp_path, text), SCHEMA, layout="lines").collect()


def test_bare_features_are_no_collection(spark, tmp_path):
    path = write(tmp_path, NDJSON)
    with pytest.raises(Exception, match="expected one FeatureCollection|MALFORMED"):
        read_geojson(spark, path, SCHEMA).collect()
    assert found(read_geojson(spark, path, SCHEMA, layout="splits")) == WANT


@pytest.mark.parametrize("blank", ["\n\t", "\r\n  "])
def test_any_blanks_between_members(spark, tmp_path, blank):
    text = COMPACT.replace('"Feature",', f'"Feature"{blank},').replace("{", "{" + blank, 1)
    path = write(tmp_path, blank + text)
    assert found(read_geojson(spark, path, SCHEMA)) == WANT
    assert found(read_geojson(spark, path, SCHEMA, layout="splits")) == WANT
    lines = write(tmp_path, PER_LINE.replace("\n{", "\n\t {"), "lines")
    assert found(read_geojson(spark, lines, SCHEMA, layout="lines")) == WANT


def test_malformed_features_raise(spark, tmp_path):
    bad = NDJSON.replace('"Cost": 1.5', '"Cost": "many"')
    with pytest.raises(Exception, match="MALFORMED"):
        read_geojson(spark, write(tmp_path, bad), SCHEMA, layout="lines").collect()


def test_inference_is_opt_in(spark, tmp_path):
    df = read_geojson(spark, write(tmp_path, PRETTY), "infer")
    assert sorted(df.columns) == ["Cost", "Extra", "Name", "geometry"]
    lines = read_geojson(spark, write(tmp_path, NDJSON, "l"), "infer", layout="lines")
    assert sorted(lines.columns) == sorted(df.columns) and lines.count() == 4
    with pytest.raises(ValueError, match="pass a schema"):
        read_geojson(spark, write(tmp_path, PRETTY), "infer", layout="splits")


def test_inference_without_any_place(spark, tmp_path):
    plain = {"type": "Feature", "properties": {"Name": "x"}, "geometry": None}
    path = write(tmp_path, json.dumps({"type": "FeatureCollection", "features": [plain]}))
    assert [tuple(r) for r in read_geojson(spark, path, "infer").collect()] == [("x", None)]


def test_unknown_layout(spark, tmp_path):
    with pytest.raises(ValueError, match="layout"):
        read_geojson(spark, str(tmp_path), SCHEMA, layout="tiles")


def test_a_folder_of_collections(spark, tmp_path):
    for i in range(3):
        write(tmp_path, COMPACT, f"{i}.geojson")
    assert read_geojson(spark, str(tmp_path), SCHEMA).count() == 12
    assert read_geojson(spark, str(tmp_path), SCHEMA, layout="splits").count() == 12


@pytest.mark.parametrize("layout", ["collection", "splits"])
def test_an_empty_collection_has_no_rows(spark, tmp_path, layout):
    path = write(tmp_path, '{"type":"FeatureCollection","features":[]}')
    assert read_geojson(spark, path, SCHEMA, layout=layout).count() == 0
    assert read_geojson(spark, path, SCHEMA, layout="lines").count() == 0


def test_large_files_are_refused_not_read_otherwise(spark, tmp_path):
    path = write(tmp_path, COMPACT)
    with pytest.raises(ValueError, match="bytes"):
        read_geojson(spark, path, SCHEMA, max_document_bytes=len(COMPACT) // 2)


@pytest.mark.parametrize("layout", ["collection", "splits"])
@pytest.mark.parametrize("text", [COMPACT + "\n" + COMPACT, COMPACT[: len(COMPACT) // 2], COMPACT + " more"])
def test_more_or_less_than_a_collection_is_refused(spark, tmp_path, layout, text):
    with pytest.raises(Exception, match="FeatureCollection|MALFORMED|start with"):
        read_geojson(spark, write(tmp_path, text), SCHEMA, layout=layout).collect()


@pytest.mark.parametrize(
    "line",
    ['{"type":"Fea', '{"properties":{"Name":"no type"},"geometry":null}', '{"type":"Feature"} {}', "text"],
)
def test_every_line_must_be_a_feature(spark, tmp_path, line):
    good = json.dumps(FEATURES[0])
    with pytest.raises(Exception, match="one feature per line|MALFORMED"):
        read_geojson(spark, write(tmp_path, f"{good}\n{line}\n{good}"), SCHEMA, layout="lines").collect()


def test_lines_take_any_order_of_members(spark, tmp_path):
    text = json.dumps({"properties": {"Name": "x", "Kind": "Feature", "tags": [1]}, "geometry": None, "type": "Feature", "more": [1]})
    assert found(read_geojson(spark, write(tmp_path, text), SCHEMA, layout="lines")) == [("x", None)]
