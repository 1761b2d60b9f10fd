from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from worksledger import constants as C
from worksledger import functions as fn


def apply(spark, expr, values, kind):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_strip_spaces_takes_every_space_separator_but_no_control(spark):
    got = apply(
        spark,
        fn.strip_spaces,
        [" x ", "\tx\t", " x ", "　", "", None, "x \n", "ñ ", "  a b  "],
        "string",
    )
    assert got == ["x", "\tx\t", "x", "", "", None, "x \n", "ñ", "a b"]


def test_clean_text_renames(spark):
    df = spark.createDataFrame([(" a ", "b")], "One string, Two string")
    out = fn.clean_text(df, {"One": "one"})
    assert out.columns == ["one"] and out.first().one == "a"


def test_zero_fill_and_variance(spark):
    df = spark.createDataFrame([(None, 5.0), (3.0, None), (None, None)], "cost double, abc double")
    rows = df.select(fn.coalesce_zero("cost").alias("c"), fn.cost_variance("cost", "abc").alias("v"))
    assert [tuple(r) for r in rows.collect()] == [(0.0, -5.0), (3.0, 3.0), (0.0, 0.0)]


def test_safe_ratio_guards_the_denominator(spark):
    df = spark.createDataFrame(
        [(5.0, 0.0), (5.0, None), (5.0, -1.0), (None, 5.0), (1.0, 3.0)], "n double, d double"
    )
    got = [r[0] for r in df.select(fn.safe_ratio("n", "d")).collect()]
    assert got == [None, None, None, None, 0.3333]


def test_bucketize_edges(spark):
    values = [None, 0.0, -1.0, 999_999.99, 1e6, 1e7, 5e7, 1e8]
    got = apply(
        spark,
        lambda c: fn.bucketize(c, C.COST_CLASSES, C.COST_CLASS_ABOVE, C.COST_CLASS_UNKNOWN),
        values,
        "double",
    )
    names = [v.split(" (")[0] for v in got]
    assert names == [
        "Unknown", "Unknown", "Small", "Small", "Medium", "Large", "Very Large", "Mega"
    ]


def test_to_int_rounds_half_to_even(spark):
    got = apply(spark, fn.to_int, [2020.5, 2021.5, 2020.7, -2.5, None], "double")
    assert got == [2020, 2022, 2021, -2, None]


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("2021", None),
        ("2021-03", None),
        ("2021/3/4", dt.date(2021, 3, 4)),
        ("2021/03/04", dt.date(2021, 3, 4)),
        ("2021-03/04", None),
        ("2021-03-04T", None),
        ("2021-03-04 99:99", None),
        ("2021-02-30", None),
        ("", None),
        ("n/a", None),
        (None, None),
        (" 2021-03-04 ", dt.date(2021, 3, 4)),
        ("\t2021-03-04", dt.date(2021, 3, 4)),
        ("2021-03-04 10:00:00", dt.date(2021, 3, 4)),
        ("2021-03-04T10:00:00Z", dt.date(2021, 3, 4)),
        ("2021-03-04T10:00:00+08", dt.date(2021, 3, 4)),
        ("2021-03-04x", None),
        ("21-3-4", dt.date(21, 3, 4)),
        ("2021 03 04", dt.date(2021, 3, 4)),
        ("2021-03-04 24:00:00", dt.date(2021, 3, 4)),
        ("2021-03-04 24:00:01", None),
        ("2021-03-04 10:00 Europe/Paris", dt.date(2021, 3, 4)),
        ("epoch", None),
    ],
)
def test_try_date(spark, text, day):
    assert apply(spark, fn.try_date, [text], "string") == [day]


def test_duration_may_be_negative(spark):
    df = spark.sql("SELECT date'2021-03-04' AS a, date'2021-03-01' AS b, cast(null AS date) AS n")
    row = df.select(
        fn.duration_days("a", "b").alias("back"), fn.duration_days("a", "n").alias("none")
    ).first()
    assert (row.back, row.none) == (-3, None)


def test_bounding_box_includes_edges_and_never_is_null(spark):
    df = spark.createDataFrame(
        [(4.5, 116.0), (21.5, 127.0), (4.49, 120.0), (None, 120.0), (10.0, None)],
        "lat double, lon double",
    )
    got = [r[0] for r in df.select(fn.in_bbox("lat", "lon")).collect()]
    assert got == [True, True, False, False, False]


def test_flags(spark):
    assert apply(spark, fn.is_filled, ["a", "  ", "", None, " "], "string") == [
        True, False, False, False, False
    ]
    assert apply(spark, fn.is_positive, [1.0, 0.0, -1.0, None], "double") == [
        True, False, False, False
    ]


def test_round_half_uses_the_binary_value(spark):
    assert apply(spark, lambda c: fn.round_half(c, 2), [1.005, 2.675, -1.115, None], "double") == [
        1.0, 2.68, -1.12, None
    ]
    assert apply(spark, lambda c: fn.round_half(c, 0), [2.5, -2.5, 0.49], "double") == [3.0, -3.0, 0.0]


def test_scale_units(spark):
    assert apply(spark, lambda c: fn.scale_units(c, "billion"), [2.5e9], "double") == [2.5]
    assert apply(spark, lambda c: fn.scale_units(c, "million"), [2.5e6], "double") == [2.5]


def test_truncate_and_dash(spark):
    assert apply(spark, lambda c: fn.truncate_text(c, 3), ["abc", "abcd", None], "string") == [
        "abc", "abc…", None
    ]
    assert apply(spark, fn.null_display, [1, None], "int") == ["1", "—"]


def test_plain_number_reads_like_a_browser_number(spark):
    cases = {
        12345678.0: "12345678",
        12345678.9: "12345678.9",
        0.0: "0",
        -0.0: "0",
        1.0: "1",
        0.1: "0.1",
        1234.5678901234: "1234.5678901234",
        120.98765432109876: "120.98765432109876",
        123456789012345680.0: "123456789012345680",
        1e20: "100000000000000000000",
        1e21: "1e+21",
        1.5e22: "1.5e+22",
        0.00012: "0.00012",
        0.000001: "0.000001",
        1.5e-7: "1.5e-7",
        -98765432.1: "-98765432.1",
        100000000.0: "100000000",
    }
    assert apply(spark, fn.plain_number, list(cases), "double") == list(cases.values())
    assert apply(spark, fn.plain_number, [None], "double") == [None]


def test_exact_sum_is_exact_and_order_independent(spark):
    values = [0.1] * 10 + [9e12, -9e12, 123456789.01, 0.01, -0.07, 999.9999, 1000.0001]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    want = math.fsum([1.0, 123456789.01, 0.01, -0.07, 2000.0])
    for parts in (1, 3, 7):
        got = df.repartition(parts).agg(fn.exact_sum("x").alias("s")).first().s
        assert got == want


@pytest.mark.parametrize(
    ("values", "want"),
    [
        ([1e300, 1.0], 1e300),
        ([1e300], 1e300),
        ([-1e14, 0.25], -1e14 + 0.25),
        ([float("inf"), 1.0], float("inf")),
        ([1e22, -1e22, 5.5], 5.5),
        ([None, 2.5], 2.5),
        ([-0.1, -0.2, -999.9], math.fsum([-0.1, -0.2, -999.9])),  # not rounded to -1000.2
    ],
)
def test_values_beyond_money_do_not_stop_a_sum(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    merged = df.groupBy("x").agg(*fn.sum_parts("x")).agg(fn.merged_sum("x").alias("s"))
    assert df.agg(fn.exact_sum("x").alias("s")).first().s == want == merged.first().s


@pytest.mark.parametrize(
    "values",
    [
        [0.00004] * 1000,
        [1e-13, 3e-11, -7e-9, 1e-5] * 40,
        [1e13 + 0.5, -1e13, 0.25, 12345678901234.56] * 30,
        [8e27, 1.0, -8e27, 1e-12, 2.0**-60],
        [1.0, 2.0**-53, 2.0**-80],
        [1.0, 2.0**-53],
        [-1.0, -(2.0**-53), -(2.0**-90)],
        [2.0**95, 2.0**42, -(2.0**-40)],
        [0.1] * 7 + [-0.7],
        [0.0, -0.0],
        [1e-13],
        [2.0**-43],
    ],
)
def test_exact_sum_is_the_nearest_double(spark, values):
    """Whatever sizes and signs are mixed, and however the rows are spread."""
    want = math.fsum(values)
    for parts in (1, 5):
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
        assert df.agg(fn.exact_sum("x").alias("s")).first().s == want
        merged = df.groupBy(F.spark_partition_id()).agg(*fn.sum_parts("x")).agg(fn.merged_sum("x").alias("s"))
        assert merged.first().s == want


def test_exact_avg_skips_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (2.0,)], "x double")
    row = df.agg(fn.exact_avg("x").alias("a")).first()
    none = df.filter("x > 5").agg(fn.exact_avg("x").alias("a"), fn.exact_sum("x").alias("s")).first()
    assert row.a == 1.5 and none.a is None and none.s is None


def test_merged_sums_equal_direct_ones(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") * 1234.5678).alias("x"))
    direct = df.agg(fn.exact_sum("x"), fn.exact_avg("x")).first()
    merged = (
        df.groupBy("k").agg(*fn.sum_parts("x")).agg(fn.merged_sum("x"), fn.merged_avg("x")).first()
    )
    assert tuple(direct) == tuple(merged)
