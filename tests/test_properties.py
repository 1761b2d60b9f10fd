"""Random inputs against Python and the SQL engine."""

from __future__ import annotations

import math

import duckdb
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from worksledger import constants as C
from worksledger import functions as fn
from worksledger.operators.dedup import dedup_latest

FEW = settings(
    max_examples=6,
    deadline=None,
    phases=[Phase.explicit, Phase.reuse, Phase.generate],  # shrinking would run Spark for minutes
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
MONEY = st.floats(-1e9, 1e9, allow_nan=False).map(lambda x: round(x, 2))


def spark_values(spark, values, kind, expr):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def sql_values(values, kind, expr):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t (i INTEGER, x {kind})")
    con.executemany("INSERT INTO t VALUES (?, ?)", [[i, v] for i, v in enumerate(values)])
    return [r[0] for r in con.execute(f"SELECT {expr} FROM t ORDER BY i").fetchall()]


@FEW
@given(st.lists(MONEY, min_size=50, max_size=200))
def test_rounding(spark, values):
    for n in (0, 2, 4):
        assert spark_values(spark, values, "double", lambda c, n=n: fn.round_half(c, n)) == sql_values(
            values, "DOUBLE", f"round(x, {n})"
        )


@FEW
@given(st.lists(st.floats(-1e6, 1e6).map(lambda x: round(x * 2) / 2), min_size=50, max_size=200))
def test_integer_cast(spark, values):
    assert spark_values(spark, values, "double", fn.to_int) == sql_values(
        values, "DOUBLE", "CAST(x AS INTEGER)"
    )


NUMBER = st.integers(0, 45)
SEPARATOR = st.sampled_from(["-", "/"])
TAIL = st.sampled_from(["", " 10:00:00", "T09:15:00Z", "T", " 24:00:00", " 10:00", "x", " "])


@st.composite
def date_like(draw):
    year = draw(st.integers(1900, 2100))
    month, day = draw(NUMBER), draw(NUMBER)
    pad = draw(st.booleans())
    form = "{:02d}" if pad else "{}"
    a, b = draw(SEPARATOR), draw(SEPARATOR)
    return f"{year}{a}{form.format(month)}{b}{form.format(day)}{draw(TAIL)}"


@FEW
@given(st.lists(date_like(), min_size=100, max_size=300))
def test_dates(spark, values):
    assert spark_values(spark, values, "string", fn.try_date) == sql_values(
        values, "VARCHAR", "TRY_CAST(x AS DATE)"
    )


DAYS = [
    "2021-03-04", "2021/3/4", "2021-3-04", "12021-03-04", "2021-13-01", "2021-00-10", "0021-03-04",
    "0000-01-01", "021-03-04", "1-1-1", "2021-003-04", "2021-02-29", "2020-02-29", "2021.03.04",
    "2021 03 04", "2021-03/04", "+2021-03-04", "-2021-03-04", "2021\\03\\04", "20210304", "2021",
    "2021-03", "00002021-03-04", "0-2021-03-04", "5881580-07-10", "5881581-01-01", "",
]
TAILS = [
    "", " ", "\t", "\n", "T", "x", " x", "Z", "+08", " 10", " 10:", " 10:00", "T10:00", " 1:2",
    " 10:0:0", "T10:00:00", " 10:00:00.123", " 10:00:00.", " 24:00:00", " 24:00:01", " 24:01",
    " 25:00:00", " 10:60:00", " 10:00:60", "T10:00Z", " 10:00:00 Z", " 10:00:00z", " 10:00:00+08",
    " 10:00:00 +08", " 10:00:00+0800", " 10:00:00+08:00", " 10:00:00+8", " 10:00:00+99:99",
    " 10:00:00+080000", " 10:00:00 UTC", " 10:00:00UTC", " 10:00:00 Europe/Paris", "  10:00:00",
    "\t10:00", "T 10:00", "TT10:00", " 0010:00", " 10:000:00", " 10:00.5", " 10:00:00 AM", " :00",
    " 10:00:00 foo bar", " 10:00:00 f:g", " 10:00:00 .", " 10:00:00   ",
]


def test_dates_with_every_tail(spark):
    values = [lead + d + t for lead in ("", " ", "\t") for d in DAYS for t in TAILS]
    ours = spark_values(spark, values, "string", lambda c: F.unix_date(fn.try_date(c)))
    theirs = sql_values(
        values, "VARCHAR", "date_diff('day', DATE '1970-01-01', TRY_CAST(x AS DATE))"
    )
    assert [v for v, a, b in zip(values, ours, theirs, strict=True) if a != b] == []


@FEW
@given(st.lists(st.text(alphabet="aé \t   　", max_size=8), min_size=50, max_size=200))
def test_trim(spark, values):
    assert spark_values(spark, values, "string", fn.strip_spaces) == sql_values(
        values, "VARCHAR", "trim(x)"
    )


@FEW
@given(st.lists(MONEY, min_size=50, max_size=200))
def test_classes_are_total_and_monotone(spark, values):
    order = [label for _, label in C.COST_CLASSES] + [C.COST_CLASS_ABOVE]
    labels = spark_values(
        spark,
        sorted(values),
        "double",
        lambda c: fn.bucketize(c, C.COST_CLASSES, C.COST_CLASS_ABOVE, C.COST_CLASS_UNKNOWN),
    )
    ranks = [order.index(label) for label in labels if label != C.COST_CLASS_UNKNOWN]
    assert ranks == sorted(ranks)


@FEW
@given(st.lists(MONEY, min_size=1, max_size=300), st.integers(1, 6))
def test_exact_sum_is_the_true_sum(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    cents = sum(round(v * 100) for v in values)
    got = df.agg(fn.exact_sum("x").alias("s")).first().s
    assert math.isclose(got, cents / 100, rel_tol=1e-15, abs_tol=1e-9)


SIZES = st.builds(lambda m, e: m * 2.0**e, st.floats(-2, 2, allow_nan=False), st.integers(-40, 90)).filter(
    lambda x: x == 0 or 2.0**-43 <= abs(x) < 2.0**92
)


@FEW
@given(st.lists(SIZES, min_size=1, max_size=60), st.integers(1, 6))
def test_exact_sum_is_correctly_rounded_at_any_size(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    assert df.agg(fn.exact_sum("x").alias("s")).first().s == math.fsum(values)


@FEW
@given(
    st.lists(
        st.tuples(st.sampled_from("abcd"), st.sampled_from(["1", "2", "3", None]), st.integers(0, 9)),
        min_size=1,
        max_size=80,
    ),
    st.integers(1, 5),
)
def test_one_newest_row_per_key(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, edited string, n int").repartition(parts)
    kept = dedup_latest(df, ["k"], "edited", [F.col("n").asc()]).collect()
    want = {}
    for k, edited, n in sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", -r[2])):
        want[k] = (k, edited, n)
    assert sorted(map(tuple, kept), key=str) == sorted(want.values(), key=str)


@FEW
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=20, max_size=100))
def test_plain_numbers_read_back_as_the_same_value(spark, values):
    texts = spark_values(spark, values, "double", fn.plain_number)
    assert [float(t) for t in texts] == values
