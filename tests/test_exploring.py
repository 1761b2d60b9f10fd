from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import column, plan_text
from worksledger import session
from worksledger.operators import breakdowns, cube, filters, layout, ordering, ranks
from worksledger.operators.cleaning import clean_projects


@pytest.fixture(scope="module")
def clean(raw_rows):
    rows = [
        ("C1", "North", "Upper", "River wall 50%", "O'Neil Ltd", "Dike", 2020, 5e5),
        ("C2", "North", "Lower", "a_b pump", "Acme", "Pump", 2021, 2e6),
        ("C3", "South", "Bay", r"path a\b", "acme", None, 2021, 3e7),
        ("C4", "South", "Bay", "axb pump", None, "Pump", None, 0.0),
        ("C5", "South", "Bay", "Ñu canal", "", "Dike", 2020, 2e8),
    ]
    names = ("ProjectComponentID", "Region", "Province", "ProjectDescription", "Contractor",
             "TypeofWork", "InfraYear", "ContractCost")
    raw = raw_rows(
        *[
            dict(zip(names, r, strict=True))
            | {"GlobalID": "G" + r[0], "InfraYear": None if r[6] is None else float(r[6])}
            for r in rows
        ]
    )
    return clean_projects(raw)


def keys(df):
    return sorted(column(df, "project_component_id"))


def test_filters_combine_and_empty_means_all(clean):
    assert keys(filters.filter_projects(clean)) == ["C1", "C2", "C3", "C4", "C5"]
    assert keys(filters.filter_projects(clean, region="", year="")) == keys(clean)
    assert keys(filters.filter_projects(clean, region="South", year="2021")) == ["C3"]
    assert keys(filters.filter_projects(clean, work_type="Pump", year=2021)) == ["C2"]
    assert keys(filters.filter_projects(clean, cost_category="Mega (₱100M+)")) == ["C5"]


def test_year_must_be_a_number(clean):
    with pytest.raises(ValueError, match="whole number"):
        filters.filter_projects(clean, year="soon")


@pytest.mark.parametrize(
    ("term", "found"),
    [
        ("", ["C1", "C2", "C3", "C4", "C5"]),
        ("  ", ["C1", "C2", "C3", "C4", "C5"]),
        ("PUMP", ["C2", "C4"]),
        ("a_b", ["C2", "C3", "C4"]),
        ("r%50", ["C1"]),
        (r"a\b", ["C3"]),
        ("O'Neil", ["C1"]),
        ("ñu", ["C5"]),
        ("bay", ["C3", "C4", "C5"]),
        (" acme ", ["C2", "C3"]),
    ],
)
def test_search(clean, term, found):
    assert keys(filters.search(clean, term)) == found


def test_drill_down(clean):
    chosen = filters.ProjectFilter(year=2021)
    assert keys(filters.drill_down(clean, chosen, "South")) == ["C3"]
    assert keys(filters.drill_down(clean, chosen, None)) == ["C2", "C3"]


def test_predicates_reach_the_scan(spark, clean, tmp_path):
    path = str(tmp_path / "clean")
    clean.write.parquet(path)
    shown = ordering.explore(spark.read.parquet(path), filters.ProjectFilter("South", 2021), "b")
    plan = plan_text(shown)
    assert "EqualTo(region,South)" in plan and "EqualTo(infra_year,2021)" in plan
    assert "TakeOrderedAndProject" in plan and plan.count("Exchange") == 1
    assert "Partial" in plan.split("Exchange", 1)[1]  # k rows per task leave it
    read = plan.split("ReadSchema:")[1]
    assert "approved_budget" not in read and "Python" not in plan


def test_kpis_of_all_and_of_nothing(clean):
    row = breakdowns.kpi_overview(clean).first()
    assert tuple(row) == (5, 232_500_000.0, 46_500_000.0, 4, 2)
    none = breakdowns.kpi_overview(clean, filters.ProjectFilter(region="West")).first()
    assert tuple(none) == (0, None, None, 0, 0)


def test_breakdowns(clean):
    assert [tuple(r) for r in breakdowns.by_year(clean).collect()] == [
        (2020, 2, 200_500_000.0), (2021, 2, 32_000_000.0)
    ]
    assert column(breakdowns.by_work_type(clean), "type_of_work") == ["Dike", "Pump", None]
    assert column(breakdowns.by_work_type(clean, k=1), "type_of_work") == ["Dike"]
    assert column(breakdowns.by_region(clean), "region") == ["South", "North"]
    assert column(breakdowns.by_cost_category(clean), "projects") == [1] * 5
    assert None in column(breakdowns.by_contractor(clean), "contractor")
    province = breakdowns.by_province(clean, None, "South").first()
    assert (province.province, province.projects, province.contractors) == ("Bay", 3, 2)


def test_shares_are_of_the_rows_shown(clean):
    for bounded in (True, False):
        top = breakdowns.by_work_type(clean, k=2)
        shares = column(breakdowns.share_of_total(top, "projects", bounded), "share_pct")
        assert shares == [50.0, 50.0]
    series = breakdowns.cost_category_shares(clean)
    assert sum(column(series, "share_pct")) == pytest.approx(100, abs=0.5)
    assert column(series, "cost_billions")[0] == 0.2


def test_facets(clean):
    got = {k: column(df, k) for k, df in breakdowns.facets(clean).items()}
    assert got["region"] == ["North", "South"]
    assert got["infra_year"] == [2021, 2020]
    assert got["type_of_work"] == ["Dike", "Pump"]
    assert len(got["cost_category"]) == 5
    assert column(breakdowns.facet_values(clean, "type_of_work"), "type_of_work")[-1] is None


def test_chart_series(clean):
    assert breakdowns.year_series(clean).columns == ["infra_year", "projects", "cost_billions"]
    assert column(breakdowns.region_bars(clean), "label") == ["South", "North"]
    assert column(breakdowns.province_bars(clean, None, "North"), "projects") == [1, 1]
    assert breakdowns.contractor_bars(clean).count() == 5
    assert breakdowns.work_type_shares(clean).count() == 3


def test_sort_puts_missing_last_both_ways_and_ignores_case(spark):
    df = spark.createDataFrame([("b",), ("Á",), (None,), ("A",), ("C",)], "x string")
    assert column(ordering.sort_table(df, "x", "asc"), "x") == ["A", "Á", "b", "C", None]
    assert column(ordering.sort_table(df, "x", "desc"), "x") == ["C", "b", "Á", "A", None]
    numbers = spark.createDataFrame([(10,), (None,), (9,)], "x int")
    assert column(ordering.sort_table(numbers, "x", "asc"), "x") == [9, 10, None]
    assert column(ordering.sort_table(numbers, "x", "desc"), "x") == [10, 9, None]
    with pytest.raises(ValueError, match="direction"):
        ordering.sort_table(df, "x", "up")


def test_toggle():
    assert ordering.toggle("a", None, "asc") == ("a", "desc")
    assert ordering.toggle("a", "a", "desc") == ("a", "asc")
    assert ordering.toggle("a", "a", "asc") == ("a", "desc")
    assert ordering.toggle("b", "a", "asc") == ("b", "desc")


@pytest.mark.parametrize("partitions", [1, 300])
def test_top_rows_are_those_of_a_plain_sort(spark, partitions):
    df = spark.range(0, 5000, 1, partitions).selectExpr(
        "id", "nullif((id * 7919) % 101, 0) AS v"
    )
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    want = [tuple(r) for r in df.orderBy(*order).limit(120).collect()]
    assert [tuple(r) for r in ordering.top_rows(df, order, 120).collect()] == want
    assert ordering.top_rows(df, order, 9999).count() == 5000


def test_top_rows_are_limited_before_the_shuffle_in_any_session(spark):
    """Also for a k beyond what the session plans as a limit per group."""
    df = spark.range(0, 5000, 1, 30).selectExpr("id", "id % 101 AS v")
    order = [F.col("v").desc(), F.col("id").asc()]
    name = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(name)
    try:
        for threshold, node in (("50", "TakeOrderedAndProject"), ("1000", "WindowGroupLimit")):
            spark.conf.set(name, threshold)
            got = ordering.top_rows(df, order, 120)
            assert node in plan_text(got)
            assert got.collect() == df.orderBy(*order).limit(120).collect()
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("deep_from", [10**6, 0])
def test_pages_put_together_are_the_sorted_table(spark, deep_from):
    df = spark.range(103).selectExpr("id", "cast(id % 10 AS string) AS x").repartition(5)
    order = ordering.sort_order(df, "x", "desc", ["id"])
    want = [r.id for r in df.orderBy(*order).collect()]
    got = [
        r.id
        for page in range(5)
        for r in ordering.paginate(df, order, page, 25, deep_from).collect()
    ]
    assert got == want
    assert ordering.paginate(df, order, 5, 25, deep_from).count() == 0
    assert tuple(ordering.page_count(df, 25).first()) == (103, 5)


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "stored")
    rows = spark.range(2000).selectExpr("id", "cast(id % 7 AS string) AS x", "if(id % 3 = 0, 1, id % 5) AS y", "repeat('z', 50) AS wide")
    rows.unionAll(rows.where("id < 3")).repartition(9).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("deep_from", [10**6, 0])
@pytest.mark.parametrize("filtered", [False, True])
def test_pages_of_stored_rows(spark, stored, deep_from, filtered):
    df = stored.filter("y = 1").select("x", "id", "wide") if filtered else stored
    order = ordering.sort_order(df, "x", "asc")
    size = 97
    pages = [ordering.paginate(df, order, k, size, deep_from).collect() for k in range(df.count() // size + 2)]
    assert [len(p) for p in pages[:-2]] == [size] * (len(pages) - 2) and pages[-1] == []
    got = [r for p in pages for r in p]
    assert sorted(got) == sorted(df.collect()) and [r.x for r in got] == sorted(r.x for r in got)


def test_two_deep_pages_are_one_sort(stored, monkeypatch):
    built = []
    build = ranks.RankIndex.build.__func__
    monkeypatch.setattr(ranks.RankIndex, "build", classmethod(lambda cls, *a: built.append(1) or build(cls, *a)))
    first = ordering.paginate(stored, ordering.sort_order(stored, "x"), 3, 20, deep_from=0)
    second = ordering.paginate(stored, ordering.sort_order(stored, "x"), 7, 20, deep_from=0)
    assert len(built) == 1 and first.count() == second.count() == 20
    ordering.paginate(stored, ordering.sort_order(stored, "y"), 7, 20, deep_from=0)
    assert len(built) == 2
    # of the table, a page reads the files of its rows; it sorts those rows only
    plan = plan_text(first)
    assert "BroadcastHashJoin" in plan and "rangepartitioning(_rank" in plan and "rangepartitioning(x" not in plan
    assert "file_path" in plan.split("PartitionFilters")[0]


def test_indexes_hold_places_and_are_removed(spark, stored, monkeypatch):
    ranks.forget_indexes()
    monkeypatch.setattr(ranks, "MOST_INDEXES", 1)
    page = ordering.paginate(stored, ordering.sort_order(stored, "x"), 3, 20, deep_from=0)
    (kept,) = [index for _, index in ranks._INDEXES.values()]
    assert set(spark.read.parquet(kept.path).columns) == {*ranks.PLACE, "_rank"}
    ordering.paginate(stored, ordering.sort_order(stored, "y"), 3, 20, deep_from=0)
    assert not Path(kept.path).exists() and len(ranks._INDEXES) == 1
    assert page.count() == 20  # a page does not need the index any more
    ranks.forget_indexes()
    assert not ranks._INDEXES
    with pytest.raises(ValueError, match="shared folder"):
        session.remove(spark, "/somewhere/else")


def test_rows_without_a_place_are_indexed_whole(spark, stored):
    grouped = stored.groupBy("x", "y").count()
    assert ranks.located(grouped) is None and ranks.located(stored.join(stored.limit(1), "id")) is None
    assert ranks.located(stored.select("id", F.explode(F.array("x", "y")))) is None
    order = ordering.sort_order(grouped, "y", "asc", ["x"])
    got = [r for k in range(6) for r in ordering.paginate(grouped, order, k, 7, deep_from=0).collect()]
    assert got == grouped.orderBy(*order).collect()[:42]


def test_an_index_follows_the_files(spark, stored, tmp_path):
    order = ordering.sort_order(stored, "id", "asc")
    assert ordering.paginate(stored, order, 1, 10, deep_from=0).count() == 10
    stored.limit(5).write.mode("append").parquet(str(tmp_path / "stored"))
    more = spark.read.parquet(str(tmp_path / "stored"))
    last = ordering.paginate(more, ordering.sort_order(more, "id", "asc"), 200, 10, deep_from=0)
    assert last.count() == 8


def test_a_selection_opens_the_files_it_needs(spark, clean, tmp_path):
    """Files opened before and after clustering; one region holds most rows."""
    many = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, "Hot").otherwise(F.concat(F.lit("R"), F.col("id") % 20)).alias("region"),
        (2000 + F.col("id") % 11).cast("int").alias("infra_year"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("T"), F.col("id") % 5)).alias("type_of_work"),
        F.lit("Low").alias("cost_category"),
        F.concat(F.lit("G"), "id").alias("global_id"),
    )
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    many.repartition(24).write.parquet(plain)
    layout.write_clustered(many, clustered, 24)
    sizes = [r.rows for r in spark.read.parquet(f"{clustered}/spans").collect()]
    assert len(sizes) == 24 and sum(sizes) == 6000 and max(sizes) < 1000  # "Hot" has 4000 rows
    for selected in (
        filters.ProjectFilter(region="R3"),
        filters.ProjectFilter(region="Hot", year=2004),
        filters.ProjectFilter(region="Hot", year="2004", work_type="T2", cost_category="Low"),
        filters.ProjectFilter(work_type="T1"),
        filters.ProjectFilter(region="none"),
        None,
    ):
        want = filters.apply_filter(spark.read.parquet(plain), selected)
        got = layout.read_clustered(spark, clustered, selected)
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
        opened = len(layout.files_for(spark, clustered, selected))
        if selected and selected.region:
            assert opened <= 4 and len({r.f for r in want.select(F.input_file_name().alias("f")).collect()}) >= opened


SELECTIONS = [
    None,
    filters.ProjectFilter(year=2021, work_type="Pump"),
]


@pytest.mark.parametrize("selected", SELECTIONS)
def test_the_cube_answers_as_the_table(clean, selected):
    cubed = cube.cube(clean.unionAll(clean).unionAll(clean.limit(0))).cache()
    table = clean.unionAll(clean).cache()
    questions = [
        breakdowns.kpi_overview, breakdowns.by_year, breakdowns.by_work_type, breakdowns.by_cost_category,
        breakdowns.by_region, breakdowns.by_province, breakdowns.by_contractor, breakdowns.year_series,
        breakdowns.work_type_shares, breakdowns.cost_category_shares, breakdowns.region_bars,
        breakdowns.province_bars, breakdowns.contractor_bars,
    ]
    for ask in questions:
        assert ask(cubed, selected).collect() == ask(table, selected).collect(), ask.__name__
    assert {k: v.collect() for k, v in breakdowns.facets(cubed).items()} == {
        k: v.collect() for k, v in breakdowns.facets(table).items()
    }
    assert cubed.count() <= clean.count() and cube.cube(clean.limit(0)).count() == 0


def test_top_k_cuts_ties_in_a_fixed_order(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2), (None, 1)], "k string, n int")
    assert column(ordering.top_k(df.repartition(3), "n", 2, ["k"]), "k") == ["c", "a"]


def test_explorer(clean):
    shown = ordering.explore(clean, k=2)
    assert column(shown, "contract_cost") == [2e8, 3e7]
    cells = ordering.explorer_cells(shown).first()
    assert cells.cost_millions == 200.0 and cells.region == "South"
