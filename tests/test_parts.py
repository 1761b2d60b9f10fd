"""Large tables are gone over in parts: the same rows, and one part at a time on the disks."""

from __future__ import annotations

import re
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from parity import queries, tables
from tests.conftest import SMALL
from worksledger import session
from worksledger.operators import cleaning, dedup
from worksledger.operators.cleaning import CleaningRules, clean_projects
from worksledger.plans.jobs import transform
from worksledger.sinks import materialise, materialise_parts


@pytest.fixture
def given(spark):
    return tables.Given(spark, SMALL)


@pytest.fixture
def in_fives(monkeypatch):
    monkeypatch.setattr(session, "PART_BYTES", 1)
    monkeypatch.setattr(session, "MOST_PARTS", 5)


def rows(df):
    return sorted(df.collect(), key=str)


def shuffles(spark) -> set[int]:
    """Shuffles that have files."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(k).getName() for k in range(files.size())]
    return {int(m[1]) for name in names if (m := re.match(r"shuffle_(\d+)_", name))}


def later_shuffles(spark, before: set[int]) -> set[int]:
    for _ in range(50):  # files are removed in the background
        left = {k for k in shuffles(spark) if k > max(before, default=-1)}
        if not left:
            break
        time.sleep(0.2)
    return left


def test_number_of_parts():
    assert [session.parts_for(n, 10, 4) for n in (0, 10, 11, 40, 10**9)] == [1, 1, 2, 4, 4]
    assert session.parts_for(session.PART_BYTES) == 1 < session.parts_for(10**18) == session.MOST_PARTS


def test_parts_keep_keys_together_and_lose_no_row(spark):
    df = spark.range(200).select("id", F.when(F.col("id") % 7 != 0, F.concat(F.lit(" k"), F.col("id") % 30)).alias("key"))
    parts = dedup.in_parts(df, ["key"], 4)
    assert rows(parts[0].union(parts[1]).union(parts[2]).union(parts[3])) == rows(df)
    of = [{r.key for r in p.collect()} for p in parts]
    assert sum(map(len, of)) == len(set().union(*of)) == 31
    assert dedup.in_parts(df, ["key"], 1) == [df]
    padded = spark.createDataFrame([(f"{' ' * k}k{k % 5}",) for k in range(40)], "key string")
    of = [{r.key.strip() for r in p.collect()} for p in dedup.in_parts(padded, ["key"], 3, normalise_key=True)]
    assert sum(map(len, of)) == 5


@pytest.mark.parametrize("normalise", [False, True])
@pytest.mark.parametrize("from_source", [False, True])
def test_clean_rows_of_parts(given, in_fives, tmp_path, normalise, from_source):
    rules = CleaningRules(normalise_key=normalise)
    attributes = tables.raw_attributes() if from_source else None
    done = transform(given.source if from_source else given.lazy_raw, str(tmp_path / "clean"), rules, attributes)
    want = rows(clean_projects(given.lazy_raw, rules))
    assert rows(done.clean) == want and done.rows == len(want)


def test_given_tables_of_parts(given, in_fives):
    assert rows(given.raw) == rows(given.lazy_raw)
    assert rows(given.clean) == rows(clean_projects(given.lazy_raw))


def test_newest_edits_of_parts(given, in_fives):
    want = dedup.dedup_latest(given.lazy_raw, [cleaning.KEY], cleaning.EDITED, cleaning.default_tie_breakers())
    assert rows(queries._dedup_latest(given)) == rows(want)


def test_collections_are_read_and_removed_in_parts(spark, given, monkeypatch):
    monkeypatch.setattr(queries, "TEXT_PART_BYTES", 50_000)
    shared = Path(session.shared_folder(spark).removeprefix("file:"))
    most, made, of = [0], [], tables.Given.collections_of
    before = set(shared.glob("collections-*"))

    def watched(self, source):
        made.append(of(self, source))
        most.append(len(set(shared.glob("collections-*")) - before))
        return made[-1]

    monkeypatch.setattr(tables.Given, "collections_of", watched)
    got = queries._read_geojson_splits(given)
    assert len(made) > 1 and max(most) == 1
    assert set(shared.glob("collections-*")) == before
    assert rows(got) == rows(given.lazy_raw)


def test_shuffle_files_go_with_the_part(spark, tmp_path):
    before = shuffles(spark)
    parts = [spark.range(1000).repartition(3, "id").groupBy((F.col("id") % k).alias("x")).count() for k in (7, 5)]
    done = materialise_parts(parts, str(tmp_path / "t"), ["x"])
    assert later_shuffles(spark, before) == set()
    assert done.rows == done.table.count() == 12


def test_a_table_is_replaced_not_added_to(spark, tmp_path):
    path = str(tmp_path / "t")
    materialise_parts([spark.range(5), spark.range(3)], path)
    assert materialise(spark.range(4), path).table.count() == 4


def test_settings_are_put_back(spark):
    before = spark.conf.get(session._REMOVED, None)
    with session.shuffles_removed(spark):
        assert spark.conf.get(session._REMOVED) == "true"
        with session.shuffles_removed(spark):
            pass
        assert spark.conf.get(session._REMOVED) == "true"
    assert spark.conf.get(session._REMOVED, None) == before
