from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from worksledger import session  # noqa: E402
from worksledger.schemas import RAW_SCHEMA  # noqa: E402

SMALL = "/root/testdata/sf0.001"

BASE = {
    "ProjectID": "P1",
    "ProjectComponentID": "C1",
    "ContractID": "K1",
    "GlobalID": "G1",
    "Region": "North",
    "Province": "Upper",
    "ProjectDescription": "dike",
    "TypeofWork": "Dike",
    "Contractor": "Acme",
    "ABC": 2_000_000.0,
    "ContractCost": 1_000_000.0,
    "InfraYear": 2020.0,
    "FundingYear": "2020",
    "StartDate": "2020-01-01",
    "CompletionDateActual": "2020-03-01",
    "EditDate": "2021-01-01",
    "Longitude": 120.0,
    "Latitude": 10.0,
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    checkpoint = tmp_path_factory.mktemp("shared")
    s = (
        session.builder("tests")
        .master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(checkpoint))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def raw_rows(spark):
    """Build raw records from partial dicts over a complete base record."""

    def build(*rows: dict):
        full = [BASE | r for r in rows]
        return spark.createDataFrame(
            [tuple(r.get(f.name) for f in RAW_SCHEMA.fields) for r in full], RAW_SCHEMA
        )

    return build


def column(df, name):
    return [r[name] for r in df.collect()]


def plan_text(df) -> str:
    """The physical plan as Spark prints it."""
    from contextlib import redirect_stdout
    from io import StringIO

    out = StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()
