"""Run a registered query and its SQL on the same files and compare the rows."""

from __future__ import annotations

from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from parity.oracle import oracle_sql
from parity.queries import queries


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


_TYPES = {"VARCHAR": "string", "INTEGER": "int"}


def types(con: duckdb.DuckDBPyConnection, sql: str) -> dict[str, str]:
    """Column types of a SQL result, as Spark names them."""
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    return {row[0]: _TYPES.get(row[1], row[1].lower()) for row in described}


def _sortable(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in row)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    rows = [tuple(r[n] for n in names) for r in df.collect()]
    return names, sorted(rows, key=_sortable)


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    rows = [tuple(r[i] for i in at) for r in result.fetchall()]
    return names, sorted(rows, key=_sortable)


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str:
    """Empty when the results are equal."""
    df, sql = queries()[name](spark, sf_dir), oracle_sql()[name]
    if dict(df.dtypes) != types(con, sql):
        return f"columns {dict(df.dtypes)} instead of {types(con, sql)}"
    _, got = spark_rows(df)
    _, want = sql_rows(con, sql)
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""
