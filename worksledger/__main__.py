"""Run the jobs from the command line; exits with 1 when a check or stage failed.

    spark-submit ... worksledger/__main__.py publish SRC OUT --layout lines
    python -m worksledger ingest SRC RAW
    python -m worksledger transform RAW DIR
    python -m worksledger export DIR OUT
    python -m worksledger verify OUT

The stages pass their state through Parquet folders: ``transform`` writes the
clean table and the summaries below DIR, ``export`` copies those with a manifest.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from worksledger import constants as C
from worksledger import session
from worksledger.operators.quality import Thresholds, quality_report
from worksledger.plans import jobs
from worksledger.sinks import export_parquet


def _show(df: DataFrame) -> None:
    df.show(100, truncate=False)


def _tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {file: spark.read.parquet(f"{folder}/{file}") for file in C.VIEWS.values()}


def _ingest(spark: SparkSession, args: argparse.Namespace) -> bool:
    for table in jobs.ingest(spark, args.src, args.out, layout=args.layout).profile.values():
        _show(table)
    return True


def _transform(spark: SparkSession, args: argparse.Namespace) -> bool:
    result = jobs.transform(spark.read.parquet(args.src), f"{args.out}/{C.CLEAN_FILE}")
    export_parquet(result.summaries, args.out)
    for table in result.profile.values():
        _show(table)
    return True


def _export(spark: SparkSession, args: argparse.Namespace) -> bool:
    jobs.export(_tables(spark, args.src), args.out, args.source)
    return True


def _verify(spark: SparkSession, args: argparse.Namespace) -> bool:
    tables = _tables(spark, args.out)
    checks = jobs.verify(tables[C.CLEAN_FILE], tables, args.out, expected=_expected(args))
    _show(checks)
    report = quality_report(checks)
    _show(report)
    return report.first()["failed"] == 0


def _publish(spark: SparkSession, args: argparse.Namespace) -> bool:
    report = jobs.publish(
        spark,
        args.src,
        args.out,
        args.source,
        layout=args.layout,
        expected=_expected(args),
        promote=args.promote,
    )
    report.show(truncate=False, vertical=True)
    return report.first()["status"] == "SUCCESS"


def _expected(args: argparse.Namespace) -> Thresholds:
    return Thresholds(row_bounds=(args.min_rows, args.max_rows))


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="worksledger")
    stages = parser.add_subparsers(required=True)

    def stage(name, run, *paths):
        sub = stages.add_parser(name)
        for path in paths:
            sub.add_argument(path)
        sub.set_defaults(run=run)
        return sub

    reads = [stage("publish", _publish, "src", "out"), stage("ingest", _ingest, "src", "out")]
    stage("transform", _transform, "src", "out")
    names = [reads[0], stage("export", _export, "src", "out")]
    checks = [reads[0], stage("verify", _verify, "out")]
    for sub in reads:
        sub.add_argument("--layout", choices=["collection", "lines"], default="collection")
    for sub in names:
        sub.add_argument("--source", default="")
    for sub in checks:
        sub.add_argument("--min-rows", type=int, default=C.ROW_COUNT_RANGE[0])
        sub.add_argument("--max-rows", type=int, default=C.ROW_COUNT_RANGE[1])
    reads[0].add_argument("--promote", choices=["on_pass", "always"], default="on_pass")
    return parser


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = session.builder().getOrCreate()
    return 0 if args.run(spark, args) else 1


if __name__ == "__main__":
    sys.exit(main())
