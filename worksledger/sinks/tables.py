"""Parquet outputs."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from worksledger.session import shuffles_removed


class Landed(NamedTuple):
    """A written table, read back, and the number of rows that were written."""

    table: DataFrame
    rows: int


def materialise(df: DataFrame, path: str, cluster_by: Sequence[str] = ()) -> Landed:
    """Replace the table at ``path`` and read it back.

    ``cluster_by`` sorts inside each task (no shuffle), so that row groups and
    pages cover few values and filters on those columns skip the rest. Rows are
    counted while they are written, not by another pass.
    """
    return materialise_parts([df], path, cluster_by)


def materialise_parts(parts: Iterable[DataFrame], path: str, cluster_by: Sequence[str] = ()) -> Landed:
    """The same for the rows of all parts, which are written one after another.

    Shuffle files of a part are removed when it is written, so that the disks hold those of
    one part at a time. A job that dies leaves the parts that it has written; the next one
    replaces them.
    """
    rows = 0
    for k, df in enumerate(parts):
        writer, written = _writer(df, cluster_by, "append" if k else "overwrite")
        with shuffles_removed(df.sparkSession):
            writer.parquet(path)
        rows += written.get["rows"]
    # the schema is known, so no footer has to be read for it
    return Landed(df.sparkSession.read.schema(df.schema).parquet(path), rows)


def replace_table(df: DataFrame, base: str, cluster_by: Sequence[str] = ()) -> Landed:
    """Write a new version of the table at ``base`` and make it the current one.

    Every version has a folder of its own, and a line appended to ``base/current`` names
    the one that counts: readers see the old table or the new one, and a job that dies
    while it writes changes nothing. A table may be replaced by a result computed from
    itself. Of two writers at a time the one that ends last wins. Older versions stay
    until ``drop_versions``, as readers may still be at them.
    """
    folder = f"{base.rstrip('/')}/versions/{uuid.uuid4().hex}"
    landed = materialise(df, folder, cluster_by)
    line = df.sparkSession.range(0, 1, 1, 1).select(F.lit(folder).alias("folder"), F.current_timestamp().alias("at"))
    line.write.mode("append").parquet(f"{base.rstrip('/')}/current")
    return landed


def current_folder(spark: SparkSession, base: str) -> str:
    """Where the current version of a table written by ``replace_table`` lies."""
    lines = spark.read.schema("folder string, at timestamp").parquet(f"{base.rstrip('/')}/current")
    return lines.agg(F.max_by("folder", F.struct("at", "folder"))).first()[0]


def current_table(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(current_folder(spark, base))


def drop_versions(spark: SparkSession, base: str) -> int:
    """Remove all versions that were current before; returns their number.

    Folders that no line names belong to writers at work, or to jobs that died; they stay.
    """
    now = current_folder(spark, base)
    lines = spark.read.schema("folder string, at timestamp").parquet(f"{base.rstrip('/')}/current")
    removed = 0
    for row in lines.select("folder").where(F.col("folder") != now).toLocalIterator():  # a line per version
        place = spark._jvm.org.apache.hadoop.fs.Path(row.folder)
        removed += place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return removed


def create_table(df: DataFrame, name: str, cluster_by: Sequence[str] = ()) -> Landed:
    """The same for a table of the session's catalog."""
    writer, written = _writer(df, cluster_by)
    writer.format("parquet").saveAsTable(name)
    return Landed(df.sparkSession.table(name), written.get["rows"])


def _writer(df: DataFrame, cluster_by: Sequence[str], mode: str = "overwrite") -> tuple[DataFrameWriter, Observation]:
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    ordered = counted.sortWithinPartitions(*cluster_by) if cluster_by else counted
    return ordered.write.mode(mode).option("compression", "snappy"), written


def export_parquet(tables: Mapping[str, DataFrame], out_dir: str) -> dict[str, DataFrame]:
    """Write each table below ``out_dir`` under its name and read it back.

    The tables are independent, so their jobs are submitted side by side and fill
    the cluster together. An ordered table keeps its order: Spark writes sort
    partitions as files in sequence, and the few rows of a summary end up in one.
    """
    base = out_dir.rstrip("/")
    with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
        jobs = {n: pool.submit(materialise, df, f"{base}/{n}") for n, df in tables.items()}
        return {n: job.result().table for n, job in jobs.items()}
