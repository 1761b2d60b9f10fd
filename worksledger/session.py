"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What the jobs rely on. Sizes are left to the cluster's own configuration.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    # one run compiles more than the default 100 stages, and a session that answers
    # interactive questions should not compile them again each time
    "spark.sql.codegen.cache.maxEntries": "1000",
    # a filter on a row number stays a limit on the map side for any k in use
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000000",
}


def builder(app_name: str = "worksledger") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024
MOST_SHUFFLE_PARTITIONS = 50_000
MOST_READ_TASKS = 200_000
# Stored bytes that one task sorts. Compressed columns grow up to 30 times as rows of
# text in memory, and a task may hold two such sorts, in a quarter of 6 GB or so.
SORTED_BYTES = 16 * 1024 * 1024


@contextmanager
def sized_for(spark: SparkSession, input_bytes: int, sorts: bool = False) -> Iterator[None]:
    """Partition counts that follow the input, within the block.

    Adaptive execution merges small shuffle partitions but never creates more, so
    the initial number has to fit the data; 200 partitions of 100 TB would be
    500 GB each. Read splits grow once 128 MB ones would be too many tasks (and
    output files). The session's own values are minimums and are put back.

    ``sorts`` is for jobs that sort whole rows: read splits and the shuffle partitions
    that adaptive execution merges are kept so small that a sort fits the memory of its
    task. Sorts that do not are written to disk, some ten times the stored bytes.
    """
    shuffles = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    splits = "spark.sql.files.maxPartitionBytes"
    merged = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {name: spark.conf.get(name, None) for name in (shuffles, splits, merged)}
    least = int(before[shuffles] or spark.conf.get("spark.sql.shuffle.partitions"))
    per_task = SORTED_BYTES // 8 if sorts else SHUFFLE_PARTITION_BYTES  # shuffled rows are wider than stored ones
    wanted = min(-(-input_bytes // per_task), MOST_SHUFFLE_PARTITIONS)
    spark.conf.set(shuffles, max(least, wanted))
    if sorts:
        spark.conf.set(merged, min(conf_bytes(spark, merged), SORTED_BYTES))
        spark.conf.set(splits, max(min(conf_bytes(spark, splits), SORTED_BYTES), -(-input_bytes // MOST_READ_TASKS)))
    elif input_bytes > MOST_READ_TASKS * SHUFFLE_PARTITION_BYTES:
        spark.conf.set(splits, -(-input_bytes // MOST_READ_TASKS))
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


# Stored bytes that a job with wide shuffles goes over at a time, and the most parts it
# makes of its input: each part reads the input again, so their number is bounded.
PART_BYTES = 64 * 1024 * 1024
MOST_PARTS = 8


def parts_for(input_bytes: int, part_bytes: int | None = None, most: int | None = None) -> int:
    return min(max(-(-input_bytes // (part_bytes or PART_BYTES)), 1), most or MOST_PARTS)


_REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that begin in the block are removed when each ends.

    Else they stay until the driver happens to collect its garbage, and those of all
    steps of a job lie on the disks together.
    """
    before = spark.conf.get(_REMOVED, None)
    if before == "true":
        yield
        return
    spark.conf.set(_REMOVED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVED)
        else:
            spark.conf.set(_REMOVED, before)


_UNITS = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def conf_bytes(spark: SparkSession, name: str) -> int:
    """A size in the session's settings, which may carry a unit ("64MB", "16m", "134217728b")."""
    text = spark.conf.get(name).lower().rstrip("b")
    return int(text[:-1]) * _UNITS[text[-1]] if text[-1] in _UNITS else int(text)


_UNKNOWN_BYTES = 1 << 60  # what a plan reports that does not know its size


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the stored files that a plan reads, by the optimizer's statistics."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size())]
    return sum(size for size in sizes if size < _UNKNOWN_BYTES)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session that names none (tests, a laptop) gets a temporary one; on a
    cluster such a folder would be another one on each machine, so that is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="worksledger-"))
        base = context.getCheckpointDir()
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten there."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder below the shared folder, and nothing else."""
    if not path.startswith(f"{shared_folder(spark)}/"):
        raise ValueError(f"{path} is not in the shared folder")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
