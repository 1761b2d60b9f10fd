"""A clustered layout of the clean table, and the files that a selection needs.

Rows are dealt over files in ranges of the filter columns. A value that more rows share than
a range holds would make one range of its own; a hash of the key at the end of the order cuts
it into as many as it needs. What each file spans is kept in a small table beside the data,
so that a selection opens the files it can match and no footers of others.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worksledger.operators.filters import ProjectFilter, apply_filter
from worksledger.session import SORTED_BYTES, sized_for, stored_bytes

CLUSTER = ("region", "infra_year", "type_of_work")
_DATA, _SPANS = "data", "spans"


def files_by_size(df: DataFrame) -> int:
    """Files of a clustered copy of df: one per task slot, and more where one task would sort too much."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return max(slots, -(-stored_bytes(df) // SORTED_BYTES))


def write_clustered(
    df: DataFrame, path: str, files: int, by: Sequence[str] = CLUSTER, key: str = "global_id"
) -> None:
    """Write df below path in `files` ranges of `by`, and the span of each file."""
    order = [*by, F.xxhash64(key)]
    ranged = df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    with sized_for(df.sparkSession, stored_bytes(df), sorts=True):
        ranged.write.mode("overwrite").parquet(f"{path}/{_DATA}")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/{_DATA}")
    bounds = [f(c).alias(f"{name}_{c}") for c in by for name, f in (("least", F.min), ("most", F.max))]
    nulls = [F.bool_or(F.col(c).isNull()).alias(f"null_{c}") for c in by]
    file = F.col("_metadata.file_path").alias("file")
    spans = stored.groupBy(file).agg(F.count("*").alias("rows"), *bounds, *nulls)
    spans.repartition(1).write.mode("overwrite").parquet(f"{path}/{_SPANS}")  # a row per file


def files_for(spark: SparkSession, path: str, selected: ProjectFilter | None, by: Sequence[str] = CLUSTER) -> list[str]:
    """Files whose spans can hold a selected row."""
    spans = spark.read.parquet(f"{path}/{_SPANS}")
    wanted = selected.chosen() if selected else {}
    inside = [F.lit(v).between(F.col(f"least_{c}"), F.col(f"most_{c}")) for c, v in wanted.items() if c in by]
    found = spans.where(reduce(and_, inside)) if inside else spans
    return sorted(r["file"] for r in found.select("file").collect())


def read_clustered(spark: SparkSession, path: str, selected: ProjectFilter | None = None) -> DataFrame:
    """The selected rows of a clustered table; only files that can hold one are opened."""
    whole = spark.read.parquet(f"{path}/{_DATA}")
    files = files_for(spark, path, selected)
    if not files:
        return whole.limit(0)
    return apply_filter(spark.read.schema(whole.schema).parquet(*files), selected)
