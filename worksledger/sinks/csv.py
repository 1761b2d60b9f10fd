"""CSV export."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worksledger.functions import plain_number

# A field is quoted only when it has to be, a quote inside is doubled,
# NULL and empty text are both empty, blanks are kept.
_FORMAT = {
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
#: A result that cannot have more rows than this (a top-k) is a single part.
ONE_PART_ROWS = 100_000


def export_csv(df: DataFrame, path: str) -> bool:
    """Write the rows as CSV; without rows nothing is written (returns False).

    The parts in the order of their names are one CSV with one header, in the order
    of the rows: the header is a row of its own before the others, so it is in the
    first part alone (a reader that takes each part for a CSV of its own must not
    expect one in the others). The rows are computed once, while they are written,
    beside ``path``; the folder is put in place when it is complete, and what was
    there before stays if there are no rows.
    """
    spark = df.sparkSession
    floating = (T.DoubleType, T.FloatType)
    names = df.columns
    text = [
        plain_number(f.name).alias(f.name) if isinstance(f.dataType, floating) else F.col(f.name)
        for f in df.schema.fields
    ]
    written = Observation()
    lines = df.select(F.to_csv(F.struct(*text), _FORMAT).alias("value"))
    counted = lines.observe(written, F.count(F.lit(1)).alias("rows"))
    titles = F.struct(*[F.lit(name).alias(f"c{k}") for k, name in enumerate(names)])
    header = spark.range(0, 1, 1, 1).select(F.to_csv(titles, _FORMAT).alias("value"))
    every = header.union(counted)
    most = df._jdf.queryExecution().optimizedPlan().maxRows()
    if most.isDefined() and most.get() <= ONE_PART_ROWS:
        every = every.coalesce(1)
    base = path.rstrip("/")
    beside = f"{base}-{uuid.uuid4().hex}"
    every.write.text(beside)
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(beside), hadoop.Path(base)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not written.get["rows"]:
        files.delete(source, True)
        return False
    files.delete(target, True)
    if not files.rename(source, target):
        raise OSError(f"{beside} could not be renamed to {base}")
    return True
