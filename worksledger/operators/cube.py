"""An additive cube of the clean table, from which the interactive questions are answered.

One row per combination of the dimensions that a user filters by, breaks down by or counts
distinct values of, with the number of projects and the parts of their exact cost. Counts
and costs of any selection are sums over its rows; distinct provinces or contractors are
those of the rows, as they are dimensions themselves. So a question reads the combinations
of a selection and not its projects, and gives the same answer to the last bit.

Every function of ``breakdowns`` takes the cube in place of the clean table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worksledger.functions import exact_sum, merged_sum, sum_parts

DIMENSIONS = ("region", "infra_year", "type_of_work", "cost_category", "province", "contractor")
COST = "contract_cost"
_PROJECTS = "cube_projects"


def cube(clean: DataFrame) -> DataFrame:
    """The cube; never more rows than projects, and a missing value is a value of its dimension.

    Partial sums are made before the shuffle, so a combination that most projects share is
    one row of each task.
    """
    return clean.groupBy(*DIMENSIONS).agg(F.count("*").alias(_PROJECTS), *sum_parts(COST))


def is_cube(df: DataFrame) -> bool:
    return _PROJECTS in df.columns


def projects(df: DataFrame) -> Column:
    """Number of projects in a group of rows, of the clean table or of its cube."""
    return F.sum(_PROJECTS) if is_cube(df) else F.count("*")


def total_cost(df: DataFrame) -> Column:
    return merged_sum(COST) if is_cube(df) else exact_sum(COST)


def cost_parts(df: DataFrame) -> list[Column]:
    """What a coarser grouping needs to take ``merged_sum`` and ``merged_avg`` of the cost."""
    if not is_cube(df):
        return sum_parts(COST)
    names = [c for c in df.columns if c.startswith(f"{COST}_")]
    return [F.sum(c).alias(c) for c in names]
