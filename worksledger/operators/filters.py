"""Predicates of the interactive questions, as Columns that reach the scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worksledger import constants as C


@dataclass(frozen=True)
class ProjectFilter:
    """What a user has selected; None or '' means no restriction."""

    region: str | None = None
    year: int | str | None = None
    work_type: str | None = None
    cost_category: str | None = None

    def chosen(self) -> dict[str, str | int]:
        """Columns restricted to a value."""
        every = {
            "region": self.region,
            "infra_year": self._year(),
            "type_of_work": self.work_type,
            "cost_category": self.cost_category,
        }
        return {c: v for c, v in every.items() if v not in (None, "")}

    def conditions(self) -> list[Column]:
        return [F.col(c) == F.lit(v) for c, v in self.chosen().items()]

    def _year(self) -> int | None:
        if self.year in (None, ""):
            return None
        try:
            return int(self.year)
        except ValueError:
            raise ValueError(f"year must be a whole number, not {self.year!r}") from None


def apply_filter(df: DataFrame, selected: ProjectFilter | None) -> DataFrame:
    conditions = selected.conditions() if selected else []
    return df.filter(reduce(and_, conditions)) if conditions else df


def filter_projects(
    df: DataFrame,
    region: str | None = None,
    year: int | str | None = None,
    work_type: str | None = None,
    cost_category: str | None = None,
) -> DataFrame:
    return apply_filter(df, ProjectFilter(region, year, work_type, cost_category))


def search(df: DataFrame, term: str, cols: Sequence[str] = C.SEARCH_COLUMNS) -> DataFrame:
    """Rows in which any of the columns contains the term, whatever its case.

    ``%`` and ``_`` typed by the user are wildcards; a backslash is just a
    backslash, so it is doubled for Spark's LIKE.
    """
    wanted = term.strip()
    if not wanted:
        return df
    pattern = "%" + wanted.replace("\\", "\\\\") + "%"
    return df.filter(reduce(or_, [F.col(c).ilike(pattern) for c in cols]))


def drill_down(df: DataFrame, selected: ProjectFilter | None, region: str | None) -> DataFrame:
    """The selection narrowed to one region; no region leaves it as it is."""
    return filter_projects(apply_filter(df, selected), region=region)
