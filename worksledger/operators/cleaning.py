"""Raw attributes to the 34-column clean table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worksledger import constants as C
from worksledger.functions import (
    bucketize,
    coalesce_zero,
    cost_variance,
    duration_days,
    in_bbox,
    is_filled,
    is_positive,
    safe_ratio,
    strip_spaces,
    to_int,
    try_date,
)
from worksledger.operators.dedup import dedup_latest, in_parts, require_not_null
from worksledger.schemas import CLEAN_SCHEMA

KEY = "ProjectComponentID"
EDITED = "EditDate"


@dataclass(frozen=True)
class CleaningRules:
    """What may differ between datasets."""

    cost_classes: Sequence[tuple[float, str]] = C.COST_CLASSES
    cost_class_above: str = C.COST_CLASS_ABOVE
    cost_class_unknown: str = C.COST_CLASS_UNKNOWN
    lat_range: tuple[float, float] = C.LATITUDE_RANGE
    lon_range: tuple[float, float] = C.LONGITUDE_RANGE
    normalise_key: bool = False
    tie_breakers: Sequence[Column] | None = None


def default_tie_breakers(prefix: str = "") -> list[Column]:
    """Makes the choice between edits of the same date a fixed one."""
    return [
        F.col(f"{prefix}GlobalID").asc_nulls_last(),
        F.col(f"{prefix}CompletionDateActual").asc_nulls_last(),
        F.col(f"{prefix}ContractCost").desc_nulls_last(),
        F.col(f"{prefix}ABC").desc_nulls_last(),
    ]


def quality_flags(df: DataFrame) -> DataFrame:
    """Adds the four has_* flags to raw rows; none of them is ever NULL."""
    return df.withColumns(
        {
            "has_cost_data": is_positive("ContractCost"),
            "has_contractor": is_filled("Contractor"),
            "has_start_date": try_date("StartDate").isNotNull(),
            "has_completion_date": try_date("CompletionDateActual").isNotNull(),
        }
    )


# What the choice between edits looks at, unless other tie-breakers are given.
_CHOSEN_BY = (KEY, EDITED, "GlobalID", "CompletionDateActual", "ContractCost", "ABC")


def latest_projects(
    raw: DataFrame,
    rules: CleaningRules = CleaningRules(),
    attributes: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The newest edit of every project component that has a key and a region.

    The key test commutes with the ranking and goes first, so rows without a key
    are dropped at the scan. The region test does not: a project whose newest
    edit lacks a region is dropped even if an older edit has one.

    ``attributes``, if given, are the raw attributes as expressions over the columns
    of ``raw``. Only what the choice looks at is computed before its shuffle, the rest
    from the rows chosen, so that the shuffle moves the columns of the source.
    """
    if attributes is None:
        ties = default_tie_breakers() if rules.tie_breakers is None else rules.tie_breakers
        keyed = require_not_null(raw, [KEY])
        newest = dedup_latest(keyed, [KEY], EDITED, ties, rules.normalise_key)
        return require_not_null(newest, ["Region"])
    if rules.tie_breakers is not None:  # they may name any attribute
        return latest_projects(raw.select(*[e.alias(n) for n, e in attributes.items()]), rules)
    early = {f"_{name}": attributes[name] for name in _CHOSEN_BY}
    keyed = require_not_null(raw.withColumns(early), [f"_{KEY}"])
    newest = dedup_latest(
        keyed, [f"_{KEY}"], f"_{EDITED}", default_tie_breakers("_"), rules.normalise_key
    )
    found = [F.col(f"_{n}").alias(n) if n in _CHOSEN_BY else e.alias(n) for n, e in attributes.items()]
    return require_not_null(newest.select(*found), ["Region"])


def clean_projects(
    raw: DataFrame,
    rules: CleaningRules = CleaningRules(),
    attributes: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One lazy plan: newest edits, then every cleaned and derived column."""
    text = C.IDENTIFIER_COLUMNS | C.LOCATION_COLUMNS | C.DETAIL_COLUMNS | C.OFFICE_COLUMNS
    values = {clean: strip_spaces(name) for name, clean in text.items()}
    values |= {
        "approved_budget": coalesce_zero("ABC"),
        "contract_cost": coalesce_zero("ContractCost"),
        "cost_variance": cost_variance("ContractCost", "ABC"),
        "cost_efficiency_ratio": safe_ratio("ContractCost", "ABC"),
        "cost_category": bucketize(
            "ContractCost", rules.cost_classes, rules.cost_class_above, rules.cost_class_unknown
        ),
        "infra_year": to_int("InfraYear"),
        "funding_year": strip_spaces("FundingYear"),
        "completion_year": to_int("CompletionYear"),
        "longitude": F.col("Longitude").cast("double"),
        "latitude": F.col("Latitude").cast("double"),
        "is_valid_coordinates": in_bbox(
            "Latitude", "Longitude", rules.lat_range, rules.lon_range
        ),
        "has_cost_data": is_positive("ContractCost"),
        "has_contractor": is_filled("Contractor"),
        # the dates are parsed once, here, and reused by the outer projection
        "start_date": try_date("StartDate"),
        "actual_completion_date": try_date("CompletionDateActual"),
    }
    parsed = latest_projects(raw, rules, attributes).select(
        *[expr.alias(name) for name, expr in values.items()]
    )
    return parsed.withColumns(
        {
            "duration_days": duration_days("start_date", "actual_completion_date"),
            "has_start_date": F.col("start_date").isNotNull(),
            "has_completion_date": F.col("actual_completion_date").isNotNull(),
        }
    ).select(*CLEAN_SCHEMA.names)


def clean_parts(
    raw: DataFrame,
    n: int,
    rules: CleaningRules = CleaningRules(),
    attributes: Mapping[str, Column] | None = None,
) -> list[DataFrame]:
    """The rows of ``clean_projects`` in n tables, all edits of a component in one of them."""
    key = F.col(KEY) if attributes is None else attributes[KEY]
    return [clean_projects(part, rules, attributes) for part in in_parts(raw, [key], n, rules.normalise_key)]
