"""Schemas of the raw attributes and of the clean table."""

from __future__ import annotations

from pyspark.sql import types as T

from worksledger import constants as C


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _double(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


# The attributes the cleaning step reads. Declaring them saves the full pass
# that inference costs, and keeps types from flipping between two loads.
RAW_SCHEMA = T.StructType(
    _text(*C.IDENTIFIER_COLUMNS, *C.LOCATION_COLUMNS, *C.DETAIL_COLUMNS, *C.OFFICE_COLUMNS)
    + _double("ABC", "ContractCost", "InfraYear", "CompletionYear")
    + _text("FundingYear", "StartDate", "CompletionDateActual", "EditDate")
    + _double("Longitude", "Latitude")
)

CLEAN_SCHEMA = T.StructType(
    _text(
        *C.IDENTIFIER_COLUMNS.values(),
        *C.LOCATION_COLUMNS.values(),
        *C.DETAIL_COLUMNS.values(),
        *C.OFFICE_COLUMNS.values(),
    )
    + _double("approved_budget", "contract_cost", "cost_variance", "cost_efficiency_ratio")
    + [
        T.StructField("cost_category", T.StringType()),
        T.StructField("infra_year", T.IntegerType()),
        T.StructField("funding_year", T.StringType()),
        T.StructField("completion_year", T.IntegerType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("actual_completion_date", T.DateType()),
        T.StructField("duration_days", T.LongType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("is_valid_coordinates", T.BooleanType()),
        T.StructField("has_cost_data", T.BooleanType()),
        T.StructField("has_contractor", T.BooleanType()),
        T.StructField("has_start_date", T.BooleanType()),
        T.StructField("has_completion_date", T.BooleanType()),
    ]
)
