"""Fixed values of the data model.

Everything in this module must equal what existing data, files and users of
these tables expect; it is data, not logic. Each value is the default of a
parameter somewhere in the package, so another dataset can bring its own.
"""

from __future__ import annotations

# --- fixed values: raw text attribute -> clean column ------------------------
IDENTIFIER_COLUMNS = {
    "ProjectID": "project_id",
    "ProjectComponentID": "project_component_id",
    "ContractID": "contract_id",
    "GlobalID": "global_id",
}
LOCATION_COLUMNS = {
    "Region": "region",
    "Province": "province",
    "Municipality": "municipality",
    "LegislativeDistrict": "legislative_district",
}
DETAIL_COLUMNS = {
    "ProjectDescription": "project_description",
    "ProjectComponentDescription": "project_component_description",
    "TypeofWork": "type_of_work",
    "infra_type": "infra_type",
    "Program": "program",
}
OFFICE_COLUMNS = {
    "ImplementingOffice": "implementing_office",
    "DistrictEngineeringOffice": "district_engineering_office",
    "Contractor": "contractor",
}

# --- fixed values: cost classes (exclusive upper bound, label) ---------------
COST_CLASSES = (
    (1_000_000.0, "Small (<₱1M)"),
    (10_000_000.0, "Medium (₱1M-₱10M)"),
    (50_000_000.0, "Large (₱10M-₱50M)"),
    (100_000_000.0, "Very Large (₱50M-₱100M)"),
)
COST_CLASS_ABOVE = "Mega (₱100M+)"
COST_CLASS_UNKNOWN = "Unknown"

# --- fixed values: bounding box of valid coordinates (inclusive) -------------
LATITUDE_RANGE = (4.5, 21.5)
LONGITUDE_RANGE = (116.0, 127.0)

# --- fixed values: columns profiled on the raw table -------------------------
NULL_PROFILE_COLUMNS = (
    "InfraYear",
    "Region",
    "Province",
    "Municipality",
    "TypeofWork",
    "ContractCost",
    "Contractor",
    "Longitude",
    "Latitude",
)

# --- fixed values: quality flags of the clean table --------------------------
COMPLETENESS_FLAGS = (
    "has_cost_data",
    "has_contractor",
    "has_start_date",
    "has_completion_date",
    "is_valid_coordinates",
)

# --- fixed values: published datasets ----------------------------------------
CLEAN_FILE = "flood_control_cleaned.parquet"
REGION_FILE = "summary_by_region.parquet"
WORK_TYPE_FILE = "summary_by_work_type.parquet"
YEAR_FILE = "summary_by_year.parquet"
CONTRACTOR_FILE = "summary_top_contractors.parquet"
MANIFEST_FILE = "manifest.json"
MANIFEST_VERSION = "1.0.0"
DESCRIPTIONS = {
    CLEAN_FILE: "Full cleaned dataset",
    REGION_FILE: "Aggregated by region",
    WORK_TYPE_FILE: "Aggregated by work type",
    YEAR_FILE: "Aggregated by infrastructure year",
    CONTRACTOR_FILE: "Top 100 contractors by project count",
}
VIEWS = {
    "flood_control": CLEAN_FILE,
    "summary_region": REGION_FILE,
    "summary_work_type": WORK_TYPE_FILE,
    "summary_year": YEAR_FILE,
    "summary_contractors": CONTRACTOR_FILE,
}

# --- fixed values: columns offered by the project explorer -------------------
EXPLORER_COLUMNS = (
    "project_id",
    "project_description",
    "region",
    "province",
    "contractor",
    "contract_cost",
    "infra_year",
    "type_of_work",
    "cost_category",
)
SEARCH_COLUMNS = ("project_description", "contractor", "province")

# --- fixed values: limits ----------------------------------------------------
TOP_CONTRACTORS = 100
TOP_WORK_TYPES = 8
TOP_PROVINCES = 20
TOP_CONTRACTORS_SCREEN = 25
TOP_DISTRIBUTION = 10
EXPLORER_ROWS = 500
PAGE_SIZE = 20
CONTRACTOR_LABEL_CHARS = 35
EXPLORER_CELL_CHARS = {"project_description": 60, "contractor": 25, "type_of_work": 20}

# --- fixed values: data-quality thresholds -----------------------------------
REQUIRED_COLUMNS = (
    "project_id",
    "region",
    "province",
    "contract_cost",
    "approved_budget",
    "infra_year",
    "type_of_work",
    "longitude",
    "latitude",
)
ZERO_NULL_COLUMNS = ("project_component_id", "region", "infra_year")
ROW_COUNT_RANGE = (9_000, 10_000)
YEAR_RANGE = (2015, 2026)
REGION_COUNT_RANGE = (5, 20)
MAX_OUT_OF_BOUNDS_PCT = 5.0
RATIO_RANGE = (0.1, 2.0)
MAX_EXTREME_RATIO_PCT = 10.0
OVER_BUDGET_FACTOR = 1.5
MAX_OVER_BUDGET_PCT = 5.0
MIN_OUTPUT_BYTES = 1024 * 1024
