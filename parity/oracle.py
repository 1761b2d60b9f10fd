"""What every registered query must return, as SQL over the given tables."""

from __future__ import annotations

from worksledger import constants as C

_TEXT = C.IDENTIFIER_COLUMNS | C.LOCATION_COLUMNS | C.DETAIL_COLUMNS | C.OFFICE_COLUMNS
_RAW_TEXT = [*_TEXT, "FundingYear", "StartDate", "CompletionDateActual", "EditDate"]
_FILES = {"clean": C.CLEAN_FILE, "region": C.REGION_FILE, "type": C.WORK_TYPE_FILE,
          "year": C.YEAR_FILE, "contractor": C.CONTRACTOR_FILE}

# The cube and the clustered copy answer as the clean table does, a job returns what its parts do.
CUBE_QUERIES = tuple(
    f"cube_{name}"
    for name in (
        "kpi_overview", "kpi_overview_filtered", "by_year", "by_work_type_top8", "by_cost_category",
        "by_region", "by_province_drill_down", "by_contractor_top25", "facet_work_type", "year_series",
    )
)
SAME_QUERIES = {
    "ingest_job_regions": "value_distribution",
    "ingest_job_numbers": "numeric_profile",
    "transform_job_clean": "clean_projects",
    "transform_job_regions": "summary_by_region",
    "transform_job_work_types": "summary_by_work_type",
    "transform_job_contractors": "summary_top_contractors",
    "transform_job_cost_categories": "cost_category_distribution",
    "transform_job_completeness": "completeness",
    "export_job_clean": "clean_projects",
    "export_job_regions": "summary_by_region",
    "export_job_years": "summary_by_year",
    "filter_projects_clustered": "filter_projects",
}

_N = "CAST(COUNT(*) AS BIGINT)"


def _distinct(col: str) -> str:
    return f"CAST(COUNT(DISTINCT {col}) AS BIGINT)"


def _sum(col: str) -> str:
    """Of the doubles as they are, in units of 2**-60, so that the order of rows cannot show."""
    unit = float(1 << 60)
    return f"(CAST(SUM(CAST({col} * {unit!r} AS HUGEINT)) AS DOUBLE) / {unit!r})"


def _avg(col: str) -> str:
    return f"({_sum(col)} / COUNT({col}))"


def _pct(part: str, whole: str, digits: int) -> str:
    return f"CASE WHEN {whole} > 0 THEN ROUND(CAST({part} AS DOUBLE) / {whole} * 100, {digits}) END"


def _cost_class(col: str) -> str:
    steps = " ".join(f"WHEN {col} < {bound} THEN '{label}'" for bound, label in C.COST_CLASSES)
    return (
        f"CASE WHEN coalesce({col}, 0) = 0 THEN '{C.COST_CLASS_UNKNOWN}' {steps} "
        f"ELSE '{C.COST_CLASS_ABOVE}' END"
    )


_RAW = """
projects_raw AS MATERIALIZED (
  SELECT
    concat('P', l_orderkey) AS "ProjectID",
    CASE WHEN l_partkey % 211 <> 0
         THEN concat(' C', l_orderkey, '-', l_linenumber, ' ') END AS "ProjectComponentID",
    concat('K', l_suppkey, '-', l_partkey % 50) AS "ContractID",
    concat('G', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS "GlobalID",
    CASE WHEN l_partkey % 97 <> 0 THEN r_name END AS "Region",
    CASE WHEN l_linenumber = 2 THEN chr(160) || n_name ELSE n_name END AS "Province",
    concat(n_name, '-', l_linenumber) AS "Municipality",
    concat('District ', l_linenumber) AS "LegislativeDistrict",
    p_name AS "ProjectDescription",
    concat(p_name, ' ', p_brand) AS "ProjectComponentDescription",
    CASE WHEN l_partkey % 31 <> 0 THEN p_type END AS "TypeofWork",
    p_brand AS infra_type,
    o_orderpriority AS "Program",
    n_name AS "ImplementingOffice",
    concat(r_name, ' DEO') AS "DistrictEngineeringOffice",
    CASE WHEN l_suppkey % 29 = 0 THEN NULL WHEN l_suppkey % 23 = 0 THEN '   '
         ELSE s_name END AS "Contractor",
    CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 17 = 0 THEN 0.0::DOUBLE
         WHEN l_linenumber = 7 AND l_partkey % 5 = 0 THEN l_extendedprice * 500
         ELSE l_extendedprice * 1000 END AS "ABC",
    CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 19 = 0 THEN 0.0::DOUBLE
         ELSE l_extendedprice * (1 - l_discount) * 1000 END AS "ContractCost",
    CAST(year(l_shipdate) AS DOUBLE) AS "InfraYear",
    CAST(year(l_shipdate) AS DOUBLE) AS "CompletionYear",
    CAST(year(o_orderdate) AS VARCHAR) AS "FundingYear",
    CASE l_linenumber WHEN 5 THEN 'n/a'
         WHEN 6 THEN CAST(year(o_orderdate) AS VARCHAR)
         WHEN 4 THEN strftime(o_orderdate, '%Y/%m/%d')
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "StartDate",
    CASE WHEN l_partkey % 7 = 0 THEN ''
         ELSE strftime(l_shipdate, '%Y-%m-%d') END AS "CompletionDateActual",
    CASE WHEN l_quantity <> 50 THEN strftime(o_orderdate, '%Y-%m-%d') END AS "EditDate",
    CASE WHEN l_partkey % 41 <> 0 THEN 115.5::DOUBLE + l_suppkey % 12 END AS "Longitude",
    CASE WHEN l_partkey % 41 <> 0 THEN 4.5::DOUBLE + l_partkey % 18 END AS "Latitude"
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

_NEWEST = """
newest AS MATERIALIZED (
  SELECT * FROM projects_raw
  QUALIFY row_number() OVER (
    PARTITION BY "ProjectComponentID"
    ORDER BY "EditDate" DESC NULLS LAST, "GlobalID" NULLS LAST,
             "CompletionDateActual" NULLS LAST, "ContractCost" DESC NULLS LAST,
             "ABC" DESC NULLS LAST) = 1
)"""

_TRIMMED = ",\n    ".join(f'trim("{raw}") AS {clean}' for raw, clean in _TEXT.items())

_CLEAN = f"""
parsed AS (
  SELECT *, TRY_CAST("StartDate" AS DATE) AS began,
         TRY_CAST("CompletionDateActual" AS DATE) AS ended
  FROM newest WHERE "ProjectComponentID" IS NOT NULL AND "Region" IS NOT NULL
),
clean AS MATERIALIZED (
  SELECT
    {_TRIMMED},
    coalesce("ABC", 0) AS approved_budget,
    coalesce("ContractCost", 0) AS contract_cost,
    coalesce("ContractCost", 0) - coalesce("ABC", 0) AS cost_variance,
    CASE WHEN "ABC" > 0 THEN ROUND("ContractCost" / "ABC", 4) END AS cost_efficiency_ratio,
    {_cost_class('"ContractCost"')} AS cost_category,
    CAST("InfraYear" AS INTEGER) AS infra_year,
    trim("FundingYear") AS funding_year,
    CAST("CompletionYear" AS INTEGER) AS completion_year,
    began AS start_date,
    ended AS actual_completion_date,
    date_diff('day', began, ended) AS duration_days,
    "Longitude" AS longitude,
    "Latitude" AS latitude,
    coalesce("Latitude" BETWEEN 4.5 AND 21.5 AND "Longitude" BETWEEN 116 AND 127, false)
      AS is_valid_coordinates,
    coalesce("ContractCost" > 0, false) AS has_cost_data,
    coalesce(trim("Contractor") <> '', false) AS has_contractor,
    began IS NOT NULL AS has_start_date,
    ended IS NOT NULL AS has_completion_date
  FROM parsed
)"""

_EXPLORER = ", ".join(C.EXPLORER_COLUMNS)
_SELECTED = "region = 'ASIA' AND type_of_work = 'STANDARD'"
_BY_YEAR = "infra_year = 1999"
_FOUND = " OR ".join(f"{c} ILIKE '%ED r%g%'" for c in C.SEARCH_COLUMNS)
_TOP500 = "ORDER BY contract_cost DESC NULLS LAST, global_id LIMIT 500"


def _raw(sql: str) -> str:
    return f"WITH {_RAW}\n{sql}"


def _newest(sql: str) -> str:
    return f"WITH {_RAW},{_NEWEST}\n{sql}"


def _clean(sql: str, *more: str) -> str:
    return f"WITH {','.join([_RAW, _NEWEST, _CLEAN, *more])}\n{sql}"


def _breakdown(dimension: str, where: str = "true", cost: str = "total_cost", more: str = "") -> str:
    return (
        f"SELECT {dimension}, {_N} AS projects, ROUND({_sum('contract_cost')}, 0) AS {cost}{more} "
        f"FROM clean WHERE {where} GROUP BY {dimension}"
    )


def _billions(dimension: str) -> str:
    return (
        f"SELECT {dimension}, {_N} AS projects, "
        f"ROUND({_sum('contract_cost')} / 1e9, 2) AS total_cost_billions "
        f"FROM clean WHERE {dimension} IS NOT NULL GROUP BY {dimension}"
    )


def _kpi(where: str) -> str:
    return (
        f"SELECT {_N} AS total_projects, ROUND({_sum('contract_cost')}, 0) AS total_cost, "
        f"ROUND({_avg('contract_cost')}, 0) AS avg_cost, "
        f"{_distinct('contractor')} AS unique_contractors, {_distinct('region')} AS regions "
        f"FROM clean WHERE {where}"
    )


_BY_REGION_SUMMARY = f"""
SELECT region, {_N} AS total_projects, {_distinct('contractor')} AS unique_contractors,
       ROUND({_sum('contract_cost')}, 2) AS total_contract_cost,
       ROUND({_avg('contract_cost')}, 2) AS avg_contract_cost,
       ROUND({_sum('approved_budget')}, 2) AS total_approved_budget,
       MIN(infra_year) AS earliest_year, MAX(infra_year) AS latest_year
FROM clean GROUP BY region"""

_BY_TYPE_SUMMARY = f"""
SELECT type_of_work, {_N} AS total_projects,
       ROUND({_sum('contract_cost')}, 2) AS total_cost,
       ROUND({_avg('contract_cost')}, 2) AS avg_cost,
       ROUND({_avg('cost_efficiency_ratio')}, 4) AS avg_efficiency
FROM clean GROUP BY type_of_work"""

_BY_YEAR_SUMMARY = f"""
SELECT infra_year, {_N} AS total_projects, {_distinct('region')} AS regions_covered,
       {_distinct('contractor')} AS unique_contractors,
       ROUND({_sum('contract_cost')}, 2) AS total_cost,
       ROUND({_avg('contract_cost')}, 2) AS avg_cost,
       ROUND(CAST(SUM(duration_days) AS DOUBLE) / COUNT(duration_days), 0) AS avg_duration_days
FROM clean WHERE infra_year IS NOT NULL GROUP BY infra_year"""

_CONTRACTORS = f"""
SELECT contractor, {_N} AS total_projects, {_distinct('region')} AS regions_active,
       ROUND({_sum('contract_cost')}, 2) AS total_contract_value,
       ROUND({_avg('contract_cost')}, 2) AS avg_contract_value,
       MIN(infra_year) AS first_year, MAX(infra_year) AS last_year
FROM clean WHERE has_contractor GROUP BY contractor"""

_TOP100 = f"{_CONTRACTORS} ORDER BY total_projects DESC, contractor LIMIT 100"

# rows of each published dataset
_SIZES = {
    "clean": "SELECT COUNT(*) FROM clean",
    "region": f"SELECT COUNT(*) FROM ({_BY_REGION_SUMMARY})",
    "type": f"SELECT COUNT(*) FROM ({_BY_TYPE_SUMMARY})",
    "year": f"SELECT COUNT(*) FROM ({_BY_YEAR_SUMMARY})",
    "contractor": f"SELECT COUNT(*) FROM ({_TOP100})",
}


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _share(bad: str, base: str) -> tuple[str, str, str]:
    part = f"COUNT(*) FILTER ({base} AND {bad})"
    whole = f"COUNT(*) FILTER ({base})"
    return part, whole, f"coalesce({_pct(part, whole, 2)}, 0)"


def _check_sql() -> str:
    """The verdicts for the thresholds the queries pass."""

    def row(group: str, name: str, passed: str, detail: str, source: str = "clean") -> str:
        return (
            f"SELECT '{group}' AS check_group, '{name}' AS check_name, "
            f"coalesce({passed}, false) AS passed, {detail} AS detail FROM {source}"
        )

    def share_row(group: str, name: str, bad: str, base: str, limit: float) -> str:
        part, whole, pct = _share(bad, base)
        detail = f"printf('%d of %d (%.2f%%)', {part}, {whole}, CAST({pct} AS DOUBLE))"
        return row(group, name, f"{pct} < {limit}", detail)

    rows = [
        row("completeness", "row_count_range", f"{_N} BETWEEN 1 AND 1000000000000000",
            f"concat('rows: ', {_N})"),
        *[
            row("completeness", f"zero_nulls:{c}", f"COUNT(*) FILTER ({c} IS NULL) = 0",
                f"concat('nulls: ', COUNT(*) FILTER ({c} IS NULL))")
            for c in C.ZERO_NULL_COLUMNS
        ],
        *[
            row("completeness", f"required_column:{c}", f"COUNT({c}) >= 0", "''")
            for c in C.REQUIRED_COLUMNS
        ],
        row("accuracy", "no_negative_costs",
            "COUNT(*) FILTER (contract_cost < 0 OR approved_budget < 0) = 0",
            "concat('negative: ', COUNT(*) FILTER (contract_cost < 0 OR approved_budget < 0))"),
        row("accuracy", "year_range", "MIN(infra_year) >= 1992 AND MAX(infra_year) <= 2026",
            "concat('years: ', MIN(infra_year), '-', MAX(infra_year))"),
        share_row("accuracy", "coords_out_of_bounds", "NOT is_valid_coordinates",
                  "longitude IS NOT NULL AND latitude IS NOT NULL", 5),
        share_row("accuracy", "extreme_ratio",
                  "(cost_efficiency_ratio > 2.0 OR cost_efficiency_ratio < 0.1)",
                  "cost_efficiency_ratio IS NOT NULL", 10),
        row("consistency", "distinct_regions", "COUNT(DISTINCT region) BETWEEN 2 AND 20",
            "concat('regions: ', COUNT(DISTINCT region))"),
        share_row("consistency", "over_budget", "contract_cost > approved_budget * 1.5",
                  "approved_budget > 0", 5),
        row("consistency", "no_duplicate_keys", "COUNT(*) = 0",
            "concat('duplicated keys: ', COUNT(*))",
            "(SELECT project_component_id FROM clean GROUP BY 1 HAVING COUNT(*) > 1)"),
        "SELECT 'cross_table', 'summary_total_matches', s.n = t.n, "
        "concat('summary: ', s.n, ', table: ', t.n) "
        f"FROM (SELECT SUM(total_projects) AS n FROM ({_BY_REGION_SUMMARY})) s, "
        "(SELECT COUNT(*) AS n FROM clean) t",
        "SELECT 'cross_table', 'summary_years_complete', s.n = t.n, "
        "concat('summary: ', s.n, ', table: ', t.n) "
        f"FROM (SELECT COUNT(*) AS n FROM ({_BY_YEAR_SUMMARY})) s, "
        "(SELECT COUNT(DISTINCT infra_year) AS n FROM clean) t",
    ]
    return _union(rows)


_CHECKS = f"checks AS ({_check_sql()})"
_FAILURES = "coalesce(string_agg(check_name, ', ' ORDER BY check_name) FILTER (NOT passed), '')"
_PASSED = "COUNT(*) FILTER (passed)"

_RAW_COLUMNS = ", ".join(f'"{c}"' for c in [
    *_TEXT, "ABC", "ContractCost", "InfraYear", "CompletionYear", *_RAW_TEXT[len(_TEXT):],
    "Longitude", "Latitude"])


def oracle_sql() -> dict[str, str]:
    made = _direct()
    cube = {name: made[name.removeprefix("cube_")] for name in CUBE_QUERIES}
    jobs = {name: made[same] for name, same in SAME_QUERIES.items()}
    return made | cube | jobs


def _direct() -> dict[str, str]:
    explorer = f"SELECT {_EXPLORER} FROM clean"
    sorted_500 = (
        f"SELECT *, row_number() OVER (ORDER BY lower(contractor) DESC NULLS LAST, project_id, "
        f"contract_cost) AS position FROM ({explorer} {_TOP500})"
    )
    page3 = (
        "SELECT global_id, project_description, contract_cost FROM clean "
        "ORDER BY lower(project_description) NULLS LAST, global_id LIMIT 15 OFFSET 45"
    )
    top8 = f"{_breakdown('type_of_work')} ORDER BY projects DESC, type_of_work LIMIT 8"
    classes = _breakdown("cost_category")
    nulls = _raw(_union([
        f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT(\"{c}\") AS nulls, "
        + _pct(f'(COUNT(*) - COUNT("{c}"))', "COUNT(*)", 1)
        + " AS pct FROM projects_raw"
        for c in C.NULL_PROFILE_COLUMNS
    ]))
    return {
        "read_geojson": _raw(f"SELECT {_RAW_COLUMNS} FROM projects_raw"),
        "read_geojson_splits": _raw(f"SELECT {_RAW_COLUMNS} FROM projects_raw"),
        "read_parquet": f"SELECT {_N} AS rows FROM lineitem",
        "register_views": _clean(_union([
            f"SELECT '{view}' AS view_name, ({size}) AS rows"
            for view, size in zip(C.VIEWS, _SIZES.values(), strict=True)
        ])),
        "describe_schema": (
            "SELECT column_name, CASE column_type WHEN 'VARCHAR' THEN 'string' "
            "WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS column_type, "
            f'"null" FROM (DESCRIBE {_clean("SELECT * FROM clean")})'
        ),
        "export_parquet_roundtrip": _clean("SELECT * FROM clean"),
        # empty text and NULL are the same in a CSV file
        "export_csv_roundtrip": _clean(
            "SELECT * REPLACE (nullif(contractor, '') AS contractor) "
            f"FROM (SELECT global_id, {_EXPLORER} FROM clean)"
        ),
        "manifest": _clean(_union([
            f"SELECT '{C.MANIFEST_VERSION}' AS pipeline_version, 'given tables' AS source, "
            f"'{file}' AS name, ({_SIZES[key]}) AS rows, '{C.DESCRIPTIONS[file]}' AS description"
            for key, file in _FILES.items()
        ])),
        "clean_text": _raw(f'SELECT {_TRIMMED}, trim("FundingYear") AS funding_year FROM projects_raw'),
        "zero_fill": _raw(
            'SELECT "GlobalID", coalesce("ABC", 0) AS approved_budget, '
            'coalesce("ContractCost", 0) AS contract_cost, '
            'coalesce("ContractCost", 0) - coalesce("ABC", 0) AS cost_variance FROM projects_raw'
        ),
        "safe_ratio": _raw(
            'SELECT "GlobalID", CASE WHEN "ABC" > 0 THEN ROUND("ContractCost" / "ABC", 4) END '
            "AS ratio FROM projects_raw"
        ),
        "bucketize": _raw(
            f'SELECT "GlobalID", {_cost_class(chr(34) + "ContractCost" + chr(34))} AS cost_category '
            "FROM projects_raw"
        ),
        "cast_int": (
            "SELECT l_orderkey, l_linenumber, CAST(l_quantity / 2 AS INTEGER) AS half_quantity, "
            "CAST(l_extendedprice AS INTEGER) AS price FROM lineitem"
        ),
        "round_half": (
            "SELECT l_orderkey, l_linenumber, ROUND(l_extendedprice * l_discount, 2) AS rounded_2, "
            "ROUND(l_quantity / 2, 0) AS rounded_0, "
            "ROUND(l_extendedprice / l_quantity, 4) AS rounded_4 FROM lineitem"
        ),
        "try_date": _raw(
            'SELECT "GlobalID", TRY_CAST("StartDate" AS DATE) AS start_date, '
            'TRY_CAST("CompletionDateActual" AS DATE) AS actual_completion_date FROM projects_raw'
        ),
        "duration_days": _raw(
            "SELECT \"GlobalID\", date_diff('day', TRY_CAST(\"StartDate\" AS DATE), "
            'TRY_CAST("CompletionDateActual" AS DATE)) AS duration_days FROM projects_raw'
        ),
        "in_bounding_box": _raw(
            'SELECT "GlobalID", coalesce("Latitude" BETWEEN 4.5 AND 21.5 AND '
            '"Longitude" BETWEEN 116 AND 127, false) AS inside FROM projects_raw'
        ),
        "quality_flags": _raw(
            'SELECT "GlobalID", coalesce("ContractCost" > 0, false) AS has_cost_data, '
            "coalesce(trim(\"Contractor\") <> '', false) AS has_contractor, "
            'TRY_CAST("StartDate" AS DATE) IS NOT NULL AS has_start_date, '
            'TRY_CAST("CompletionDateActual" AS DATE) IS NOT NULL AS has_completion_date '
            "FROM projects_raw"
        ),
        "truncate_text": (
            "SELECT doc_id, CASE WHEN length(text) > 60 THEN substring(text, 1, 60) || '…' "
            "ELSE text END AS label FROM documents"
        ),
        "scale_units": _clean(
            "SELECT global_id, contract_cost / 1e9 AS billions, contract_cost / 1e6 AS millions "
            "FROM clean"
        ),
        "null_display": _clean(
            "SELECT global_id, coalesce(type_of_work, '—') AS type_of_work, "
            "coalesce(CAST(start_date AS VARCHAR), '—') AS start_date, "
            "coalesce(CAST(infra_year AS VARCHAR), '—') AS infra_year FROM clean"
        ),
        "projects_raw": _raw(f"SELECT {_RAW_COLUMNS} FROM projects_raw"),
        "dedup_latest": _newest(f"SELECT {_RAW_COLUMNS} FROM newest"),
        "essential_fields": _newest(
            f'SELECT {_RAW_COLUMNS} FROM newest WHERE "ProjectComponentID" IS NOT NULL '
            'AND "Region" IS NOT NULL'
        ),
        "clean_projects": _clean("SELECT * FROM clean"),
        "duplicate_keys": _raw(
            f'SELECT "ProjectComponentID", {_N} AS copies FROM projects_raw '
            "GROUP BY 1 HAVING COUNT(*) > 1"
        ),
        "row_count": _clean(f"SELECT {_N} AS rows FROM clean"),
        "null_profile": nulls,
        "value_distribution": _raw(
            f'SELECT "Region", {_N} AS projects, '
            + _pct("COUNT(*)", "(SELECT COUNT(*) FROM projects_raw)", 1)
            + ' AS pct FROM projects_raw WHERE "Region" IS NOT NULL GROUP BY 1 '
            'ORDER BY projects DESC, "Region" LIMIT 10'
        ),
        "numeric_profile": _raw(
            'SELECT CAST(MIN("InfraYear") AS INTEGER) AS min_year, '
            'CAST(MAX("InfraYear") AS INTEGER) AS max_year, MIN("ContractCost") AS min_cost, '
            f'MAX("ContractCost") AS max_cost, {_avg(chr(34) + "ContractCost" + chr(34))} AS avg_cost, '
            'MIN("ABC") AS min_budget, MAX("ABC") AS max_budget FROM projects_raw'
        ),
        "duplicate_profile": _raw(
            'SELECT COUNT(*) AS total_rows, COUNT(DISTINCT "ProjectComponentID") AS unique_keys, '
            'COUNT(*) - COUNT(DISTINCT "ProjectComponentID") AS duplicates FROM projects_raw'
        ),
        "rows_removed": _clean(
            "SELECT (SELECT COUNT(*) FROM projects_raw) AS raw_rows, COUNT(*) AS clean_rows, "
            "(SELECT COUNT(*) FROM projects_raw) - COUNT(*) AS rows_removed FROM clean"
        ),
        "cost_category_distribution": _clean(_billions("cost_category")),
        "year_distribution": _clean(_billions("infra_year")),
        "completeness": _clean(_union([
            f"SELECT '{flag}' AS flag, COUNT(*) FILTER ({flag}) AS rows, "
            + _pct(f"COUNT(*) FILTER ({flag})", "COUNT(*)", 1)
            + " AS pct FROM clean"
            for flag in C.COMPLETENESS_FLAGS
        ])),
        "summary_by_region": _clean(_BY_REGION_SUMMARY),
        "summary_by_work_type": _clean(_BY_TYPE_SUMMARY),
        "summary_by_year": _clean(_BY_YEAR_SUMMARY),
        "contractor_totals": _clean(_CONTRACTORS),
        "summary_top_contractors": _clean(_TOP100),
        "filter_projects": _clean(
            f"SELECT * FROM clean WHERE {_SELECTED} AND {_BY_YEAR} "
            f"AND cost_category = '{C.COST_CLASSES[2][1]}'"
        ),
        "search_projects": _clean(f"SELECT global_id, {_EXPLORER} FROM clean WHERE {_FOUND}"),
        "drill_down": _clean(f"SELECT * FROM clean WHERE {_BY_YEAR} AND region = 'EUROPE'"),
        "kpi_overview": _clean(_kpi("true")),
        "kpi_overview_filtered": _clean(_kpi(_SELECTED)),
        "by_year": _clean(_breakdown("infra_year", f"{_SELECTED} AND infra_year IS NOT NULL")),
        "by_work_type_top8": _clean(top8),
        "by_cost_category": _clean(_breakdown("cost_category", _SELECTED)),
        "by_region": _clean(_breakdown("region")),
        "by_region_export": _clean(_breakdown("region", _BY_YEAR)),
        "by_province_drill_down": _clean(
            _breakdown("province", f"{_BY_YEAR} AND region = 'EUROPE'",
                       more=f", {_distinct('contractor')} AS contractors")
            + " ORDER BY projects DESC, province LIMIT 20"
        ),
        "by_contractor_top25": _clean(
            _breakdown("contractor", cost="total_value")
            + " ORDER BY projects DESC, contractor NULLS LAST LIMIT 25"
        ),
        "by_contractor_export": _clean(
            _breakdown("contractor", _SELECTED, "total_value")
            + " ORDER BY projects DESC, contractor NULLS LAST LIMIT 100"
        ),
        "share_of_total": _clean(
            f"SELECT *, ROUND(CAST(projects AS DOUBLE) / SUM(projects) OVER () * 100, 1) AS share_pct "
            f"FROM ({_breakdown('region')})"
        ),
        "facet_region": _clean("SELECT DISTINCT region FROM clean"),
        "facet_year": _clean("SELECT DISTINCT infra_year FROM clean WHERE infra_year IS NOT NULL"),
        "facet_work_type": _clean(
            "SELECT DISTINCT type_of_work FROM clean WHERE type_of_work IS NOT NULL"
        ),
        "facet_cost_category": _clean("SELECT DISTINCT cost_category FROM clean"),
        "project_explorer": _clean(f"{explorer} WHERE {_BY_YEAR} AND ({_FOUND}) {_TOP500}"),
        "explorer_cells": _clean(
            "SELECT CASE WHEN length(project_description) > 60 "
            "THEN substring(project_description, 1, 60) || '…' ELSE project_description END "
            "AS project_description, coalesce(region, '—') AS region, "
            "coalesce(province, '—') AS province, "
            "CASE WHEN length(contractor) > 25 THEN substring(contractor, 1, 25) || '…' "
            "ELSE contractor END AS contractor, contract_cost / 1e6 AS cost_millions, infra_year, "
            "CASE WHEN length(type_of_work) > 20 THEN substring(type_of_work, 1, 20) || '…' "
            f"ELSE type_of_work END AS type_of_work FROM (SELECT * FROM clean {_TOP500})"
        ),
        "top_k": _clean(
            f"{_CONTRACTORS} ORDER BY total_contract_value DESC NULLS LAST, contractor LIMIT 20"
        ),
        "top_rows": _clean(
            "SELECT global_id, cost_variance FROM clean "
            "ORDER BY cost_variance DESC NULLS LAST, global_id LIMIT 20"
        ),
        "sort_table_desc": _clean(sorted_500),
        "paginate_page3": _clean(page3),
        "paginate_deep": _clean(page3),
        "page_count": _clean(
            "SELECT COUNT(*) AS records, CAST(ceil(COUNT(*) / 20.0) AS BIGINT) AS pages FROM clean"
        ),
        "year_series": _clean(
            "SELECT infra_year, projects, total_cost / 1e9 AS cost_billions "
            f"FROM ({_breakdown('infra_year', 'infra_year IS NOT NULL')})"
        ),
        "share_of_work_type": _clean(
            "SELECT type_of_work, projects, "
            f"ROUND(CAST(projects AS DOUBLE) / SUM(projects) OVER () * 100, 1) AS share_pct FROM ({top8})"
        ),
        "share_of_cost_category": _clean(
            "SELECT cost_category, total_cost, "
            "ROUND(total_cost / SUM(total_cost) OVER () * 100, 1) AS share_pct, "
            f"total_cost / 1e9 AS cost_billions FROM ({classes})"
        ),
        "region_bars": _clean(f"SELECT region AS label, projects FROM ({_breakdown('region')})"),
        "province_bars": _clean(
            "SELECT province AS label, projects FROM "
            f"({_breakdown('province', 'region = ' + chr(39) + 'AFRICA' + chr(39))} "
            "ORDER BY projects DESC, province LIMIT 20)"
        ),
        "contractor_bars": _clean(
            "SELECT CASE WHEN length(contractor) > 35 THEN substring(contractor, 1, 35) || '…' "
            "ELSE contractor END AS label, projects FROM "
            f"({_breakdown('contractor')} ORDER BY projects DESC, contractor NULLS LAST LIMIT 25)"
        ),
        "quality_checks_core": _clean("SELECT * FROM checks", _CHECKS),
        "quality_report": _clean(
            f"SELECT COUNT(*) AS total, {_PASSED} AS passed, COUNT(*) - {_PASSED} AS failed, "
            f"{_FAILURES} AS failures, {_pct(_PASSED, 'COUNT(*)', 1)} AS score FROM checks",
            _CHECKS,
        ),
        "dataset_sizes_checked": _union([
            f"SELECT '{name}' AS name, true AS positive, true AS adds_up, true AS pct_by_formula"
            for name in [*_FILES.values(), "total"]
        ]),
        "ingest_job": nulls,
        "transform_job": _clean(_BY_YEAR_SUMMARY),
        "export_job": _clean(_TOP100),
        "verify_job": _clean(
            _union([
                "SELECT check_group, check_name, passed FROM checks",
                *[
                    f"SELECT 'files', '{name}', true"
                    for name in [
                        *[f"output_exists:{file}" for file in [*_FILES.values(), C.MANIFEST_FILE]],
                        "min_output_size",
                        "round_trip",
                    ]
                ],
            ]),
            _CHECKS,
        ),
        # the eight checks on written files all pass for a run that has written them
        "publish_report": _clean(
            f"SELECT CASE WHEN COUNT(*) = {_PASSED} THEN 'SUCCESS' ELSE 'FAILED' END AS status, "
            f"COUNT(*) = {_PASSED} AS promoted, (SELECT COUNT(*) FROM clean) AS rows, "
            f"COUNT(*) + 8 AS checks_total, {_PASSED} + 8 AS checks_passed, "
            f"{_FAILURES} AS failures, {_pct(f'({_PASSED} + 8)', '(COUNT(*) + 8)', 1)} AS score "
            "FROM checks",
            _CHECKS,
        ),
    }
