"""The given star-schema tables seen as raw project records.

``projects_raw`` joins line items with their order, part, supplier, nation and
region and renames the result to the raw attributes, with missing, padded and
unparsable values mixed in by rule. No size is assumed: joins carry no hints, so
Spark broadcasts a side only when its size statistics allow it, and adaptive
execution splits a part or supplier key that dominates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from worksledger import constants as C
from worksledger.operators.cube import cube
from worksledger.operators.dedup import in_parts
from worksledger.plans.jobs import CLUSTER_BY, land_clean, summary_tables
from worksledger.schemas import RAW_SCHEMA
from worksledger.session import conf_bytes, parts_for, scratch_path, shuffles_removed, sized_for, stored_bytes
from worksledger.sinks import export_parquet, materialise, materialise_parts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """Rows of a table of few files and splits over all task slots.

    Spark cuts a file into as many splits as there are slots once each has the size of
    ``openCostInBytes``; such a table is read in parallel as it is and not shuffled.
    """
    spark = df.sparkSession
    slots = spark.sparkContext.defaultParallelism
    fills = slots * conf_bytes(spark, "spark.sql.files.openCostInBytes")
    few = len(df.inputFiles()) < slots and stored_bytes(df) < fills
    return df.repartition(slots) if few else df


def _multiple(col: str, n: int) -> Column:
    return F.col(col) % n == 0


def _iso_day(col: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


_BRACE = "}"  # ends every piece of a collection, and is written behind it as the line separator


def _as_collection(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features as the pieces of one collection, each without its last brace."""
    opening, closing = '{"name":"works","features":[', '],"type":"FeatureCollection"'
    lead = opening
    for batch in batches:
        if batch.num_rows:
            leads = pa.array([lead] + [","] * (batch.num_rows - 1))
            texts = pc.utf8_slice_codeunits(batch.column(0), 0, -1)
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(leads, texts, "")], ["value"])
            lead = ","
    last = closing if lead == "," else opening + closing
    yield pa.RecordBatch.from_arrays([pa.array([last])], ["value"])


SOURCE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_shipdate", "o_orderdate", "o_orderpriority", "p_name", "p_brand", "p_type",
    "s_name", "n_name", "r_name",
)


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with what the raw attributes are made of."""
    lineitem = _spread(table(spark, sf_dir, "lineitem"))
    joined = (
        lineitem.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(*SOURCE_COLUMNS)


def raw_attributes() -> dict[str, Column]:
    """The raw attributes as expressions over ``source_rows``."""
    line = F.col("l_linenumber")
    price = F.col("l_extendedprice")
    attributes = {
        "ProjectID": F.concat(F.lit("P"), "l_orderkey"),
        "ProjectComponentID": F.when(
            ~_multiple("l_partkey", 211),
            F.concat(F.lit(" C"), "l_orderkey", F.lit("-"), "l_linenumber", F.lit(" ")),
        ),
        "ContractID": F.concat(F.lit("K"), "l_suppkey", F.lit("-"), F.col("l_partkey") % 50),
        "GlobalID": F.concat(
            F.lit("G"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        ),
        "Region": F.when(~_multiple("l_partkey", 97), F.col("r_name")),
        "Province": F.when(line == 2, F.concat(F.lit("\u00a0"), "n_name")).otherwise(F.col("n_name")),
        "Municipality": F.concat("n_name", F.lit("-"), "l_linenumber"),
        "LegislativeDistrict": F.concat(F.lit("District "), "l_linenumber"),
        "ProjectDescription": F.col("p_name"),
        "ProjectComponentDescription": F.concat("p_name", F.lit(" "), "p_brand"),
        "TypeofWork": F.when(~_multiple("l_partkey", 31), F.col("p_type")),
        "infra_type": F.col("p_brand"),
        "Program": F.col("o_orderpriority"),
        "ImplementingOffice": F.col("n_name"),
        "DistrictEngineeringOffice": F.concat("r_name", F.lit(" DEO")),
        "Contractor": F.when(_multiple("l_suppkey", 29), F.lit(None))
        .when(_multiple("l_suppkey", 23), F.lit("   "))
        .otherwise(F.col("s_name")),
        "ABC": F.when(_multiple("l_partkey", 13), F.lit(None))
        .when(_multiple("l_partkey", 17), F.lit(0.0))
        .when((line == 7) & _multiple("l_partkey", 5), price * 500)
        .otherwise(price * 1000),
        "ContractCost": F.when(_multiple("l_partkey", 11), F.lit(None))
        .when(_multiple("l_partkey", 19), F.lit(0.0))
        .otherwise(price * (1 - F.col("l_discount")) * 1000),
        "InfraYear": F.year("l_shipdate"),
        "CompletionYear": F.year("l_shipdate"),
        "FundingYear": F.year("o_orderdate"),
        "StartDate": F.when(line == 5, F.lit("n/a"))
        .when(line == 6, F.year("o_orderdate").cast("string"))
        .when(line == 4, F.replace(_iso_day("o_orderdate"), F.lit("-"), F.lit("/")))
        .otherwise(_iso_day("o_orderdate")),
        "CompletionDateActual": F.when(_multiple("l_partkey", 7), F.lit("")).otherwise(
            _iso_day("l_shipdate")
        ),
        "EditDate": F.when(F.col("l_quantity") != 50, _iso_day("o_orderdate")),
        "Longitude": F.when(~_multiple("l_partkey", 41), 115.5 + F.col("l_suppkey") % 12),
        "Latitude": F.when(~_multiple("l_partkey", 41), 4.5 + F.col("l_partkey") % 18),
    }
    return {f.name: attributes[f.name].cast(f.dataType) for f in RAW_SCHEMA.fields}


def raw_records(source: DataFrame) -> DataFrame:
    return source.select(*[e.alias(n) for n, e in raw_attributes().items()])


def projects_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_records(source_rows(spark, sf_dir))


def feature_rows(raw: DataFrame) -> DataFrame:
    """Raw records as GeoJSON features in a column ``value``."""
    point = F.struct(
        F.lit("Point").alias("type"), F.array("Longitude", "Latitude").alias("coordinates")
    )
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*RAW_SCHEMA.names).alias("properties"),
        F.when(F.col("Longitude").isNotNull(), point).alias("geometry"),
    )
    return raw.select(F.to_json(feature).alias("value"))


@dataclass(frozen=True, eq=False)
class Given:
    """One set of given tables and the tables Spark derives from them.

    Raw and clean records are written once to the shared folder, as the jobs do,
    and later queries read the columns they need from there. Each is made from the
    given tables: clean records are not read from the raw ones, whose attributes are
    many times as wide as the columns they are made of.
    """

    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @cached_property
    def base_dir(self) -> str:
        return scratch_path(self.spark, "projects")

    @cached_property
    def source(self) -> DataFrame:
        """Rows that ``raw_attributes`` are computed from; not stored."""
        return source_rows(self.spark, self.sf_dir)

    @cached_property
    def lazy_raw(self) -> DataFrame:
        """The raw records, not stored."""
        return raw_records(self.source)

    def source_parts(self, n: int) -> list[DataFrame]:
        """The rows of ``source`` in n tables, by order, so that a part reads its orders only."""
        return in_parts(self.source, ["l_orderkey"], n)

    @cached_property
    def raw(self) -> DataFrame:
        size = stored_bytes(self.source)
        n = parts_for(size)
        with sized_for(self.spark, size // n, sorts=True):
            parts = [raw_records(part) for part in self.source_parts(n)]
            return materialise_parts(parts, f"{self.base_dir}/raw").table

    @cached_property
    def clean(self) -> DataFrame:
        path = f"{self.base_dir}/{C.CLEAN_FILE}"
        return land_clean(self.source, path, attributes=raw_attributes()).table

    @cached_property
    def cube(self) -> DataFrame:
        with sized_for(self.spark, stored_bytes(self.clean), sorts=True):
            return materialise(cube(self.clean), f"{self.base_dir}/cube", CLUSTER_BY).table

    @cached_property
    def feature_rows(self) -> DataFrame:
        """The raw records as GeoJSON features in a column ``value``; not stored."""
        return feature_rows(self.lazy_raw)

    @cached_property
    def features(self) -> str:
        """The features, one per line, compressed, as names repeat in each; the folder's path."""
        path = scratch_path(self.spark, "features")
        with sized_for(self.spark, stored_bytes(self.source), sorts=True), shuffles_removed(self.spark):
            self.feature_rows.write.option("compression", "gzip").text(path)
        return path

    @cached_property
    def collections(self) -> str:
        """The same features as large collections, members in an unusual order; the folder's path."""
        return self.collections_of(self.source)

    def collections_of(self, source: DataFrame) -> str:
        """The features of some source rows.

        Plain text, so that Spark cuts the files into splits; each task writes one file.
        """
        path = scratch_path(self.spark, "collections")
        with sized_for(self.spark, stored_bytes(source), sorts=True), shuffles_removed(self.spark):
            pieces = feature_rows(raw_records(source)).mapInArrow(_as_collection, "value string")
            pieces.write.option("lineSep", _BRACE).text(path)
        return path

    @cached_property
    def summaries(self) -> dict[str, DataFrame]:
        return export_parquet(summary_tables(self.clean), self.base_dir)


_GIVEN: dict[tuple, Given] = {}


def _version(sf_dir: str) -> tuple:
    """Changes when local files do, so that derived tables never go stale."""
    files = sorted(Path(sf_dir).glob("*.parquet"))
    return tuple((f.name, f.stat().st_size, f.stat().st_mtime_ns) for f in files)


def given(spark: SparkSession, sf_dir: str) -> Given:
    key = (spark.sparkContext.applicationId, sf_dir, _version(sf_dir))
    if key not in _GIVEN:
        _GIVEN[key] = Given(spark, sf_dir)
    return _GIVEN[key]
