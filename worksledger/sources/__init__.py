"""Reading projects."""

from worksledger.sources.geojson import read_geojson
from worksledger.sources.tables import describe_schema, read_parquet, register_views

__all__ = ["describe_schema", "read_geojson", "read_parquet", "register_views"]
