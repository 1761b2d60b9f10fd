"""Writing tables, files and the manifest."""

from worksledger.sinks.csv import export_csv
from worksledger.sinks.manifest import dataset_sizes, manifest, write_manifest
from worksledger.sinks.tables import create_table, current_table, drop_versions, export_parquet, materialise, materialise_parts, replace_table

__all__ = [
    "create_table",
    "current_table",
    "dataset_sizes",
    "drop_versions",
    "export_csv",
    "export_parquet",
    "manifest",
    "materialise",
    "materialise_parts",
    "replace_table",
    "write_manifest",
]
