"""Change-data-capture warehouse on Spark: curation, star loads, temporal queries, telemetry and lineage."""

from starloom.catalog import CATALOG, Catalog, EntitySpec, Field, Kind, build_catalog
from starloom.session import prepare, shared_dir

__all__ = ["CATALOG", "Catalog", "EntitySpec", "Field", "Kind", "build_catalog", "prepare", "shared_dir"]
