"""Where data comes from and goes to: layer paths, versioned tables, CSV landing."""

from tillbook.sources.landing import (
    audit,
    create_raw,
    insert_rows,
    load_csv,
    read_raw,
    read_rejects,
    stream_raw,
)
from tillbook.sources.layers import Layers
from tillbook.sources.tables import MergeTable, VersionedTable

__all__ = [
    "Layers",
    "MergeTable",
    "VersionedTable",
    "audit",
    "create_raw",
    "insert_rows",
    "load_csv",
    "read_raw",
    "read_rejects",
    "stream_raw",
]
