"""Reading, writing and the declared layouts of the input tables."""

from roadweave.sources.tables import (
    current_version,
    define_view,
    expire_materialized,
    expire_versions,
    load,
    materialize,
    read_table,
    replace_table,
    snapshot,
)

__all__ = [
    "current_version",
    "define_view",
    "expire_materialized",
    "expire_versions",
    "load",
    "materialize",
    "read_table",
    "replace_table",
    "snapshot",
]
