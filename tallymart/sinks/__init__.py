"""Target tables and delimited exports."""

from tallymart.sinks.exports import export_delimited, publish, publish_scripts
from tallymart.sinks.tables import (
    Layout,
    compact,
    create_schema,
    drop_stage,
    merge_insert_only,
    overwrite,
    recover,
    stage,
)

__all__ = [
    "Layout",
    "compact",
    "create_schema",
    "drop_stage",
    "export_delimited",
    "merge_insert_only",
    "overwrite",
    "publish",
    "publish_scripts",
    "recover",
    "stage",
]
