"""Sheet exports, catalog tables and SQL scripts as inputs."""

from tallymart.sources.inference import infer_types, read_cells, read_inferred
from tallymart.sources.scripts import read_scripts, run_script
from tallymart.sources.sheets import Sheets, conform, read_sheet, read_sheets
from tallymart.sources.tables import scan_table

__all__ = [
    "Sheets",
    "conform",
    "infer_types",
    "read_cells",
    "read_inferred",
    "read_scripts",
    "read_sheet",
    "read_sheets",
    "run_script",
    "scan_table",
]
