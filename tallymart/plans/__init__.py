"""From the sheets of a batch to loaded target tables."""

from tallymart.plans.batch import (
    clean_lines,
    load,
    prepare_orders,
    prepare_people,
    prepare_returns,
    run,
    run_sheets,
    standardise_lines,
)

__all__ = [
    "clean_lines",
    "load",
    "prepare_orders",
    "prepare_people",
    "prepare_returns",
    "run",
    "run_sheets",
    "standardise_lines",
]
