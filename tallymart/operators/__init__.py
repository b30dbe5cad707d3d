"""DataFrame -> DataFrame operators. Keys, order columns and column lists are
parameters; the retail names are only their defaults."""

from tallymart.operators.collapse import collapse
from tallymart.operators.dedupe import distinct_rows, keep_first
from tallymart.operators.duplicates import (
    duplicate_count,
    duplicate_rows_all,
    duplicate_rows_later,
)
from tallymart.operators.insert import rows_to_insert
from tallymart.operators.membership import flag_membership, keep_members
from tallymart.operators.quality import (
    contract_checks,
    count_not_equal,
    distinct_count,
    head_rows,
    null_counts,
    profile_table,
    tail_rows,
    value_counts,
)
from tallymart.operators.reconcile import (
    ReconciliationError,
    mismatches,
    reconcile_counts,
    require_reconciled,
)
from tallymart.operators.star import star_customers, star_orders, star_products, star_regions

__all__ = [
    "ReconciliationError",
    "collapse",
    "contract_checks",
    "count_not_equal",
    "distinct_count",
    "distinct_rows",
    "duplicate_count",
    "duplicate_rows_all",
    "duplicate_rows_later",
    "flag_membership",
    "head_rows",
    "keep_first",
    "keep_members",
    "mismatches",
    "null_counts",
    "profile_table",
    "reconcile_counts",
    "require_reconciled",
    "rows_to_insert",
    "star_customers",
    "star_orders",
    "star_products",
    "star_regions",
    "tail_rows",
    "value_counts",
]
