"""Split cleaned order lines and people into the four star-schema tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tallymart.operators.dedupe import keep_first
from tallymart.schemas import (
    CUSTOMER_ADDRESS,
    CUSTOMERS_COLUMNS,
    GROUPED_KEYS,
    ORDERS_COLUMNS,
    PRODUCT_ID,
    PRODUCTS_COLUMNS,
    REGIONS_COLUMNS,
)

# Lines are taken in the order of the keys they were grouped by.
LINE_ORDER = tuple(GROUPED_KEYS.values())


def star_orders(lines: DataFrame) -> DataFrame:
    return lines.select(*ORDERS_COLUMNS)


def star_customers(
    lines: DataFrame,
    subset: Sequence[str] = CUSTOMER_ADDRESS,
    order: Sequence[str] = LINE_ORDER,
) -> DataFrame:
    """One row per customer address; ``subset=CUSTOMER_ID`` gives one per customer."""
    return keep_first(lines.select(*CUSTOMERS_COLUMNS, *order), subset, order).drop(*order)


def star_products(
    lines: DataFrame, subset: Sequence[str] = PRODUCT_ID, order: Sequence[str] = LINE_ORDER
) -> DataFrame:
    return keep_first(lines.select(*PRODUCTS_COLUMNS, *order), subset, order).drop(*order)


def star_regions(people: DataFrame) -> DataFrame:
    return people.select(*REGIONS_COLUMNS)
