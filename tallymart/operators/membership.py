"""Membership of a row's key in another table.

Both operators join against the distinct members with null-safe equality. The
members are reduced to one row per key first, so nothing fans out, and Spark
broadcasts them only when their measured size allows. Beyond that size it is a
sort-merge join whose two inputs are plain shuffles (a null-safe key never
reuses the partitioning of the distinct step), which is the form adaptive
execution can split when one key holds a large share of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.cells import yes_no

_MEMBER = "__member"


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(
        Column.__and__, [left[k].eqNullSafe(right[f"__{k}"]) for k in keys]
    )


def _members(members: DataFrame, keys: Sequence[str]) -> DataFrame:
    return members.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()


def flag_membership(
    df: DataFrame,
    members: DataFrame,
    keys: Sequence[str] = ("order_id",),
    name: str = "returned",
    missing: bool = True,
) -> DataFrame:
    """All rows of ``df`` with ``name`` = Yes where the key occurs in
    ``members``, else No. A missing key matches a missing key.

    With ``missing`` false no key of ``df`` is missing. The join is a plain equality then, and rows
    that are dealt by the key already stay where they are."""
    found = _members(members, keys).withColumn(_MEMBER, F.lit(True))
    if missing:
        same = _same_key(df, found, keys)
    else:
        same = reduce(Column.__and__, [df[k] == found[f"__{k}"] for k in keys])
    return (
        df.join(found, same, "left")
        .select(*df.columns, yes_no(F.col(_MEMBER).isNotNull()).alias(name))
    )


def keep_members(df: DataFrame, members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose key occurs in ``members``."""
    found = _members(members, keys)
    return df.join(found, _same_key(df, found, keys), "left_semi")
