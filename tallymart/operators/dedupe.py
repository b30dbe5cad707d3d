"""Distinct rows, and the first row of a key subset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows over all columns; nulls are equal to each other."""
    return df.dropDuplicates()


def keep_first(df: DataFrame, subset: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every ``subset`` value in ``order``; nulls are equal.

    Spark limits each task to its own first row per key before the shuffle, so
    a key with very many rows does not gather in one task.
    """
    first = Window.partitionBy(*subset).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(first)).where(f"{_RANK} = 1").drop(_RANK)
