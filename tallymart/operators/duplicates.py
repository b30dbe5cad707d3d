"""Duplicate counts and duplicate rows. Nulls are equal to each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.operators.membership import keep_members

_COPIES, _CHUNK = "__copies", "__chunk"

# Copies written out by one row of the replication step.
_CHUNK_SIZE = 65536


def _counted(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.groupBy(*subset).agg(F.count(F.lit(1)).alias(_COPIES))


def duplicate_count(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """How many rows repeat an earlier one on ``subset`` (default: all columns)."""
    subset = list(subset or df.columns)
    surplus = F.coalesce(F.sum(F.col(_COPIES) - 1), F.lit(0)).cast("bigint")
    return _counted(df, subset).agg(
        F.lit(", ".join(subset)).alias("subset"), surplus.alias("duplicates")
    )


def duplicate_rows_all(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Every row whose ``subset`` value occurs more than once.

    Keys are counted with partial aggregation and only the repeated ones are
    joined back, so no task ever holds a whole group of rows.
    """
    repeated = _counted(df, subset).where(F.col(_COPIES) > 1)
    return keep_members(df, repeated, subset)


def duplicate_rows_later(df: DataFrame) -> DataFrame:
    """The second and later copies of every row.

    Copies of a row are interchangeable, so they are counted, not moved: each
    distinct row travels once and is written out again (count - 1) times. The
    copies of one row are cut into chunks that are spread over the tasks, so a
    row repeated very often is not written out by a single task.
    """
    columns = list(df.columns)
    surplus = F.col(_COPIES) - 1
    last_chunk = F.floor((surplus - 1) / _CHUNK_SIZE)
    chunks = (
        _counted(df, columns)
        .where(surplus > 0)
        .withColumn(_CHUNK, F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
    )
    size = F.least(surplus - F.col(_CHUNK) * _CHUNK_SIZE, F.lit(_CHUNK_SIZE))
    return (
        chunks.repartition(*columns, _CHUNK)
        .withColumn(_COPIES, F.explode(F.sequence(F.lit(1), size.cast("int"))))
        .select(*columns)
    )
