"""Data-quality queries. Each is one pass over the columns it needs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.cells import value_or_null


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Occurrences per present value, most frequent first, ties by value.

    ``top`` makes it a top-k; without it the full ordered list is returned.
    """
    counted = (
        df.select(value_or_null(df, column).alias(column))
        .where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), column)
    )
    return counted if top is None else counted.limit(top)


def count_not_equal(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Rows whose value differs from ``value``; a missing value differs."""
    differs = ~F.col(column).eqNullSafe(F.lit(value))
    return df.where(differs).agg(F.count(F.lit(1)).alias("rows"))


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column; missing counts as one value."""
    distinct = df.select(value_or_null(df, column).alias(column)).distinct()
    return distinct.agg(F.lit(column).alias("column"), F.count(F.lit(1)).alias("distinct_values"))


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, all columns in one aggregation."""
    counted = df.agg(
        *[F.count_if(value_or_null(df, c).isNull()).alias(c) for c in df.columns]
    )
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("nulls")) for c in df.columns]
    return counted.select(F.inline(F.array(*cells)))


def profile_table(df: DataFrame) -> DataFrame:
    """Position, type and present values of every column, with the row count."""
    counted = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(value_or_null(df, c)).alias(c) for c in df.columns],
    )
    cells = [
        F.struct(
            F.lit(position).cast("bigint").alias("position"),
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col(f"`{field.name}`").alias("non_null"),
            F.col("__rows").alias("rows"),
        )
        for position, field in enumerate(df.schema.fields)
    ]
    return counted.select(F.inline(F.array(*cells)))


def contract_checks(checks: Mapping[str, tuple[DataFrame, DataFrame, str | None]]) -> DataFrame:
    """Compare each output's shape with what its input demands.

    ``checks`` maps an output name to (output, input, key): the output must
    have as many rows as the input has rows (key None) or distinct keys, a
    missing key counting as one. The result has one row per output.
    """

    def one(name: str, output: DataFrame, source: DataFrame, key: str | None) -> DataFrame:
        expected = source if key is None else source.select(key).distinct()
        marks = output.select(F.lit(1).alias("produced"), F.lit(0).alias("demanded")).unionAll(
            expected.select(F.lit(0), F.lit(1))
        )
        return marks.agg(
            F.lit(name).alias("output"),
            F.coalesce(F.sum("produced"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum("demanded"), F.lit(0)).alias("expected_rows"),
            F.lit(len(output.columns)).cast("bigint").alias("columns"),
        )

    result = reduce(DataFrame.unionByName, [one(name, *parts) for name, parts in checks.items()])
    return result.withColumn("holds", F.col("rows") == F.col("expected_rows"))


def head_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in ``order``; every task keeps its own ``n`` only."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in order]).limit(n)


def tail_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The last ``n`` rows, in ``order``; every task keeps its own ``n`` only."""
    last = df.orderBy(*[F.desc_nulls_first(c) for c in order]).limit(n)
    return last.orderBy(*[F.asc_nulls_last(c) for c in order])
