"""Collapse repeated rows of a key into one."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.cells import value_or_null
from tallymart.schemas import LINE_KEYS, ROW_ORDER, SUMMED

_COMPLETE, _LATEST = "__complete", "__latest"


def collapse(
    df: DataFrame,
    keys: Sequence[str] = LINE_KEYS,
    sums: Collection[str] = SUMMED,
    order: str = ROW_ORDER,
) -> DataFrame:
    """One row per key: ``sums`` are added up (0 when all are missing), every
    other column takes its last present value in ``order``.

    Rows with a missing key are dropped and the column order is kept. Each
    "last" is the maximum of (order, value) pairs, which merges in any order:
    a task first reduces its own rows to one per key, and only those are
    shuffled. A key holding a large share of all rows therefore costs no more
    than any other, and rows that tie in ``order`` still give one result.

    Most rows miss nothing, so those travel as one (order, all values) record
    instead of a pair per column. Rows that miss some value contribute a pair
    for each value they do have, and the newer of the two wins per column.
    """
    last = [c for c in df.columns if c not in keys and c not in sums and c != order]
    value = {c: value_or_null(df, c) for c in df.columns}

    def present(columns: Sequence[str]) -> Column:
        return reduce(Column.__and__, [value[c].isNotNull() for c in columns], F.lit(True))

    def total(name: str) -> Column:
        zero = F.lit(0).cast(df.schema[name].dataType)
        return F.coalesce(F.sum(value[name]), zero).alias(name)

    def part(name: str) -> Column:
        pair = F.struct(F.col(order).alias("order"), value[name].alias("value"))
        usable = ~F.col(_COMPLETE) & value[name].isNotNull()
        return F.max(F.when(usable, pair)).alias(f"__{name}")

    complete = F.struct(F.col(order).alias("order"), *[F.col(c).alias(c) for c in last])
    reduced = (
        df.where(present(keys))
        .withColumn(_COMPLETE, present(last))
        .groupBy(*keys)
        .agg(
            F.max(value[order]).alias(order),
            *[total(c) for c in df.columns if c in sums],
            F.max(F.when(F.col(_COMPLETE), complete)).alias(_LATEST),
            *[part(c) for c in last],
        )
    )

    def newest(name: str) -> Column:
        partial, latest = F.col(f"__{name}"), F.col(_LATEST)
        later = F.coalesce(partial["order"] > latest["order"], latest["order"].isNull())
        use_partial = partial.isNotNull() & (latest.isNull() | later)
        return F.when(use_partial, partial["value"]).otherwise(latest[name]).alias(name)

    return reduced.select(*[newest(c) if c in last else F.col(c) for c in df.columns])
