"""Types of sheets that declare none.

Every cell fits some types; a set of types is a mask with a bit for each, and what fits a
whole column is the bitwise and over its cells. That merges in any order, so one
aggregation over all cells of all columns, with partial results per task, types a sheet
of any size, and every row counts. The narrowest type left is the column's.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions.cells import fold_na_tokens
from tallymart.sources.sheets import CSV_OPTIONS, conform

# The types a column can get, from the narrowest; every cell fits the last.
TYPES = ("boolean", "bigint", "double", "timestamp_ntz", "string")

# Numbers with a leading zero, such as post codes, are texts.
WHOLE_NUMBER = r"^[+-]?(0|[1-9][0-9]*)$"
NUMBER = r"^[+-]?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
ISO_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"


def fitting_types(text: Column) -> Column:
    """The mask of the types that a text cell fits; NULL for a missing cell.

    A whole number that bigint cannot hold is a text: a double would change its digits.
    """
    def mask(*names: str) -> Column:
        return F.lit(sum(1 << TYPES.index(n) for n in names))

    # Few cells look like numbers or dates: the first character spares the others the patterns.
    looks = F.substring(text, 1, 1)
    whole = F.when(text.try_cast("bigint").isNotNull(), mask("bigint", "double", "string")).otherwise(mask("string"))
    timed = F.when(text.try_cast("timestamp_ntz").isNotNull(), mask("timestamp_ntz", "string")).otherwise(mask("string"))
    figures = (
        F.when(text.rlike(WHOLE_NUMBER), whole)
        .when(text.rlike(NUMBER), mask("double", "string"))
        .when(text.rlike(ISO_TIMESTAMP), timed)
        .otherwise(mask("string"))
    )
    truth = (F.octet_length(text) <= 5) & F.lower(text).isin("true", "false")
    fits = F.when((looks <= "9") & (looks >= "+"), figures).when(truth, mask("boolean", "string"))
    return F.when(text.isNotNull(), fits.otherwise(mask("string")))


def _cells(df: DataFrame) -> Mapping[str, Column]:
    """The cells of text columns with missing-value tokens folded; other columns keep their type."""
    return {
        f.name: fold_na_tokens(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    }


def infer_types(df: DataFrame) -> DataFrame:
    """Per column: ``position``, ``column``, ``type``, ``present`` and ``rows``.

    A column without any present cell is a text. A column that has a type already keeps it.
    """
    cells = _cells(df)
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    masks = [F.bit_and(fitting_types(c)).alias(f"mask {i}") for i, (n, c) in enumerate(cells.items()) if n in text]
    counts = [F.count(c).alias(f"present {i}") for i, c in enumerate(cells.values())]
    typed = df.agg(F.count(F.lit(1)).alias("all rows"), *masks, *counts)

    def narrowest(i: int, name: str) -> Column:
        if name not in text:
            return F.lit(df.schema[name].dataType.simpleString())
        mask = F.coalesce(F.col(f"`mask {i}`"), F.lit(1 << TYPES.index("string")))
        first = F.when(mask.bitwiseAND(1) != 0, TYPES[0])
        for bit, kind in enumerate(TYPES[1:], start=1):
            first = first.when(mask.bitwiseAND(1 << bit) != 0, kind)
        return first

    rows = [
        F.struct(
            F.lit(i).cast("bigint").alias("position"),
            F.lit(name).alias("column"),
            narrowest(i, name).alias("type"),
            F.col(f"`present {i}`").alias("present"),
            F.col("`all rows`").alias("rows"),
        )
        for i, name in enumerate(cells)
    ]
    return typed.select(F.inline(F.array(*rows)))


def read_cells(
    spark: SparkSession, path: str | list[str], fmt: str = "csv", *, multi_line: bool = False
) -> DataFrame:
    """A sheet as written: every column under its header, CSV cells as text."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS).option("multiLine", multi_line)
    return reader.load(path)


def read_inferred(
    spark: SparkSession, path: str | list[str], fmt: str = "csv", *, multi_line: bool = False
) -> DataFrame:
    """A sheet of any columns, typed by all of its cells. Reads it once to type it, and then lazily."""
    cells = read_cells(spark, path, fmt, multi_line=multi_line)
    types = {r["column"]: r["type"] for r in infer_types(cells).collect()}  # a row per column
    return conform(cells, types)
