"""Cell-level cleaning, rounding and parsing as built-in column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.schemas import MONEY, NA_TOKENS, NO, NULL_TEXTS, WHITESPACE, WHOLE, YES


def fold_na_tokens(text: Column) -> Column:
    """NULL for the texts that count as missing while a sheet is read."""
    return F.when(~text.isin(*NA_TOKENS), text)


def null_text_to_null(text: Column) -> Column:
    """Strip all Unicode whitespace; NULL for empty or "null" text in any case.

    Most cells begin and end with a printable ASCII character, which two comparisons of bytes tell. Only the others
    are stripped: ``trim`` with a set of characters costs more than all else that is done to a cell. Only texts of
    the length of a null text are lower-cased.
    """
    (word,) = [t for t in NULL_TEXTS if t]
    last = F.substring(text.cast("binary"), -1, 1)
    bare = (text >= "!") & (text < "\x7f") & (last > F.lit(b" ")) & (last < F.lit(b"\x7f"))
    stripped = F.trim(text, F.lit(WHITESPACE))

    def kept(cell: Column) -> Column:
        return F.when(F.octet_length(cell) > len(word), cell).when(~F.lower(cell).isin(*NULL_TEXTS), cell)

    return F.when(bare, kept(text)).otherwise(kept(stripped))


def value_or_null(df: DataFrame, name: str) -> Column:
    """The column, with NaN folded into NULL where the type can hold NaN."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), column)
    return column


def std_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Standardise missing values in the given (default: all) columns."""
    chosen = set(df.columns if columns is None else columns)

    def cell(field: T.StructField) -> Column:
        if field.name not in chosen:
            return F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            return null_text_to_null(F.col(f"`{field.name}`")).alias(field.name)
        return value_or_null(df, field.name).alias(field.name)

    return df.select(*[cell(f) for f in df.schema.fields])


def round2(value: Column) -> Column:
    """Two decimals, half to even on the scaled double.

    ``round`` and ``bround`` go through a decimal and differ on ties that the
    double itself does not hold exactly.
    """
    return F.rint(value * 100) / 100


def round_measures(
    df: DataFrame, money: Sequence[str] = MONEY, whole: Sequence[str] = WHOLE
) -> DataFrame:
    """Doubles rounded to two decimals and whole-number columns cast to bigint."""
    return df.withColumns(
        {c: round2(F.col(c).cast("double")) for c in money}
        | {c: F.col(c).cast("bigint") for c in whole}
    )


def parse_datetime(text: Column, fmt: str | None = None) -> Column:
    """Wall-clock timestamp of a text; unparsable text raises under ANSI mode."""
    return F.to_timestamp_ntz(text, F.lit(fmt)) if fmt else text.cast("timestamp_ntz")


def yes_no(flag: Column) -> Column:
    return F.when(flag, YES).otherwise(NO)
