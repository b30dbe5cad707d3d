"""Text forms used by delimited exports, and the names exports go under."""

from __future__ import annotations

import calendar
from collections.abc import Mapping
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# How a timestamp column is written, by the finest unit it uses.
DATETIME_FORMATS = {
    "day": "yyyy-MM-dd",
    "second": "yyyy-MM-dd HH:mm:ss",
    "millisecond": "yyyy-MM-dd HH:mm:ss.SSS",
    "microsecond": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


#: Up to so many significant digits a decimal text stands for one double only.
SURE_DIGITS = 15


@F.arrow_udf(T.StringType())
def _shortest(values: pa.Array) -> pa.Array:
    return pa.array([None if x is None else repr(x) for x in values.to_pylist()], pa.string())


def float_text(value: Column) -> Column:
    """Shortest decimal text of a double that reads back as it: plain digits while the
    exponent is in [-4, 16), otherwise ``1e+20`` / ``1.5e-07`` form; NaN becomes NULL.

    The JVM's own text reads back too, but before Java 19 it has a digit too many for
    some doubles. It is taken as it is where it is short and plain; the others are spelled in Arrow batches.
    """
    raw = F.abs(value).cast("string")
    short = raw.contains(".") & ~raw.contains("E") & (F.length(raw) <= SURE_DIGITS + 1)
    sign = F.when(value.cast("string").startswith("-"), "-").otherwise("")
    return F.when(short, F.concat(sign, raw)).otherwise(_shortest(F.when(~short & ~F.isnan(value), value)))


def is_datetime(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.TimestampType, T.TimestampNTZType))


def datetime_resolutions(df: DataFrame) -> dict[str, str]:
    """The finest unit each timestamp column uses, for all columns in one pass."""
    units = list(DATETIME_FORMATS)

    def finest(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        fraction = F.date_format(value, "SSSSSS")
        level = (
            F.when(value.cast("date").cast(field.dataType) == value, units.index("day"))
            .when(fraction == "000000", units.index("second"))
            .when(fraction.endswith("000"), units.index("millisecond"))
            .when(value.isNotNull(), units.index("microsecond"))
        )
        return F.max(level).alias(field.name)

    fields = [f for f in df.schema.fields if is_datetime(f.dataType)]
    if not fields:
        return {}
    levels = df.agg(*[finest(f) for f in fields]).first().asDict()
    return {name: units[level or 0] for name, level in levels.items()}


def as_export_text(df: DataFrame, resolutions: Mapping[str, str]) -> DataFrame:
    """The same rows with booleans, doubles and timestamps spelled for export.

    ``resolutions`` gives the unit of each timestamp column (default: second).
    """

    def cell(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.BooleanType):
            column = F.initcap(column.cast("string"))
        elif isinstance(field.dataType, T.DoubleType):
            column = float_text(column)
        elif isinstance(field.dataType, T.FloatType):
            column = float_text(column.cast("string").cast("double"))  # by its own shortest digits
        elif is_datetime(field.dataType):
            unit = resolutions.get(field.name, "second")
            column = F.date_format(column, DATETIME_FORMATS[unit])
        return column.alias(field.name)

    return df.select(*[cell(f) for f in df.schema.fields])


def export_name(stem: str | Column, day: date | Column | None = None) -> str | Column:
    """``<stem>_<yyyy-MM-dd>.csv``; the day defaults to today."""
    if isinstance(stem, Column) or isinstance(day, Column):
        stem = stem if isinstance(stem, Column) else F.lit(stem)
        day = F.current_date() if day is None else day if isinstance(day, Column) else F.lit(day)
        return F.concat(stem, F.lit("_"), F.date_format(day, "yyyy-MM-dd"), F.lit(".csv"))
    return f"{stem}_{day or date.today():%Y-%m-%d}.csv"


def publish_path(name: str | Column, day: date | Column | None = None) -> str | Column:
    """``<year>/<month name>/<name>``; the day defaults to today."""
    if isinstance(name, Column) or isinstance(day, Column):
        name = name if isinstance(name, Column) else F.lit(name)
        day = F.current_date() if day is None else day if isinstance(day, Column) else F.lit(day)
        return F.concat_ws("/", F.year(day).cast("string"), F.date_format(day, "MMMM"), name)
    day = day or date.today()
    return f"{day.year}/{calendar.month_name[day.month]}/{name}"
