"""Date texts of unknown form: which order day and month have is read off the whole column.

Year-first dates and dates with a named month can be read in one way only, so each such cell is
taken as it is. Where both other parts are numbers, one order must fit all cells of the column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names as dates spell them, and the orders of numeric dates.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
YEAR_FIRST, MONTH_FIRST, DAY_FIRST = "ymd", "mdy", "dmy"

_TIME = r"(?:[ T]+([0-9]{1,2}):([0-9]{2})(?::([0-9]{2}(?:\.[0-9]{1,6})?))?)?$"
_YEAR_FIRST = r"^([0-9]{4})([-/.])([0-9]{1,2})\2([0-9]{1,2})" + _TIME
_COMPACT = r"^([0-9]{4})()([0-9]{2})([0-9]{2})" + _TIME
_TWO_NUMBERS = r"^([0-9]{1,2})([-/.])([0-9]{1,2})\2([0-9]{4})" + _TIME
_DAY_NAME_YEAR = r"^([0-9]{1,2})([- ])([A-Za-z]{3})[a-z]*\.?\2([0-9]{4})" + _TIME
_NAME_DAY_YEAR = r"^([A-Za-z]{3})[a-z]*(\.? )([0-9]{1,2}), ?([0-9]{4})" + _TIME


class AmbiguousDates(ValueError):
    """Day and month could be either way round in a column."""


class UnreadableDates(ValueError):
    """No order of day and month fits all cells of a column."""


#: Each pattern with what its groups 1, 3 and 4 are; a cell fits one pattern at most.
_FORMS = {
    "two": (_TWO_NUMBERS, None),
    "year": (_YEAR_FIRST, "ymd"),
    "compact": (_COMPACT, "ymd"),
    "day name": (_DAY_NAME_YEAR, "dny"),
    "name day": (_NAME_DAY_YEAR, "ndy"),
}
_PARTS = "$1\u0001$3\u0001$4\u0001$5\u0001$6\u0001$7"


def _parts(text: Column) -> Column:
    """The form of a cell and the texts of its parts, by one replacement under the pattern it fits; NULL if it fits none.

    Select it as a column of its own before it is used, so that a cell is matched once.
    """
    found = F.lit(None).cast("array<string>")
    for form, (pattern, _) in reversed(_FORMS.items()):
        split = F.split(F.regexp_replace(text, F.lit(pattern), F.lit(_PARTS)), "\u0001", -1)
        found = F.when(text.rlike(pattern), F.concat(F.array(F.lit(form)), split)).otherwise(found)
    return found


def _at(parts: Column, order: str) -> Column:
    """The time that parts say when a date of two numbers has ``order``; NULL if they do not fit."""
    form = F.get(parts, F.lit(0))
    two = lambda part: F.lpad(part, 2, "0")

    def place(kind: str) -> Column:
        places = {f: (o or order).find(kind) + 1 for f, (_, o) in _FORMS.items()}
        chosen = F.lit(None).cast("int")
        for at in sorted({p for p in places.values() if p}):
            chosen = F.when(form.isin(*[f for f, p in places.items() if p == at]), at).otherwise(chosen)
        return chosen

    named = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.get(parts, place("n"))))
    month = F.when(form.isin("day name", "name day"), named.cast("string")).otherwise(F.get(parts, place("m")))
    day = F.concat(F.get(parts, place("y")), F.lit("-"), two(month), F.lit("-"), two(F.get(parts, place("d"))))
    clock = F.concat(two(F.get(parts, F.lit(4))), F.lit(":"), two(F.get(parts, F.lit(5))), F.lit(":"))
    # the patterns pass over a line end after the cell, which stays behind the last part
    seconds, space = F.translate(F.get(parts, F.lit(6)), "\n\r\u0085\u2028\u2029", ""), F.lit(" ")
    # a minute may have a second 60, which is the next minute
    over = seconds.rlike(r"^60(\.0*)?$")
    spelled = F.when(over, "59").when(seconds == "", "00").otherwise(seconds)
    made = F.concat(day, space, clock, spelled).try_cast("timestamp_ntz")
    made = F.when(over, made + F.expr("INTERVAL '1' SECOND")).otherwise(made)
    return F.when(form != "two", made) if order == YEAR_FIRST else F.when(form.isNotNull(), made)


def detect_orders(df: DataFrame, columns: Sequence[str], prefer: str | None = None) -> dict[str, str]:
    """The order of day and month in each column, from all cells of all columns in one aggregation.

    ``YEAR_FIRST`` means that no cell leaves it open. Missing cells fit everything. Where both orders fit
    all cells and differ in some, ``prefer`` decides, and without it the column is refused.
    """

    def read(i: int) -> list[Column]:
        """Whether a cell is there, and its time by each order."""
        orders = (YEAR_FIRST, MONTH_FIRST, DAY_FIRST)
        return [F.col(f"there {i}"), *[_at(F.col(f"parts {i}"), o).alias(f"{o} {i}") for o in orders]]

    def counts(name: str, i: int) -> Column:
        there = F.col(f"there {i}")
        clear, month, day = (F.col(f"{o} {i}") for o in (YEAR_FIRST, MONTH_FIRST, DAY_FIRST))
        return F.struct(
            F.count_if(there & clear.isNull()).alias("open"),
            F.count_if(there & month.isNull()).alias("no_month_first"),
            F.count_if(there & day.isNull()).alias("no_day_first"),
            F.count_if(month != day).alias("differ"),
        ).alias(name)

    texts = [F.trim(F.col(f"`{c}`")) for c in columns]
    parts = [c for i, t in enumerate(texts) for c in ((t != "").alias(f"there {i}"), _parts(t).alias(f"parts {i}"))]
    times = [c for i in range(len(columns)) for c in read(i)]
    found = df.select(*parts).select(*times).agg(*[counts(c, i) for i, c in enumerate(columns)]).first()
    return {name: _decided(name, found[name], prefer) for name in columns}


def _decided(name: str, count: Mapping[str, int], prefer: str | None) -> str:
    if not count["open"]:
        return YEAR_FIRST
    if count["no_month_first"] and count["no_day_first"]:
        least = min(count["no_month_first"], count["no_day_first"])
        raise UnreadableDates(f"{least} or more cells of {name!r} are no dates in any order")
    if count["no_month_first"]:
        return DAY_FIRST
    if count["no_day_first"]:
        return MONTH_FIRST
    if count["differ"] and prefer is None:
        raise AmbiguousDates(f"{count['differ']} cells of {name!r} can be read day first or month first")
    return prefer or MONTH_FIRST


def parse_detected(
    df: DataFrame, columns: Sequence[str], prefer: str | None = None, orders: Mapping[str, str] | None = None
) -> DataFrame:
    """``df`` with date texts as timestamps, each column by the order found in it.

    ``orders`` are those that ``detect_orders`` found, if it ran already.
    """
    orders = detect_orders(df, columns, prefer) if orders is None else orders
    parts = {f"__parts {c}": _parts(F.trim(F.col(f"`{c}`"))) for c in columns}
    times = {c: _at(F.col(f"`__parts {c}`"), orders[c]) for c in columns}
    return df.withColumns(parts).withColumns(times).drop(*parts)
