"""Header rules. They touch the schema only, never a row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

_SEPARATORS = str.maketrans({" ": "_", "-": "_"})


def snake_case(header: str) -> str:
    return header.strip().lower().translate(_SEPARATORS)


def rename_headers(
    df: DataFrame, renames: Mapping[str, str] | None = None, *, snake: bool = True
) -> DataFrame:
    """Rename the given headers (absent ones are ignored), then snake-case all."""
    names = [(renames or {}).get(c, c) for c in df.columns]
    if snake:
        names = [snake_case(n) for n in names]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"several headers map to the same name: {', '.join(clashes)}")
    return df.toDF(*names)
