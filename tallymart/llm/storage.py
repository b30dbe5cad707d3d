"""Cutting lineage through the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallymart.session import fresh_path


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the folder that the session names in ``spark.checkpoint.dir`` and read from there.

    A written table also sheds the conditions that the optimizer knows of ``df``;
    over the rounds of an iteration it would combine them without end.
    """
    path = fresh_path(df.sparkSession, "written")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
