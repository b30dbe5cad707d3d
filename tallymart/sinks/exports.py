"""Pipe-delimited exports under dated names.

An export is a dataset folder of part files written by the tasks, or one file; nothing is
gathered on the driver. Point ``root`` at any file system Spark can write to,
an object store included, and there is no separate upload.

Exports are written beside their path and take it when they are complete, so one that
fails leaves the old one as it is. One file replaces another by a rename, which
most file systems make atomic; a folder is moved aside first.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tallymart.functions.export_text import (
    as_export_text,
    datetime_resolutions,
    export_name,
    publish_path,
)
from tallymart.sinks import files
from tallymart.sources.scripts import read_scripts, run_script

# Fixed values of the export format.
CSV_OPTIONS = {
    "sep": "|",
    "header": "true",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def export_delimited(
    df: DataFrame,
    path: str,
    resolutions: Mapping[str, str] | None = None,
    single_file: bool = False,
) -> str:
    """Write ``df`` to ``path``, replacing what is there, and return the path.

    A timestamp column is written with the finest unit any of its values uses
    (a column of whole days as dates). ``resolutions`` names those units; when
    it is not given, one extra pass over the rows finds them.
    ``single_file`` makes ``path`` one file. One task streams the rows into it, as one
    file needs, so it is for reports; a failure costs that task, not what made the rows.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    text = as_export_text(df, datetime_resolutions(df) if resolutions is None else resolutions)
    if single_file:
        text = text.repartition(1)  # only the write is single, not what makes the rows
    parent, slash, name = path.rpartition("/")
    beside, old = (f"{parent}{slash}.{name}.{uuid.uuid4().hex[:12]}.{what}" for what in ("new", "old"))
    try:
        text.write.options(**CSV_OPTIONS).csv(beside)
        if files.is_folder(spark, path) or not single_file and files.exists(spark, path):
            files.move(spark, path, old)
        if single_file:
            (part,) = files.data_files(spark, beside)
            files.replace_file(spark, f"{beside}/{part}", path)
        else:
            files.move(spark, beside, path)
    except BaseException:
        if files.exists(spark, old) and not files.exists(spark, path):
            files.move(spark, old, path)
        raise
    finally:
        files.delete(spark, beside)
        if files.exists(spark, path):
            files.delete(spark, old)
    return path


def publish(df: DataFrame, root: str, stem: str, day: date | None = None, **options) -> str:
    """Export to ``<root>/<year>/<month name>/<stem>_<day>.csv``.

    Publishing the same stem on the same day replaces the earlier export. Give
    ``day`` so that a rerun writes where the first run did.
    """
    path = f"{root.rstrip('/')}/{publish_path(export_name(stem, day), day)}"
    return export_delimited(df, path, **options)


def publish_scripts(
    spark: SparkSession,
    folder: str,
    root: str,
    day: date | None = None,
    tables: Mapping[str, DataFrame] | None = None,
    **options,
) -> dict[str, str]:
    """Run every script in ``folder`` and publish its result under its name.

    ``tables`` names the DataFrames that ``{name}`` stands for in the scripts.
    """
    day = day or date.today()
    return {
        stem: publish(run_script(spark, text, **(tables or {})), root, stem, day, **options)
        for stem, text in read_scripts(spark, folder).items()
    }
