"""Saved SQL scripts, one query per ``.sql`` file."""

from __future__ import annotations

from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUFFIX = ".sql"


def read_scripts(spark: SparkSession, folder: str, suffix: str = SUFFIX) -> dict[str, str]:
    """Script name (without suffix) -> query text, for the scripts in ``folder``.

    A plain path is a folder of the driver; a URI is read through Spark. Only
    query texts pass through the driver, never their results.
    """
    if urlparse(folder).scheme:
        files = (
            spark.read.option("wholetext", True)
            .option("pathGlobFilter", f"*{suffix}")
            .text(folder)
            .select(F.col("_metadata.file_name").alias("name"), "value")
            .collect()
        )
        texts = {row["name"]: row["value"] for row in files}
    else:
        paths = Path(folder).iterdir()
        texts = {p.name: p.read_text(encoding="utf-8") for p in paths if p.name.endswith(suffix)}
    return {name.removesuffix(suffix): texts[name] for name in sorted(texts)}


def run_script(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """The query as a lazy DataFrame. Without ``tables`` the text runs as it
    is; with them, ``{name}`` in the text stands for the given DataFrame, and
    every other brace for itself."""
    if not tables:
        return spark.sql(text)
    text = text.replace("{", "{{").replace("}", "}}")
    for name in tables:
        text = text.replace(f"{{{{{name}}}}}", f"{{{name}}}")
    return spark.sql(text, **tables)
