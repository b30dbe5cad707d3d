"""The corpus pipeline: five stages from raw documents to a mixed training corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each as Parquet to the shared folder and gives what it reads back to the next.
All stages but the last return the columns of ``documents``.

Edge cases: a null, empty or very short text fails the quality rules; rows that repeat id and text
pass or fail together, and of them one stays after ``near_duplicates``; null ids come last
among copies; ties go as each operator's docstring says; very long texts go whole
through every stage; extra columns, whatever their names, travel along up to the last stage;
empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import decontaminate, minhash, mixing, quality, templates
from tallymart.llm.storage import written
from tallymart.session import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy keeps."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their recurring lines; one that holds nothing else, line for line in other documents, goes.

    Copies, exact or near, count as one document and lose the same lines, so the next stage still finds them."""
    cut = templates.cut_recurring_lines(docs, groups=written(minhash.groups(docs)))
    return cut.where(F.col("text").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, on five-word shingles at a similarity of 0.8."""
    return minhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("lines", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

#: The sketches, templates and learned terms of the stages cannot be expressed in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
