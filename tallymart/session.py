"""Session settings and the shared folder that written intermediates go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

# Adaptive execution carries the plans: it measures shuffles before it
# broadcasts, splits skewed join partitions and merges small ones. The number of
# shuffle partitions stays Spark's default unless it is given: set it to about
# the shuffled bytes over 200 MB; smaller batches are coalesced.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# The shuffle files of a write go when it has ended, not when the driver happens to collect its garbage.
CLEAN_STEPS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# A task that writes rows of several batches has their files open side by side and sorts nothing.
SIDE_BY_SIDE = CLEAN_STEPS | {"spark.sql.maxConcurrentOutputFileWriters": "16"}
# Code for a whole stage that cleans and collapses lines of so many columns is one method beyond what the JVM
# compiles; operators of their own come in small methods.
WIDE_STEPS = CLEAN_STEPS | {"spark.sql.codegen.wholeStage": "false"}


def drop_shuffles(spark: SparkSession) -> None:
    """Let the shuffle files of SQL inserts go, which ``CLEAN_STEPS`` does not cover: Spark deletes them when the
    driver collects its garbage, which a large heap hardly ever does by itself."""
    spark._jvm.System.gc()


@contextmanager
def steps(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """``settings`` hold for what the session runs inside, its own ones again afterwards."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def build_session(
    app_name: str = "tallymart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (SETTINGS | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="tallymart-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in
    ``spark.checkpoint.dir``. Only a local session gets one made for it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _local_folder(context.applicationId)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
