"""Files of any file system that Spark writes to: list, move, replace, delete.

Only names pass through the driver, never contents.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _java_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _conf(spark: SparkSession):
    return spark._jsparkSession.sessionState().newHadoopConf()


def _system(spark: SparkSession, path: str):
    return _java_path(spark, path).getFileSystem(_conf(spark))


def qualified(spark: SparkSession, path: str) -> str:
    """The one spelling of a path, with its file system."""
    return _system(spark, path).makeQualified(_java_path(spark, path)).toString()


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_java_path(spark, path))


def is_folder(spark: SparkSession, path: str) -> bool:
    system, where = _system(spark, path), _java_path(spark, path)
    return system.exists(where) and system.getFileStatus(where).isDirectory()


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in ``folder`` in order; none if it is not there."""
    system, where = _system(spark, folder), _java_path(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(where)) if system.exists(where) else []


def data_files(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in names(spark, folder) if not n.startswith(("_", "."))]


def delete(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_java_path(spark, path), True)


def make_folder(spark: SparkSession, path: str) -> None:
    _system(spark, path).mkdirs(_java_path(spark, path))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename to a path that is not there yet."""
    if not _system(spark, source).rename(_java_path(spark, source), _java_path(spark, target)):
        raise OSError(f"{source} could not be moved to {target}")


def replace_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file over ``target``; on file systems with an atomic rename, readers see the old or the new one."""
    system = _system(spark, target)
    parent = _java_path(spark, target).getParent()
    system.mkdirs(parent)
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(system.makeQualified(parent).toUri(), _conf(spark))
    qualified = [system.makeQualified(_java_path(spark, p)) for p in (source, target)]
    context.rename(qualified[0], qualified[1], options)
