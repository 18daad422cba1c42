"""State tables on plain parquet: appended events and versioned snapshots."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, or no rows when it has not been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_events(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


class SnapshotConflict(RuntimeError):
    """Another writer committed the version that this one was to become."""


def write_snapshot(df: DataFrame, path: str, parent: int | None = None) -> int:
    """Write ``df`` as the version after ``parent``, by default the current one, and return its number.

    The rows go to a folder of their own; a complete commit file, renamed into a place that only one writer can take, then names it. Readers keep
    the version before until it is there. A writer that comes second, or that read a version which is
    no longer the current one and passed it as ``parent``, gets a ``SnapshotConflict`` and changes nothing.
    """
    spark = df.sparkSession
    version = (current_version(spark, path) if parent is None else parent) + 1
    folder = str(uuid.uuid4())
    df.write.parquet(f"{path}/rows/{folder}")
    if not claim(spark, f"{path}/commits", version, folder):
        raise SnapshotConflict(f"version {version} of {path} exists")
    return version


def claim(spark: SparkSession, path: str, number: int, folder: str) -> bool:
    """Commit ``folder`` under ``number`` in the folder ``path``; False if that number is taken.

    A complete file is renamed into a place that only one writer can take.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    commit = hadoop.Path(f"{path}/{number:012d}")
    conf = spark._jsc.hadoopConfiguration()
    files = commit.getFileSystem(conf)
    commit, draft = files.makeQualified(commit), files.makeQualified(hadoop.Path(f"{path}/.{uuid.uuid4()}"))
    out = files.create(draft)
    out.write(f"{number} {folder}\n".encode())
    out.close()
    # Without options a rename never replaces a file.
    no_options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        hadoop.FileContext.getFileContext(commit.toUri(), conf).rename(draft, commit, no_options)
    except Py4JJavaError as error:
        if "AlreadyExists" not in error.java_exception.getClass().getName():
            raise
        files.delete(draft, False)
        return False
    return True


def read_snapshot(spark: SparkSession, path: str, schema: str) -> DataFrame:
    last = _last_commit(spark, path)
    return spark.createDataFrame([], schema) if last is None else spark.read.schema(schema).parquet(f"{path}/rows/{last[1]}")


def current_version(spark: SparkSession, path: str) -> int:
    """The number of the current version, 0 before the first."""
    last = _last_commit(spark, path)
    return 0 if last is None else last[0]


def _last_commit(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """Version and folder of the last commit: one line in each commit file."""
    try:
        lines = spark.read.text(f"{path}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    parts = F.split("value", " ")
    found = lines.agg(F.max(F.struct(parts[0].cast("bigint").alias("version"), parts[1].alias("folder"))).alias("last")).first()
    return None if found["last"] is None else tuple(found["last"])
