"""Outputs as numbered versions, with a manifest row that makes a version the present one.

A version is written beside the others and counts only when its manifest row is complete, which is
written last. A reader takes the newest complete version, so it never meets half of an overwrite, and a
job that stops leaves the version before it. Whether there is one is seen in the folder alone, before
any job is started.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST_SCHEMA = "number long, written_at string, note string"
_DONE = "_SUCCESS"


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _numbers(spark: SparkSession, folder: str, complete: bool) -> list[int]:
    """Numbers of the versions in a folder, by its listing."""
    fs, path = _fs(spark, folder)
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("number=") and (not complete or fs.exists(_fs(spark, f"{folder}/{name}/{_DONE}")[1])):
            found.append(int(name.removeprefix("number=")))
    return sorted(found)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions, oldest first. Starts no job."""
    return _numbers(spark, f"{path}/manifest", True)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A row for each complete version."""
    numbers = versions(spark, path)
    if not numbers:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path}/manifest")
    return rows.where(F.col("number").isin(numbers))


def version_path(path: str, number: int) -> str:
    return f"{path}/data/number={number}"


def write_version(
    spark: SparkSession, path: str, write: Callable[[str], None], note: str = "", keep: int | None = None
) -> int:
    """Write the next version with ``write(folder)`` and then its manifest row; returns its number.

    One writer at a time: two that take the same number fail at the manifest. ``keep`` drops all but so
    many of the newest versions, their manifest rows first; a reader has that long to finish.
    """
    taken = _numbers(spark, f"{path}/data", False) + _numbers(spark, f"{path}/manifest", False)
    number = max(taken, default=0) + 1
    write(version_path(path, number))
    row = spark.range(1).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("written_at"),
        F.lit(note).alias("note"),
    )
    row.coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifest/number={number}")
    if keep is not None:
        for old in versions(spark, path)[:-keep]:
            for folder in (f"{path}/manifest/number={old}", version_path(path, old)):
                fs, old_path = _fs(spark, folder)
                fs.delete(old_path, True)
    return number


def read_current(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """The newest complete version."""
    numbers = versions(spark, path)
    if not numbers:
        raise FileNotFoundError(f"no complete version: {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(version_path(path, numbers[-1]))


def reuse_or_write(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], schema: StructType | str, replace: bool = False
) -> DataFrame:
    """What is there, without a job and without calling ``build``; else, or to replace it, a new version."""
    if replace or not versions(spark, path):
        write_version(spark, path, lambda folder: build().write.parquet(folder))
    return read_current(spark, path, schema)
