"""Checkpoint files (JSON) and file inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from textloom.operators.ledger import RECORD_FIELDS

_CORRUPT = "_corrupt_record"
_FILE_SCHEMA = StructType([*RECORD_FIELDS, StructField(_CORRUPT, StringType())])


def _read(spark: SparkSession, folder: str, recursive: bool, pattern: str) -> DataFrame:
    """One row per file: its stem, its text, and the record parsed from it."""
    files = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", recursive)
        .text(folder, wholetext=True)
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = files.select(
        F.regexp_replace("_metadata.file_name", r"\.[^.]+$", "").alias("checkpoint_key"),
        F.col("value").alias("content"),
        F.from_json("value", _FILE_SCHEMA, options).alias("record"),
    )
    broken = F.col("record").isNull() | F.col(f"record.{_CORRUPT}").isNotNull()
    return parsed.withColumn("broken", broken)


def scan_checkpoints(spark: SparkSession, folder: str, recursive: bool = False, pattern: str = "*.json") -> DataFrame:
    """All readable checkpoint files of a folder, keyed by file stem; others are skipped."""
    rows = _read(spark, folder, recursive, pattern).where(~F.col("broken"))
    return rows.select("checkpoint_key", *[F.col(f"record.{f.name}") for f in RECORD_FIELDS])


def corrupt_checkpoints(
    spark: SparkSession, folder: str, recursive: bool = False, pattern: str = "*.json"
) -> DataFrame:
    """Files that could not be read, with what they hold."""
    return _read(spark, folder, recursive, pattern).where("broken").select("checkpoint_key", "content")


def inventory(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """Path and size of the files below a folder; their contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "length")
    )
