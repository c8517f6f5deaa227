"""The progress ledger: an append-only table of what was done per (phase, dataset, subset).

A record is never changed in place. A commit, a reset or a delete appends a row with a higher
``seq``; the state of a key is its newest row, and a delete hides it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from textloom.functions.formats import elapsed_micros, format_duration, safe_ratio, status_text

RECORD_FIELDS = [
    StructField("dataset_name", StringType()),
    StructField("subset", StringType()),
    StructField("phase", StringType()),
    StructField("total_samples_processed", LongType()),
    StructField("total_tokens_processed", LongType()),
    StructField("files_created", IntegerType()),
    StructField("current_file_idx", IntegerType()),
    StructField("samples_in_current_file", IntegerType()),
    StructField("completed", BooleanType()),
    StructField("failed", BooleanType()),
    StructField("error_message", StringType()),
    StructField("retry_count", IntegerType()),
    StructField("started_at", StringType()),
    StructField("last_checkpoint_at", StringType()),
]
LEDGER_SCHEMA = StructType(
    [*RECORD_FIELDS, StructField("seq", LongType()), StructField("op", StringType())]
)
KEY = ("phase", "dataset_name", "subset")

# Defaults of a record's fields, and how often a failed dataset is retried.
DEFAULT_PHASE = "phase1"
DEFAULT_SUBSET = "default"
UNKNOWN = "Unknown"
UNKNOWN_ERROR = "Unknown error"
MAX_RETRIES = 3

_COUNTERS = [f for f in RECORD_FIELDS if isinstance(f.dataType, (LongType, IntegerType))]


def checkpoint_key() -> Column:
    """One text for a key, used for sorting and file names."""
    return F.concat_ws("_", F.col("phase"), F.col("dataset_name"), F.coalesce("subset", F.lit(DEFAULT_SUBSET)))


def latest(ledger: DataFrame) -> DataFrame:
    """Newest row of each key, deleted keys left out; ``seq`` is unique within a key.

    The newest ``seq`` is a hash aggregate with map-side combine, and the rows are joined back on it;
    the key is one struct, which is never null and in which nulls are equal.
    """
    keyed = ledger.withColumn("_key", F.struct(*KEY))
    newest = keyed.groupBy("_key").agg(F.max("seq").alias("seq"))
    return keyed.join(newest, ["_key", "seq"]).where(F.col("op") != "delete").select(*ledger.columns)


def with_defaults(state: DataFrame) -> DataFrame:
    """Counters default to 0 and flags to false; a null counts as missing."""
    filled = {f.name: F.coalesce(F.col(f.name), F.lit(0)).cast(f.dataType) for f in _COUNTERS}
    filled.update({c: F.coalesce(F.col(c), F.lit(False)) for c in ("completed", "failed")})
    return state.withColumns({k: v for k, v in filled.items() if k in state.columns})


def status_list(state: DataFrame) -> DataFrame:
    """One row per record with its status, by key."""
    return with_defaults(state).select(
        checkpoint_key().alias("checkpoint_key"),
        status_text(F.col("completed"), F.col("failed")).alias("status"),
        "dataset_name",
        F.coalesce("subset", F.lit(DEFAULT_SUBSET)).alias("subset"),
        "phase",
        F.col("total_samples_processed").alias("samples"),
        F.col("total_tokens_processed").alias("tokens"),
        F.col("files_created").alias("files"),
        F.col("retry_count").alias("retries"),
        "started_at",
        "last_checkpoint_at",
        "error_message",
    ).orderBy("checkpoint_key")


def summary(state: DataFrame) -> DataFrame:
    """One row: records by status, totals, and speed over records that have both times.

    A record that is both completed and failed is counted in both and so taken twice from the
    number in progress. Times are summed as whole microseconds and divided once.
    """
    micros = elapsed_micros(F.col("started_at"), F.col("last_checkpoint_at"))
    totals = with_defaults(state).agg(
        F.count(F.lit(1)).alias("total_datasets"),
        F.count_if("completed").alias("completed"),
        F.count_if("failed").alias("failed"),
        F.coalesce(F.sum("total_samples_processed"), F.lit(0)).alias("total_samples"),
        F.coalesce(F.sum("total_tokens_processed"), F.lit(0)).alias("total_tokens"),
        F.coalesce(F.sum(micros), F.lit(0)).alias("total_micros"),
    )
    seconds = F.col("total_micros") / F.lit(1e6)
    return totals.select(
        "total_datasets",
        "completed",
        "failed",
        (F.col("total_datasets") - F.col("completed") - F.col("failed")).alias("in_progress"),
        "total_samples",
        "total_tokens",
        seconds.alias("total_time"),
        safe_ratio(F.col("total_samples"), seconds).alias("samples_per_sec"),
        safe_ratio(F.col("total_tokens"), seconds).alias("tokens_per_sec"),
        format_duration(seconds).alias("processing_time"),
    )


def durations(state: DataFrame) -> DataFrame:
    """Seconds between start and last checkpoint of each record, as a number and as text."""
    seconds = elapsed_micros(F.col("started_at"), F.col("last_checkpoint_at")) / F.lit(1e6)
    return state.select(*KEY, seconds.alias("seconds"), format_duration(seconds).alias("duration"))


def in_progress(state: DataFrame, as_of: Column) -> DataFrame:
    """Records neither completed nor failed, with the time elapsed until ``as_of``."""
    micros = F.unix_micros(as_of) - F.unix_micros(F.try_to_timestamp("started_at"))
    return (
        with_defaults(state)
        .where(~F.col("completed") & ~F.col("failed"))
        .select(
            F.coalesce("dataset_name", F.lit(UNKNOWN)).alias("dataset_name"),
            F.coalesce("subset", F.lit(DEFAULT_SUBSET)).alias("subset"),
            F.col("total_samples_processed").alias("samples"),
            F.col("total_tokens_processed").alias("tokens"),
            F.col("files_created").alias("files"),
            F.coalesce(format_duration(micros / F.lit(1e6)), F.lit(UNKNOWN)).alias("elapsed"),
        )
    )


def failures(state: DataFrame) -> DataFrame:
    """Failed records with their error and retries."""
    return (
        with_defaults(state)
        .where("failed")
        .select(
            F.coalesce("dataset_name", F.lit(UNKNOWN)).alias("dataset_name"),
            F.coalesce("subset", F.lit(DEFAULT_SUBSET)).alias("subset"),
            F.coalesce("error_message", F.lit(UNKNOWN_ERROR)).alias("error"),
            F.col("retry_count").alias("retries"),
            F.lit(MAX_RETRIES).alias("max_retries"),
        )
    )


def _append(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    return ledger.unionByName(rows.select(*ledger.columns))


def _selected(ledger: DataFrame, dataset_name: str, subset: str | None, phase: str) -> DataFrame:
    same = (F.col("dataset_name") == dataset_name) & (F.col("phase") == phase)
    return latest(ledger.where(same & F.col("subset").eqNullSafe(F.lit(subset))))


def _tombstones(state: DataFrame) -> DataFrame:
    return state.withColumn("op", F.lit("delete")).withColumn("seq", F.col("seq") + 1)


def reset_rows(
    ledger: DataFrame, dataset_name: str, subset: str | None = None, phase: str = DEFAULT_PHASE, now: Column | None = None
) -> DataFrame:
    """The row that sets a record back to its start; none when there is no such record."""
    started = F.date_format(now if now is not None else F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    zero = {f.name: F.lit(0).cast(f.dataType) for f in _COUNTERS}
    return _selected(ledger, dataset_name, subset, phase).withColumns(
        {
            **zero,
            "completed": F.lit(False),
            "failed": F.lit(False),
            "error_message": F.lit(None).cast("string"),
            "started_at": started,
            "seq": F.col("seq") + 1,
            "op": F.lit("reset"),
        }
    )


def reset(ledger: DataFrame, dataset_name: str, subset: str | None = None, phase: str = DEFAULT_PHASE, now: Column | None = None) -> DataFrame:
    """The ledger with a reset appended."""
    return _append(ledger, reset_rows(ledger, dataset_name, subset, phase, now))


def delete(ledger: DataFrame, dataset_name: str, subset: str | None = None, phase: str = DEFAULT_PHASE) -> DataFrame:
    """The ledger with a delete appended."""
    return _append(ledger, _tombstones(_selected(ledger, dataset_name, subset, phase)))


def clear_failed(ledger: DataFrame) -> DataFrame:
    """The ledger with a delete appended for every failed record."""
    return _append(ledger, failed_tombstones(ledger))


def failed_tombstones(ledger: DataFrame) -> DataFrame:
    """The deletes that ``clear_failed`` appends; their number is what it reports."""
    return _tombstones(latest(ledger).where(F.coalesce("failed", F.lit(False))))


def unfinished(work: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of ``work`` whose (phase, dataset, subset) is not completed in the ledger."""
    done = latest(ledger).where(F.coalesce("completed", F.lit(False))).select(
        *[F.col(c).alias(f"_{c}") for c in KEY]
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in KEY]
    return work.join(done, same[0] & same[1] & same[2], "left_anti")
