"""Watch mode: the ledger as a stream of status counts, or of the whole report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.functions.formats import status_text
from textloom.operators.ledger import KEY, LEDGER_SCHEMA
from textloom.plans.report import report_table
from textloom.session import write_and_read
from textloom.sources.versions import write_version

# Fixed value: seconds between two refreshes.
WATCH_SECONDS = 30
# Refreshes that stay readable.
KEPT = 3


def ledger_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The ledger's files as they arrive."""
    reader = spark.readStream.schema(LEDGER_SCHEMA)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def latest_stream(ledger: DataFrame) -> DataFrame:
    """Newest state per key as a streaming aggregate; state is one row per key."""
    fields = F.struct("seq", "op", "completed", "failed", "total_samples_processed", "total_tokens_processed")
    return ledger.groupBy(*KEY).agg(F.max_by(fields, "seq").alias("state")).select(*KEY, "state.*")


def status_counts(latest: DataFrame) -> DataFrame:
    """Records, samples and tokens by status (over one refresh of ``latest_stream``)."""
    live = latest.where(F.col("op") != "delete")
    return live.groupBy(status_text(F.col("completed"), F.col("failed")).alias("status")).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("total_samples_processed").alias("samples"),
        F.sum("total_tokens_processed").alias("tokens"),
    )


def state_stream(ledger: DataFrame) -> DataFrame:
    """The newest whole record of each key as a streaming aggregate; state is one record per key.

    Arrivals may come in any order: a late row with a lower ``seq`` changes nothing.
    """
    fields = [f.name for f in LEDGER_SCHEMA.fields if f.name not in KEY]
    newest = F.max_by(F.struct(*fields), "seq").alias("state")
    return ledger.groupBy(*KEY).agg(newest).select(*KEY, "state.*")


def _start(
    stream: DataFrame, output: str, show: Callable[[DataFrame], DataFrame], seconds: int | None, checkpoint: str | None
) -> StreamingQuery:
    """Write what ``show`` makes of all keys to ``output`` at every refresh, as a version of its own."""

    def refresh(batch: DataFrame, batch_id: int) -> None:
        rows = show(batch).coalesce(1)
        write_version(batch.sparkSession, output, rows.write.parquet, f"refresh {batch_id}", KEPT)

    writer = stream.writeStream.outputMode("complete").foreachBatch(refresh)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


def watch(
    ledger: DataFrame, output: str, seconds: int | None = WATCH_SECONDS, checkpoint: str | None = None
) -> StreamingQuery:
    """Write the current status counts to ``output`` at every refresh, as a version of their own.

    ``seconds=None`` refreshes once over all that is there, then stops.
    """
    return _start(latest_stream(ledger), output, status_counts, seconds, checkpoint)


def watch_report(
    ledger: DataFrame,
    output: str,
    as_of: Callable[[], Column] = F.current_timestamp,
    files: Callable[[], DataFrame] | None = None,
    seconds: int | None = WATCH_SECONDS,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Write the whole report to ``output`` at every refresh: summary, storage, records in progress with
    the time elapsed until ``as_of``, failed records and the status list.

    ``files`` gives the inventory anew at each refresh; without it there is no storage section.
    """

    def show(batch: DataFrame) -> DataFrame:
        # A refresh reads its keys in every section; they are a row each.
        kept = write_and_read(batch.where(F.col("op") != "delete"), "watched")
        return report_table(kept, files() if files is not None else None, as_of())

    return _start(state_stream(ledger), output, show, seconds, checkpoint)
