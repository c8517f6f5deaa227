"""Stream to tokenized Parquet, with a ledger row per micro-batch.

Each micro-batch writes its records to its own ``batch_id=N`` directory, then the totals of all
datasets so far, then its ledger rows, all in overwrite mode: a batch that is replayed after a
lost driver replaces what it had written. A batch builds on the totals of the batch before it
and on nothing else, so a replay sees what the first try saw, and a batch costs the same however
many went before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from textloom.functions.text import MIN_CHARS, long_enough
from textloom.functions.tokens import MAX_LENGTH, Codec
from textloom.operators.encoding import TOKENIZED_SCHEMA, encode_records
from textloom.operators.ledger import LEDGER_SCHEMA, MAX_RETRIES, latest
from textloom.operators.quota import take_with_room
from textloom.session import write_and_read
from textloom.sources.catalog import marker_of
from textloom.sources.sinks import write_records
from textloom.sources.tables import filter_documents

# Fixed value: samples between two progress records. File streams are bounded by files or bytes.
CHECKPOINT_SAMPLES = 1_000
# Commits of successive batches are this far apart, which leaves room for resets and deletes.
SEQ_STEP = 1_024

RECORD_SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        *TOKENIZED_SCHEMA.fields,
        StructField("phase", StringType()),
    ]
)


@dataclass
class IngestOptions:
    """What to ingest and how.

    ``max_samples`` is a quota per dataset over the whole stream. ``complete`` marks all datasets
    as completed when a run has taken in everything there is. ``interval`` is the number of samples
    between two ledger rows and ``step_intervals`` how many of them are written together; both are
    for the ingest of a catalogue, where a unit's batch is one commit if ``interval`` is not set.
    """

    phases: list[str] | None = None
    languages: list[str] | None = None
    min_chars: int = MIN_CHARS
    max_length: int = MAX_LENGTH
    pad_to_max: bool = False
    markers: bool = False
    max_samples: int | None = None
    complete: bool = False
    interval: int | None = None
    step_intervals: int = 1_024


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
) -> DataFrame:
    """A folder of Parquet files as a stream; the bound on a batch is files or bytes."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.parquet(path)


TOTALS_SCHEMA = StructType(
    [
        StructField("phase", StringType()),
        StructField("dataset_name", StringType()),
        StructField("samples", LongType()),
        StructField("tokens", LongType()),
        StructField("files", LongType()),
        StructField("started_at", StringType()),
        StructField("retry_count", LongType()),
    ]
)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def read_ledger(spark: SparkSession, output: str) -> DataFrame:
    """Committed ledger rows."""
    path = f"{output}/ledger"
    schema = StructType([*LEDGER_SCHEMA.fields, StructField("batch_id", LongType())])
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_records(spark: SparkSession, output: str) -> DataFrame:
    """Records of committed batches: data without a ledger row is not there yet."""
    schema = StructType([*RECORD_SCHEMA.fields, StructField("batch_id", LongType())])
    committed = read_ledger(spark, output).select("batch_id").distinct()
    rows = spark.read.schema(schema).parquet(f"{output}/data")
    return rows.join(committed, "batch_id", "left_semi")


def totals_before(spark: SparkSession, output: str, batch_id: int) -> DataFrame:
    """Samples, tokens and files per (phase, dataset) when a batch starts.

    Every batch but the first needs the totals of the one before it: without them quotas would start
    afresh, so their loss is an error.
    """
    if batch_id == 0:
        return spark.createDataFrame([], TOTALS_SCHEMA)
    path = f"{output}/totals/batch_id={batch_id - 1}"
    if not _exists(spark, path):
        raise FileNotFoundError(f"batch {batch_id} needs the totals of the batch before it: {path}")
    return spark.read.schema(TOTALS_SCHEMA).parquet(path)


def _within_quota(batch: DataFrame, totals: DataFrame, max_samples: int) -> DataFrame:
    """The rows for which their (phase, dataset) still has room; nulls are names like any other."""
    names = batch.select("phase", "dataset").distinct()
    same = names["phase"].eqNullSafe(totals["phase"]) & names["dataset"].eqNullSafe(totals["dataset_name"])
    room = F.lit(max_samples) - F.coalesce(totals["samples"], F.lit(0))
    left = names.join(totals, same, "left").select(names["phase"], names["dataset"], room.alias("room"))
    return take_with_room(batch, left, ["phase", "dataset"])


def _new_totals(records: DataFrame, totals: DataFrame, retries: int) -> DataFrame:
    """Totals after a batch, with ``new_samples`` for the datasets the batch added to.

    ``retries`` is how often the query was started again in this run.
    """
    fresh = records.groupBy("phase", F.col("dataset").alias("dataset_name")).agg(
        F.count(F.lit(1)).alias("new_samples"), F.sum("length").alias("new_tokens")
    )

    def total(name: str, added):
        return (F.coalesce(F.col(name), F.lit(0)) + F.coalesce(added, F.lit(0))).cast("bigint").alias(name)

    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    before = totals.withColumnsRenamed({"phase": "_phase", "dataset_name": "_name"})
    same = fresh["phase"].eqNullSafe(before["_phase"]) & fresh["dataset_name"].eqNullSafe(before["_name"])
    # A row has one side or both; a null name stays null either way.
    return fresh.join(before, same, "full").select(
        F.coalesce("phase", "_phase").alias("phase"),
        F.coalesce("dataset_name", "_name").alias("dataset_name"),
        total("samples", F.col("new_samples")),
        total("tokens", F.col("new_tokens")),
        total("files", F.when(F.col("new_samples").isNotNull(), 1)),
        F.coalesce("started_at", now).alias("started_at"),
        F.greatest(F.coalesce("retry_count", F.lit(0)), F.lit(retries)).cast("bigint").alias("retry_count"),
        "new_samples",
    )


def _ledger_rows(totals: DataFrame, batch_id: int) -> DataFrame:
    """One commit row for each dataset the batch added to."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return totals.where("new_samples is not null").select(
        "dataset_name",
        F.lit(None).cast("string").alias("subset"),
        "phase",
        F.col("samples").alias("total_samples_processed"),
        F.col("tokens").alias("total_tokens_processed"),
        F.col("files").cast("int").alias("files_created"),
        F.col("files").cast("int").alias("current_file_idx"),
        F.lit(0).alias("samples_in_current_file"),
        F.lit(False).alias("completed"),
        F.lit(False).alias("failed"),
        F.lit(None).cast("string").alias("error_message"),
        F.col("retry_count").cast("int").alias("retry_count"),
        "started_at",
        now.alias("last_checkpoint_at"),
        F.lit(batch_id * SEQ_STEP).cast("bigint").alias("seq"),
        F.lit("commit").alias("op"),
    )


def write_batch(
    batch: DataFrame, batch_id: int, codec: Codec, output: str, options: IngestOptions, retries: int = 0
) -> None:
    """Encode one micro-batch, write it with the totals so far, then commit it to the ledger.

    Raw texts are moved to the dataset they belong to and encoded there, so no ids are shuffled.
    """
    spark = batch.sparkSession
    totals = totals_before(spark, output, batch_id)
    rows = filter_documents(batch, options.phases, options.languages)
    rows = rows.where(long_enough(F.col("text"), options.min_chars))
    if options.max_samples is not None:
        rows = _within_quota(rows, totals, options.max_samples)
    records = encode_records(
        rows.hint("rebalance", "phase", "dataset"),
        codec,
        marker=marker_of(F.col("language")) if options.markers else None,
        keep=["doc_id", "phase"],
        max_length=options.max_length,
        pad_to_max=options.pad_to_max,
    )
    data_path, totals_path = f"{output}/data/batch_id={batch_id}", f"{output}/totals/batch_id={batch_id}"
    write_records(records, data_path, compact=False)
    written = spark.read.schema(RECORD_SCHEMA).parquet(data_path)
    _new_totals(written, totals, retries).coalesce(1).write.mode("overwrite").parquet(totals_path)
    after = spark.read.schema(StructType([*TOTALS_SCHEMA.fields, StructField("new_samples", LongType())])).parquet(totals_path)
    _ledger_rows(after, batch_id).coalesce(1).write.mode("overwrite").parquet(f"{output}/ledger/batch_id={batch_id}")


# Ledger rows that close runs go to a directory that no batch uses.
_CLOSED = -1


def _names_of(batch: DataFrame) -> DataFrame | None:
    """Phases and datasets of a batch as a table; None if the batch cannot be read."""
    try:
        names = batch.select("phase", F.col("dataset").alias("dataset_name")).distinct()
        return write_and_read(names, "failed-names")
    except PySparkException:
        return None


def _close(spark: SparkSession, output: str, names: DataFrame, **values) -> None:
    """Append a row with some fields set for each (phase, dataset_name) of ``names``, newer than its
    newest commit; one that has none gets a first row."""
    state = latest(read_ledger(spark, output).drop("batch_id"))
    names = names.select(F.col("phase").alias("_phase"), F.col("dataset_name").alias("_name")).distinct()
    same = state["phase"].eqNullSafe(names["_phase"]) & state["dataset_name"].eqNullSafe(names["_name"])
    fields = {name: F.lit(value).cast(LEDGER_SCHEMA[name].dataType) for name, value in values.items()}
    fields |= {
        "phase": F.col("_phase"),
        "dataset_name": F.col("_name"),
        "seq": F.coalesce(F.col("seq") + 1, F.lit(1)).cast("bigint"),
        "op": F.coalesce("op", F.lit("commit")),
    }
    rows = names.join(state, same, "left").withColumns(fields).select(*LEDGER_SCHEMA.fieldNames())
    staged = write_and_read(rows, "close")
    staged.coalesce(1).write.mode("append").parquet(f"{output}/ledger/batch_id={_CLOSED}")


def run_ingest(
    documents: DataFrame,
    codec: Codec,
    output: str,
    options: IngestOptions | None = None,
    retries: int = MAX_RETRIES,
) -> int:
    """Ingest all that is available and stop; a later call goes on where this one ended.

    Spark retries tasks. A query that fails as a whole is started again up to ``retries`` times
    from its checkpoint; after that the datasets of the batch that failed are marked as failed and the
    error is raised. Only what this run committed is marked as completed.
    Returns how often it was restarted.
    """
    options = options or IngestOptions()
    if options.interval is not None:
        raise ValueError("interval is an option of the ingest of a catalogue")
    spark = documents.sparkSession
    attempt, batches = 0, set()
    broken: list[DataFrame | None] = []

    def take_in(batch: DataFrame, batch_id: int) -> None:
        try:
            write_batch(batch, batch_id, codec, output, options, attempt)
        except Exception:
            broken[:] = [_names_of(batch)]
            raise
        batches.add(batch_id)

    while True:
        query = (
            documents.writeStream.foreachBatch(take_in)
            .option("checkpointLocation", f"{output}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        try:
            query.awaitTermination()
            break
        except StreamingQueryException as error:
            if attempt >= retries:
                message = str(error).splitlines()[0]
                names = broken[0] if broken else None
                if names is None or names.isEmpty():
                    names = spark.createDataFrame([(None, None)], "phase string, dataset_name string")
                _close(spark, output, names, failed=True, error_message=message, retry_count=attempt)
                raise
            attempt += 1
    if options.complete:
        ran = read_ledger(spark, output).where(F.col("batch_id").isin(sorted(batches)))
        _close(spark, output, ran, completed=True, failed=False, error_message=None)
    return attempt
