"""Exact dedup as a stateful stream.

A stream reads the files of a table and keeps, for every SHA-256 digest of a text, one row of state: the
stable identifier (the largest id), the locator of its content (file and row in the file) and the number
of rows. The state lies in RocksDB on the executors' disks, is saved to the shared folder with every
batch and never expires, so a later run over new files goes on from it. Sums and maxima are combined
before the shuffle: a text that a third of all rows share is one row a task.

A digest that comes again is a hit, and hits are checked by their full bytes before a result is given:
the whole texts of a digest's rows are grouped by their bytes, again with a map-side combine, and the
group that holds the content at the retained locator is the one that state speaks for. Any other group
failed the check (two texts with one digest) and gets its own identifier and size from its bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.session import drop_path, fresh_path, read_table, write_and_read

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Bytes of files in a micro-batch.
BATCH = 64 << 30
DIGEST_BYTES = 32


def _side_session(spark: SparkSession) -> SparkSession:
    """A session with the disk-backed state store, so that the caller's settings stay as they are."""
    side = spark.newSession()
    side.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    side.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    # Each store reserves megabytes for its logs otherwise, whatever it holds, and there is one a partition.
    side.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    return side


def _as_glob(path: str) -> str:
    """A pattern that only ``path`` matches: a stream takes one file by a pattern alone."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def _rows(reader, path: str, schema: str) -> DataFrame:
    """The id, the whole text (null: empty), its SHA-256, and the place of each row."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return reader.schema(schema).parquet(path).select(
        F.col("doc_id"),
        text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("sha"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("at"),
    )


def _digest(width: int) -> Column:
    return F.substring("sha", 1, width).alias("digest")


def _id_schema(spark: SparkSession, path: str) -> str:
    kind = spark.read.parquet(path).schema["doc_id"].dataType.simpleString()
    return f"doc_id {kind}, text string"


def take_in(
    spark: SparkSession,
    path: str,
    state: str,
    bytes_per_batch: int = BATCH,
    digest_bytes: int = DIGEST_BYTES,
    files_per_batch: int | None = None,
) -> None:
    """Bring the state in the folder ``state`` up to date with the files of ``path``.

    Files that the state knows are not read again. A run that is stopped goes on with its last batch.
    """
    side = _side_session(spark)
    if files_per_batch is None:
        reader = side.readStream.option("maxBytesPerTrigger", bytes_per_batch)
    else:
        reader = side.readStream.option("maxFilesPerTrigger", files_per_batch)
    rows = _rows(reader, _as_glob(path), _id_schema(spark, path))
    rows = rows.select("doc_id", "file", "at", _digest(digest_bytes))
    kept = rows.groupBy("digest").agg(
        F.max(F.struct("doc_id", "file", "at")).alias("keep"), F.count(F.lit(1)).alias("n")
    )
    run = (
        kept.writeStream.format("noop")
        .outputMode("update")
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()


def retained(spark: SparkSession, state: str) -> DataFrame:
    """What the state holds: digest, keep (doc_id, file, at: the row that stays) and n, a row a digest."""
    stored = _side_session(spark).read.format("statestore").load(state)
    groups = stored.select("key.digest", F.col("value.max").alias("keep"), F.col("value.count").alias("n"))
    path = fresh_path(spark, "exact-state")
    groups.write.parquet(path)
    return read_table(spark, path, groups.schema)


def _regroup(texts: DataFrame, clash: DataFrame) -> DataFrame:
    """Rows of digests that failed the check, grouped by their bytes."""
    odd = texts.join(clash.select("digest").distinct(), "digest", "left_semi")
    groups = odd.groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", "file", "at")).alias("best"), F.count(F.lit(1)).alias("size")
    )
    same = odd.join(groups, ["digest", "text"])
    kept = (F.col("file") == F.col("best.file")) & (F.col("at") == F.col("best.at"))
    return same.select("doc_id", F.col("best.doc_id").alias("keep_id"), F.col("size").alias("n"), kept.alias("kept"), "sha")


def deduplicate(
    spark: SparkSession,
    path: str,
    state: str | None = None,
    bytes_per_batch: int = BATCH,
    digest_bytes: int = DIGEST_BYTES,
    files_per_batch: int | None = None,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each row of the Parquet table at ``path``.

    Texts are equal when their bytes are; null counts as empty. Of equal texts the row with the largest
    id stays, of rows with that id the last by file and place, so exactly one row of a group is kept,
    whatever repeats. Null ids are less than any other: a group of null ids keeps one row and has a null
    keep_id. Other columns are not read, whatever they are named; an empty table gives no rows.

    ``state`` is the folder of a state to go on from (in a shared file system), by default a fresh one
    that is dropped again. ``digest_bytes`` shortens the digest and thereby provokes hits that fail.
    """
    folder = state or fresh_path(spark, "exact-stream")
    take_in(spark, path, folder, bytes_per_batch, digest_bytes, files_per_batch)
    groups = retained(spark, folder)
    if state is None:
        drop_path(spark, folder)

    scan = _rows(spark.read, path, _id_schema(spark, path))
    kept = (F.col("file") == F.col("keep.file")) & (F.col("at") == F.col("keep.at"))
    rows = scan.select("doc_id", "sha", _digest(digest_bytes), "file", "at").join(groups, "digest")
    rows = rows.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "n", kept.alias("kept"), "sha", "file", "at"
    )
    rows = write_and_read(rows, "exact-rows")

    hits = rows.where("n > 1").select("file", "at", "kept")
    texts = scan.select("doc_id", "text", "sha", _digest(digest_bytes), "file", "at").join(hits, ["file", "at"])
    checked = texts.groupBy("digest", "text").agg(F.max("kept").alias("holds"))
    clash = write_and_read(checked.where("NOT holds").select("digest"), "exact-clash")
    if not clash.isEmpty():
        failed = _regroup(texts, clash)
        rows = rows.withColumn("digest", _digest(digest_bytes))
        rows = rows.join(clash.distinct(), "digest", "left_anti")
        rows = rows.select("doc_id", "keep_id", "n", "kept", "sha").unionByName(failed)
    return rows.select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        "kept",
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
