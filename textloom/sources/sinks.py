"""Sinks: corpus text, tokenized Parquet, vocabulary tables, metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.vocabulary import MERGES_SCHEMA, VOCAB_SCHEMA, Vocabulary
from textloom.sources.catalog import COMPRESSION, ROW_GROUP_ROWS

# The algorithm name, languages and longest sequence stated in the metadata.
ALGORITHM = "Byte-level BPE"
METADATA_LANGUAGES = ("en", "hi", "ta", "te", "bn", "mr", "gu", "kn", "code")
METADATA_MAX_LENGTH = 2048
METADATA_SCHEMA = (
    "vocab_size int, algorithm string, special_tokens array<string>, languages array<string>, "
    "max_length int, created_for string"
)


def _mode(replace: bool) -> str:
    return "overwrite" if replace else "ignore"


def write_corpus(df: DataFrame, path: str, by: str | None = "category", text: str = "text", replace: bool = True) -> None:
    """UTF-8 text, a line break after each document. ``replace=False`` keeps a corpus that exists."""
    columns = [text] if by is None else [by, text]
    writer = df.select(*columns).write.mode(_mode(replace))
    if by is not None:
        writer = writer.partitionBy(by)
    writer.text(path)


def write_records(
    df: DataFrame,
    path: str,
    by: tuple[str, ...] = ("phase", "dataset"),
    row_group_rows: int = ROW_GROUP_ROWS,
    replace: bool = True,
    compact: bool = True,
) -> None:
    """Snappy Parquet with bounded row groups, one directory per phase and dataset.

    ``compact`` rebalances rows by directory first: Spark then splits a large dataset over many
    tasks and gathers small ones, so files have a good size. Leave it out when the input is
    already laid out by dataset, to save the shuffle.
    """
    rows = df.hint("rebalance", *by) if compact else df
    (
        rows.write.mode(_mode(replace))
        .partitionBy(*by)
        .option("compression", COMPRESSION)
        .option("parquet.block.row.count.limit", str(row_group_rows))
        .parquet(path)
    )


def write_vocabulary(
    vocabulary: Vocabulary, spark: SparkSession, path: str, vocab_size: int, created_for: str = "", replace: bool = True
) -> None:
    """The vocab and merges tables and one JSON row of metadata below ``path``."""
    mode = _mode(replace)
    vocabulary.vocab_table(spark).coalesce(1).write.mode(mode).parquet(f"{path}/vocab")
    vocabulary.merges_table(spark).coalesce(1).write.mode(mode).parquet(f"{path}/merges")
    metadata(spark, vocabulary, vocab_size, created_for).coalesce(1).write.mode(mode).json(f"{path}/metadata")


def metadata(spark: SparkSession, vocabulary: Vocabulary, vocab_size: int, created_for: str = "") -> DataFrame:
    row = (
        vocab_size,
        ALGORITHM,
        vocabulary.tokens[: vocabulary.n_special],
        list(METADATA_LANGUAGES),
        METADATA_MAX_LENGTH,
        created_for,
    )
    return spark.createDataFrame([row], METADATA_SCHEMA)


def read_vocabulary(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(vocab, merges) as tables."""
    return (
        spark.read.schema(VOCAB_SCHEMA).parquet(f"{path}/vocab"),
        spark.read.schema(MERGES_SCHEMA).parquet(f"{path}/merges").orderBy(F.col("rank")),
    )
