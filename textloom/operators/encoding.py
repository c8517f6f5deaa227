"""Tokenized records with the fixed output schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from textloom.functions.tokens import MAX_LENGTH, Codec, attention_mask, pad, truncate

# The columns of a tokenized record.
TOKENIZED_SCHEMA = StructType(
    [
        StructField("input_ids", ArrayType(IntegerType())),
        StructField("attention_mask", ArrayType(IntegerType())),
        StructField("labels", ArrayType(IntegerType())),
        StructField("length", IntegerType()),
        StructField("language", StringType()),
        StructField("dataset", StringType()),
    ]
)


def shape_records(
    df: DataFrame,
    ids: str = "ids",
    keep: list[str] | None = None,
    max_length: int = MAX_LENGTH,
    pad_to_max: bool = False,
    pad_id: int = 1,
) -> DataFrame:
    """Truncate ids and add mask, labels and length. ``length`` counts ids before padding."""
    cut = df.withColumn("input_ids", truncate(F.col(ids), max_length)).withColumn(
        "length", F.size("input_ids")
    )
    mask = attention_mask(F.col("length"), max_length if pad_to_max else None)
    shown = pad(F.col("input_ids"), max_length, pad_id) if pad_to_max else F.col("input_ids")
    return cut.select(
        *(keep or []),
        shown.alias("input_ids"),
        mask.alias("attention_mask"),
        shown.alias("labels"),
        "length",
        "language",
        "dataset",
    )


def encode_records(
    documents: DataFrame,
    codec: Codec,
    text: str = "text",
    marker: Column | None = None,
    keep: list[str] | None = None,
    max_length: int = MAX_LENGTH,
    pad_to_max: bool = False,
    parse_special: bool = True,
) -> DataFrame:
    """Encode ``text`` of a (language, dataset, ...) table to tokenized records.

    ``marker`` names a special token that goes before the text's ids. One scan, no shuffle.
    """
    ids = codec.encode(F.col(text), parse_special)
    if marker is not None:
        ids = codec.encode(F.concat(F.coalesce(marker, F.lit("")), F.col(text)), parse_special)
    encoded = documents.select(*(keep or []), ids.alias("ids"), "language", "dataset")
    return shape_records(encoded, "ids", keep, max_length, pad_to_max, codec.pad_id)


def token_totals(records: DataFrame) -> DataFrame:
    """Tokens and samples per dataset and language."""
    return records.groupBy("dataset", "language").agg(
        F.sum("length").alias("total_tokens"), F.count(F.lit(1)).alias("total_samples")
    )
