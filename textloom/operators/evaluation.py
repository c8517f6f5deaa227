"""Vocabulary quality: tokens per word by text and language."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.formats import fertility_band, safe_ratio
from textloom.functions.text import preview, word_count
from textloom.functions.tokens import Codec
from textloom.operators.stats import fertility, macro_average


def text_fertility(texts: DataFrame, codec: Codec, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Preview, tokens, words and tokens per word of each (language, text) row."""
    counted = texts.select(
        *(keep or []),
        "language",
        preview(F.col(text)).alias("text"),
        F.size(codec.encode(F.col(text))).alias("tokens"),
        word_count(F.col(text)).alias("words"),
    )
    return counted.withColumn("fertility", safe_ratio(F.col("tokens"), F.col("words")))


def fertility_by_language(texts: DataFrame, codec: Codec, text: str = "text") -> DataFrame:
    return fertility(text_fertility(texts, codec, text))


def fertility_report(texts: DataFrame, codec: Codec, group: list[str], text: str = "text") -> DataFrame:
    """Per-language rows, then one row ``group mean`` with the mean over ``group`` and its band."""
    per_language = fertility_by_language(texts, codec, text)
    rows = per_language.select("language", "tokens", "words", "texts", "fertility")
    mean = macro_average(rows, group).select(
        F.lit("group mean").alias("language"),
        F.lit(None).cast("bigint").alias("tokens"),
        F.lit(None).cast("bigint").alias("words"),
        F.lit(None).cast("bigint").alias("texts"),
        F.col("macro_fertility").alias("fertility"),
    )
    return rows.unionByName(mean).withColumn("band", fertility_band(F.col("fertility")))
