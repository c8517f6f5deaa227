"""Balanced vocabulary corpus: union of sources, filter, strip, quota take, statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import MIN_CHARS, long_enough, strip
from textloom.operators.quota import Group, group_quotas, stratified_take
from textloom.operators.stats import breakdown, category_counts


def eligible(documents: DataFrame, min_chars: int = MIN_CHARS, length_col: str | None = None) -> DataFrame:
    """Documents long enough to be used, measured before stripping.

    With ``length_col`` (a stored code point count) the test is a Parquet filter and steps that
    need no text never read it.
    """
    if length_col is not None:
        return documents.where(F.col(length_col) > min_chars)
    return documents.where(long_enough(F.col("text"), min_chars))


def build_corpus(
    documents: DataFrame,
    total: int,
    groups: Sequence[Group],
    stratum: str = "language",
    key: str = "doc_id",
    min_chars: int = MIN_CHARS,
    length_col: str | None = None,
    method: str = "cut",
) -> DataFrame:
    """Category, stratum, key and stripped text of the documents that fill the quotas."""
    rows = group_quotas(total, groups)
    category = {member: cat for cat, member, _ in rows}
    pairs = [F.lit(x) for item in category.items() for x in item]
    usable = eligible(documents, min_chars, length_col)
    taken = stratified_take(usable, {m: q for _, m, q in rows}, stratum, key, method)
    return taken.select(
        F.element_at(F.create_map(*pairs), F.col(stratum)).alias("category"),
        F.col(stratum).alias("member"),
        key,
        strip(F.col("text")).alias("text"),
    )


def corpus_stats(corpus: DataFrame) -> DataFrame:
    return category_counts(corpus)


def corpus_breakdown(corpus: DataFrame, compat: bool = False) -> DataFrame:
    return breakdown(corpus, compat=compat)
