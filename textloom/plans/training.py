"""Vocabulary training from a corpus, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from textloom.operators.vocabulary import (
    MIN_FREQUENCY,
    VOCAB_SIZE,
    Vocabulary,
    corpus_lines,
    train_vocabulary,
    word_counts,
)
from textloom.sources.sinks import write_vocabulary

WORD_COUNT_SCHEMA = StructType([StructField("word", StringType()), StructField("n", LongType())])


def train_from_corpus(
    corpus: DataFrame,
    vocab_size: int = VOCAB_SIZE,
    min_frequency: int = MIN_FREQUENCY,
    max_merges: int | None = None,
    output: str | None = None,
    created_for: str = "",
    in_task: int = 0,
) -> Vocabulary:
    """Count words once, learn merges, and save the tables when ``output`` is given. Words of at most
    ``in_task`` symbols in all are learned from by one task."""
    counts = word_counts(corpus_lines(corpus))
    vocabulary = train_vocabulary(counts, vocab_size, min_frequency, max_merges=max_merges, in_task=in_task)
    if output is not None:
        write_vocabulary(vocabulary, corpus.sparkSession, output, vocab_size, created_for)
    return vocabulary
