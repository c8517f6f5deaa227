"""Queries over a vocabulary learned from the balanced corpus, pages included, to 1,024 tokens.

The queries beside these stop after a few merges, which SQL can unroll; these run the whole job from
sources to quotas to training to encoding, and the tests hold them against a public tokenizer library.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions.tokens import Codec
from textloom.operators.evaluation import fertility_by_language
from textloom.operators.vocabulary import Vocabulary
from textloom.plans.corpus import build_corpus
from textloom.plans.training import train_from_corpus
from textloom.queries.base import GROUPS, all_sources, query
from textloom.session import fresh_path
from textloom.sources.sinks import METADATA_SCHEMA, read_vocabulary, write_vocabulary

TRAINED_SIZE = 1024
_LEARNED: dict[tuple[str, str], Vocabulary] = {}


def balanced(spark, sf):
    """The balanced corpus: every language and the code group up to their quotas."""
    src = all_sources(spark, sf)
    return build_corpus(src, src.count(), GROUPS, length_col="n_chars")


def learned(spark, sf) -> Vocabulary:
    """The vocabulary of a folder's balanced corpus, once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LEARNED:
        _LEARNED[key] = train_from_corpus(balanced(spark, sf), vocab_size=TRAINED_SIZE)
    return _LEARNED[key]


@query("trained_merges")
def trained_merges(spark, sf):
    rows = learned(spark, sf).merges_table(spark)
    return rows.select("rank", "left", "right", "token", "token_id", "pair_count")


@query("trained_metadata")
def trained_metadata(spark, sf):
    """The saved vocabulary read back: what its metadata says, and what is there."""
    path, vocabulary = fresh_path(spark, "vocabulary"), learned(spark, sf)
    write_vocabulary(vocabulary, spark, path, len(vocabulary.tokens))
    vocab, merges = read_vocabulary(spark, path)
    info = spark.read.schema(METADATA_SCHEMA).json(f"{path}/metadata")
    return info.select(
        "vocab_size",
        vocab.agg(F.count(F.lit(1))).scalar().alias("n_tokens"),
        merges.agg(F.count(F.lit(1))).scalar().alias("n_merges"),
    )


@query("trained_encoding")
def trained_encoding(spark, sf):
    """Every document and page as token ids."""
    codec = Codec.of(learned(spark, sf), spark)
    rows = all_sources(spark, sf).select("dataset", "doc_id", codec.encode(F.col("text")).alias("ids"))
    return rows.select(
        "dataset",
        "doc_id",
        F.size("ids").alias("n_tokens"),
        F.array_join(F.col("ids").cast("array<string>"), " ").alias("input_ids"),
    )


@query("trained_fertility")
def trained_fertility(spark, sf):
    """Tokens per word of each language and of page source."""
    return fertility_by_language(all_sources(spark, sf), Codec.of(learned(spark, sf), spark))
