"""The corpus pipeline: five stages over ``documents``, each with an operator of ``textloom.llm``.

A stage takes (spark, docs, sf_dir) and returns the documents that it keeps, in the columns that it was
given; the last returns their token ids. Columns that a stage does not need may hold anything, extra
ones included, and are handed on. No SQL can express the stages, so ORACLE_SQL is None and the tests
hold them against plain Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import mixing, pieces, secrets, simhash, toxicity
from textloom.llm.queries import DROPOUT, DROPOUT_SEED, MIX_LEVELS, MIX_SEED, MIX_WEIGHTS, with_domain
from textloom.session import write_and_read

# Share of all tokens that the mix keeps at most. A document is taken once.
KEPT_SHARE = 0.8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of ``toxicity.THRESHOLD`` or more go; labels are learned in part."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.score_documents(docs, toxicity.fit(docs, labels))
    return scored.where(F.col("score") < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group that SimHash links, the row with the least id stays.

    Rows are told apart by id and text, so rows of one id are documents of their own, a group of rows
    without an id keeps one, and only rows that repeat in both go without being in a group. Rows with an
    id stay before rows without.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    unnamed = F.col("doc_id").isNull()
    key = F.struct(unnamed.alias("unnamed"), F.col("doc_id").alias("id"), F.sha2(text, 256).alias("digest"))
    groups = simhash.near_duplicates(docs.select(key.alias("key"), "text"), id_col="key")
    first = groups.where("key = component_id").select("key").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), key.alias("key")).join(first, "key", "left_semi")
    return rows.dropDuplicates(["key"]).select("row.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text are replaced by a mark; ``n_chars`` follows the text."""
    clean = secrets.redact_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The prefix of each source that its token budget allows. Rows are carried through the mix, so
    repeated and null ids take what they hold and no more."""
    rows = docs.withColumn("row", F.struct(*docs.columns)).select("doc_id", "text", "lang", "source", "row")
    mixed = mixing.mix(
        with_domain(rows),
        MIX_LEVELS,
        MIX_WEIGHTS,
        share=KEPT_SHARE,
        epochs=1,
        seed=MIX_SEED,
        carry="row",
    )
    return mixed.where("copies > 0").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the token ids of every document."""
    encoded = pieces.encode_documents(
        docs.select("doc_id", "lang", "source", "text"), dropout=DROPOUT, seed=DROPOUT_SEED
    )
    return encoded.select("doc_id", "lang", "source", F.size("ids").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("source_mix", mix_sources),
    ("sentencepiece", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is a table before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_and_read(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
