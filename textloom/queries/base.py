"""Registry of queries, the views they read, and shared pieces of their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import BLANKS
from textloom.operators.quota import Group
from textloom.operators.vocabulary import IN_TASK, Vocabulary
from textloom.plans.corpus import eligible
from textloom.plans.training import train_from_corpus
from textloom.sources.tables import spread

Run = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query and the SQL it is checked against."""

    def add(run: Run) -> Run:
        REGISTRY[name] = Query(run, sql)
        return run

    return add


PHASE = "phase1_pretraining"
PHASE_2 = "phase2_instruction"
# The mix of the test tables: one main language, a group of three, and page source as code.
GROUPS = (
    Group("english", 0.35, ("en",)),
    Group("european", 0.55, ("de", "es", "fr")),
    Group("code", 0.10, ("html",)),
)
# Merges learned by the registered queries.
N_MERGES = 32


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet").select(
        "doc_id",
        "text",
        F.col("lang").alias("language"),
        F.col("source").alias("dataset"),
        F.lit(PHASE).alias("phase"),
        "n_chars",
    )


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/pages.parquet").select(
        F.col("page_id").alias("doc_id"),
        F.col("html").alias("text"),
        F.lit("html").alias("language"),
        F.lit("pages").alias("dataset"),
        F.lit(PHASE).alias("phase"),
        F.length("html").cast("bigint").alias("n_chars"),
    )


def all_sources(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).unionByName(pages(spark, sf))


def spread_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents for costly text work: a file with few row groups still uses all cores."""
    return spread(documents(spark, sf), "doc_id")


def spread_sources(spark: SparkSession, sf: str) -> DataFrame:
    return spread(all_sources(spark, sf), "doc_id")


_VOCABULARIES: dict[tuple[str, str], Vocabulary] = {}
_WHOLE: dict[tuple[str, str], Vocabulary] = {}


def vocabulary(spark: SparkSession, sf: str, fresh: bool = False) -> Vocabulary:
    """A vocabulary learned from all eligible documents, once per session and table folder."""
    key = (spark.sparkContext.applicationId, sf)
    if fresh or key not in _VOCABULARIES:
        corpus = eligible(spread_documents(spark, sf), length_col="n_chars")
        _VOCABULARIES[key] = train_from_corpus(corpus, max_merges=N_MERGES)
    return _VOCABULARIES[key]


def whole_vocabulary(spark: SparkSession, sf: str) -> Vocabulary:
    """The same without an end of the merges: until it has its full size or no pair is frequent. Only the last
    folder's is kept, as the driver holds it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _WHOLE:
        _WHOLE.clear()
        corpus = eligible(spread_documents(spark, sf), length_col="n_chars")
        _WHOLE[key] = train_from_corpus(corpus, in_task=IN_TASK)
    return _WHOLE[key]


DOCS = f"""docs AS (
  SELECT doc_id, text, lang AS language, source AS dataset, '{PHASE}' AS phase, n_chars FROM documents)"""
SRC = f"""{DOCS}, src AS (
  SELECT * FROM docs UNION ALL
  SELECT page_id, html, 'html', 'pages', '{PHASE}', length(html) FROM pages)"""

# The blanks as a trim set and as the inside of a character class that is not Unicode-aware.
TRIM_SET = BLANKS
BLANK_CLASS = (
    r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# The blanks of the split pattern, which leave out U+001C to U+001F.
PATTERN_BLANKS = (
    r"\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def sql_strip(text: str) -> str:
    return f"trim({text}, '{TRIM_SET}')"


def sql_lines(text: str) -> str:
    return f"regexp_split_to_array({text}, '\\r\\n|\\r|\\n')"


def sql_words(text: str) -> str:
    return f"len(regexp_extract_all({text}, '[^{BLANK_CLASS}]+'))"


def sql_pretokens(text: str) -> str:
    """Pre-tokens without lookahead: a blank run is first cut before its last blank, then matched."""
    ws = PATTERN_BLANKS
    pattern = (
        f"''s|''t|''re|''ve|''m|''ll|''d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{ws}\\p{{L}}\\p{{N}}]+|[{ws}]+"
    )
    cut = f"regexp_replace({text}, '([{ws}]+)([{ws}][^{ws}])', '\\1' || chr(57344) || '\\2', 'g')"
    return (
        f"flatten(list_transform(string_split({cut}, chr(57344)), "
        f"lambda s: regexp_extract_all(s, '{pattern}')))"
    )
