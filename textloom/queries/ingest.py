"""Queries over the ingest of a catalogue: phases as streams and batches, resume, and resets."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions.text import MIN_CHARS
from textloom.functions.tokens import Codec
from textloom.operators.ledger import LEDGER_SCHEMA, latest
from textloom.plans import ingest as I
from textloom.queries.base import PHASE, PHASE_2, query, vocabulary
from textloom.queries.bpe_sql import encoding
from textloom.session import fresh_path
from textloom.sources.catalog import CATALOG_SCHEMA
from textloom.streaming.ingest import CHECKPOINT_SAMPLES, IngestOptions

PHASE_3 = "phase3_function_calling"
LANGUAGES = ["de", "en", "es", "fr"]


def _catalog(spark, streaming=True):
    rows = [
        (PHASE, "documents", "documents", LANGUAGES, streaming, "text", 1.0),
        (PHASE_2, "conversations", "conversations", None, False, "text", 1.0),
        (PHASE_3, "pages", "pages", None, True, "html", 1.0),
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def _layouts(sf):
    lang, row = F.col("lang"), F.col("conv_id") * 1000 + F.col("turn")
    return {
        "documents": I.Layout(f"{sf}/{{documents}}.parquet", "doc_id bigint, text string, lang string", F.col("doc_id"), lang, lang),
        "conversations": I.Layout(f"{sf}/{{conversations}}.parquet", "conv_id bigint, turn bigint, text string", row, F.lit("en")),
        "pages": I.Layout(f"{sf}/{{pages}}.parquet", "page_id bigint, html string", F.col("page_id"), F.lit("html")),
    }


def _codec(spark, sf) -> Codec:
    return Codec.of(vocabulary(spark, sf), spark)


_UNITS = f"""units AS (
  SELECT '{PHASE}' AS phase, 'documents' AS dataset_name, lang AS subset, doc_id, text FROM documents
  UNION ALL SELECT '{PHASE_2}', 'conversations', NULL, conv_id * 1000 + turn, text FROM conversations
  UNION ALL SELECT '{PHASE_3}', 'pages', NULL, page_id, html FROM pages),
texts AS (SELECT dataset_name || '/' || doc_id AS k, * FROM units WHERE length(text) > {MIN_CHARS})"""


@query(
    "catalog_ingest",
    f"""WITH {_UNITS}, {encoding('texts')}
SELECT phase, dataset_name, subset, count(*) AS samples, CAST(sum(least(len(ids), 2048)) AS BIGINT) AS tokens, true AS completed
FROM enc JOIN texts USING (k) GROUP BY phase, dataset_name, subset""",
)
def catalog_ingest(spark, sf):
    """Three phases of one catalogue in one run, one of them as batches."""
    output = fresh_path(spark, "ingest")
    I.run_catalog(spark, _catalog(spark), _layouts(sf), _codec(spark, sf), output, strict=True)
    state = latest(I.stored_ledger(spark, output).select(*LEDGER_SCHEMA.fieldNames()))
    return state.select(
        "phase",
        "dataset_name",
        "subset",
        F.col("total_samples_processed").alias("samples"),
        F.col("total_tokens_processed").alias("tokens"),
        "completed",
    )


_COUNTED = f"""SELECT dataset_name, subset, count(*) AS samples, {{generation}} AS generation, {{commits}} AS commits
FROM texts WHERE dataset_name = 'documents' GROUP BY dataset_name, subset"""


def _counted(spark, output):
    records = I.read_ingested(spark, output)
    counts = records.groupBy(F.col("dataset").alias("dataset_name"), "subset").agg(
        F.count(F.lit(1)).alias("samples"), F.max("generation").cast("int").alias("generation")
    )
    commits = I.stored_ledger(spark, output).where("op = 'commit'").groupBy("dataset_name", "subset").agg(
        F.count(F.lit(1)).alias("commits")
    )
    return counts.join(commits, ["dataset_name", "subset"])


def _documents(spark):
    return _catalog(spark, streaming=False).where("dataset = 'documents'")


@query("batch_resume", f"WITH {_UNITS} {_COUNTED.format(generation='0', commits='CAST(1 AS BIGINT)')}")
def batch_resume(spark, sf):
    """Batch subsets, stopped after one of them and then finished: each is committed once."""
    output, codec = fresh_path(spark, "ingest"), _codec(spark, sf)
    for units in (1, None, None):
        I.run_catalog(spark, _documents(spark), _layouts(sf), codec, output, max_units=units, strict=True)
    return _counted(spark, output)


@query(
    "reset_ingest",
    f"""WITH {_UNITS} {_COUNTED.format(generation="(subset = 'en')::INTEGER", commits="CAST(1 + (subset = 'en')::INTEGER AS BIGINT)")}
  HAVING subset <> 'fr'""",
)
def reset_ingest(spark, sf):
    """Ingest, reset one subset, delete another, ingest what the reset opened: it starts at zero."""
    output, codec = fresh_path(spark, "ingest"), _codec(spark, sf)
    I.run_catalog(spark, _documents(spark), _layouts(sf), codec, output, strict=True)
    I.reset(spark, output, PHASE, "documents", "en")
    rest = _documents(spark).withColumn("subsets", F.array_remove("subsets", "fr"))
    I.run_catalog(spark, rest, _layouts(sf), codec, output, strict=True)
    I.delete(spark, output, PHASE, "documents", "fr")
    return _counted(spark, output)


def _interval_sql(interval: int) -> str:
    """A ledger row for every full interval and one for what is left."""
    return f"""WITH {_UNITS}, {encoding('texts')},
sizes AS (SELECT phase, dataset_name, count(*) AS n, CAST(sum(least(len(ids), 2048)) AS BIGINT) AS tokens
  FROM enc JOIN texts USING (k) GROUP BY phase, dataset_name),
marks AS (SELECT *, unnest(range(1, CAST(ceil(n / {interval}.0) AS BIGINT) + 1)) AS i FROM sizes)
SELECT phase, dataset_name, least(i * {interval}, n) AS samples, i * {interval} >= n AS completed,
  CASE WHEN i * {interval} >= n THEN tokens END AS tokens FROM marks"""


def _interval_commits(spark, sf, interval):
    output = fresh_path(spark, "ingest")
    options = IngestOptions(complete=True, interval=interval)
    whole = _catalog(spark, streaming=False).withColumn("subsets", F.lit(None).cast("array<string>"))
    I.run_catalog(spark, whole, _layouts(sf), _codec(spark, sf), output, options, strict=True)
    commits = I.stored_ledger(spark, output).where("op = 'commit' AND batch_id >= 0")
    streams = F.col("phase") == PHASE_3
    # A stream is marked as completed by a row of its own; its last commit has all of its samples.
    totals = commits.groupBy("phase").agg(F.max("total_samples_processed").alias("all"))
    done = F.when(streams, F.col("total_samples_processed") == F.col("all")).otherwise(F.col("completed"))
    return commits.join(totals, "phase").select(
        "phase",
        "dataset_name",
        F.col("total_samples_processed").alias("samples"),
        done.alias("completed"),
        F.when(done, F.col("total_tokens_processed")).alias("tokens"),
    )


@query("interval_commits", _interval_sql(CHECKPOINT_SAMPLES))
def interval_commits(spark, sf):
    """Ingest with a ledger row every 1,000 samples of a unit."""
    return _interval_commits(spark, sf, CHECKPOINT_SAMPLES)


@query("interval_commits_fine", _interval_sql(64))
def interval_commits_fine(spark, sf):
    """The same with a ledger row every 64 samples."""
    return _interval_commits(spark, sf, 64)
