"""The progress report: five queries over one ledger state and a file inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.formats import format_size
from textloom.operators.ledger import failures, in_progress, status_list, summary
from textloom.operators.stats import storage_totals


def progress_report(state: DataFrame, files: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """Summary, storage, records in progress, failed records and the status list."""
    storage = storage_totals(files)
    return {
        "summary": summary(state),
        "storage": storage.select(
            "*",
            format_size(F.col("total_bytes")).alias("total_size"),
            F.when(F.col("n_files") > 0, format_size(F.col("mean_bytes"))).otherwise("0 B").alias("mean_size"),
        ),
        "in_progress": in_progress(state, as_of),
        "failed": failures(state),
        "status": status_list(state),
    }


def report_lines(state: DataFrame, files: DataFrame, as_of: Column) -> DataFrame:
    """The report as (section, item, value) rows."""
    parts = progress_report(state, files, as_of)

    def long_form(section: str, df: DataFrame, item: Column, values: Column) -> DataFrame:
        return df.select(F.lit(section).alias("section"), item.alias("item"), values.alias("value"))

    one_row = [("summary", parts["summary"]), ("storage", parts["storage"])]
    rows = None
    for section, df in one_row:
        entries = F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).cast("string").alias("value")) for c in df.columns])
        part = df.select(F.lit(section).alias("section"), F.inline(entries))
        rows = part if rows is None else rows.unionByName(part)
    name = F.concat("dataset_name", F.lit(" ("), "subset", F.lit(")"))
    active = F.format_string(
        "Samples: %d | Tokens: %d | Files: %d | Elapsed: %s", "samples", "tokens", "files", "elapsed"
    )
    failed = F.format_string("Error: %s | Retries: %d/%d", "error", "retries", "max_retries")
    return rows.unionByName(long_form("in progress", parts["in_progress"], name, active)).unionByName(
        long_form("failed", parts["failed"], name, failed)
    )


# One row of the report: which section and record, its numbers, and its text.
REPORT_SCHEMA = (
    "section string, item string, dataset_name string, subset string, samples bigint, tokens bigint, "
    "files bigint, retries bigint, amount double, shown string"
)


def report_table(state: DataFrame, files: DataFrame | None, as_of: Column) -> DataFrame:
    """The whole report as typed rows; without ``files`` there is no storage section.

    Summary and storage have a row a figure (``amount``), the other sections a row a record: ``shown`` is
    the time elapsed, the error, or the status.
    """
    fields = [f.split() for f in REPORT_SCHEMA.split(", ")]

    def rows(section: str, df: DataFrame, **values: Column) -> DataFrame:
        values = {"section": F.lit(section), **values}
        return df.select(*[values.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in fields])

    def figures(section: str, df: DataFrame, names: list[str], texts: list[str]) -> DataFrame:
        entries = [F.struct(F.lit(n).alias("item"), F.col(n).cast("double").alias("amount"), F.lit(None).cast("string").alias("shown")) for n in names]
        entries += [F.struct(F.lit(n).alias("item"), F.lit(None).cast("double").alias("amount"), F.col(n).alias("shown")) for n in texts]
        long = df.select(F.inline(F.array(*entries)))
        return rows(section, long, item=F.col("item"), amount=F.col("amount"), shown=F.col("shown"))

    def records(section: str, df: DataFrame, shown: str, *columns: str, **values: Column) -> DataFrame:
        columns = ("dataset_name", "subset", *columns)
        return rows(section, df, **{c: F.col(c) for c in columns}, shown=F.col(shown), **values)

    totals = summary(state)
    counts = [c for c in totals.columns if c != "processing_time"]
    parts = [figures("summary", totals, counts, ["processing_time"])]
    if files is not None:
        stored = storage_totals(files).withColumn("total_size", format_size(F.col("total_bytes")))
        parts.append(figures("storage", stored, ["n_files", "total_bytes", "mean_bytes"], ["total_size"]))
    numbers = ("samples", "tokens", "files")
    parts += [
        records("in progress", in_progress(state, as_of), "elapsed", *numbers),
        records("failed", failures(state), "error", "retries"),
        records("status", status_list(state), "status", *numbers, "retries", item=F.col("checkpoint_key")),
    ]
    return reduce(DataFrame.unionByName, parts)
