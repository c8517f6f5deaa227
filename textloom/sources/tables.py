"""Scans, source probes and the union of sources."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from textloom.functions.text import text_or_empty
from textloom.sources.catalog import catalog_phases

DOCUMENT_SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("language", StringType()),
        StructField("dataset", StringType()),
        StructField("phase", StringType()),
    ]
)


def scan(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A Parquet table; with a schema nothing is inferred and a missing column reads as null."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash a scan over all cores when it has too few input splits to keep them busy.

    A large table has many more splits than there are cores and is left alone, so this never
    shuffles one. Meant for a plain scan ahead of costly text expressions; filters and column
    pruning still reach the scan below the exchange.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= 2 * cores else df.repartition(2 * cores, key)


def scan_subsets(
    spark: SparkSession, root: str, schema: StructType | str | None = None, **chosen: Sequence[str] | str
) -> DataFrame:
    """Partition directories of a table by value, such as ``language=["hi", "ta"]``.

    Catalyst prunes on the partition columns, so other directories are not listed for reading.
    """
    df = scan(spark, root, schema)
    for column, values in chosen.items():
        wanted = [values] if isinstance(values, str) else list(values)
        df = df.where(F.col(column).isin(wanted))
    return df


def scan_directory(spark: SparkSession, root: str, directory: str, schema: StructType | str | None = None) -> DataFrame:
    """One sub-directory of a source, such as one programming language."""
    return scan(spark, f"{root.rstrip('/')}/{directory}", schema)


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """A corpus text sink read back by line."""
    return spark.read.text(path).select(F.col("value").alias("line"))


def as_documents(
    df: DataFrame, doc_id: str, text_field: str, language, dataset, phase="phase1_pretraining"
) -> DataFrame:
    """Project a source to the document schema. Constants are given as plain values or columns."""

    def value(v):
        return F.lit(v) if isinstance(v, str) else v

    return df.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        text_or_empty(text_field).alias("text"),
        value(language).alias("language"),
        value(dataset).alias("dataset"),
        value(phase).alias("phase"),
    )


def phase_names(phases: Sequence[str]) -> list[str]:
    """Names that records of the phases may carry: ``phase1`` stands for itself and for the phase of
    the catalogue that begins with it.

    A name that is neither in the catalogue nor short for one of its phases is an error, since it
    would select nothing without a word.
    """
    known = catalog_phases()
    out = []
    for name in phases:
        found = [p for p in known if p == name or p.startswith(f"{name}_")]
        if not found:
            raise ValueError(f"unknown phase {name!r}; there are {', '.join(known)}")
        out += sorted({name, *found})
    return out


def filter_documents(
    df: DataFrame, phases: Sequence[str] | None = None, languages: Sequence[str] | None = None
) -> DataFrame:
    """Keep chosen phases and languages; none given means all. Phases may be short names."""
    if phases:
        df = df.where(F.col("phase").isin(phase_names(phases)))
    if languages:
        df = df.where(F.col("language").isin(list(languages)))
    return df


def probe(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """First record of a source by key: its key, its text's length and the source's columns.

    The least key comes from the key column alone; the text is read where the scan finds that key.
    """
    least = df.agg(F.min(key)).first()[0]
    length = F.length(F.coalesce(F.col(text), F.lit("")))
    # Of several records with that key the longest text counts.
    first = df.where(F.col(key) == F.lit(least)).groupBy(key).agg(F.max(length).alias("n_chars"))
    return first.select(key, "n_chars", F.lit(",".join(df.columns)).alias("fields"))


@dataclass
class SourceError:
    source: str
    message: str


Opener = Callable[[], DataFrame]


def try_open(name: str, opener: Opener) -> DataFrame | SourceError:
    """Open a source and touch its first record; a failure is returned, not raised."""
    try:
        df = opener()
        df.select(F.lit(1)).limit(1).collect()  # opens the first file, reads no column
        return df
    except (PySparkException, OSError, ValueError) as error:
        return SourceError(name, str(error).splitlines()[0])


def first_available(candidates: Sequence[tuple[str, Opener]]) -> tuple[str | None, DataFrame | None, list[SourceError]]:
    """The first source of a list that opens, with the failures before it."""
    failures = []
    for name, opener in candidates:
        found = try_open(name, opener)
        if isinstance(found, DataFrame):
            return name, found, failures
        failures.append(found)
    return None, None, failures


def union_sources(sources: Sequence[tuple[str, Opener]]) -> tuple[DataFrame | None, list[SourceError]]:
    """Union of all sources that open, duplicates kept; the others are reported and give no rows."""
    failures, union = [], None
    for name, opener in sources:
        found = try_open(name, opener)
        if isinstance(found, SourceError):
            failures.append(found)
        else:
            union = found if union is None else union.unionByName(found, allowMissingColumns=True)
    return union, failures
