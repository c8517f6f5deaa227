"""The source catalogue, language maps and markers, and how they join to records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    StringType,
    StructField,
    StructType,
)

from textloom.functions.formats import safe_ratio

CATALOG_SCHEMA = StructType(
    [
        StructField("phase", StringType(), False),
        StructField("dataset", StringType(), False),
        StructField("name", StringType(), False),
        StructField("subsets", ArrayType(StringType())),
        StructField("streaming", BooleanType(), False),
        StructField("text_field", StringType(), False),
        StructField("weight", DoubleType(), False),
    ]
)

# The catalogue. Weights sum to 1 within a phase; no subsets means the whole set.
SOURCES = (
    ("phase1_pretraining", "indiccorp_v2", "ai4bharat/IndicCorpV2",
     ["hi", "ta", "te", "bn", "mr", "gu", "kn"], True, "text", 0.15),
    ("phase1_pretraining", "wikipedia", "wikimedia/wikipedia",
     ["20231101.en", "20231101.hi", "20231101.ta", "20231101.te", "20231101.bn", "20231101.mr"],
     True, "text", 0.10),
    ("phase1_pretraining", "mc4", "mc4", ["en", "hi", "ta", "te", "bn", "mr"], True, "text", 0.20),
    ("phase1_pretraining", "fineweb_edu", "HuggingFaceFW/fineweb-edu", ["sample-10BT"], True, "text", 0.35),
    ("phase1_pretraining", "code_starcoderdata", "bigcode/starcoderdata",
     ["python", "javascript", "html", "css"], True, "content", 0.20),
    ("phase2_instruction", "indic_instruct", "Cognitive-Lab/indic-instruct", ["all"], True, "output", 0.50),
    ("phase2_instruction", "openorca", "Open-Orca/OpenOrca", None, True, "response", 0.30),
    ("phase2_instruction", "code_alpaca", "sahil2801/CodeAlpaca-20k", None, False, "output", 0.20),
    ("phase3_function_calling", "glaive_function_calling", "glaiveai/glaive-function-calling-v2",
     None, True, "text", 1.0),
)

# Language shares.
LANGUAGE_WEIGHTS = {
    "en": 0.55,
    "hi": 0.10,
    "ta": 0.05,
    "te": 0.05,
    "bn": 0.05,
    "mr": 0.05,
    "gu": 0.05,
    "kn": 0.05,
    "code": 0.05,
}

# Language code, display name, split name.
LANGUAGES = (
    ("hi", "Hindi", "hin_Deva"),
    ("ta", "Tamil", "tam_Taml"),
    ("te", "Telugu", "tel_Telu"),
    ("bn", "Bengali", "ben_Beng"),
    ("mr", "Marathi", "mar_Deva"),
    ("gu", "Gujarati", "guj_Gujr"),
    ("kn", "Kannada", "kan_Knda"),
)

# The marker of each language, content type and role.
LANGUAGE_MARKERS = {
    "en": "<|english|>",
    "hi": "<|hindi|>",
    "ta": "<|tamil|>",
    "te": "<|telugu|>",
    "bn": "<|bengali|>",
    "mr": "<|marathi|>",
    "gu": "<|gujarati|>",
    "kn": "<|kannada|>",
}
CONTENT_MARKERS = {
    "code": "<|code|>",
    "python": "<|python|>",
    "javascript": "<|javascript|>",
    "html": "<|html|>",
    "css": "<|css|>",
}
ROLE_MARKERS = {"system": "<|system|>", "user": "<|user|>", "assistant": "<|assistant|>"}

# Defaults of processing and output.
BATCH_SIZE = 1_000
ROW_GROUP_ROWS = 10_000
COMPRESSION = "snappy"


def catalog_phases() -> list[str]:
    """The phases of the catalogue, in order."""
    return sorted({source[0] for source in SOURCES})


def catalog(spark: SparkSession, sources=SOURCES) -> DataFrame:
    """The catalogue as a table, one row per dataset."""
    return spark.createDataFrame([tuple(r) for r in sources], CATALOG_SCHEMA)


def catalog_of(df: DataFrame, phase: str, text_field: str = "text", streaming: bool = True) -> DataFrame:
    """A catalogue read off a (dataset, language) table: its datasets, their languages and shares."""
    counts = df.groupBy("dataset", "language").agg(F.count(F.lit(1)).alias("n"))
    per_set = counts.groupBy("dataset").agg(
        F.array_sort(F.collect_set("language")).alias("subsets"), F.sum("n").alias("n")
    )
    total = F.sum("n").over(Window.partitionBy())
    return per_set.select(
        F.lit(phase).alias("phase"),
        "dataset",
        F.concat(F.lit("tables/"), "dataset").alias("name"),
        "subsets",
        F.lit(streaming).alias("streaming"),
        F.lit(text_field).alias("text_field"),
        safe_ratio(F.col("n"), total).alias("weight"),
    )


def catalog_subsets(sources: DataFrame) -> DataFrame:
    """One row per subset; a dataset without subsets keeps one row with a null subset."""
    return sources.select(
        "phase", "dataset", "name", F.explode_outer("subsets").alias("subset"), "streaming", "text_field", "weight"
    )


def subset_list(one: Column | None, many: Column | None = None, languages: Column | None = None) -> Column:
    """One subset, a list of subsets or a list of languages as one list; null when all are missing."""
    shapes = [many, languages]
    if one is not None:
        shapes.append(F.when(one.isNotNull(), F.array(one)))
    return F.coalesce(*[s for s in shapes if s is not None])


def subset_parts(subset: Column) -> tuple[Column, Column]:
    """(snapshot, language) of a dated subset name; a plain language has no snapshot."""
    dated = F.contains(subset, F.lit("."))
    return (
        F.when(dated, F.split_part(subset, F.lit("."), F.lit(1))),
        F.when(dated, F.split_part(subset, F.lit("."), F.lit(2))).otherwise(subset),
    )


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """Value of a small fixed map; null for a key that is not in it."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.element_at(F.create_map(*pairs), key)


def language_table(spark: SparkSession, languages=LANGUAGES) -> DataFrame:
    return spark.createDataFrame(list(languages), "language string, language_name string, split_name string")


def with_language(df: DataFrame, languages: DataFrame, key: str = "language") -> DataFrame:
    """Add name and split of each record's language; records of unmapped languages are skipped.

    The map has one row per language the catalogue knows, so it is broadcast.
    """
    return df.join(F.broadcast(languages), key)


def unmapped(df: DataFrame, languages: DataFrame, key: str = "language") -> DataFrame:
    """Languages that were skipped, with how many records they have."""
    missing = df.join(F.broadcast(languages), key, "left_anti")
    return missing.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def marker_of(language: Column) -> Column:
    """Marker of a language or content type; null when there is none."""
    return lookup({**LANGUAGE_MARKERS, **CONTENT_MARKERS}, language)
