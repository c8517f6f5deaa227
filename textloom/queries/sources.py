"""Queries over sources, scalar expressions and sinks of text."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions.formats import fertility_band, format_duration, format_size, safe_ratio
from textloom.functions.text import first_nonempty, lines, nfkc, preview, strip, text_or_empty, with_marker, word_count
from textloom.operators.stats import storage_totals
from textloom.plans.corpus import eligible
from textloom.queries.base import (
    DOCS,
    PHASE,
    PHASE_2,
    SRC,
    all_sources,
    documents,
    pages,
    query,
    sql_lines,
    sql_strip,
    spread_sources,
    sql_words,
    TRIM_SET,
)
from textloom.session import fresh_path
from textloom.sources.catalog import (
    CONTENT_MARKERS,
    LANGUAGE_MARKERS,
    ROLE_MARKERS,
    catalog_of,
    catalog_subsets,
    language_table,
    lookup,
    marker_of,
    subset_parts,
    unmapped,
    with_language,
)
from textloom.sources.files import inventory
from textloom.sources.sinks import write_corpus
from textloom.sources.tables import as_documents, filter_documents, first_available, probe, scan_directory, scan_lines
from textloom.sources.versions import manifest, read_current, reuse_or_write, write_version

# Languages of the test tables that have a split; English has none and is skipped.
TEST_LANGUAGES = (
    ("de", "German", "deu_Latn"),
    ("es", "Spanish", "spa_Latn"),
    ("fr", "French", "fra_Latn"),
)
_VALUES = ", ".join(f"('{c}', '{n}', '{s}')" for c, n, s in TEST_LANGUAGES)


@query("scan_documents", "SELECT doc_id, text, lang AS language, source AS dataset FROM documents")
def scan_documents(spark, sf):
    return documents(spark, sf).select("doc_id", "text", "language", "dataset")


@query(
    "source_catalog",
    f"""WITH {DOCS}, sets AS (
  SELECT dataset, count(*) AS n, list_sort(list(DISTINCT language)) AS subsets FROM docs GROUP BY dataset)
SELECT '{PHASE}' AS phase, dataset, 'tables/' || dataset AS name, unnest(subsets) AS subset, true AS streaming,
  'text' AS text_field, CAST(n AS DOUBLE) / CAST((SELECT count(*) FROM docs) AS DOUBLE) AS weight FROM sets""",
)
def source_catalog(spark, sf):
    return catalog_subsets(catalog_of(documents(spark, sf), PHASE))


@query(
    "scan_by_language",
    f"""WITH {DOCS}, m(language, language_name, split_name) AS (VALUES {_VALUES})
SELECT doc_id, language, split_name, n_chars FROM docs JOIN m USING (language)""",
)
def scan_by_language(spark, sf):
    mapped = language_table(spark, TEST_LANGUAGES)
    docs = filter_documents(documents(spark, sf), languages=[c for c, _, _ in TEST_LANGUAGES])
    return with_language(docs, mapped).select("doc_id", "language", "split_name", "n_chars")


@query(
    "scan_by_dir",
    f"WITH {SRC} SELECT doc_id, dataset, n_chars, md5(text) AS text_md5 FROM src WHERE language = 'html'",
)
def scan_by_dir(spark, sf):
    root = fresh_path(spark, "by-dir")
    all_sources(spark, sf).write.partitionBy("language").parquet(root)
    one = scan_directory(spark, root, "language=html")
    return one.select("doc_id", "dataset", "n_chars", F.md5("text").alias("text_md5"))


@query(
    "subset_parse",
    f"""WITH {DOCS}, s AS (SELECT CASE WHEN language = 'en' THEN language ELSE '20231101.' || language END AS subset,
  n_chars FROM docs)
SELECT subset, CASE WHEN subset LIKE '%.%' THEN split_part(subset, '.', 1) END AS snapshot,
  CASE WHEN subset LIKE '%.%' THEN split_part(subset, '.', 2) ELSE subset END AS language,
  count(*) AS n_docs FROM s GROUP BY subset""",
)
def subset_parse(spark, sf):
    subset = F.when(F.col("language") == "en", F.col("language")).otherwise(
        F.concat(F.lit("20231101."), "language")
    )
    named = documents(spark, sf).groupBy(subset.alias("subset")).agg(F.count(F.lit(1)).alias("n_docs"))
    snapshot, language = subset_parts(F.col("subset"))
    return named.select("subset", snapshot.alias("snapshot"), language.alias("language"), "n_docs")


@query(
    "corpus_lines",
    f"""WITH {SRC}, l AS (SELECT language, unnest({sql_lines(sql_strip('text'))}) AS line FROM src WHERE n_chars > 100)
SELECT {sql_strip('line')} AS line, count(*) AS n FROM l GROUP BY 1""",
)
def corpus_lines_query(spark, sf):
    path = fresh_path(spark, "corpus")
    stripped = eligible(spread_sources(spark, sf), length_col="n_chars").select("language", strip(F.col("text")).alias("text"))
    write_corpus(stripped, path, by="language")
    back = scan_lines(spark, path)
    # The file reader breaks at CR, LF and CR LF as well, so only the strip is left to do.
    return back.select(strip(F.col("line")).alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query(
    "document_lines",
    f"""WITH {DOCS} SELECT doc_id, unnest({sql_lines('text')}) AS line FROM docs""",
)
def document_lines(spark, sf):
    return documents(spark, sf).select("doc_id", F.explode(lines(F.col("text"))).alias("line"))


def text_files(spark, sf):
    """The inventory of a text file for every dataset, a line for every document."""
    path = fresh_path(spark, "texts")
    line = F.translate("text", "\r\n", "  ").alias("line")
    rows = documents(spark, sf).select("dataset", line)
    rows.repartition("dataset").write.partitionBy("dataset").text(path)
    return inventory(spark, path, "*.txt")


# A file holds its lines and a line end for each.
FILES = f"""{DOCS}, files AS (SELECT 'dataset=' || dataset AS folder,
  CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS length FROM docs GROUP BY dataset)"""


@query("storage_inventory", f"WITH {FILES} SELECT folder, length FROM files")
def storage_inventory(spark, sf):
    return text_files(spark, sf).select(F.element_at(F.split("path", "/"), -2).alias("folder"), "length")


_UNITS = (("B", 0), ("KB", 1), ("MB", 2), ("GB", 3), ("TB", 4))


def sql_size(b: str) -> str:
    whens = " ".join(
        f"WHEN {b} < {float(1024 ** (p + 1))} THEN printf('%.2f {u}', {b} / {float(1024**p)})" for u, p in _UNITS
    )
    return f"CASE {whens} ELSE printf('%.2f PB', {b} / {float(1024**5)}) END"


@query(
    "storage_stats",
    f"""WITH {FILES}, t AS (SELECT count(*) AS n_files, CAST(sum(length) AS BIGINT) AS total_bytes FROM files)
SELECT n_files, total_bytes, CAST(total_bytes AS DOUBLE) / CAST(n_files AS DOUBLE) AS mean_bytes,
  {sql_size('CAST(total_bytes AS DOUBLE)')} AS total_size FROM t""",
)
def storage_stats(spark, sf):
    return storage_totals(text_files(spark, sf)).select(
        "n_files", "total_bytes", "mean_bytes", format_size(F.col("total_bytes")).alias("total_size")
    )


@query(
    "source_probe",
    """SELECT 'documents' AS source, doc_id, length(text) AS n_chars, 'doc_id,text,language,dataset,phase,n_chars' AS fields
FROM documents WHERE doc_id = (SELECT min(doc_id) FROM documents) UNION ALL
SELECT 'pages', page_id, length(html), 'doc_id,text,language,dataset,phase,n_chars' FROM pages
WHERE page_id = (SELECT min(page_id) FROM pages)""",
)
def source_probe(spark, sf):
    rows = None
    for name, df in (("documents", documents(spark, sf)), ("pages", pages(spark, sf))):
        row = probe(df).select(F.lit(name).alias("source"), "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"), "fields")
        rows = row if rows is None else rows.unionByName(row)
    return rows


@query(
    "text_field_projection",
    f"SELECT page_id AS doc_id, coalesce(html, '') AS text, 'html' AS language, 'pages' AS dataset, '{PHASE}' AS phase FROM pages",
)
def text_field_projection(spark, sf):
    table = spark.read.parquet(f"{sf}/pages.parquet")
    return as_documents(table, "page_id", "html", "html", "pages", PHASE)


@query(
    "first_nonempty",
    """SELECT d.doc_id, coalesce(nullif(p.html, ''), nullif(CASE WHEN d.lang = 'en' THEN '' ELSE d.source END, ''),
  nullif(d.text, ''), '') AS text FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id""",
)
def first_nonempty_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    page = spark.read.parquet(f"{sf}/pages.parquet").select(F.col("page_id").alias("doc_id"), F.col("html").alias("content"))
    code = F.when(F.col("lang") == "en", F.lit("")).otherwise(F.col("source"))
    joined = docs.join(page, "doc_id", "left").withColumn("code", code)
    return joined.select("doc_id", first_nonempty("content", "code", "text").alias("text"))


@query("min_length_filter", "SELECT doc_id, length(text) AS chars FROM documents WHERE text IS NOT NULL AND length(text) > 100")
def min_length_filter(spark, sf):
    return eligible(documents(spark, sf)).select("doc_id", F.length("text").cast("bigint").alias("chars"))


@query("strip_text", f"SELECT doc_id, {sql_strip('text')} AS text FROM documents")
def strip_text(spark, sf):
    """Documents between blanks of every kind, which come off again."""
    padded = F.concat(F.lit(TRIM_SET), F.col("text"), F.lit(TRIM_SET[::-1]))
    return documents(spark, sf).select("doc_id", strip(padded).alias("text"))


_MIXED = f"""{SRC}, mixed AS (SELECT doc_id, language, phase FROM src UNION ALL
  SELECT conv_id * 1000 + turn, 'en', '{PHASE_2}' FROM conversations)"""


@query(
    "filter_phase_language",
    f"WITH {_MIXED} SELECT doc_id, language, phase FROM mixed WHERE phase = '{PHASE_2}' OR (phase = '{PHASE}' AND language IN ('fr', 'de'))",
)
def filter_phase_language(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), F.lit("en").alias("language"), F.lit(PHASE_2).alias("phase")
    )
    mixed = all_sources(spark, sf).select("doc_id", "language", "phase").unionByName(turns)
    first = filter_documents(mixed, phases=[PHASE], languages=["fr", "de"])
    return first.unionByName(filter_documents(mixed, phases=[PHASE_2]))


@query(
    "language_lookup",
    f"""WITH {SRC}, m(language, language_name, split_name) AS (VALUES {_VALUES})
SELECT language, language_name, split_name, count(*) AS n FROM src LEFT JOIN m USING (language)
GROUP BY language, language_name, split_name""",
)
def language_lookup(spark, sf):
    mapped = language_table(spark, TEST_LANGUAGES)
    docs = all_sources(spark, sf).select("doc_id", "language")
    known = with_language(docs, mapped).groupBy("language", "language_name", "split_name").agg(F.count(F.lit(1)).alias("n"))
    return known.unionByName(unmapped(docs, mapped), allowMissingColumns=True)


_MARKERS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in {**LANGUAGE_MARKERS, **CONTENT_MARKERS}.items())


@query(
    "language_marker",
    f"WITH {SRC} SELECT dataset, doc_id, coalesce(CASE language {_MARKERS} END, '') || text AS text FROM src",
)
def language_marker(spark, sf):
    return all_sources(spark, sf).select("dataset", "doc_id", with_marker(marker_of(F.col("language")), F.col("text")).alias("text"))


_ROLES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ROLE_MARKERS.items())


@query(
    "conversation_render",
    f"""SELECT conv_id, count(*) AS turns, string_agg(coalesce(CASE role {_ROLES} END, '') || text, '' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id""",
)
def conversation_render(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select(
        "conv_id",
        F.struct("turn", with_marker(lookup(ROLE_MARKERS, F.col("role")), text_or_empty("text")).alias("text")).alias("part"),
    )
    # A conversation is one record of the output, so its turns have to meet in one row.
    joined = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("turns"), F.array_sort(F.collect_list("part")).alias("parts")
    )
    return joined.select("conv_id", "turns", F.array_join("parts.text", "").alias("text"))


# Letters and their full-width forms, which NFKC turns back.
_LETTERS = "".join(chr(c) for c in (*range(65, 91), *range(97, 123)))
_WIDE = "".join(chr(ord(c) + 0xFEE0) for c in _LETTERS)


@query(
    "nfkc",
    f"""WITH {SRC} SELECT language, count(*) AS docs, CAST(sum(length(text)) AS BIGINT) AS chars,
  count(*) AS restored, count(*) FILTER (regexp_matches(text, '[A-Za-z]')) AS changed FROM src GROUP BY language""",
)
def nfkc_query(spark, sf):
    """Texts spelled with a ligature and full-width letters come back as they were."""
    wide = F.translate(F.replace("text", F.lit("fi"), F.lit("\ufb01")), _LETTERS, _WIDE)
    spelled = spread_sources(spark, sf).select("language", "text", wide.alias("wide"))
    normal = spelled.withColumn("normal", nfkc(F.col("wide")))
    return normal.groupBy("language").agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum(F.length("normal")).alias("chars"),
        F.count_if(F.col("normal") == F.col("text")).alias("restored"),
        F.count_if(F.col("normal") != F.col("wide")).alias("changed"),
    )


@query("word_count", f"WITH {SRC} SELECT dataset, doc_id, CAST({sql_words('text')} AS BIGINT) AS words FROM src")
def word_count_query(spark, sf):
    return spread_sources(spark, sf).select("dataset", "doc_id", word_count(F.col("text")).cast("bigint").alias("words"))


@query(
    "text_preview",
    f"WITH {SRC} SELECT dataset, doc_id, CASE WHEN length(text) > 50 THEN substring(text, 1, 50) || '...' ELSE text END AS preview FROM src",
)
def text_preview(spark, sf):
    return all_sources(spark, sf).select("dataset", "doc_id", preview(F.col("text")).alias("preview"))


@query(
    "fertility_band",
    f"""WITH {SRC}, r AS (SELECT dataset, doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS bytes, {sql_words('text')} AS words FROM src),
f AS (SELECT dataset, doc_id, CASE WHEN words > 0 THEN CAST(bytes AS DOUBLE) / CAST(words AS DOUBLE) / 2 ELSE 0.0 END AS ratio FROM r)
SELECT dataset, CASE WHEN ratio <= 2.5 THEN 'EXCELLENT' WHEN ratio <= 3.5 THEN 'GOOD' ELSE 'POOR' END AS band, count(*) AS n
FROM f GROUP BY 1, 2""",
)
def fertility_band_query(spark, sf):
    """Bands over two bytes per token, a figure that needs no vocabulary."""
    ratio = safe_ratio(F.octet_length("text"), word_count(F.col("text"))) / 2
    banded = spread_sources(spark, sf).select("dataset", fertility_band(ratio).alias("band"))
    return banded.groupBy("dataset", "band").agg(F.count(F.lit(1)).alias("n"))


@query(
    "format_size",
    f"""WITH {SRC}, s AS (SELECT dataset, CAST(CAST(sum(octet_length(encode(text))) AS BIGINT) AS DOUBLE) AS b FROM src GROUP BY dataset)
SELECT dataset, {sql_size('b')} AS size, {sql_size('(b * b)')} AS squared FROM s""",
)
def format_size_query(spark, sf):
    sums = all_sources(spark, sf).groupBy("dataset").agg(F.sum(F.octet_length("text")).alias("bytes"))
    b = F.col("bytes").cast("double")
    return sums.select("dataset", format_size(b).alias("size"), format_size(b * b).alias("squared"))


@query(
    "format_duration",
    """WITH s AS (SELECT event_type, user_id, CAST(floor(sum(CAST(round(value * 100) AS BIGINT)) / 1) AS BIGINT) AS secs
  FROM events GROUP BY event_type, user_id)
SELECT event_type, user_id, CASE secs // 86400 WHEN 0 THEN '' WHEN 1 THEN '1 day, ' ELSE (secs // 86400) || ' days, ' END ||
  (secs % 86400) // 3600 || printf(':%02d:%02d', (secs % 3600) // 60, secs % 60) AS duration FROM s""",
)
def format_duration_query(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    secs = events.groupBy("event_type", "user_id").agg(F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("secs"))
    return secs.select("event_type", "user_id", format_duration(F.col("secs") + 0.75).alias("duration"))


_PER_SET = "SELECT source AS dataset, count(*) AS n FROM documents {where} GROUP BY source"


def _per_set(rows):
    return rows.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))


@query("output_reuse", _PER_SET.format(where=""))
def output_reuse(spark, sf):
    """An output asked for twice: the second time it is there, and nothing is built."""
    path, schema = fresh_path(spark, "output"), "dataset string, n bigint"
    reuse_or_write(spark, path, lambda: _per_set(documents(spark, sf)), schema)

    def never():
        raise AssertionError("built again")

    return reuse_or_write(spark, path, never, schema)


@query("output_replace", f"SELECT o.*, 2::BIGINT AS versions FROM ({_PER_SET.format(where='WHERE n_chars > 1000')}) o")
def output_replace(spark, sf):
    """An output written, then replaced while a reader of the first version is open, and a stop half way."""
    path = fresh_path(spark, "output")
    write_version(spark, path, _per_set(documents(spark, sf)).write.parquet, "all")
    write_version(spark, path, _per_set(documents(spark, sf).where("n_chars > 1000")).write.parquet, "long texts")

    def stops(folder):
        _per_set(documents(spark, sf).where("doc_id < 0")).write.parquet(folder)
        raise InterruptedError

    try:
        write_version(spark, path, stops)
    except InterruptedError:
        pass
    count = manifest(spark, path).agg(F.count(F.lit(1))).scalar()
    return read_current(spark, path).select("dataset", "n", count.alias("versions"))


@query("source_fallback", "SELECT 'documents' AS source, 2 AS failures, count(*) AS n FROM documents")
def source_fallback(spark, sf):
    """The first of three sources that opens: one folder is missing, one lacks a column."""
    name, rows, failures = first_available(
        [
            ("nowhere", lambda: spark.read.parquet(f"{sf}/no_such_table.parquet")),
            ("pages", lambda: spark.read.parquet(f"{sf}/pages.parquet").select("doc_id")),
            ("documents", lambda: documents(spark, sf)),
        ]
    )
    return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("source"), F.lit(len(failures)).alias("failures"), "n")
