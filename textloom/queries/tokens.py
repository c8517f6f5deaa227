"""Queries over vocabulary training, encoding, tokenized records and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions.pretokens import SPECIAL_TOKENS, pretokens, word_symbols
from textloom.functions.text import MIN_CHARS, nfkc
from textloom.functions.tokens import Codec
from textloom.operators.encoding import encode_records, shape_records, token_totals
from textloom.operators.evaluation import fertility_by_language, fertility_report, text_fertility
from textloom.operators.slots import place_of_row
from textloom.operators.stats import macro_average
from textloom.operators.vocabulary import VOCAB_SIZE, corpus_lines, pair_counts, word_counts
from textloom.plans.corpus import eligible
from textloom.plans.layout import write_tokenized
from textloom.queries.base import (
    DOCS,
    SRC,
    all_sources,
    spread_documents,
    spread_sources,
    documents,
    query,
    sql_pretokens,
    sql_words,
    vocabulary,
    whole_vocabulary,
)
from textloom.queries.bpe_sql import WORD_COUNTS, encoding, pair_table, symbols, token_texts, training, whole_counts
from textloom.session import fresh_path
from textloom.sources.sinks import ALGORITHM, METADATA_SCHEMA, read_vocabulary, write_records, write_vocabulary
from textloom.sources.tokenizer_file import read_tokenizer, write_tokenizer
from textloom.streaming.ingest import IngestOptions, read_ledger, read_records, run_ingest, stream_files

_GROUP = ["de", "es", "fr"]


def _codec(spark, sf) -> Codec:
    return Codec.of(vocabulary(spark, sf), spark)


def _usable(spark, sf):
    return eligible(spread_documents(spark, sf), length_col="n_chars")


def _ids_text(column: str):
    return F.array_join(F.col(column).cast("array<string>"), " ")


@query(
    "pretokenize",
    f"WITH {SRC} SELECT dataset, doc_id, CAST(len(w) AS BIGINT) AS n, array_to_string(w, '~') AS pieces FROM (SELECT dataset, doc_id, {sql_pretokens('text')} AS w FROM src)",
)
def pretokenize(spark, sf):
    pieces = spread_sources(spark, sf).select("dataset", "doc_id", pretokens(F.col("text")).alias("w"))
    return pieces.select("dataset", "doc_id", F.size("w").cast("bigint").alias("n"), F.array_join("w", "~").alias("pieces"))


@query("pretoken_counts", f"WITH {WORD_COUNTS} SELECT word, n FROM words")
def pretoken_counts(spark, sf):
    return word_counts(corpus_lines(_usable(spark, sf)))


@query(
    "bpe_pair_counts",
    f"WITH {WORD_COUNTS}, w AS (SELECT {symbols('word')} AS sym, n FROM words), p AS ({pair_table('w')}) SELECT l AS left_id, r AS right_id, n FROM p WHERE n >= 2",
)
def bpe_pair_counts(spark, sf):
    words = word_counts(corpus_lines(_usable(spark, sf))).select(word_symbols(F.col("word")).alias("symbols"), "n")
    pairs = pair_counts(words).where(F.col("n") >= 2)
    # Ids are small here (bytes only), so a symbol's id is its code point less 256.
    left = F.ascii(F.substring("pair", 1, 1)) - 256
    right = F.ascii(F.substring("pair", 2, 1)) - 256
    return pairs.select(left.alias("left_id"), right.alias("right_id"), "n")


@query(
    "bpe_merges",
    f"WITH {training()} SELECT rank, l AS left_id, r AS right_id, id AS token_id, n AS pair_count FROM merges",
)
def bpe_merges(spark, sf):
    learned = vocabulary(spark, sf, fresh=True).merges_table(spark)
    return learned.select("rank", "left_id", "right_id", "token_id", "pair_count")


@query("bpe_vocab", f"WITH {training()}, {token_texts()} SELECT id, token FROM tokens")
def bpe_vocab(spark, sf):
    path = fresh_path(spark, "vocabulary")
    write_vocabulary(vocabulary(spark, sf), spark, path, VOCAB_SIZE)
    vocab, _ = read_vocabulary(spark, path)
    return vocab.select("id", "token")


@query(
    "bpe_merge_parts",
    f"""WITH {training()} SELECT rank, id AS token_id, 1 + (l >= 277)::INTEGER + (r >= 277)::INTEGER AS parts FROM merges""",
)
def bpe_merge_parts(spark, sf):
    """The saved merges read back: which of their sides are merges themselves."""
    path = fresh_path(spark, "vocabulary")
    write_vocabulary(vocabulary(spark, sf), spark, path, VOCAB_SIZE)
    _, merges = read_vocabulary(spark, path)
    first = 277
    parts = F.lit(1) + (F.col("left_id") >= first).cast("int") + (F.col("right_id") >= first).cast("int")
    return merges.select("rank", "token_id", parts.alias("parts"))


@query(
    "vocab_metadata",
    f"""WITH {training()} SELECT 277 + (SELECT count(*) FROM merges) AS vocab_size, '{ALGORITHM}' AS algorithm, 2048 AS max_length,
  '{" ".join(SPECIAL_TOKENS)}' AS special_tokens, 'en hi ta te bn mr gu kn code' AS languages,
  (SELECT count(*) FROM merges) AS n_merges, 277 + (SELECT count(*) FROM merges) AS n_tokens""",
)
def vocab_metadata(spark, sf):
    """The saved metadata with the sizes of the tables beside it."""
    path, built = fresh_path(spark, "vocabulary"), vocabulary(spark, sf)
    write_vocabulary(built, spark, path, len(built.tokens))
    vocab, merges = read_vocabulary(spark, path)
    info = spark.read.schema(METADATA_SCHEMA).json(f"{path}/metadata")
    return info.select(
        "vocab_size",
        "algorithm",
        "max_length",
        F.array_join("special_tokens", " ").alias("special_tokens"),
        F.array_join("languages", " ").alias("languages"),
        merges.agg(F.count(F.lit(1))).scalar().alias("n_merges"),
        vocab.agg(F.count(F.lit(1))).scalar().alias("n_tokens"),
    )


_TEXTS = f"{DOCS}, texts AS (SELECT doc_id AS k, text, language, dataset FROM docs)"
_USABLE = f"{DOCS}, texts AS (SELECT doc_id AS k, text, language, dataset, phase FROM docs WHERE n_chars > {MIN_CHARS})"


@query(
    "encode_documents",
    f"WITH {_TEXTS}, {encoding('texts')} SELECT k AS doc_id, CAST(len(ids) AS BIGINT) AS n_tokens, array_to_string(ids, ' ') AS input_ids FROM enc",
)
def encode_documents(spark, sf):
    ids = _codec(spark, sf).encode(F.col("text"))
    encoded = spread_documents(spark, sf).select("doc_id", ids.alias("ids"))
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), _ids_text("ids").alias("input_ids"))


@query(
    "tokenizer_file",
    f"WITH {_TEXTS}, {encoding('texts')} SELECT k AS doc_id, CAST(len(ids) AS BIGINT) AS n_tokens, array_to_string(ids, ' ') AS input_ids FROM enc",
)
def tokenizer_file(spark, sf):
    """The vocabulary written as a public tokenizer file, read back, and used."""
    path = fresh_path(spark, "tokenizer")
    write_tokenizer(vocabulary(spark, sf), spark, path)
    codec = read_tokenizer(spark, path)
    encoded = documents(spark, sf).select("doc_id", codec.encode(F.col("text")).alias("ids"))
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), _ids_text("ids").alias("input_ids"))


@query(
    "decode_roundtrip",
    f"WITH {SRC} SELECT language, count(*) AS docs, CAST(sum(length(text)) AS BIGINT) AS chars, 0 AS mismatches FROM src GROUP BY language",
)
def decode_roundtrip(spark, sf):
    codec = _codec(spark, sf)
    encoded = spread_sources(spark, sf).select("language", "text", codec.encode(F.col("text")).alias("ids"))
    back = encoded.select("language", nfkc(F.col("text")).alias("normal"), codec.decode(F.col("ids")).alias("decoded"))
    return back.groupBy("language").agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum(F.length("decoded")).alias("chars"),
        F.count_if(F.col("decoded") != F.col("normal")).cast("int").alias("mismatches"),
    )


_SHORT = 64


@query(
    "truncate_pad",
    f"""WITH t AS (SELECT doc_id, list_transform(string_split(text, ' '), lambda w: CAST(length(w) AS INTEGER)) AS ids, lang, source FROM documents),
c AS (SELECT doc_id, lang, source, ids[:{_SHORT}] AS cut FROM t)
SELECT doc_id, lang AS language, source AS dataset, CAST(len(cut) AS INTEGER) AS length,
  array_to_string(list_resize(cut, {_SHORT}, 1), ' ') AS input_ids,
  array_to_string(list_resize(list_transform(cut, lambda x: 1), {_SHORT}, 0), ' ') AS attention_mask,
  array_to_string(list_resize(cut, {_SHORT}, 1), ' ') AS labels FROM c""",
)
def truncate_pad(spark, sf):
    """Cut and fill up lists of word lengths, so that plain SQL can check it."""
    ids = F.transform(F.split("text", " "), lambda w: F.length(w))
    listed = documents(spark, sf).select("doc_id", ids.alias("ids"), "language", "dataset")
    shaped = shape_records(listed, "ids", ["doc_id"], _SHORT, pad_to_max=True)
    return shaped.select(
        "doc_id", "language", "dataset", "length", *[_ids_text(c).alias(c) for c in ("input_ids", "attention_mask", "labels")]
    )


@query(
    "tokenized_schema",
    f"""WITH {_TEXTS}, {encoding('texts')}, c AS (SELECT k, list_prepend(5 + (language <> 'en')::INTEGER, ids)[:2048] AS ids, language, dataset
  FROM enc JOIN texts USING (k) WHERE language = 'en'
  UNION ALL SELECT k, ids[:2048], language, dataset FROM enc JOIN texts USING (k) WHERE language <> 'en')
SELECT k AS doc_id, CAST(len(ids) AS INTEGER) AS length, language, dataset, array_to_string(ids, ' ') AS input_ids,
  array_to_string(list_transform(ids, lambda x: 1), ' ') AS attention_mask, array_to_string(ids, ' ') AS labels FROM c""",
)
def tokenized_schema(spark, sf):
    """Records with a language marker (only English has one among the test languages)."""
    from textloom.sources.catalog import marker_of

    records = encode_records(spread_documents(spark, sf), _codec(spark, sf), marker=marker_of(F.col("language")), keep=["doc_id"])
    return records.select(
        "doc_id", "length", "language", "dataset", *[_ids_text(c).alias(c) for c in ("input_ids", "attention_mask", "labels")]
    )


@query(
    "tokenized_roundtrip",
    f"""WITH {_USABLE}, {encoding('texts')}
SELECT k AS doc_id, phase, dataset, CAST(len(ids[:2048]) AS INTEGER) AS length, array_to_string(ids[:2048], ' ') AS input_ids
FROM enc JOIN texts USING (k)""",
)
def tokenized_roundtrip(spark, sf):
    path = fresh_path(spark, "records")
    records = encode_records(_usable(spark, sf), _codec(spark, sf), keep=["doc_id", "phase"])
    write_records(records, path)
    back = spark.read.parquet(path)
    return back.select("doc_id", "phase", "dataset", "length", _ids_text("input_ids").alias("input_ids"))


# Rows of a file in the layout query; row groups are no longer than that.
_SLOT_ROWS = 1_000


@query(
    "slot_layout",
    f"""WITH {_USABLE}, {encoding('texts')}, t AS (SELECT phase, dataset, count(*) AS samples,
  CAST(sum(len(ids[:2048])) AS BIGINT) AS tokens FROM enc JOIN texts USING (k) GROUP BY phase, dataset)
SELECT phase, dataset, samples, tokens, samples // {_SLOT_ROWS} AS full_files,
  CAST(samples % {_SLOT_ROWS} > 0 AS BIGINT) AS part_files FROM t""",
)
def slot_layout(spark, sf):
    """Files of whole row groups: texts are moved once to the file they belong to, then encoded."""
    path = fresh_path(spark, "slots")
    rows = eligible(documents(spark, sf).withColumn("place", place_of_row()), length_col="n_chars")
    write_tokenized(rows, _codec(spark, sf), path, "place", _SLOT_ROWS)
    files = spark.read.parquet(path).groupBy("phase", "dataset", F.col("_metadata.file_path").alias("file"))
    files = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("tokens"))
    return files.groupBy("phase", "dataset").agg(
        F.sum("n").alias("samples"),
        F.sum("tokens").alias("tokens"),
        F.count_if(F.col("n") == _SLOT_ROWS).alias("full_files"),
        F.count_if(F.col("n") < _SLOT_ROWS).alias("part_files"),
    )


_PER_LANGUAGE = """per AS (SELECT language, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(words) AS BIGINT) AS words, count(*) AS texts,
  CASE WHEN sum(words) > 0 THEN sum(tokens)::DOUBLE / sum(words)::DOUBLE ELSE 0.0 END AS fertility FROM counted GROUP BY language)"""
_COUNTED = f"""{_TEXTS}, {encoding('texts')},
counted AS (SELECT language, dataset, len(ids) AS tokens, {sql_words('text')} AS words, text FROM enc JOIN texts USING (k)),
{_PER_LANGUAGE}"""
_WHOLE_COUNTED = f"""{_TEXTS}, {whole_counts('texts')},
counted AS (SELECT language, n_tokens AS tokens, {sql_words('text')} AS words FROM enc JOIN texts USING (k)),
{_PER_LANGUAGE}"""


def _sql_band(f: str) -> str:
    return f"CASE WHEN {f} <= 2.5 THEN 'EXCELLENT' WHEN {f} <= 3.5 THEN 'GOOD' ELSE 'POOR' END"


@query(
    "fertility_by_language",
    f"""WITH RECURSIVE {_WHOLE_COUNTED}, m AS (SELECT language, round(avg(CASE WHEN words > 0 THEN tokens::DOUBLE / words::DOUBLE ELSE 0.0 END), 6) AS mean_fertility
  FROM counted GROUP BY language) SELECT language, tokens, words, texts, fertility, mean_fertility FROM per JOIN m USING (language)""",
)
def fertility_by_language_query(spark, sf):
    codec = Codec.of(whole_vocabulary(spark, sf), spark)
    return fertility_by_language(spread_documents(spark, sf), codec).withColumn(
        "mean_fertility", F.round("mean_fertility", 6)
    )


@query(
    "fertility_macro",
    f"WITH {_COUNTED} SELECT round(avg(fertility), 9) AS macro_fertility, count(*) AS languages FROM per WHERE language IN ('de', 'es', 'fr')",
)
def fertility_macro(spark, sf):
    per_language = fertility_by_language(spread_documents(spark, sf), _codec(spark, sf))
    return macro_average(per_language, _GROUP).withColumn("macro_fertility", F.round("macro_fertility", 9))


@query(
    "fertility_report",
    f"""WITH {_COUNTED}, rows AS (SELECT language, tokens, words, texts, fertility FROM per UNION ALL
  SELECT 'group mean', NULL, NULL, NULL, avg(fertility) FROM per WHERE language IN ('de', 'es', 'fr'))
SELECT language, tokens, words, texts, round(fertility, 9) AS fertility, {_sql_band('fertility')} AS band FROM rows""",
)
def fertility_report_query(spark, sf):
    report = fertility_report(spread_documents(spark, sf), _codec(spark, sf), _GROUP)
    return report.withColumn("fertility", F.round("fertility", 9))


@query(
    "text_fertility",
    f"""WITH {_TEXTS}, {encoding('texts')}
SELECT k AS doc_id, language, CASE WHEN length(text) > 50 THEN substring(text, 1, 50) || '...' ELSE text END AS text,
  CAST(len(ids) AS INTEGER) AS tokens, CAST({sql_words('text')} AS INTEGER) AS words,
  CASE WHEN {sql_words('text')} > 0 THEN len(ids)::DOUBLE / {sql_words('text')}::DOUBLE ELSE 0.0 END AS fertility
FROM enc JOIN texts USING (k)""",
)
def text_fertility_query(spark, sf):
    return text_fertility(spread_documents(spark, sf), _codec(spark, sf), keep=["doc_id"])


@query(
    "token_totals",
    f"""WITH {_USABLE}, {encoding('texts')} SELECT dataset, language, CAST(sum(least(len(ids), 2048)) AS BIGINT) AS total_tokens,
  count(*) AS total_samples FROM enc JOIN texts USING (k) GROUP BY dataset, language""",
)
def token_totals_query(spark, sf):
    return token_totals(encode_records(_usable(spark, sf), _codec(spark, sf)))


# Two of the given tables as one stream of files: what one lacks reads as null. The path of a
# file stream is a folder or a pattern, hence the braces around a single name.
_STREAM_SCHEMA = "doc_id bigint, text string, lang string, source string, page_id bigint, html string"


def _stream(spark, sf, tables: str):
    rows = stream_files(spark, f"{sf}/{tables}.parquet", _STREAM_SCHEMA)
    return rows.select(
        F.coalesce("doc_id", "page_id").alias("doc_id"),
        F.coalesce("text", "html").alias("text"),
        F.coalesce("lang", F.lit("html")).alias("language"),
        F.coalesce("source", F.lit("pages")).alias("dataset"),
        F.lit("phase1_pretraining").alias("phase"),
    )


@query(
    "stream_ingest",
    f"""WITH {_USABLE}, {encoding('texts')} SELECT phase, dataset AS dataset_name, count(*) AS samples,
  CAST(sum(least(len(ids), 2048)) AS BIGINT) AS tokens, 1 AS files FROM enc JOIN texts USING (k) GROUP BY phase, dataset""",
)
def stream_ingest(spark, sf):
    output = fresh_path(spark, "stream")
    run_ingest(_stream(spark, sf, "{documents}"), _codec(spark, sf), output)
    return read_ledger(spark, output).select(
        "phase",
        "dataset_name",
        F.col("total_samples_processed").alias("samples"),
        F.col("total_tokens_processed").alias("tokens"),
        F.col("files_created").alias("files"),
    )


_ALL_USABLE = f"{SRC}, texts AS (SELECT dataset || '/' || doc_id AS k, doc_id, text, language, dataset, n_chars FROM src WHERE n_chars > {MIN_CHARS})"


@query(
    "stream_resume",
    f"""WITH {_ALL_USABLE}, {encoding('texts')} SELECT CAST((language = 'html')::INTEGER AS BIGINT) AS batch_id, dataset, language, doc_id,
  CAST(least(len(ids), 2048) AS INTEGER) AS length FROM enc JOIN texts USING (k)""",
)
def stream_resume(spark, sf):
    """A stream that is stopped after one table and goes on when the next has arrived."""
    output, codec = fresh_path(spark, "stream"), _codec(spark, sf)
    run_ingest(_stream(spark, sf, "{documents}"), codec, output)
    run_ingest(_stream(spark, sf, "{documents,pages}"), codec, output)
    return read_records(spark, output).select("batch_id", "dataset", "language", "doc_id", "length")


@query(
    "stream_quota",
    f"""WITH {_ALL_USABLE}, {encoding('texts')}, q AS (SELECT count(*) * 9 // 10 AS quota FROM texts),
r AS (SELECT ids, row_number() OVER (ORDER BY language = 'html', doc_id) AS rn FROM enc JOIN texts USING (k))
SELECT 'mixed' AS dataset_name, count(*) AS samples, CAST(sum(least(len(ids), 2048)) AS BIGINT) AS tokens FROM r, q WHERE rn <= quota""",
)
def stream_quota(spark, sf):
    """One quota over two arrivals: the second batch takes what the first left open."""
    output, codec = fresh_path(spark, "stream"), _codec(spark, sf)
    options = IngestOptions(max_samples=eligible(all_sources(spark, sf), length_col="n_chars").count() * 9 // 10)
    for tables in ("{documents}", "{documents,pages}"):
        run_ingest(_stream(spark, sf, tables).withColumn("dataset", F.lit("mixed")), codec, output, options)
    newest = read_ledger(spark, output).groupBy("dataset_name").agg(
        F.max("total_samples_processed").alias("samples"), F.max("total_tokens_processed").alias("tokens")
    )
    return newest.select("dataset_name", "samples", "tokens")



