"""The registered queries of the subpackage, one for each operator, and the SQL that judges them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import (
    collocations,
    embeddings,
    exact,
    fingerprints,
    mixing,
    pieces,
    secrets,
    sharding,
    simhash,
    spelling,
    suffixes,
    toxicity,
    url_filter,
)

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query(
    "op1_embeddings",
    """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
n AS (SELECT *, sqrt(list_dot_product(e, e)) AS size FROM v WHERE list_dot_product(e, e) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label
  AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  AND list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.98),
reach AS (SELECT vec_id AS origin, vec_id AS node FROM embeddings
  UNION SELECT r.origin, l.b FROM reach r JOIN links l ON r.node = l.a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT origin AS vec_id, coalesce(any_value(d.n), 0)::BIGINT AS n_links, min(node) AS component_id,
  origin = min(node) AS kept
FROM reach LEFT JOIN degree d ON d.a = origin GROUP BY origin""",
)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf, "embeddings"))


@query("op2_secrets")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.digest(table(spark, sf, "documents"))


# The mix: a domain holds five neighbouring sources; sources of a language weigh the same.
DOMAINS = ("web", "news", "books", "forum")
MIX_LEVELS = ("domain", "lang", "source")
MIX_WEIGHTS = {
    "domain": {"web": 0.4, "news": 0.25, "books": 0.2, "forum": 0.15},
    "lang": {"en": 0.4, "de": 0.25, "fr": 0.25, "es": 0.1},
}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.5, 2, 7


def with_domain(docs: DataFrame) -> DataFrame:
    """``domain`` by the number at the end of ``source``; without one, "other"."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), r"(\d{1,4})$", 1)
    at = F.expr("try_cast(_number AS INT)")
    domain = F.coalesce(F.get(F.array(*map(F.lit, DOMAINS)), (at / 5).cast("int")), F.lit("other"))
    return docs.withColumn("_number", number).withColumn("domain", domain).drop("_number")


def _share_sql(step: str, before: str, parent: str, name: str, weights: dict[str, float]) -> str:
    """One level of the budget tree: the closed form of the shares."""
    weight = " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items())
    weight = f"CASE {name} {weight} ELSE 1.0 END::DOUBLE" if weights else "1.0::DOUBLE"
    by = f"PARTITION BY {parent}" if parent else ""
    keys = f"{parent}, {name}" if parent else name
    same = " AND ".join(f"b.{k} IS NOT DISTINCT FROM s.{k}" for k in keys.split(", "))
    return f"""
{step}n AS (SELECT {keys}, sum(supply) AS supply, {weight} AS weight, max(above) AS above
  FROM {before} GROUP BY {keys}),
{step}l AS (SELECT *, (above - coalesce(sum(supply) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM {step}n WINDOW o AS ({by} ORDER BY supply / weight, {name})),
{step}s AS (SELECT {keys}, least(supply::DOUBLE, weight * max(lev) OVER ({by})) AS budget FROM {step}l),
{step} AS (SELECT b.* EXCLUDE (above), s.budget AS above FROM {before} b JOIN {step}s s ON {same})"""


MIX_SQL = f"""
WITH d AS (SELECT doc_id,
    coalesce(CASE try_cast(regexp_extract(coalesce(source, ''), '(\\d{{1,4}})$', 1) AS INT) // 5
      WHEN 0 THEN 'web' WHEN 1 THEN 'news' WHEN 2 THEN 'books' WHEN 3 THEN 'forum' END, 'other') AS domain,
    lang, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS tokens
  FROM documents),
leaf AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens FROM d GROUP BY ALL),
live AS (SELECT *, tokens * {MIX_EPOCHS} AS supply,
    least({MIX_SHARE} * (SELECT sum(tokens) FROM leaf), {MIX_EPOCHS} * (SELECT sum(tokens) FROM leaf))::DOUBLE
      AS above FROM leaf WHERE tokens > 0),
{_share_sql("t1", "live", "", "domain", MIX_WEIGHTS["domain"])},
{_share_sql("t2", "t1", "domain", "lang", MIX_WEIGHTS["lang"])},
{_share_sql("t3", "t2", "domain, lang", "source", {})},
plan AS (SELECT domain, lang, source, tokens AS whole, floor(above + 1e-6)::BIGINT AS budget FROM t3),
keyed AS (SELECT d.*, coalesce(p.budget, 0) AS budget, coalesce(p.budget // p.whole, 0) AS epoch,
    coalesce(p.budget % p.whole, 0) AS lft
  FROM d LEFT JOIN plan p ON d.domain = p.domain AND d.lang IS NOT DISTINCT FROM p.lang
    AND d.source IS NOT DISTINCT FROM p.source),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5(concat_ws(':', '{MIX_SEED}', epoch, doc_id)), tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM keyed)
SELECT doc_id, domain, lang, source, tokens, budget,
  CASE WHEN budget > 0 THEN epoch + (upto <= lft)::INT ELSE 0 END::INT AS copies
FROM summed"""


@query("op3_mixing", MIX_SQL)
def op3(spark: SparkSession, sf: str) -> DataFrame:
    docs = with_domain(table(spark, sf, "documents"))
    return mixing.mix(docs, MIX_LEVELS, MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)


@query("op4_simhash")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query("op5_sharding")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf, "documents"), shards=24)


@query("op6_toxicity")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf, "labels").select("doc_id", "toxic"))
    scored = toxicity.score_documents(docs, model)
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


# The rules of the contract.
URL_RULES = {
    "net/": "block",
    "example.net/en/": "allow",
    "example.com/de/": "block",
    "org/fr/": "allow",
}


@query(
    "op7_url_filter",
    r"""
WITH parts AS (
  SELECT page_id, url,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id, url,
    translate(regexp_extract(rest, '^[^/?#]*', 0),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
rules(rule, action) AS (
  VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'),
    ('org/fr/', 'allow')),
fits AS (
  SELECT s.page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
  FROM split s JOIN rules ON starts_with(path, substr(rule, instr(rule, '/')))
    AND (host = split_part(rule, '/', 1) OR host LIKE '%.' || split_part(rule, '/', 1))
  GROUP BY s.page_id),
listed AS (
  SELECT host FROM split WHERE host <> '' GROUP BY host
  HAVING NOT bool_or(coalesce(starts_with(url, 'https://'), false)))
SELECT s.page_id, s.host, s.path, f.rule,
  coalesce(f.action, CASE WHEN s.host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END)
    AS verdict
FROM split s LEFT JOIN fits f ON f.page_id = s.page_id""",
)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    out = url_filter.filter_urls(pages, URL_RULES, url_filter.insecure_hosts(pages))
    return out.select("page_id", "host", "path", "rule", "verdict")


@query("op10_fingerprints")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf, "documents"))


# Share of merge candidates that are skipped, and the key of the hash that skips them.
DROPOUT, DROPOUT_SEED = 0.1, 2024


@query("op9_pieces")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return pieces.digest(pieces.encode_documents(docs, dropout=DROPOUT, seed=DROPOUT_SEED))


@query("op8_suffixes")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return suffixes.remove_repeats(docs, texts=False).drop("kept")


@query(
    "op11_exact",
    """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return exact.deduplicate(spark, f"{sf}/documents.parquet")


# CRC-32 in SQL: one byte by eight steps of the polynomial, and a list of bytes folded from the left.
_CRC_TABLE = """(SELECT list(c ORDER BY i) FROM (SELECT i, list_reduce(range(8), lambda c, k:
  xor(c >> 1, 3988292384 * (c & 1)), i) AS c FROM range(256) t(i)))"""


@query(
    "op12_spelling",
    f"""
WITH RECURSIVE t AS MATERIALIZED (SELECT {_CRC_TABLE} AS crc),
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
  FROM documents) GROUP BY ALL),
long AS (SELECT run, n, coalesce(doc_id::VARCHAR, '') || ':' || run AS s FROM runs WHERE length(run) >= 6),
hashed AS (SELECT run, n, xor(4294967295::BIGINT, list_reduce(list_transform(range(octet_length(encode(s))),
    lambda i: ('0x' || substr(hex(encode(s)), 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(t.crc[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT)) AS h FROM long, t),
read AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT)
    || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM read WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (SELECT DISTINCT a, b, bn FROM (
  SELECT x.word AS a, y.word AS b, y.n AS bn FROM less x JOIN less y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION ALL SELECT x.word, y.word, y.n FROM less x JOIN words y ON x.rest = y.word
  UNION ALL SELECT y.word, x.word, x.n FROM less x JOIN words y ON x.rest = y.word)),
best AS (SELECT a AS word, count(*) AS n_near, arg_min(b, (-bn, b)) AS f, max(bn) AS fn FROM near GROUP BY a),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN fn >= 5 * n THEN f END AS form, CASE WHEN fn >= 5 * n THEN fn END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS node, 0 AS step FROM forms
  UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN forms f ON c.node = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms f JOIN (SELECT word, arg_max(node, step) AS root FROM chain GROUP BY word) c USING (word)""",
)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(table(spark, sf, "documents"))


@query(
    "op13_collocations",
    """
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
split AS MATERIALIZED (SELECT lang, w FROM (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces)
  WHERE len(w) > 0),
grams AS (SELECT lang, len(g) AS words, array_to_string(g, ' ') AS phrase FROM (
  SELECT lang, unnest(list_transform(range(1, len(w) + 1), lambda i: w[i:i])) AS g FROM split
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i:i + 1])) FROM split
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) FROM split
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3])) FROM split)),
f AS MATERIALIZED (SELECT lang, phrase, any_value(words) AS words, count(*) AS f FROM grams GROUP BY lang, phrase),
cand AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= 30),
cuts AS (SELECT lang, phrase, f AS a, unnest(range(1, words)) AS k, w FROM cand),
sides AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y FROM cuts),
scored AS (SELECT s.*, l.f AS l, r.f AS r, (2000000::HUGEINT * a // (l.f::HUGEINT + r.f))::BIGINT AS score
  FROM sides s JOIN f l ON l.lang = s.lang AND l.phrase = x JOIN f r ON r.lang = s.lang AND r.phrase = y),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, f FROM (
    SELECT *, unnest(range(1, words - m + 2)) AS i FROM (SELECT *, unnest(range(2, words)) AS m FROM cand))),
longest AS (SELECT lang, phrase, max(f) AS longer FROM inner_parts GROUP BY lang, phrase),
kept AS (SELECT b.* FROM best b LEFT JOIN longest USING (lang, phrase)
  WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN n USING (lang)
WHERE rank <= 2000""",
)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))
