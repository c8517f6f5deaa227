"""Queries over quotas, takes, unions and corpus statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions.text import MIN_CHARS
from textloom.operators.quota import (
    attainment,
    group_quotas,
    plan_table,
    stratified_take,
    take_per_dataset,
    weight_quotas,
)
from textloom.plans.corpus import build_corpus, corpus_breakdown, corpus_stats, eligible
from textloom.queries.base import DOCS, GROUPS, SRC, all_sources, documents, pages, query, sql_strip
from textloom.sources.tables import union_sources

_PLAN = """total AS (SELECT count(*) AS t FROM src),
groups(category, ratio, member, members) AS (VALUES ('english', 0.35::DOUBLE, 'en', 1), ('european', 0.55::DOUBLE, 'de', 3),
  ('european', 0.55::DOUBLE, 'es', 3), ('european', 0.55::DOUBLE, 'fr', 3), ('code', 0.10::DOUBLE, 'html', 1)),
plan AS (SELECT category, member AS stratum, CAST(floor(floor(t * ratio) / members) AS BIGINT) AS quota FROM groups, total)"""
_TAKEN = f"""{SRC}, {_PLAN},
ranked AS (SELECT *, row_number() OVER (PARTITION BY language ORDER BY doc_id) AS rn FROM src WHERE n_chars > {MIN_CHARS}),
taken AS (SELECT category, stratum AS member, doc_id, {sql_strip('text')} AS text FROM ranked JOIN plan
  ON stratum = language WHERE rn <= quota)"""


def _corpus(spark, sf):
    src = all_sources(spark, sf)
    return build_corpus(src, src.count(), GROUPS, length_col="n_chars")


@query("quota_plan", f"WITH {SRC}, {_PLAN} SELECT * FROM plan")
def quota_plan(spark, sf):
    return plan_table(spark, group_quotas(all_sources(spark, sf).count(), GROUPS))


@query("stratified_take", f"WITH {_TAKEN} SELECT * FROM taken")
def stratified_take_query(spark, sf):
    return _corpus(spark, sf)


@query("stratified_take_cut", f"WITH {_TAKEN} SELECT category, member, doc_id FROM taken")
def stratified_take_cut(spark, sf):
    """The same take by histogram cut, whatever the size of the quotas."""
    src = all_sources(spark, sf)
    return build_corpus(src, src.count(), GROUPS, length_col="n_chars", method="cut").select("category", "member", "doc_id")


@query(
    "max_samples",
    f"""WITH {DOCS}, q AS (SELECT count(*) // 40 AS top FROM docs),
r AS (SELECT doc_id, dataset, row_number() OVER (PARTITION BY dataset ORDER BY doc_id) AS rn FROM docs)
SELECT doc_id, dataset FROM r, q WHERE rn <= top""",
)
def max_samples(spark, sf):
    docs = documents(spark, sf)
    return take_per_dataset(docs.select("doc_id", "dataset"), docs.count() // 40)


@query(
    "take_overlapping",
    f"""WITH {SRC}, named AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'a' ELSE 'b' END AS dataset FROM src),
r AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY doc_id) AS rn FROM named)
SELECT dataset, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS keys FROM r
WHERE rn <= (SELECT count(*) FROM src) // 5 GROUP BY dataset""",
)
def take_overlapping(spark, sf):
    """Sources whose ids overlap, with a null dataset: no quota is overfilled and no row is lost."""
    src = all_sources(spark, sf)
    name = F.when(F.col("doc_id") % 3 == 1, "a").when(F.col("doc_id") % 3 == 2, "b")
    named = src.select("doc_id", "text", name.alias("dataset"))
    taken = take_per_dataset(named, src.count() // 5)
    return taken.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("keys"))


@query(
    "weighted_mix",
    f"""WITH {DOCS}, names AS (SELECT dataset, row_number() OVER (ORDER BY dataset) AS i FROM (SELECT DISTINCT dataset FROM docs)),
w AS (SELECT dataset, CAST(i AS DOUBLE) / (SELECT sum(i) FROM names)::DOUBLE AS weight FROM names),
q AS (SELECT dataset, CAST(floor((SELECT count(*) FROM docs) * weight) AS BIGINT) AS quota FROM w),
r AS (SELECT doc_id, dataset, row_number() OVER (PARTITION BY dataset ORDER BY doc_id) AS rn FROM docs WHERE n_chars > {MIN_CHARS})
SELECT doc_id, dataset FROM r JOIN q USING (dataset) WHERE rn <= quota""",
)
def weighted_mix(spark, sf):
    docs = documents(spark, sf)
    names = sorted(r.dataset for r in docs.select("dataset").distinct().collect())
    whole = sum(range(1, len(names) + 1))
    rows = weight_quotas(docs.count(), {n: (i + 1) / whole for i, n in enumerate(names)})
    usable = eligible(docs, length_col="n_chars").select("doc_id", "dataset")
    return stratified_take(usable, {n: q for _, n, q in rows}, "dataset")


_SHARES = {"en": 0.55, "de": 0.15, "es": 0.15, "fr": 0.15}
_SHARE_ROWS = ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in _SHARES.items())


@query(
    "language_mix",
    f"""WITH {DOCS}, w(language, weight) AS (VALUES {_SHARE_ROWS}),
q AS (SELECT language, CAST(floor((SELECT count(*) FROM docs) * weight) AS BIGINT) AS quota FROM w),
r AS (SELECT doc_id, language, row_number() OVER (PARTITION BY language ORDER BY doc_id) AS rn FROM docs WHERE n_chars > {MIN_CHARS})
SELECT doc_id, language FROM r JOIN q USING (language) WHERE rn <= quota""",
)
def language_mix(spark, sf):
    docs = documents(spark, sf)
    rows = weight_quotas(docs.count(), _SHARES)
    usable = eligible(docs, length_col="n_chars").select("doc_id", "language")
    return stratified_take(usable, {n: q for _, n, q in rows}, "language")


@query(
    "quota_attainment",
    f"""WITH {_TAKEN}, c AS (SELECT member AS stratum, count(*) AS n FROM taken GROUP BY member)
SELECT category, stratum, quota, coalesce(n, 0) AS collected, quota - coalesce(n, 0) AS shortfall,
  CASE WHEN quota > 0 THEN CAST(coalesce(n, 0) AS DOUBLE) / CAST(quota AS DOUBLE) ELSE 0.0 END AS attainment
FROM plan LEFT JOIN c USING (stratum)""",
)
def quota_attainment(spark, sf):
    src = all_sources(spark, sf)
    total = src.count()
    taken = build_corpus(src, total, GROUPS, length_col="n_chars")
    return attainment(plan_table(spark, group_quotas(total, GROUPS)), taken, "member")


@query("corpus_union", f"WITH {SRC} SELECT doc_id, dataset, language, text FROM src WHERE n_chars > {MIN_CHARS}")
def corpus_union(spark, sf):
    union, _ = union_sources(
        [
            ("documents", lambda: documents(spark, sf)),
            ("missing", lambda: spark.read.parquet(f"{sf}/no-such-table.parquet")),
            ("pages", lambda: pages(spark, sf)),
        ]
    )
    return eligible(union, length_col="n_chars").select("doc_id", "dataset", "language", "text")


_STATS = f"""WITH {_TAKEN}, c AS (SELECT category, count(*) AS n FROM taken GROUP BY category)
SELECT category, n, CAST(n AS DOUBLE) / CAST((SELECT sum(n) FROM c) AS DOUBLE) * 100 AS pct FROM c ORDER BY category"""


@query("corpus_stats", _STATS)
def corpus_stats_query(spark, sf):
    return corpus_stats(_corpus(spark, sf))


def _breakdown_sql(total: str) -> str:
    return f"""WITH {_TAKEN}, c AS (SELECT category, member, CAST(grouping(member) AS INTEGER) AS level, count(*) AS n
  FROM taken GROUP BY GROUPING SETS ((category, member), (category)))
SELECT category, member, level, n, CAST(n AS DOUBLE) / CAST((SELECT {total} FROM c) AS DOUBLE) * 100 AS pct FROM c"""


@query("corpus_breakdown", _breakdown_sql("sum(n) FILTER (level = 0)"))
def corpus_breakdown_query(spark, sf):
    return corpus_breakdown(_corpus(spark, sf))


@query("corpus_breakdown_compat", _breakdown_sql("sum(n)"))
def corpus_breakdown_compat(spark, sf):
    """Shares of the sum over categories and members alike, so that a row may count twice."""
    return corpus_breakdown(_corpus(spark, sf), compat=True)
