import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import quota as Q
from textloom.operators import stats as S
from textloom.plans.corpus import build_corpus


def brute(rows, quotas):
    kept = []
    for s, q in quotas.items():
        kept += sorted(k for k, t in rows if t == s)[: max(q, 0)]
    return sorted(kept)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, stratum string")


@pytest.mark.parametrize("spread", [1, 1000, 2**50])
def test_cut_equals_window_equals_brute_force(spark, spread, monkeypatch):
    monkeypatch.setattr(Q, "_SMALL_RANGE", 20)
    monkeypatch.setattr(Q, "_RANGES", 8)
    rng = random.Random(spread)
    keys = rng.sample(range(-3000, 3000), 2500)
    rows = [(k * spread, rng.choice("aaaabbc")) for k in keys]
    rows += [(2**62 + i, "a") for i in range(40)] + [(-(2**62) - i, "c") for i in range(3)]
    quotas = {"a": 900, "b": 10_000, "c": 5, "d": 7, "e": 0, "b2": 3}
    df = frame(spark, rows)
    expected = brute(rows, quotas)
    for method in ("cut", "window"):
        got = sorted(r.doc_id for r in Q.stratified_take(df, quotas, method=method).collect())
        assert got == expected, method


def test_cut_at_every_quota(spark, monkeypatch):
    monkeypatch.setattr(Q, "_SMALL_RANGE", 3)
    monkeypatch.setattr(Q, "_RANGES", 4)
    rows = [(k * k, "a") for k in range(40)]
    df = frame(spark, rows)
    for quota in (0, 1, 2, 20, 39, 40, 41):
        got = sorted(r.doc_id for r in Q.stratified_take(df, {"a": quota}, method="cut").collect())
        assert got == [k * k for k in range(min(quota, 40))]


def test_quotas_never_shuffle_the_data_when_cut(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    taken = Q.stratified_take(docs, {"en": 50, "fr": 3}, "lang", method="cut")
    plan = taken._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Sort" not in plan


def test_window_is_limited_before_its_shuffle(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = Q.stratified_take(docs, {"en": 50, "fr": 3}, "lang", method="window")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Partial") > plan.index("Final")


def test_cut_pushes_strata_and_keys_to_the_scan(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    taken = Q.stratified_take(docs, {"en": 50, "fr": 3}, "lang", method="cut")
    plan = taken._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(doc_id," in plan and "In(lang, [en,fr])" in plan


def test_group_quotas_cut_remainders():
    rows = Q.group_quotas(5_000, Q.vocabulary_groups())
    assert rows[0] == ("english", "en", 1750)
    assert [r[2] for r in rows[1:8]] == [392] * 7
    assert [r[2] for r in rows[8:]] == [125] * 4
    assert [r[2] for r in Q.group_quotas(1_000_000, Q.vocabulary_groups())][:2] == [350_000, 78_571]
    assert Q.weight_quotas(10, {"a": 0.55, "b": 0.45}) == [("mix", "a", 5), ("mix", "b", 4)]


def test_attainment_reports_shortfall(spark):
    plan = Q.plan_table(spark, [("x", "a", 4), ("x", "b", 2), ("y", "c", 0)])
    taken = frame(spark, [(1, "a"), (2, "a"), (3, "b"), (4, "b")])
    rows = {r.stratum: r for r in Q.attainment(plan, taken).collect()}
    assert (rows["a"].collected, rows["a"].shortfall, rows["a"].attainment) == (2, 2, 0.5)
    assert rows["b"].attainment == 1.0
    assert (rows["c"].collected, rows["c"].attainment) == (0, 0.0)


def test_corpus_and_breakdown(spark):
    text = "x" * 120
    rows = [(i, f" {text}\n", "en") for i in range(10)] + [(i, text, "py") for i in range(4)] + [(9, "short", "py")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, language string")
    groups = [Q.Group("english", 0.5, ("en",)), Q.Group("code", 0.5, ("py", "js"))]
    corpus = build_corpus(docs, 12, groups)
    assert sorted((r.category, r.doc_id) for r in corpus.collect()) == [("code", i) for i in range(3)] + [("english", i) for i in range(6)]
    assert {r.text for r in corpus.collect()} == {text}
    stats = [(r.category, r.n, round(r.pct, 2)) for r in S.category_counts(corpus).collect()]
    assert stats == [("code", 3, 33.33), ("english", 6, 66.67)]
    leaf = {(r.category, r.member, r.level): round(r.pct, 2) for r in S.breakdown(corpus).collect()}
    assert leaf[("code", "py", 0)] == leaf[("code", None, 1)] == 33.33
    compat = {(r.category, r.level): round(r.pct, 2) for r in S.breakdown(corpus, compat=True).collect()}
    assert compat[("code", 1)] == 16.67


def test_running_totals_with_a_hot_key_and_nulls(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["hot", "hot", "hot", "b", None]), rng.randint(0, 9)) for i in range(-40, 400)]
    df = spark.createDataFrame(rows, "i bigint, k string, v int")
    got = S.running_totals(df, ["k"], "i", {"n": F.lit(1), "total": F.col("v")}, {"low": F.col("v")}, block=7)
    seen, sums = {}, {}
    lows = {k: min(v for _, kk, v in rows if kk == k) for k in ("hot", "b", None)}
    expected = []
    for i, k, v in rows:
        seen[k], sums[k] = seen.get(k, 0) + 1, sums.get(k, 0) + v
        expected.append((i, k, v, seen[k], sums[k], lows[k]))
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_take_per_dataset(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(30)], "doc_id bigint, dataset string")
    kept = Q.take_per_dataset(df, 4).groupBy("dataset").count().collect()
    assert {r.dataset: r["count"] for r in kept} == {"a": 4, "b": 4}


def test_ties_and_nulls_have_a_place(spark, monkeypatch):
    """Both methods take the same rows of a total order, and never more than a quota."""
    monkeypatch.setattr(Q, "_SMALL_RANGE", 4)
    monkeypatch.setattr(Q, "_RANGES", 4)
    rng = random.Random(9)
    rows = [(rng.choice([1, 2, 2, 2, 3, None]), rng.choice(["a", "b", None]), rng.randint(0, 3)) for _ in range(120)]
    df = spark.createDataFrame(rows, "doc_id bigint, stratum string, v int")
    counts = {s: sum(r[1] == s for r in rows) for s in ("a", "b", None)}
    for quota in (0, 1, 7, 20, 33, 60, 200):
        cut = sorted(map(str, Q.stratified_take(df, {s: quota for s in counts}, method="cut").collect()))
        window = sorted(map(str, Q.stratified_take(df, {s: quota for s in counts}, method="window").collect()))
        assert cut == window and len(cut) == sum(min(quota, n) for n in counts.values())
    kept = Q.stratified_take(df, {None: 5}).collect()
    first = sorted((r[0] is None, r[0] or 0) for r in rows if r[1] is None)[:5]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == first


def test_null_dataset_is_one_of_them_at_any_number(spark, monkeypatch):
    df = spark.createDataFrame([(i % 7, ("a", "b", None)[i % 3]) for i in range(30)], "doc_id bigint, dataset string")
    few = sorted(map(str, Q.take_per_dataset(df, 4).collect()))
    monkeypatch.setattr(Q, "MAX_STRATA", 0)
    assert few == sorted(map(str, Q.take_per_dataset(df, 4).collect())) and len(few) == 12
