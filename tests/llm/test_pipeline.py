"""The pipeline's stages against plain Python, and the registered queries' plans."""

from __future__ import annotations

import hashlib
import itertools
import random
from collections import Counter

import pytest

import corpus_pipeline
from textloom.llm import pieces, secrets, simhash
from textloom.llm.queries import QUERIES



@pytest.fixture(scope="module")
def labels(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("labels"))
    spark.createDataFrame([(i, 0) for i in range(30)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages(spark, awkward, awkward_rows, labels):
    docs = awkward.drop("ids").withColumnRenamed("spans", "score")
    toxic = spark.createDataFrame([(500, "You idiot, you moron!", "en", "src0", 21, None)], docs.schema)
    columns = docs.columns
    first = corpus_pipeline.drop_toxic(spark, docs.unionByName(toxic), labels)
    assert first.columns == columns and first.count() == len(awkward_rows) and first.where("doc_id = 500").count() == 0
    second = corpus_pipeline.drop_near_duplicates(spark, docs, labels)
    assert second.columns == columns
    ids = [r.doc_id for r in second.collect()]
    kept = [i for i in ids if i is not None]
    # Null, empty and blank texts are one group; every text of a row without an id has a copy with one.
    assert 0 in kept and 1 not in kept and 2 not in kept and 8 in kept and None not in ids
    third = corpus_pipeline.redact_secrets(spark, docs, labels)
    plan = secrets.plan(secrets.RULES)
    assert third.columns == columns and third.count() == len(awkward_rows)
    assert all(not secrets.spans_of([r.text or ""], plan)[0] for r in third.collect())
    assert all(r.n_chars == len(r.text) for r in third.collect() if r.text is not None)
    fourth = corpus_pipeline.mix_sources(spark, docs, labels)
    assert fourth.columns == columns and 0 < fourth.count() < len(awkward_rows)
    last = corpus_pipeline.encode(spark, docs, labels).collect()
    texts = sorted(r[1] or "" for r in awkward_rows)
    assert sorted(pieces.decode(r.ids or []) for r in last) == texts


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def test_near_duplicates_against_all_pairs(spark, labels):
    """Repeated ids with other texts, null ids, repeated rows: one row of each group stays."""
    rng = random.Random(12)
    texts = [" ".join(rng.choices(WORDS, k=60)) for _ in range(25)]
    texts += [t.replace(" ", "  ", 3) for t in texts[:8]] + [f"{t} {w}" for t in texts[8:16] for w in ("mu", "nu")]
    rows = [(i // 2 if i % 3 else None, t, i) for i, t in enumerate(texts)]
    rows += [(i, t, 99) for i, t, _ in rows[3:6]] + [(None, texts[0], 7), (None, None, 8), (None, "", 9), (5, texts[20], 10)]
    docs = spark.createDataFrame([(i, t, "key", n) for i, t, n in rows], "doc_id long, text string, key string, row int")
    prints = [simhash.fingerprint((t or "").encode()) for _, t, _ in rows]
    groups = list(range(len(rows)))
    for i, j in itertools.permutations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2:
            groups = [groups[i] if g == groups[j] else g for g in groups]
    order = lambda r: (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest())
    want = [min((r for r, g in zip(rows, groups, strict=True) if g == name), key=order)[:2] for name in set(groups)]
    got = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(3), labels)
    assert got.columns == docs.columns and len(want) < len(rows)
    plain = lambda r: (str(r[0]), r[1] or "")
    assert sorted(map(plain, got.select("doc_id", "text").collect())) == sorted(map(plain, want))


def test_mix_takes_no_more_than_its_budget(spark, labels):
    """Null and repeated ids, and rows that repeat whole: each row counts by itself."""
    rng = random.Random(3)
    rows = [(None if i % 2 else i // 4, "w " * rng.randint(1, 9), "en", f"src{i % 20}") for i in range(400)]
    rows += rows[:40]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, row string")
    kept = corpus_pipeline.mix_sources(spark, docs.repartition(3), labels).collect()
    total, taken = (sum(len(r[1].split()) for r in some) for some in (rows, kept))
    assert taken <= corpus_pipeline.KEPT_SHARE * total and taken > 0.9 * corpus_pipeline.KEPT_SHARE * total
    assert not Counter(tuple(r)[:4] for r in kept) - Counter(rows)


def test_stages_of_nothing(spark, nothing, labels):
    docs = nothing
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, labels)
        assert docs.count() == 0


def test_run_is_its_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
    assert sorted(map(str, corpus_pipeline.run(spark, small).collect())) == sorted(map(str, docs.collect()))


def test_url_filter_plan_is_native_and_joins_nothing(spark, small):
    plan = QUERIES["op7_url_filter"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Exchange" not in plan


def test_one_query_an_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
