"""The ingest of a catalogue: units, failures, stops between data and ledger, resets, quotas."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from textloom.functions.tokens import Codec
from textloom.operators.ledger import LEDGER_SCHEMA, latest
from textloom.operators.vocabulary import train_vocabulary
from textloom.plans import ingest as I
from textloom.queries import ingest as queries
from textloom.sources.catalog import CATALOG_SCHEMA
from textloom.streaming.ingest import IngestOptions

SCHEMA = "id bigint, body string, lang string"


@pytest.fixture(scope="module")
def codec(spark):
    counts = spark.createDataFrame([("ab", 9), ("abc", 5)], "word string, n bigint")
    return Codec.of(train_vocabulary(counts, vocab_size=280), spark)


@pytest.fixture
def source(spark, tmp_path):
    rows = [(i, f"text number {i} abc", ("en", "fr")[i % 2]) for i in range(20)]
    folder = str(tmp_path / "source")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(folder)
    return folder


def catalog(spark, *rows):
    return spark.createDataFrame([("p1", name, name, subsets, streaming, "body", 1.0) for name, subsets, streaming in rows], CATALOG_SCHEMA)


def layout(path):
    return I.Layout(path, SCHEMA, F.col("id"), F.col("lang"), F.col("lang"))


OPTIONS = IngestOptions(min_chars=3, complete=True)


def state(spark, output):
    rows = latest(I.stored_ledger(spark, output).select(*LEDGER_SCHEMA.fieldNames())).collect()
    return {(r.dataset_name, r.subset): (r.total_samples_processed, bool(r.completed), bool(r.failed)) for r in rows}


def ids(spark, output):
    return [(r.dataset, r.subset, r.doc_id) for r in I.read_ingested(spark, output).collect()]


def test_streams_and_batches_of_one_run(spark, codec, source, tmp_path):
    output = str(tmp_path / "out")
    sets = catalog(spark, ("a", ["en", "fr"], True), ("b", None, False))
    assert I.run_catalog(spark, sets, {"a": layout(source), "b": layout(source)}, codec, output, OPTIONS) == {}
    assert state(spark, output) == {("a", "en"): (10, True, False), ("a", "fr"): (10, True, False), ("b", None): (20, True, False)}
    want = [("a", ("en", "fr")[i % 2], i) for i in range(20)] + [("b", None, i) for i in range(20)]
    assert sorted(ids(spark, output), key=str) == sorted(want, key=str)
    assert I.plan_units(spark, sets, output) == []
    before = I.stored_ledger(spark, output).count()
    I.run_catalog(spark, sets, {}, codec, output, OPTIONS)
    assert I.stored_ledger(spark, output).count() == before


def test_a_failed_unit_is_marked_and_tried_again(spark, codec, source, tmp_path):
    output = str(tmp_path / "out")
    sets = catalog(spark, ("bad", None, False), ("bad_stream", None, True), ("good", None, False))
    wrong = I.Layout(source, "id bigint, body bigint, lang string", F.col("id"), F.col("lang"))
    layouts = {"bad": wrong, "bad_stream": wrong, "good": layout(source)}
    errors = I.run_catalog(spark, sets, layouts, codec, output, OPTIONS, retries=1)
    assert {u.dataset for u in errors} == {"bad", "bad_stream"}
    assert state(spark, output) == {
        ("bad", None): (0, False, True), ("bad_stream", None): (0, False, True), ("good", None): (20, True, False),
    }
    right = {name: layout(source) for name in layouts}
    assert [u.dataset for u in I.plan_units(spark, sets, output)] == ["bad", "bad_stream"]
    assert I.run_catalog(spark, sets.where("dataset <> 'bad_stream'"), right, codec, output, OPTIONS) == {}
    assert state(spark, output)["bad", None] == (20, True, False)
    assert I.clear_failed(spark, output) == 1 and ("bad_stream", None) not in state(spark, output)
    assert I.run_catalog(spark, sets, right, codec, output, OPTIONS) == {}
    assert state(spark, output)["bad_stream", None] == (20, True, False)


def test_data_without_a_ledger_row_is_not_there(spark, codec, source, tmp_path, monkeypatch):
    """A batch that stops between its two steps is done again, and its records are read once."""
    output, sets = str(tmp_path / "out"), catalog(spark, ("a", ["en", "fr"], False))
    append = I._append

    def stop(spark_, output_, unit, replay=False, **values):
        if unit.subset == "fr" and replay:
            raise SystemExit
        append(spark_, output_, unit, replay, **values)

    monkeypatch.setattr(I, "_append", stop)
    with pytest.raises(SystemExit):
        I.run_catalog(spark, sets, {"a": layout(source)}, codec, output, OPTIONS)
    assert {s for _, s, _ in ids(spark, output)} == {"en"}
    monkeypatch.setattr(I, "_append", append)
    assert [u.subset for u in I.plan_units(spark, sets, output)] == ["fr"]
    I.run_catalog(spark, sets, {"a": layout(source)}, codec, output, OPTIONS)
    assert len(ids(spark, output)) == 20 and state(spark, output)["a", "fr"] == (10, True, False)


@pytest.mark.parametrize("streaming", [True, False])
def test_reset_and_delete_open_a_generation(spark, codec, source, tmp_path, streaming):
    output, sets = str(tmp_path / "out"), catalog(spark, ("a", None, streaming))
    layouts = {"a": layout(source)}
    I.run_catalog(spark, sets, layouts, codec, output, OPTIONS)
    assert I.reset(spark, output, "p1", "a") == 1 and I.reset(spark, output, "p1", "none") == 0
    assert state(spark, output) == {("a", None): (0, False, False)} and ids(spark, output) == []
    I.run_catalog(spark, sets, layouts, codec, output, OPTIONS)
    assert state(spark, output) == {("a", None): (20, True, False)} and len(ids(spark, output)) == 20
    assert I.delete(spark, output, "p1", "a") == 1 and I.delete(spark, output, "p1", "a") == 0
    assert state(spark, output) == {} and ids(spark, output) == []
    I.run_catalog(spark, sets, layouts, codec, output, OPTIONS)
    assert state(spark, output) == {("a", None): (20, True, False)} and len(ids(spark, output)) == 20
    numbers = I.stored_ledger(spark, output).groupBy("seq").count().where("count > 1").count()
    assert numbers == 0


def test_quota_over_batches_and_test_mode(spark, codec, source, tmp_path):
    output, sets = str(tmp_path / "out"), catalog(spark, ("a", None, True))
    more = spark.read.parquet(source).withColumn("id", F.col("id") + 100)
    options = IngestOptions(min_chars=3, max_samples=27)
    I.run_catalog(spark, sets, {"a": layout(source)}, codec, output, options)
    assert state(spark, output) == {("a", None): (20, False, False)}
    more.coalesce(1).write.mode("append").parquet(source)
    I.run_catalog(spark, sets, {"a": layout(source)}, codec, output, options)
    assert state(spark, output) == {("a", None): (27, False, False)}
    assert sorted(i for _, _, i in ids(spark, output)) == [*range(20), *range(100, 107)]
    other = str(tmp_path / "other")
    I.run_catalog(spark, catalog(spark, ("a", None, False)), {"a": layout(source)}, codec, other, OPTIONS, test=True)
    assert state(spark, other) == {("a", None): (40, True, False)}


def test_a_number_is_taken_once(spark, codec, source, tmp_path):
    output, sets = str(tmp_path / "out"), catalog(spark, ("a", None, False))
    I.run_catalog(spark, sets, {"a": layout(source)}, codec, output, OPTIONS)
    unit = I.Unit("p1", "a", None, False, "body")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        I._append(spark, output, unit, seq=1_024, op="commit")


def running(spark, output):
    rows = I.stored_ledger(spark, output).where("op = 'commit' AND batch_id >= 0").orderBy("seq").collect()
    return [(r.total_samples_processed, bool(r.completed), r.step) for r in rows]


INTERVALS = IngestOptions(min_chars=3, complete=True, interval=3, step_intervals=2)


@pytest.mark.parametrize("streaming", [True, False])
def test_a_ledger_row_every_few_samples(spark, codec, source, tmp_path, streaming):
    output, sets = str(tmp_path / "out"), catalog(spark, ("a", None, streaming))
    assert I.run_catalog(spark, sets, {"a": layout(source)}, codec, output, INTERVALS) == {}
    want = [(n, n == 20 and not streaming, i // 2) for i, n in enumerate((3, 6, 9, 12, 15, 18, 20))]
    assert running(spark, output) == want
    assert state(spark, output) == {("a", None): (20, True, False)}
    assert sorted(i for _, _, i in ids(spark, output)) == list(range(20))
    plain = str(tmp_path / "plain")
    I.run_catalog(spark, sets, {"a": layout(source)}, codec, plain, OPTIONS)
    columns = ["doc_id", "input_ids", "attention_mask", "labels", "length", "language"]
    assert I.read_ingested(spark, output).select(*columns).exceptAll(I.read_ingested(spark, plain).select(*columns)).isEmpty()
    tokens = [I.stored_ledger(spark, o).agg(F.max("total_tokens_processed")).first()[0] for o in (output, plain)]
    assert tokens[0] == tokens[1]


@pytest.mark.parametrize("streaming", [True, False])
@pytest.mark.parametrize("again", [INTERVALS, OPTIONS])
def test_a_stopped_batch_goes_on_after_its_last_step(spark, codec, source, tmp_path, monkeypatch, streaming, again):
    """Steps that were committed are not encoded again, and the others are, whatever the source now holds."""
    output, sets = str(tmp_path / "out"), catalog(spark, ("a", None, streaming))
    append, write, steps = I._append_rows, I.write_records, []

    def stop(spark_, output_, unit, rows, replay=False):
        if rows[0].get("step") == 2:
            raise RuntimeError("stopped")
        append(spark_, output_, unit, rows, replay)

    def note(records, path, **options):
        steps.append(path.rsplit("=", 1)[1])
        write(records, path, **options)

    monkeypatch.setattr(I, "_append_rows", stop)
    monkeypatch.setattr(I, "write_records", note)
    errors = I.run_catalog(spark, sets, {"a": layout(source)}, codec, output, INTERVALS, retries=0)
    assert len(errors) == 1 and state(spark, output) == {("a", None): (12, False, True)}
    kept = ids(spark, output)
    assert len(kept) == 12 and steps == ["0", "1", "2"]
    monkeypatch.setattr(I, "_append_rows", append)
    assert I.run_catalog(spark, sets, {"a": layout(source)}, codec, output, again) == {}
    # The wider steps of the other options take what is left in one.
    assert steps == ["0", "1", "2", "2", "3"][: 5 if again is INTERVALS else 4]
    assert state(spark, output) == {("a", None): (20, True, False)}
    assert sorted(i for _, _, i in ids(spark, output)) == list(range(20)) and set(kept) <= set(ids(spark, output))
    numbers = I.stored_ledger(spark, output).groupBy("seq").count().where("count > 1").count()
    assert numbers == 0 and not (tmp_path / "out" / "staged" / f"unit={unit_of(streaming)}" / "generation=0" / "batch_id=0").exists()


def unit_of(streaming):
    return I.Unit("p1", "a", None, streaming, "body").name


def test_intervals_with_a_quota_repeated_rows_and_nothing(spark, codec, source, tmp_path):
    spark.read.parquet(source).withColumn("id", F.lit(7)).coalesce(1).write.mode("append").parquet(source)
    output, sets = str(tmp_path / "out"), catalog(spark, ("a", None, False))
    options = IngestOptions(min_chars=3, complete=True, interval=4, max_samples=26)
    I.run_catalog(spark, sets, {"a": layout(source)}, codec, output, options)
    assert [n for n, _, _ in running(spark, output)] == [4, 8, 12, 16, 20, 24, 26]
    assert len(ids(spark, output)) == 26
    empty = str(tmp_path / "empty")
    I.run_catalog(spark, sets, {"a": layout(source)}, codec, empty, IngestOptions(min_chars=999, complete=True, interval=4))
    assert running(spark, empty) == [(0, True, 0)] and ids(spark, empty) == []
    with pytest.raises(ValueError):
        I.run_catalog(spark, sets, {"a": layout(source)}, codec, empty, IngestOptions(interval=0))


def tables(spark, folder, html):
    """Documents, conversations and pages of a query's folder; ``html`` is the type of the pages' texts."""
    rows = [(i, f"text number {i} abc " * 8, "en") for i in range(70)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    rows = [(i, 0, f"turn number {i} abc " * 8) for i in range(65)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, text string").coalesce(1).write.parquet(f"{folder}/conversations.parquet")
    pages = spark.range(3).select(F.col("id").alias("page_id"), F.repeat(F.lit("7"), 150).alias("html"))
    pages = pages.withColumn("html", F.col("html") if html == "string" else F.lit(7).cast(html))
    pages.coalesce(1).write.parquet(f"{folder}/pages.parquet")


def test_a_query_does_not_return_the_rest_of_a_failed_run(spark, codec, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "_codec", lambda spark_, sf: codec)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    tables(spark, good, "string")
    found = queries.interval_commits_fine(spark, good).select("phase", "samples", "completed").collect()
    assert sorted((r.phase[:6], r.samples, r.completed) for r in found) == [
        ("phase1", 64, False), ("phase1", 70, True), ("phase2", 64, False), ("phase2", 65, True), ("phase3", 3, True),
    ]
    tables(spark, bad, "bigint")
    with pytest.raises(I.IngestFailed, match="phase3_function_calling/pages") as failed:
        queries.interval_commits_fine(spark, bad)
    assert [u.dataset for u in failed.value.errors] == ["pages"]
