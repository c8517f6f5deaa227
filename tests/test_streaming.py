import pytest
from pyspark.sql import functions as F

from textloom.functions.tokens import Codec
from textloom.operators import ledger as L
from textloom.operators.encoding import encode_records
from textloom.operators.vocabulary import Vocabulary, base_tokens
from textloom.streaming import ingest as I
from textloom.sources.versions import read_current
from textloom.streaming.watch import ledger_stream, watch

SCHEMA = "doc_id bigint, text string, language string, dataset string, phase string"


@pytest.fixture(scope="module")
def codec(spark):
    return Codec.of(Vocabulary(base_tokens(), [], 21), spark)


def rows(start, n, dataset="d", length=150):
    return [(i, f"{i} " + "x" * length, "en" if i % 2 else "hi", dataset, "phase1") for i in range(start, start + n)]


def add(spark, folder, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_stream_equals_batch(spark, codec, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for k in range(3):
        add(spark, source, rows(k * 10, 10, f"d{k % 2}") + rows(1000 + k, 1, "short", 5))
    options = I.IngestOptions(markers=True, languages=["en"], phases=["phase1"])
    I.run_ingest(I.stream_files(spark, source, SCHEMA, files_per_batch=1), codec, out, options)
    got = I.read_records(spark, out)
    assert got.select("batch_id").distinct().count() == 3
    batch = spark.read.parquet(source).where("language = 'en' and length(text) > 100")
    want = encode_records(batch, codec, marker=F.lit("<|english|>"), keep=["doc_id", "phase"])
    columns = ["doc_id", "input_ids", "attention_mask", "labels", "length", "language", "dataset", "phase"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
    state = L.latest(I.read_ledger(spark, out).drop("batch_id")).collect()
    totals = {r.dataset_name: (r.total_samples_processed, r.files_created) for r in state}
    assert totals == {"d0": (10, 2), "d1": (5, 1)}


def test_resume_adds_only_new_files(spark, codec, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    add(spark, source, rows(0, 6))
    I.run_ingest(I.stream_files(spark, source, SCHEMA), codec, out)
    add(spark, source, rows(6, 5))
    I.run_ingest(I.stream_files(spark, source, SCHEMA), codec, out)
    I.run_ingest(I.stream_files(spark, source, SCHEMA), codec, out)
    assert sorted(r.doc_id for r in I.read_records(spark, out).collect()) == list(range(11))
    total = I.totals_before(spark, out, 2).first()
    assert (total.samples, total.files) == (11, 2)
    assert L.latest(I.read_ledger(spark, out).drop("batch_id")).first().total_samples_processed == 11


def test_replaying_a_batch_changes_nothing(spark, codec, tmp_path):
    out = str(tmp_path / "out")
    first = spark.createDataFrame(rows(0, 7), SCHEMA)
    second = spark.createDataFrame(rows(7, 4), SCHEMA)
    options = I.IngestOptions(max_samples=9)
    I.write_batch(first, 0, codec, out, options)
    for _ in range(2):
        I.write_batch(second, 1, codec, out, options)
    I.write_batch(first, 0, codec, out, options)
    assert I.read_records(spark, out).count() == 9
    assert I.totals_before(spark, out, 2).first().samples == 9


def test_data_without_a_ledger_row_is_not_read(spark, codec, tmp_path):
    out = str(tmp_path / "out")
    I.write_batch(spark.createDataFrame(rows(0, 3), SCHEMA), 0, codec, out, I.IngestOptions())
    stray = spark.read.parquet(f"{out}/data/batch_id=0")
    stray.write.partitionBy("phase", "dataset").parquet(f"{out}/data/batch_id=1")
    assert I.read_records(spark, out).count() == 3


def test_quota_over_batches_and_datasets(spark, codec, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for k in range(3):
        add(spark, source, rows(k * 10, 10, "big") + rows(100 + k, 1, "small"))
    I.run_ingest(I.stream_files(spark, source, SCHEMA, files_per_batch=1), codec, out, I.IngestOptions(max_samples=12))
    counts = {r.dataset: r["count"] for r in I.read_records(spark, out).groupBy("dataset").count().collect()}
    assert counts == {"big": 12, "small": 3}


def test_failed_runs_are_retried(spark, codec, tmp_path, monkeypatch):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    add(spark, source, rows(0, 4))
    real, calls = I.write_batch, []

    def flaky(*args):
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("lost connection")
        real(*args)

    monkeypatch.setattr(I, "write_batch", flaky)
    assert I.run_ingest(I.stream_files(spark, source, SCHEMA), codec, out) == 2
    assert I.totals_before(spark, out, 1).first().retry_count == 2
    assert I.read_records(spark, out).count() == 4
    calls.clear()
    monkeypatch.setattr(I, "write_batch", lambda *a: (_ for _ in ()).throw(RuntimeError("down")))
    add(spark, source, rows(4, 1))
    with pytest.raises(Exception):
        I.run_ingest(I.stream_files(spark, source, SCHEMA), codec, out, retries=1)
    state = L.latest(I.read_ledger(spark, out).drop("batch_id")).collect()
    assert [(r.failed, r.retry_count, r.total_samples_processed) for r in state] == [(True, 1, 4)]
    assert "down" in state[0].error_message or "FOREACH" in state[0].error_message
    monkeypatch.setattr(I, "write_batch", real)
    I.run_ingest(I.stream_files(spark, source, SCHEMA), codec, out, I.IngestOptions(complete=True))
    state = L.latest(I.read_ledger(spark, out).drop("batch_id")).collect()
    assert [(r.completed, r.failed, r.error_message, r.total_samples_processed) for r in state] == [(True, False, None, 5)]
    work = spark.createDataFrame([("phase1", "d", None)], "phase string, dataset_name string, subset string")
    assert L.unfinished(work, I.read_ledger(spark, out).drop("batch_id")).count() == 0
    assert I.read_records(spark, out).count() == 5


def test_a_stream_that_never_starts_is_reported(spark, codec, tmp_path, monkeypatch):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    add(spark, source, rows(0, 1))
    monkeypatch.setattr(I, "write_batch", lambda *a: (_ for _ in ()).throw(RuntimeError("down")))
    with pytest.raises(Exception):
        I.run_ingest(I.stream_files(spark, source, SCHEMA), codec, out, retries=0)
    failed = L.failures(L.latest(I.read_ledger(spark, out).drop("batch_id"))).first()
    assert failed.dataset_name == "d"


def test_quotas_keep_null_names_and_never_overfill(spark, codec, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    text = "word " * 40
    same = [(i % 4, text, "en", d, p) for i in range(24) for d, p in (("a", "phase1"), (None, "phase1"), ("b", None))]
    for _ in range(2):
        spark.createDataFrame(same, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    I.run_ingest(I.stream_files(spark, source, SCHEMA, files_per_batch=1), codec, out, I.IngestOptions(max_samples=30))
    counts = {(r.phase, r.dataset): r["count"] for r in I.read_records(spark, out).groupBy("phase", "dataset").count().collect()}
    assert counts == {("phase1", "a"): 30, ("phase1", None): 30, (None, "b"): 30}


def test_lost_totals_are_an_error(spark, tmp_path):
    assert I.totals_before(spark, str(tmp_path), 0).count() == 0
    with pytest.raises(FileNotFoundError):
        I.totals_before(spark, str(tmp_path), 7)


def test_unknown_phases_are_an_error():
    from textloom.sources.tables import phase_names

    assert phase_names(["phase1"]) == ["phase1", "phase1_pretraining"]
    assert phase_names(["phase2_instruction"]) == ["phase2_instruction"]
    with pytest.raises(ValueError):
        phase_names(["phase9"])


def test_watch_shows_the_newest_state(spark, tmp_path):
    def entry(seq, name, op="commit", **fields):
        row = {f.name: None for f in L.LEDGER_SCHEMA}
        row.update(dataset_name=name, phase="p", seq=seq, op=op, total_samples_processed=seq, **fields)
        return tuple(row[f.name] for f in L.LEDGER_SCHEMA)

    source, out = str(tmp_path / "ledger"), str(tmp_path / "status")
    first = [entry(1, "a"), entry(2, "b", failed=True)]
    then = [entry(3, "a", completed=True), entry(4, "b", op="delete"), entry(5, "c")]
    for data in (first, then):
        spark.createDataFrame(data, L.LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(source)
        run = watch(ledger_stream(spark, source), out, seconds=None, checkpoint=str(tmp_path / "cp"))
        run.awaitTermination()
    got = {r.status: (r.records, r.samples) for r in read_current(spark, out).collect()}
    assert got == {"Complete": (1, 3), "In Progress": (1, 5)}
