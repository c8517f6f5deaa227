import pytest
from pyspark.sql import functions as F

from textloom.operators import ledger as L
from textloom.plans.report import progress_report, report_lines


def record(seq, name="d", subset="s", op="commit", **fields):
    row = {f.name: None for f in L.LEDGER_SCHEMA}
    row.update(dataset_name=name, subset=subset, phase="phase1", seq=seq, op=op, **fields)
    return tuple(row[f.name] for f in L.LEDGER_SCHEMA)


@pytest.fixture(scope="module")
def ledger(spark):
    times = {"started_at": "2024-01-01T00:00:00", "last_checkpoint_at": "2024-01-01T00:00:10.500000"}
    rows = [
        record(1, "a", total_samples_processed=5),
        record(2, "a", total_samples_processed=10, total_tokens_processed=100, files_created=1, **times),
        record(3, "b", completed=True, failed=True, error_message="both", total_samples_processed=1, **times),
        record(4, "c", None, failed=True, retry_count=2),
        record(5, "c", "x", failed=True, error_message="lost"),
        record(6, "e", completed=True, started_at="2024-01-01T00:00:00"),
    ]
    return spark.createDataFrame(rows, L.LEDGER_SCHEMA)


def names(df):
    return sorted(((r.dataset_name, r.subset) for r in df.collect()), key=str)


def test_latest_state_wins(ledger):
    state = {(r.dataset_name, r.subset): r for r in L.latest(ledger).collect()}
    assert len(state) == 5
    assert state[("a", "s")].total_samples_processed == 10


def test_summary_counts_a_double_flag_twice(ledger):
    row = L.summary(L.latest(ledger)).first()
    assert (row.total_datasets, row.completed, row.failed, row.in_progress) == (5, 2, 3, 0)
    assert (row.total_samples, row.total_tokens, row.total_time) == (11, 100, 21.0)
    assert row.samples_per_sec == 11 / 21.0 and row.processing_time == "0:00:21"


def test_summary_of_nothing(spark):
    row = L.summary(spark.createDataFrame([], L.LEDGER_SCHEMA)).first()
    assert (row.total_datasets, row.in_progress, row.total_samples, row.samples_per_sec) == (0, 0, 0, 0.0)


def test_status_list(ledger):
    rows = L.status_list(L.latest(ledger)).collect()
    assert [r.checkpoint_key for r in rows] == sorted(r.checkpoint_key for r in rows)
    status = {(r.dataset_name, r.subset): r.status for r in rows}
    assert status == {
        ("a", "s"): "In Progress",
        ("b", "s"): "Complete",
        ("c", "default"): "Failed",
        ("c", "x"): "Failed",
        ("e", "s"): "Complete",
    }


def test_in_progress_and_failures(spark, ledger):
    as_of = F.to_timestamp(F.lit("2024-01-02 01:01:01"))
    row = L.in_progress(L.latest(ledger), as_of).first()
    assert (row.dataset_name, row.samples, row.files, row.elapsed) == ("a", 10, 1, "1 day, 1:01:01")
    untimed = spark.createDataFrame([record(1, None)], L.LEDGER_SCHEMA)
    row = L.in_progress(untimed, as_of).first()
    assert (row.dataset_name, row.elapsed, row.samples) == ("Unknown", "Unknown", 0)
    failed = {(r.dataset_name, r.subset): (r.error, r.retries, r.max_retries) for r in L.failures(L.latest(ledger)).collect()}
    assert failed[("c", "default")] == ("Unknown error", 2, 3)
    assert failed[("b", "s")] == ("both", 0, 3)


def test_reset(ledger):
    now = F.to_timestamp(F.lit("2024-02-01 00:00:00.25"))
    state = {(r.dataset_name, r.subset): r for r in L.latest(L.reset(ledger, "c", now=now)).collect()}
    row = state[("c", None)]
    assert (row.failed, row.completed, row.retry_count, row.error_message) == (False, False, 0, None)
    assert (row.total_samples_processed, row.current_file_idx, row.started_at) == (0, 0, "2024-02-01T00:00:00.250000")
    assert state[("c", "x")].failed
    assert L.reset(ledger, "nothing").count() == ledger.count()


def test_delete_and_clear(ledger):
    assert names(L.latest(L.delete(ledger, "a", "s"))) == names(L.latest(ledger).where("dataset_name <> 'a'"))
    assert L.failed_tombstones(ledger).count() == 3
    assert names(L.latest(L.clear_failed(ledger))) == [("a", "s"), ("e", "s")]


def test_a_commit_after_a_delete_is_seen(spark, ledger):
    again = spark.createDataFrame([record(50, "a", total_samples_processed=1)], L.LEDGER_SCHEMA)
    state = L.latest(L.delete(ledger, "a", "s").unionByName(again)).where("dataset_name = 'a'").collect()
    assert [r.total_samples_processed for r in state] == [1]


def test_unfinished_work(spark, ledger):
    work = spark.createDataFrame(
        [("phase1", "a", "s"), ("phase1", "e", "s"), ("phase1", "e", None), ("phase2", "e", "s")],
        "phase string, dataset_name string, subset string",
    )
    assert L.unfinished(work, ledger).count() == 3


def test_report(spark, ledger):
    files = spark.createDataFrame([("a.parquet", 1024), ("b.parquet", 1280)], "path string, length bigint")
    as_of = F.to_timestamp(F.lit("2024-01-02 00:00:00"))
    parts = progress_report(L.latest(ledger), files, as_of)
    row = parts["storage"].first()
    assert (row.n_files, row.total_bytes, row.total_size, row.mean_size) == (2, 2304, "2.25 KB", "1.12 KB")
    empty = progress_report(L.latest(ledger), files.where("length < 0"), as_of)["storage"].first()
    assert (empty.n_files, empty.total_size, empty.mean_size) == (0, "0.00 B", "0 B")
    lines = {(r.section, r.item): r.value for r in report_lines(L.latest(ledger), files, as_of).collect()}
    assert lines[("in progress", "a (s)")] == "Samples: 10 | Tokens: 100 | Files: 1 | Elapsed: 1 day, 0:00:00"
    assert lines[("failed", "c (default)")] == "Error: Unknown error | Retries: 2/3"
