from pyspark.sql import functions as F

from textloom.operators import ledger as L
from textloom.plans.report import report_table
from textloom.sources.versions import read_current, versions
from textloom.streaming.watch import ledger_stream, watch_report


def entry(seq, name, op="commit", **fields):
    row = {f.name: None for f in L.LEDGER_SCHEMA}
    row.update(
        dataset_name=name, phase="p", seq=seq, op=op, total_samples_processed=seq * 10,
        started_at="2024-01-01T00:00:00", last_checkpoint_at="2024-01-01T00:00:10", **fields,
    )
    return tuple(row[f.name] for f in L.LEDGER_SCHEMA)


def as_of():
    return F.to_timestamp(F.lit("2024-01-01 01:00:00"))


ARRIVALS = [
    [entry(1, "a"), entry(6, "d", failed=True, error_message="late", retry_count=2)],
    [entry(3, "a"), entry(4, "b", op="delete"), entry(5, "c", completed=True)],
    # Rows that come after newer ones of their keys.
    [entry(2, "a", completed=True), entry(1, "b", failed=True), entry(0, "d")],
]


def test_streamed_report_equals_the_report_of_all_rows(spark, tmp_path):
    source, out = str(tmp_path / "ledger"), str(tmp_path / "report")
    files = spark.createDataFrame([("x", 1024)], "path string, length bigint")
    for i, rows in enumerate(ARRIVALS):
        spark.createDataFrame(rows, L.LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = ledger_stream(spark, source)
        watch_report(stream, out, as_of, lambda: files, None, str(tmp_path / "cp")).awaitTermination()
        want = report_table(L.latest(spark.read.schema(L.LEDGER_SCHEMA).parquet(source)), files, as_of())
        assert sorted(map(str, read_current(spark, out).collect())) == sorted(map(str, want.collect())), i
    assert len(versions(spark, out)) == 3
    report = read_current(spark, out)
    shown = {(r.section, r.dataset_name): (r.samples, r.retries, r.shown) for r in report.where("dataset_name IS NOT NULL").collect()}
    assert shown[("in progress", "a")] == (30, None, "1:00:00") and shown[("failed", "d")] == (None, 2, "late")
    assert shown[("status", "c")] == (50, 0, "Complete") and not any(name == "b" for _, name in shown)
    figures = {(r.section, r.item): (r.amount, r.shown) for r in report.where("section IN ('summary', 'storage')").collect()}
    assert figures[("summary", "total_datasets")] == (3.0, None) and figures[("storage", "total_size")] == (None, "1.00 KB")
    assert figures[("summary", "processing_time")] == (None, "0:00:30")


def test_report_of_nothing(spark):
    empty = spark.createDataFrame([], L.LEDGER_SCHEMA)
    rows = report_table(empty, None, as_of()).collect()
    assert {r.section for r in rows} == {"summary"} and {r.amount for r in rows} == {0.0, None}
