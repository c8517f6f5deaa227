import json

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from textloom.sources import catalog as C
from textloom.sources import sinks, tables
from textloom.sources.files import corrupt_checkpoints, inventory, scan_checkpoints


def test_catalogue(spark):
    sources = C.catalog(spark)
    assert sources.count() == 9
    sums = sources.groupBy("phase").agg(F.round(F.sum("weight"), 9).alias("w")).collect()
    assert {r.w for r in sums} == {1.0}
    rows = C.catalog_subsets(sources)
    assert rows.count() == 7 + 6 + 6 + 1 + 4 + 1 + 1 + 1 + 1
    assert rows.where("subset is null").count() == 3
    assert round(sum(C.LANGUAGE_WEIGHTS.values()), 9) == 1.0


def test_subset_shapes(spark):
    df = spark.createDataFrame(
        [("one", None, None), (None, ["a", "b"], None), (None, None, ["c"]), (None, None, None)],
        "subset string, subsets array<string>, languages array<string>",
    )
    got = [r[0] for r in df.select(C.subset_list(F.col("subset"), F.col("subsets"), F.col("languages"))).collect()]
    assert got == [["one"], ["a", "b"], ["c"], None]
    snapshot, language = C.subset_parts(F.col("s"))
    named = spark.createDataFrame([("20231101.hi",), ("ta",)], "s string").select(snapshot, language)
    assert [tuple(r) for r in named.collect()] == [("20231101", "hi"), (None, "ta")]


def test_language_join_skips_and_reports(spark):
    docs = spark.createDataFrame([("hi",), ("hi",), ("xx",)], "language string")
    mapped = C.language_table(spark)
    assert [r.split_name for r in C.with_language(docs, mapped).collect()] == ["hin_Deva"] * 2
    assert [(r.language, r.n) for r in C.unmapped(docs, mapped).collect()] == [("xx", 1)]
    marks = spark.createDataFrame([("en",), ("css",), ("xx",)], "l string").select(C.marker_of(F.col("l")))
    assert [r[0] for r in marks.collect()] == ["<|english|>", "<|css|>", None]


def test_partition_pruning(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.createDataFrame([(1, "hi"), (2, "ta"), (3, "te")], "doc_id int, language string").write.partitionBy("language").parquet(root)
    df = tables.scan_subsets(spark, root, language=["hi", "te"])
    assert sorted(r.doc_id for r in df.collect()) == [1, 3]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [language" in plan
    assert tables.scan_directory(spark, root, "language=ta").count() == 1


def test_missing_columns_read_as_defaults(spark, tmp_path):
    spark.createDataFrame([(1,)], "doc_id bigint").write.parquet(str(tmp_path / "d"))
    df = tables.scan(spark, str(tmp_path / "d"), tables.DOCUMENT_SCHEMA)
    assert tables.as_documents(df, "doc_id", "text", "en", "d").first().text == ""


def test_failing_sources_are_isolated(spark):
    good = lambda i: spark.createDataFrame([(i, "x")], "doc_id int, text string")

    def broken():
        raise ValueError("no such source")

    union, failures = tables.union_sources(
        [("a", lambda: good(1)), ("b", broken), ("c", lambda: spark.read.parquet("/no/such/place")), ("d", lambda: good(1))]
    )
    assert [r.doc_id for r in union.collect()] == [1, 1]
    assert [f.source for f in failures] == ["b", "c"]
    name, df, failed = tables.first_available([("b", broken), ("d", lambda: good(4))])
    assert name == "d" and df.first().doc_id == 4 and len(failed) == 1
    assert tables.first_available([("b", broken)])[0] is None


def test_probe(spark):
    df = spark.createDataFrame([(5, "abc"), (2, "héllo")], "doc_id int, text string")
    row = tables.probe(df).first()
    assert (row.doc_id, row.n_chars, row.fields) == (2, 5, "doc_id,text")
    assert tables.probe(df.where("doc_id > 9")).count() == 0


def test_spread_leaves_wide_scans_alone(spark):
    wide = spark.range(0, 1000, 1, 64)
    assert tables.spread(wide, "id") is wide
    assert tables.spread(spark.range(0, 10, 1, 1), "id").count() == 10


def test_checkpoint_files(spark, tmp_path):
    good = {"dataset_name": "d", "subset": None, "phase": "phase1", "total_samples_processed": 7, "completed": True, "other": [1]}
    (tmp_path / "phase1_d.json").write_text(json.dumps(good, indent=2))
    (tmp_path / "empty_object.json").write_text("{}")
    (tmp_path / "broken.json").write_text('{"dataset_name": "x", ')
    (tmp_path / "blank.json").write_text("")
    (tmp_path / "half.json.tmp").write_text("{}")
    (tmp_path / "notes.txt").write_text("no")
    rows = {r.checkpoint_key: r for r in scan_checkpoints(spark, str(tmp_path)).collect()}
    assert set(rows) == {"phase1_d", "empty_object"}
    assert rows["phase1_d"].total_samples_processed == 7 and rows["phase1_d"].completed
    assert rows["empty_object"].total_samples_processed is None
    bad = {r.checkpoint_key: r.content for r in corrupt_checkpoints(spark, str(tmp_path)).collect()}
    assert set(bad) == {"broken", "blank"} or set(bad) == {"broken"}
    assert bad["broken"].startswith('{"dataset_name"')


def test_inventory_reads_no_contents(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "a" / "b"))
    files = inventory(spark, str(tmp_path))
    on_disk = list((tmp_path / "a" / "b").glob("*.parquet"))
    got = files.collect()
    assert sorted(r.length for r in got) == sorted(p.stat().st_size for p in on_disk)
    assert "ReadSchema: struct<path:string,length:bigint>" in files._jdf.queryExecution().executedPlan().toString()


def test_corpus_sink_replaces_or_reuses(spark, tmp_path):
    path = str(tmp_path / "corpus")
    one = spark.createDataFrame([("en", "a\nb"), ("fr", "é")], "category string, text string")
    two = spark.createDataFrame([("en", "new")], "category string, text string")
    sinks.write_corpus(one, path)
    assert sorted(r.line for r in tables.scan_lines(spark, path).collect()) == ["a", "b", "é"]
    sinks.write_corpus(two, path, replace=False)
    assert tables.scan_lines(spark, path).count() == 3
    sinks.write_corpus(two, path)
    assert [r.line for r in tables.scan_lines(spark, path).collect()] == ["new"]


def test_record_sink_bounds_row_groups(spark, tmp_path):
    path = str(tmp_path / "records")
    df = spark.range(0, 35_000, 1, 3).select("id", F.lit("p1").alias("phase"), F.lit("d").alias("dataset"))
    sinks.write_records(df, path)
    groups = []
    for file in (tmp_path / "records").rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        groups += [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
        assert meta.row_group(0).column(0).compression == "SNAPPY"
    assert sum(groups) == 35_000 and max(groups) <= 10_000
    assert (tmp_path / "records" / "phase=p1" / "dataset=d").is_dir()
