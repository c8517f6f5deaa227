import pytest
from pyspark.sql import functions as F

from textloom.functions.tokens import Codec
from textloom.operators import slots as S
from textloom.operators.encoding import encode_records
from textloom.operators.vocabulary import Vocabulary, base_tokens
from textloom.plans.layout import write_tokenized


def table(spark, sizes):
    rows = [(d, f"{d}{i}", i) for d, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "dataset string, key string, i long").repartition(5)


@pytest.mark.parametrize("rows_per_file", [1, 7, 100, 1_000])
def test_files_are_full_but_the_last(spark, rows_per_file, monkeypatch):
    monkeypatch.setattr(S, "RANGE_BITS", 4)
    sizes = {"a": 700, "b": 100, "c": 1, None: 15}
    df = table(spark, sizes).withColumn("slot", F.lit("old"))
    got, total = S.file_slots(df, ["dataset"], "key", rows_per_file)
    counts = {(r.dataset, r.slot): r["count"] for r in got.groupBy("dataset", "slot").count().collect()}
    assert total == sum(-(-n // rows_per_file) for n in sizes.values())
    assert sorted(s for _, s in counts) == list(range(total))
    for name, n in sizes.items():
        full, rest = divmod(n, rows_per_file)
        assert sorted(c for (d, _), c in counts.items() if d == name) == sorted([rows_per_file] * full + [rest] * bool(rest))
    assert got.columns == df.columns


def test_slots_follow_the_order_of_hashes(spark, monkeypatch):
    """Against sorting all rows of a dataset by (hash, key)."""
    monkeypatch.setattr(S, "RANGE_BITS", 3)
    df = table(spark, {"a": 333})
    got, _ = S.file_slots(df, ["dataset"], "key", 10)
    unsigned = F.expr("CASE WHEN xxhash64(key) < 0 THEN 1 ELSE 0 END")
    rows = got.withColumns({"h": F.xxhash64("key"), "upper": unsigned}).collect()
    order = sorted(rows, key=lambda r: (r.upper, r.h, r.key))
    assert [r.slot for r in order] == [i // 10 for i in range(333)]


def test_repeated_rows_are_told_apart_by_place(spark, tmp_path):
    spark.createDataFrame([("a", "same")] * 500, "dataset string, text string").repartition(4).write.parquet(f"{tmp_path}/in")
    df = spark.read.parquet(f"{tmp_path}/in").withColumn("key", S.place_of_row())
    got, total = S.file_slots(df, ["dataset"], "key", 120)
    assert sorted(r["count"] for r in got.groupBy("slot").count().collect()) == [20, 120, 120, 120, 120] and total == 5


def test_empty_and_bad(spark):
    df = table(spark, {"a": 3}).limit(0)
    got, total = S.file_slots(df, ["dataset"], "key", 10)
    assert total == 0 and got.count() == 0 and S.lay_out(df, ["dataset"], "key", 10).count() == 0
    with pytest.raises(ValueError):
        S.file_slots(df, ["dataset"], "key", 0)


def test_texts_are_moved_once_and_before_they_are_encoded(spark, tmp_path):
    codec = Codec.of(Vocabulary(base_tokens(), [], 21), spark)
    rows = [(i, f"text {i}", "en", "d" if i % 3 else "e", "p") for i in range(95)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, language string, dataset string, phase string")
    docs.write.parquet(f"{tmp_path}/in")
    docs = spark.read.parquet(f"{tmp_path}/in").withColumn("key", S.place_of_row())
    laid = S.lay_out(docs, ["phase", "dataset"], "key", 20)
    plan = encode_records(laid, codec, keep=["doc_id", "phase"])._jdf.queryExecution().optimizedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Repartition" in line]
    assert len(shuffles) == 1 and "ArrowEvalPython" not in plan.split("Repartition")[1]
    write_tokenized(docs, codec, f"{tmp_path}/out", "key", 20)
    back = spark.read.parquet(f"{tmp_path}/out")
    files = back.groupBy("dataset", F.col("_metadata.file_path")).count().collect()
    assert sorted((r.dataset, r["count"]) for r in files) == [("d", 3), *[("d", 20)] * 3, ("e", 12), ("e", 20)]
    want = encode_records(docs, codec, keep=["doc_id", "phase"])
    columns = want.columns
    assert sorted(map(str, back.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
