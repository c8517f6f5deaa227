from textloom.functions.tokens import Codec
from textloom.operators import vocabulary as V
from textloom.streaming import ingest as S


def test_a_batch_shuffles_texts_and_no_ids(spark, tmp_path, monkeypatch):
    """Ids, mask and labels of every record were shuffled before they were written."""
    codec = Codec.of(V.train_vocabulary(spark.createDataFrame([("ab", 9)], "word string, n long")), spark)
    rows = [(i, "ab cd " * 30, "en", f"d{i % 3}", "phase1_pretraining") for i in range(40)]
    batch = spark.createDataFrame(rows, "doc_id long, text string, language string, dataset string, phase string")
    plans = []

    def watched(records, path, **options):
        plans.append((records._jdf.queryExecution().optimizedPlan().toString(), options))
        write(records, path, **options)

    write = S.write_records
    monkeypatch.setattr(S, "write_records", watched)
    S.write_batch(batch, 0, codec, str(tmp_path), S.IngestOptions())
    plan, options = plans[0]
    # The rebalance lies below the encoder, and the sink adds none.
    assert options["compact"] is False
    assert plan.index("ArrowEvalPython") < plan.index("RebalancePartitions")
    records = spark.read.parquet(f"{tmp_path}/data")
    assert records.count() == 40 and records.select("dataset").distinct().count() == 3
