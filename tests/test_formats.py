from datetime import timedelta

from pyspark.sql import functions as F

from textloom.functions import formats as M


def size_text(n):
    for unit in ("B", "KB", "MB", "GB", "TB"):
        if n < 1024.0:
            return f"{n:.2f} {unit}"
        n /= 1024.0
    return f"{n:.2f} PB"


def test_sizes_round_ties_to_even(spark):
    values = [0, 1, 1023, 1024, 1152, 1157, 1536, 1047552, 1048575, 1048576, 5 * 1024**3 + 12345, 7 * 1024**5, 3 * 1024**6]
    values += [1024 + 128 * k // 1 for k in range(0, 64, 3)]
    df = spark.createDataFrame([(float(v),) for v in values], "v double").select("v", M.format_size(F.col("v")).alias("s"))
    for row in df.collect():
        assert row.s == size_text(row.v), row


def test_durations_match_timedelta(spark):
    values = [0.0, 0.9, 59.999, 60.0, 3599.5, 3600.0, 86399.0, 86400.0, 90061.7, 172800.0, 1e7, -0.5, -1.5, -86400.0, -90000.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", M.format_duration(F.col("v")).alias("s"))
    for row in df.collect():
        assert row.s == str(timedelta(seconds=int(row.v)))


def test_ratio_status_and_band(spark):
    one = spark.range(1)

    def value(column):
        return one.select(column).first()[0]

    assert value(M.safe_ratio(F.lit(3), F.lit(2))) == 1.5
    assert value(M.safe_ratio(F.lit(3), F.lit(0))) == 0.0
    assert value(M.safe_ratio(F.lit(3), F.lit(-1))) == 0.0
    assert value(M.status_text(F.lit(True), F.lit(True))) == "Complete"
    assert value(M.status_text(F.lit(False), F.lit(True))) == "Failed"
    assert value(M.status_text(F.lit(None).cast("boolean"), F.lit(None).cast("boolean"))) == "In Progress"
    assert [value(M.fertility_band(F.lit(v))) for v in (2.5, 2.51, 3.5, 3.51)] == ["EXCELLENT", "GOOD", "GOOD", "POOR"]


def test_elapsed_micros(spark):
    rows = [
        ("2024-01-01T00:00:00.123456", "2024-01-01T01:00:00.000000"),
        ("2024-01-01T00:00:00", "2024-01-02T00:00:00.5"),
        (None, "2024-01-02T00:00:00"),
        ("not a time", "2024-01-02T00:00:00"),
    ]
    df = spark.createDataFrame(rows, "a string, b string").select(M.elapsed_micros(F.col("a"), F.col("b")))
    assert [r[0] for r in df.collect()] == [3599876544, 86400500000, None, None]
