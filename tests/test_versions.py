"""Versioned outputs: what a reader sees, and that reuse starts no job."""

from __future__ import annotations

import pytest

from textloom.sources import versions as W


def numbers(spark, n):
    return spark.range(n).selectExpr("id AS x")


def jobs(spark):
    return set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))


def test_reuse_starts_no_job_and_builds_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    W.reuse_or_write(spark, path, lambda: numbers(spark, 5), "x bigint")
    spark.sparkContext.setJobGroup("counted", "reuse")
    try:
        found = W.reuse_or_write(spark, path, lambda: pytest.fail("built"), "x bigint")
        assert jobs(spark) == set()
        assert found.count() == 5 and jobs(spark) != set()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert W.reuse_or_write(spark, path, lambda: numbers(spark, 7), "x bigint", replace=True).count() == 7
    assert W.versions(spark, path) == [1, 2]


def test_a_reader_never_meets_half_a_version(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        W.read_current(spark, path)
    W.write_version(spark, path, numbers(spark, 3).write.parquet)
    before = W.read_current(spark, path)

    def stops(folder):
        numbers(spark, 9).write.parquet(folder)
        raise InterruptedError

    with pytest.raises(InterruptedError):
        W.write_version(spark, path, stops)
    assert W.read_current(spark, path).count() == 3
    # The number of a version that stopped is not used again.
    assert W.write_version(spark, path, numbers(spark, 4).write.parquet) == 3
    assert W.read_current(spark, path).count() == 4 and before.count() == 3
    # A manifest row that is not complete does not count.
    (tmp_path / "out" / "manifest" / "number=4").mkdir()
    assert W.read_current(spark, path).count() == 4
    assert [r.number for r in W.manifest(spark, path).orderBy("number").collect()] == [1, 3]


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "out")
    for n in range(1, 6):
        W.write_version(spark, path, numbers(spark, n).write.parquet, f"v{n}", keep=2)
    assert W.versions(spark, path) == [4, 5] and W.read_current(spark, path).count() == 5
    assert sorted(p.name for p in (tmp_path / "out" / "data").iterdir()) == ["number=4", "number=5"]
    assert {r.note for r in W.manifest(spark, path).collect()} == {"v4", "v5"}
