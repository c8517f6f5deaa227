"""Exact dedup against a plain grouping, with repeats, nulls, hits that fail, and a state that goes on."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

from textloom.llm import exact


def write(rows, schema, spark, folder, parts=3):
    spark.createDataFrame(rows, schema).repartition(parts).write.mode("append").parquet(folder)
    return folder


def groups_of(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").encode()].append(r[0])
    return groups


def check(rows, got):
    want = []
    for text, ids in groups_of(rows).items():
        named = [i for i in ids if i is not None]
        keep = max(named) if named else None
        want += [(i, keep, len(ids), hashlib.sha256(text).hexdigest()) for i in ids]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) == sorted(want, key=key)
    kept = [r for r in got if r.kept]
    assert all(r.doc_id == r.keep_id for r in kept)
    assert sorted(r.text_sha256 for r in kept) == sorted(hashlib.sha256(t).hexdigest() for t in groups_of(rows))


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_awkward_rows(spark, awkward_rows, tmp_path, digest_bytes):
    """With a digest of one byte many hits fail the check of their bytes."""
    rows = awkward_rows + [(1000 + i, f"short text {i % 90}", "en", "s", 1, "x", "y") for i in range(200)]
    rows += [(None, "only without id", None, None, None, None, None)] * 3
    rows += [(7, "an id that repeats", None, None, None, None, None), (7, "an id that repeats", None, None, None, None, None)]
    names = "doc_id long, text string, digest string, sha string, file long, at string, keep string"
    folder = write(rows, names, spark, str(tmp_path / "docs"))
    got = exact.deduplicate(spark, folder, digest_bytes=digest_bytes, files_per_batch=1).collect()
    check(rows, got)


def test_empty_table(spark, nothing, tmp_path):
    folder = str(tmp_path / "docs")
    nothing.write.parquet(folder)
    assert exact.deduplicate(spark, folder).collect() == []


def test_text_ids_and_a_single_file(spark, tmp_path):
    folder = write([("b", "x"), ("a", "x"), ("c", None)], "doc_id string, text string", spark, str(tmp_path / "docs"), 1)
    file = next((tmp_path / "docs").glob("part-*"))
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact.deduplicate(spark, str(file)).collect()}
    assert got == {"a": ("b", 2, False), "b": ("b", 2, True), "c": ("c", 1, True)}
    assert exact.deduplicate(spark, folder).count() == 3


def test_state_goes_on(spark, tmp_path):
    """A second run reads new files only, and an old text that comes again is one group with them."""
    folder, state = str(tmp_path / "docs"), str(tmp_path / "state")
    first = [(i, f"text {i % 7}") for i in range(40)]
    later = [(100 + i, f"text {i % 9}") for i in range(30)]
    write(first, "doc_id long, text string", spark, folder)
    check(first, exact.deduplicate(spark, folder, state).collect())
    write(later, "doc_id long, text string", spark, folder)
    check(first + later, exact.deduplicate(spark, folder, state).collect())
    sizes = {r.keep.doc_id: r.n for r in exact.retained(spark, state).collect()}
    assert sum(sizes.values()) == len(first) + len(later) and len(sizes) == 9
    exact.take_in(spark, folder, state)
    assert sum(r.n for r in exact.retained(spark, state).collect()) == len(first) + len(later)


def test_state_reserves_no_disk(spark):
    """A store a partition reserved megabytes for its logs: 211 partitions of a small table took more than 0.6 GB."""
    conf = exact._side_session(spark).conf
    assert conf.get("spark.sql.streaming.stateStore.rocksdb.allowFAllocate") == "false"
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "unset") != "false"
