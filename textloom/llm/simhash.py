"""SimHash near-dedup: fingerprints that differ in few bits, found with tables of pivot distances.

Distances of a fingerprint to fixed reference fingerprints are its coordinates. By the triangle
inequality two fingerprints within ``BITS`` of each other differ by at most ``BITS`` in every
coordinate, so a pair with a larger difference is discarded, and only survivors are compared bit by
bit. To spread this over tasks without comparing everything with everything, a fingerprint is cut
into eight bytes: of two within two bits, at least six bytes agree, so the pair meets in one of the
28 cells named by six equal bytes. A cell has two free bytes, hence at most 65,536 distinct
fingerprints, whatever the input; equal fingerprints are one row before the cells are made.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.components import components, merge_roots
from textloom.llm.words import shingle_hashes
from textloom.session import write_and_read

SHINGLE_WORDS, SEED = 3, 42
BITS = 2
BYTES = 8
PIVOTS = 24
# The references: fixed pseudo-random fingerprints.
REFERENCES = np.random.default_rng(20_240_501).integers(0, 1 << 64, PIVOTS, np.uint64)
# Cells up to this size are compared many at a time.
SMALL_CELL = 8
ROW_BLOCK = 256


def fingerprint(text: bytes) -> int:
    """A bit is set if it is set in more than half of the shingle hashes; no words give zero."""
    total, counts = 0, np.zeros(64, np.int64)
    for h in shingle_hashes(text, SHINGLE_WORDS, SEED):
        for part in np.array_split(h, -(-len(h) // 65_536)):
            bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        total += len(h)
    set_bits = (2 * counts > total).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        found = (fingerprint(t.as_py() or b"") for t in texts)
        values = np.fromiter(found, np.uint64, len(texts)).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(values)], ["id", "fp"])


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Distances (rows: fingerprints, columns: references)."""
    return np.bitwise_count(fps[:, None] ^ REFERENCES[None, :]).astype(np.int8)


def _near(fps: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """The pairs of positions (a, b) within ``BITS``: coordinates first, then bits."""
    for k in range(0, PIVOTS, 6):
        gap = np.abs(table[a, k : k + 6] - table[b, k : k + 6]).max(axis=1)
        a, b = a[gap <= BITS], b[gap <= BITS]
    near = np.bitwise_count(fps[a] ^ fps[b]) <= BITS
    return a[near], b[near]


def cell_links(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the distinct fingerprints of a cell as all its close pairs would.

    Rows are sorted by the first coordinate, so that a block of them is compared with the rows whose
    first coordinate is close only. The links of a block are merged into a forest before the next
    block, so at most one link a fingerprint is kept however many pairs are close.
    """
    n = len(fps)
    table = pivot_table(fps)
    order = np.argsort(table[:, 0], kind="stable")
    fps, table = fps[order], table[order]
    root = np.arange(n)
    for start in range(0, n, ROW_BLOCK):
        stop = min(n, start + ROW_BLOCK)
        end = np.searchsorted(table[:, 0], table[stop - 1, 0] + BITS, side="right")
        for left in range(start, end, 4 * ROW_BLOCK):
            right = min(end, left + 4 * ROW_BLOCK)
            a, b = np.meshgrid(np.arange(start, stop), np.arange(left, right), indexing="ij")
            keep = a < b
            a, b = _near(fps, table, a[keep], b[keep])
            root = merge_roots(root, a, b)
    linked = root != np.arange(n)
    return fps[linked], fps[root[linked]]


def _cells_to_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(0)
        flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        sizes = np.asarray(lists.value_lengths())
        starts = np.cumsum(sizes) - sizes
        found = [(np.empty(0, np.uint64), np.empty(0, np.uint64))]
        for size in np.unique(sizes[sizes <= SMALL_CELL]).tolist():
            at = starts[sizes == size]
            pairs = np.array(list(combinations(range(size), 2)))
            a = (at[:, None] + pairs[:, 0]).ravel()
            b = (at[:, None] + pairs[:, 1]).ravel()
            used, back = np.unique(np.concatenate((a, b)), return_inverse=True)
            fps = flat[used]
            a, b = _near(fps, pivot_table(fps), back[: len(a)], back[len(a) :])
            found.append((fps[a], fps[b]))
        for i in np.flatnonzero(sizes > SMALL_CELL).tolist():
            found.append(cell_links(flat[starts[i] : starts[i] + sizes[i]]))
        u = np.concatenate([x for x, _ in found]).view(np.int64)
        v = np.concatenate([x for _, x in found]).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def links(distinct: DataFrame) -> DataFrame:
    """(u, v): links between the distinct fingerprints of ``distinct`` (column fp)."""
    cells = []
    for number, free in enumerate(combinations(range(BYTES), 2)):
        # The two free bytes are cleared and the first of them names the cell's kind; the rest stays.
        mask = ~sum(0xFF << (8 * b) for b in free) & ((1 << 64) - 1)
        signed = mask - (1 << 64) if mask >> 63 else mask
        tag = number << (8 * free[0])
        tag = tag - (1 << 64) if tag >> 63 else tag
        cells.append(F.col("fp").bitwiseAND(F.lit(signed)).bitwiseOR(F.lit(tag)))
    keyed = distinct.select(
        "fp", F.posexplode(F.array(*cells)).alias("kind", "cell")
    )
    groups = keyed.groupBy("kind", "cell").agg(F.collect_list("fp").alias("fps"))
    return groups.where(F.size("fps") > 1).select("fps").mapInArrow(_cells_to_links, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, fingerprint: 16 hex digits, component_id: least id reachable by links), a row each.

    Null and blank texts have fingerprint zero and are linked like any other. Null ids never name a
    component; one of null ids only has a null name. Repeated rows stay repeated. Ids may be of any type
    that has an order, structs included.
    """
    prints = docs.select(F.col(id_col).alias("id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        _fingerprints, f"id {docs.schema[id_col].dataType.simpleString()}, fp long"
    )
    prints = write_and_read(prints, "simhash")
    distinct = write_and_read(prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    parts = components(links(distinct), "simhash-links").withColumnRenamed("node", "fp")
    whole = distinct.join(parts, "fp", "left").withColumn("part", F.coalesce("component", "fp"))
    named = whole.groupBy("part").agg(F.min("least").alias("component_id"))
    names = write_and_read(whole.select("fp", "part").join(named, "part").drop("part"), "simhash-names")
    return prints.join(names, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
