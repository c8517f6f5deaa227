"""Document fingerprints: one-permutation MinHash of word shingles, densified, packed to few bits.

Every shingle is hashed once. The high bits of the hash name one of ``BINS`` bins, and a bin keeps its
least hash. An empty bin takes the content of a filled one: it tries bins in an order drawn from its
own number alone (optimal densification), so two texts agree there with the probability of their
Jaccard likeness. A bin is stored as ``STORED_BITS`` low bits of its hash mixed with the bin's number;
chance agreement of these bits is taken off the estimate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.words import shingle_hashes

SHINGLE_WORDS, SEED = 5, 7
BINS, BIN_BITS, STORED_BITS = 256, 8, 4
EMPTY = np.uint64((1 << 64) - 1)
# Text bytes in a partition of neighbouring documents (partitions are streamed, so more than
# MAX_PARTITIONS of them are never needed), and documents fingerprinted together.
PARTITION_BYTES = 32 << 20
MAX_PARTITIONS = 20_000
TOGETHER = 256

_EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BIN_BITS)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def bins(text: bytes) -> np.ndarray:
    """The least shingle hash of every bin, ``EMPTY`` where there is none."""
    out = np.full(BINS, EMPTY)
    for h in shingle_hashes(text, SHINGLE_WORDS, SEED):
        h.sort()
        at = np.searchsorted(h, _EDGES)
        ends = np.append(at[1:], len(h))
        filled = at < ends
        out[filled] = np.minimum(out[filled], h[at[filled]])
    return out


def densify(table: np.ndarray) -> np.ndarray:
    """Fill the empty bins of every row that has a filled one; rows without stay empty."""
    out = table.copy()
    empty = table == EMPTY
    row, col = np.nonzero(empty & ~empty.all(axis=1)[:, None])
    attempt = np.uint64(0)
    while len(row):
        attempt += np.uint64(1)
        with np.errstate(over="ignore"):
            tried = _mix(col.astype(np.uint64) * np.uint64(1_000_003) + attempt) % np.uint64(BINS)
        found = table[row, tried.astype(np.int64)]
        done = found != EMPTY
        out[row[done], col[done]] = found[done]
        row, col = row[~done], col[~done]
    return out


def pack(table: np.ndarray) -> np.ndarray:
    """The stored bits of a densified table, one small number a bin."""
    with np.errstate(over="ignore"):
        mixed = _mix(table + np.arange(1, BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (mixed & np.uint64((1 << STORED_BITS) - 1)).astype(np.uint8)


def to_text(small: np.ndarray) -> str:
    """Two bins a byte, in hex."""
    return ((small[0::2] << STORED_BITS) | small[1::2]).astype(np.uint8).tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard likeness of rows of stored bits, without the agreement due to chance."""
    chance = 1 / (1 << STORED_BITS)
    return np.clip(((a == b).mean(axis=-1) - chance) / (1 - chance), 0.0, 1.0)


class Prints:
    """Fingerprints of a list of texts. A text without words has the empty one, like itself only."""

    def __init__(self, texts: list[str]) -> None:
        table = np.array([bins(t.encode()) for t in texts]).reshape(-1, BINS)
        self.blank = (table == EMPTY).all(axis=1)
        self.bits = pack(densify(table))

    def texts(self, at: np.ndarray) -> list[str]:
        return ["" if self.blank[i] else to_text(self.bits[i]) for i in at.tolist()]

    def likeness(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        near = likeness(self.bits[a], self.bits[b])
        return np.where(self.blank[a] | self.blank[b], self.blank[a] & self.blank[b], near).astype(float)


def edit(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _judge(rows: list[tuple[int | None, str]]) -> pa.RecordBatch:
    """All rows but the last, each with the one after it."""
    n = len(rows) - 1
    texts = [t for _, t in rows]
    edited = [edit(texts[i], texts[i + 1]) for i in range(n)]
    prints = Prints(texts + edited)
    own, other = np.arange(n), np.arange(n + 1, 2 * n + 1)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _ in rows[:n]], pa.int64()),
            pa.array([len(t) for t in texts[:n]], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
            pa.array(prints.texts(own)),
            pa.array(prints.texts(other)),
            pa.array(prints.likeness(own, other)),
            pa.array(prints.likeness(own, own + 1)),
        ],
        names=[f.split()[0] for f in SCHEMA.split(", ")],
    )


SCHEMA = (
    "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by descending id; the last ones are marked and belong to the partition after."""
    held: list[tuple[int | None, str]] = []
    size, closed = 0, False
    for batch in batches:
        for key, text, extra in zip(*(batch.column(c) for c in ("id", "text", "extra")), strict=True):
            if closed:
                continue
            closed = extra.as_py()
            held.append((key.as_py(), text.as_py() or ""))
            size += len(held[-1][1])
            if len(held) > TOGETHER or size > 1 << 22 and len(held) > 1:
                yield _judge(held)
                held, size = held[-1:], 0
    if len(held) > 1:
        yield _judge(held)


def _places(ids: pa.Array) -> np.ndarray:
    """Ids as numbers to order by; null comes below all."""
    return ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), a row each.

    Documents are ordered by descending id (null ids last, repeated ids by the hash of the text); the
    one after the last is the first. Ids are cut into ranges by approximate quantiles, every range is
    one partition, and the first document of the range below is sent along with it: no task orders
    more than its range, and the text is shuffled once. A null text counts as the empty one, and a
    single document follows itself. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), "text")
    facts = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    if not facts["n"]:
        return spark.createDataFrame([], SCHEMA).withColumnRenamed("id", id_col)
    wanted = max(
        min((facts["bytes"] or 0) // PARTITION_BYTES, MAX_PARTITIONS),
        int(spark.conf.get("spark.sql.shuffle.partitions")),
    )
    shares = [i / wanted for i in range(1, wanted)]
    quantiles = docs.where("id IS NOT NULL").approxQuantile("id", shares, 0.2 / wanted)
    # Range i holds the places above cut i - 1, up to cut i.
    cuts = np.array(sorted(set(map(int, quantiles))), np.int64)

    def tops_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = _places(batch.column(0))
            ranges = np.searchsorted(cuts, places)
            found, at = np.unique(ranges, return_inverse=True)
            most = np.full(len(found), -(1 << 63), np.int64)
            np.maximum.at(most, at, places)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(most)], ["part", "top"])

    tops = docs.select("id").mapInArrow(tops_of, "part long, top long")
    tops = sorted(tops.groupBy("part").agg(F.max("top").alias("top")).collect())  # a row a range
    # The top of a range also goes to the next range above it, and the highest round to the lowest.
    above = [tops[(i + 1) % len(tops)]["part"] for i in range(len(tops))]
    high = np.array([r["top"] for r in tops], np.int64)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = _places(batch.column("id"))
            at = np.searchsorted(high, places)
            extra = np.flatnonzero(high[at] == places)
            goes = np.concatenate((np.searchsorted(cuts, places), np.array(above)[at[extra]]))
            rows = pa.Table.from_batches([batch, batch.take(pa.array(extra))]).combine_chunks()
            marks = np.arange(len(goes)) >= len(places)
            rows = rows.append_column("extra", pa.array(marks))
            rows = rows.append_column("goes", pa.array(goes.astype(np.int32)))
            yield from rows.to_batches()

    return (
        docs.mapInArrow(send, "id long, text string, extra boolean, goes int")
        .repartitionById(len(cuts) + 1, F.col("goes"))
        .sortWithinPartitions("extra", F.desc_nulls_last("id"), F.xxhash64("text"))
        .select("id", "text", "extra")
        .mapInArrow(_stream, SCHEMA)
        .withColumnRenamed("id", id_col)
    )
