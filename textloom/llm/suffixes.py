"""Removal of repeated byte strings with a logarithmic family of sparse suffix arrays.

A document loses every byte covered by a string of ``LENGTH`` bytes that also starts in a document with
a smaller id. All windows of that length are judged, but only some suffixes are indexed: each window
chooses the least-hashed of its ``CORE``-byte substrings, and consecutive windows with the same choice
form a run. Equal windows choose alike wherever they stand, so a match can only be between runs of
equal cores; an index entry is a run, ordered by (core, whole content of the run).

1. A batch of texts gives one sorted array of entries - its suffix array - which is cut by core into
   buckets. A task of a bucket keeps a family of levels: a new array is scanned against every level,
   then joins as a level of its own, and levels of like size are merged, so that an entry is moved a
   logarithmic number of times. Runs equal to those of a smaller id are removed as a whole; cores that
   meet with different content (the ends of a long match) are marked.
2. The windows of marked runs only, a few in a hundred, are compared one by one. The more text, the more of
   them are marked, so they are made anew in turns by a hash and go from the making to the comparison
   without being stored: what a turn holds on disk is a share of the text, however many are marked.

Entries that are already known to be removed within their batch are not sent, so a passage that a third
of all documents share is one entry a batch. Content is compared by hashes of 128 (runs) and 96 bits
(windows). Between the steps are tables in the shared folder; every step is a map over partitions.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.session import write_and_read

LENGTH, CORE = 50, 20
CHOICES = LENGTH - CORE + 1
# Bytes hashed together (their hashes fit a cache), text bytes of a batch, and of a bucket or a group of
# documents. Every batch sends to every bucket, and every bucket to every group, so these are not small.
PIECE, BATCH = 1 << 17, 12 << 20
PART_BYTES = 12 << 20
# Entries that a bucket gathers before they are scanned as one array: a scan reads every level, so its
# cost must not depend on the number of batches.
GATHER = 1 << 20
# Levels whose sizes differ by less than this factor are merged.
LIKE = 2
# Text bytes that wait for their windows, windows that are made and compared together, text bytes of an
# outcome.
WAIT, WINDOWS, SENT = 16 << 20, 1 << 20, 4 << 20
# Bytes of a window on its way to its bucket, and the part of all text bytes that windows of a turn may take.
WINDOW_BYTES, TURN_SHARE = 16, 3
# Columns of fewer bytes in all are compressed together, and of very few not at all.
SMALL, TINY = 1 << 15, 1 << 10

_RANDOM = np.random.default_rng(77)
_BYTE = _RANDOM.integers(0, 1 << 64, (2, 256), np.uint64)
_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
# Shuffle files go when the query that made them ends, as every step is written to a table; texts and
# blobs are large rows, so few of them are handed to Python at once.
SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


@lru_cache(maxsize=2)
def _powers(which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    n = PIECE + 2 * LENGTH
    out = []
    for base in (_BASE[which], pow(_BASE[which], -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Hashes:
    """Hashes of all substrings of a piece, from prefix sums."""

    def __init__(self, data: np.ndarray, which: int = 0) -> None:
        up, self.down = _powers(which)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[which][data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start])

    def fixed(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mix((self.sums[size:] - self.sums[:-size]) * self.down[:n])


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    span, out = 1, x
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return out if span == width else np.minimum(out[: len(x) - width + 1], out[width - span :])


# Entries: core and content hash, document, tag (tells rows of one id apart), first window and windows.
FIELDS = {"core": "u8", "whole": "u8", "doc": "i8", "tag": "u4", "start": "u4", "count": "u4"}
# Windows: two hashes and where they are.
WINDOW = {"one": "u8", "two": "u4", "doc": "i8", "tag": "u4", "start": "u4"}
# What is decided about runs: ``marked`` ones are to be compared window by window.
RUN = {"doc": "i8", "tag": "u4", "start": "u4", "count": "u4", "marked": "u1"}
Columns = dict[str, np.ndarray]


# Columns that are packed as differences, which are small where rows are in the order of documents.
STEPS = ("doc", "tag", "start")


def _order(*keys: np.ndarray) -> np.ndarray:
    """Order by integer keys, the most significant first; by one number made of all where that has 63 bits."""
    if not len(keys[0]):
        return np.empty(0, np.int64)
    lows = [int(k.min()) for k in keys]
    bits = [(int(k.max()) - low).bit_length() for k, low in zip(keys, lows, strict=True)]
    if sum(bits) > 63:
        return np.lexsort(keys[::-1])
    key = np.zeros(len(keys[0]), np.int64)
    for k, low, width in zip(keys, lows, bits, strict=True):
        if width:
            key = (key << width) | (k.astype(np.int64) - low)
    return np.argsort(key)


def in_place_order(columns: Columns) -> Columns:
    return take(columns, _order(columns["doc"], columns["tag"], columns["start"]))


def pack(columns: Columns, steps: bool = False) -> bytes:
    """Rows and lengths, then the columns: each compressed, small ones together, very small ones as they are."""
    parts = []
    for name, c in columns.items():
        if steps and name in STEPS:
            c = c.copy()
            c[1:] -= columns[name][:-1]
        parts.append(np.ascontiguousarray(c))
    n, size = len(parts[0]), sum(c.nbytes for c in parts)
    packed = parts if size >= SMALL else [b"".join([c.tobytes() for c in parts])]
    if size >= TINY:
        packed = [pa.compress(c, codec="zstd", asbytes=True) for c in packed]
    return struct.pack(f"<{1 + len(packed)}q", n, *map(len, packed)) + b"".join(packed)


def packed_rows(blob: bytes) -> int:
    return int.from_bytes(blob[:8], "little")


def unpack(blob: bytes, fields: dict[str, str], steps: bool = False) -> Columns:
    n = packed_rows(blob)
    widths = [n * int(kind[1:]) for kind in fields.values()]
    size = sum(widths)
    apart = widths if size >= SMALL else [size]
    lengths = struct.unpack_from(f"<{len(apart)}q", blob, 8)
    at, raw = 8 + 8 * len(apart), []
    for length, width in zip(lengths, apart, strict=True):
        part = blob[at : at + length]
        raw.append(part if size < TINY else pa.decompress(part, width, codec="zstd", asbytes=True))
        at += length
    every = raw[0] if len(apart) == 1 else b"".join(raw)
    at, out = 0, {}
    for (name, kind), width in zip(fields.items(), widths, strict=True):
        column = np.frombuffer(every, kind, n, at)
        out[name] = np.cumsum(column, dtype=kind) if steps and name in STEPS else column
        at += width
    return out


def take(columns: Columns, at: np.ndarray) -> Columns:
    return {name: c[at] for name, c in columns.items()}


def join(parts: list[Columns]) -> Columns:
    return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination begins in sorted keys."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


# Parts of texts laid end to end: bytes, where each part begins and ends, its text's number and its
# place there.
Laid = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def runs(laid: Laid) -> tuple[np.ndarray, ...]:
    """(core, content, position of the first window, windows, part) of all runs."""
    data, begins, ends, _, _ = laid
    windows = len(data) - LENGTH + 1
    if windows <= 0:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 3
    hashes = Hashes(data)
    chosen = _least(hashes.fixed(CORE), CHOICES)
    # The windows of a part stop before those that reach into the next.
    stops = np.maximum(begins, ends - LENGTH + 1)
    new = _firsts(chosen)
    new[begins[begins < windows]] = True
    new[stops[stops < windows]] = True
    first = np.flatnonzero(new)
    last = np.append(first[1:], windows)
    part = np.searchsorted(begins, first, "right") - 1
    keep = first < stops[part]
    first, last, part = first[keep], last[keep], part[keep]
    # Mixed again, as the least of many hashes are low and would crowd the first buckets.
    return _mix(chosen[first]), hashes.of(first, last + LENGTH - 1), first, last - first, part


def _pieces(stretches: Iterator[tuple[int, int, int, bytes]]) -> Iterator[Laid]:
    """Bounded pieces of (number, first window, end of windows, text) stretches; a long one is cut into parts that
    overlap, so that each of its windows lies in one."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for number, first, end, text in stretches:
        for at in range(first, end, PIECE // 2):
            part = text[at : min(at + PIECE // 2, end) + LENGTH - 1]
            if held and size + len(part) > PIECE:
                yield _lay(held)
                held, size = [], 0
            held.append((number, at, part))
            size += len(part)
    if held:
        yield _lay(held)


def _lay(held: list[tuple[int, int, bytes]]) -> Laid:
    ends = np.cumsum([len(p) for _, _, p in held])
    begins = np.append(0, ends[:-1])
    data = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
    return data, begins, ends, np.array([n for n, _, _ in held]), np.array([a for _, a, _ in held])


def entries(texts: list[tuple[int, int, bytes]]) -> Columns:
    """The index entries of (doc, tag, text) rows, not sorted."""
    docs = np.array([d for d, _, _ in texts], np.int64)
    tags = np.array([t for _, t, _ in texts], np.uint32)
    parts = [{name: np.empty(0, kind) for name, kind in FIELDS.items()}]
    for laid in _pieces((i, 0, len(t) - LENGTH + 1, t) for i, (_, _, t) in enumerate(texts)):
        core, whole, at, count, part = runs(laid)
        if len(core):
            _, begins, _, numbers, places = laid
            number = numbers[part]
            parts.append(
                {
                    "core": core,
                    "whole": whole,
                    "doc": docs[number],
                    "tag": tags[number],
                    "start": (at + (places - begins)[part]).astype(np.uint32),
                    "count": count.astype(np.uint32),
                }
            )
    return join(parts)


def ordered(columns: Columns) -> Columns:
    """By core, content, then document."""
    order = np.argsort(columns["core"])
    # Few cores are there twice; only theirs are ordered by the rest.
    new = _firsts(columns["core"][order])
    tied = np.flatnonzero(~(new & np.append(new[1:], True)))
    some = order[tied]
    order[tied] = some[np.lexsort((columns["doc"][some], columns["whole"][some], columns["core"][some]))]
    return take(columns, order)


def settle(level: Columns) -> tuple[Columns, Columns]:
    """(entries that stay, entries removed as a whole) of a sorted array: of equal runs, those with the
    least id stay, for none of them is repeated from a smaller one."""
    new = _firsts(level["core"], level["whole"])
    least = level["doc"][np.flatnonzero(new)]
    gone = level["doc"] > least[np.cumsum(new) - 1] if len(new) else new
    return take(level, np.flatnonzero(~gone)), take(level, np.flatnonzero(gone))


class Family:
    """The levels of one bucket. ``marked`` is kept beside each entry of a level."""

    def __init__(self) -> None:
        self.levels: list[Columns] = []
        self.removed: list[Columns] = []

    def add(self, batch: Columns) -> None:
        """Scan a sorted array against all levels, then let it join them."""
        batch = {**batch, "marked": np.zeros(len(batch["core"]), bool)}
        self._mark_within(batch)
        for level in self.levels:
            self._mark(level, batch)
            batch = self._remove(level, batch)
        if len(batch["core"]):
            self.levels.append(batch)
        while len(self.levels) > 1 and len(self.levels[-2]["core"]) < LIKE * len(self.levels[-1]["core"]):
            merged = ordered(join([self.levels.pop(), self.levels.pop()]))
            merged, gone = settle(merged)
            self.removed.append(gone)
            self.levels.append(merged)

    @staticmethod
    def _mark_within(batch: Columns) -> None:
        """Mark all runs of a core that has several contents and documents."""
        new = _firsts(batch["core"])
        if new.all():
            return
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(new)) - 1
        # Contents are sorted within a core, so the ends tell whether any differs.
        hit = batch["whole"][first] != batch["whole"][last]
        hit &= np.minimum.reduceat(batch["doc"], first) != np.maximum.reduceat(batch["doc"], first)
        batch["marked"] |= hit[np.cumsum(new) - 1]

    @staticmethod
    def _mark(level: Columns, batch: Columns) -> None:
        """Mark runs whose core has other content in another document, on both sides."""
        a, b = level["core"], batch["core"]
        low, high = np.searchsorted(a, b, "left"), np.searchsorted(a, b, "right")
        met = np.flatnonzero(high > low)
        if not len(met):
            return
        first, last = low[met], high[met] - 1
        # Documents and contents of the core's entries in the level: one kind, or several?
        cores = np.flatnonzero(_firsts(a))
        group = np.cumsum(_firsts(a)) - 1
        least = np.minimum.reduceat(level["doc"], cores)[group[first]]
        most = np.maximum.reduceat(level["doc"], cores)[group[first]]
        doc, whole = batch["doc"][met], batch["whole"][met]
        # Contents are sorted within a core, so the ends tell whether any differs.
        other = (level["whole"][first] != whole) | (level["whole"][last] != whole)
        hit = met[other & ((least != doc) | (most != doc))]
        batch["marked"][hit] = True
        touched = np.zeros(len(cores), bool)
        touched[group[low[hit]]] = True
        level["marked"] |= touched[group]

    def _remove(self, level: Columns, batch: Columns) -> Columns:
        """The batch without the runs that the level has with a smaller id."""
        low = np.searchsorted(level["core"], batch["core"], "left")
        end = np.searchsorted(level["core"], batch["core"], "right")
        met = np.flatnonzero(low < end)
        if not len(met):
            return batch
        # Within a core contents are sorted, and equal ones by document.
        a, b, wanted = low[met], end[met], batch["whole"][met]
        while (open_ := np.flatnonzero(a < b)).size:
            middle = (a[open_] + b[open_]) // 2
            less = level["whole"][middle] < wanted[open_]
            a[open_[less]] = middle[less] + 1
            b[open_[~less]] = middle[~less]
        here = np.flatnonzero(a < end[met])
        here = here[level["whole"][a[here]] == wanted[here]]
        here = here[level["doc"][a[here]] < batch["doc"][met[here]]]
        gone = np.zeros(len(low), bool)
        gone[met[here]] = True
        self.removed.append(take(batch, np.flatnonzero(gone)))
        return take(batch, np.flatnonzero(~gone))

    def finish(self) -> list[Columns]:
        """Merge what is left; the removed runs, and the marked ones among those that stay."""
        if len(self.levels) > 1:
            stay, gone = settle(ordered(join(self.levels)))
            self.removed.append(gone)
            self.levels = [stay]
        self.levels = [take(level, np.flatnonzero(level["marked"])) for level in self.levels]
        return [*({**r, "marked": np.zeros(len(r["core"]), bool)} for r in self.removed), *self.levels]


def _decided(columns: Columns) -> Columns:
    return {name: columns[name].astype(kind) for name, kind in RUN.items()}


def _group(doc: np.ndarray, groups: int) -> np.ndarray:
    return (doc ^ (doc >> 11)) % groups


def _by_part(columns: Columns, part: np.ndarray) -> Iterator[tuple[int, Columns]]:
    if not len(part):
        return
    order = np.argsort(part, kind="stable")
    columns, part = take(columns, order), part[order]
    starts = np.flatnonzero(_firsts(part))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(part)], strict=True):
        yield int(part[a]), {name: c[a:b] for name, c in columns.items()}


def _blobs(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))]
    return pa.RecordBatch.from_arrays(columns, ["part", "kind", "blob"])


def _texts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(doc, tag, text) rows of about ``size`` bytes."""
    rows, held = [], 0
    for batch in batches:
        for doc, tag, text in zip(batch.column("doc"), batch.column("tag"), batch.column("text"), strict=True):
            rows.append((doc.as_py(), tag.as_py(), text.as_py()))
            held += len(rows[-1][2])
            if held >= size:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


def _index(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Batches of entries, sorted and cut by core (kind 0), and runs repeated within a batch (kind 1)."""
    width = np.uint64((1 << 64) // buckets + 1)
    for rows in _texts(batches, BATCH):
        stay, gone = settle(ordered(entries(rows)))
        out = [(part, 0, pack(c)) for part, c in _by_part(stay, (stay["core"] // width).astype(np.int64))]
        if len(gone["core"]):
            # They only pass through a bucket, so a batch sends them to one, by a hash.
            part = int(gone["whole"].max() % np.uint64(buckets))
            gone["marked"] = np.zeros(len(gone["core"]), bool)
            out.append((part, 1, pack(in_place_order(_decided(gone)), steps=True)))
        if out:
            yield _blobs(out)


def _scan(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """The family of a bucket; decisions leave by groups of documents."""
    family, decided = Family(), []
    held: list[Columns] = []
    size = 0

    def add() -> None:
        stay, gone = settle(ordered(join(held)))
        decided.append(_decided(gone | {"marked": np.zeros(len(gone["core"]), bool)}))
        family.add(stay)

    for batch in batches:
        for kind, blob in zip(batch.column("kind"), batch.column("blob"), strict=True):
            if kind.as_py():
                decided.append(unpack(blob.as_py(), RUN, steps=True))
                continue
            held.append(unpack(blob.as_py(), FIELDS))
            size += len(held[-1]["core"])
            if size >= GATHER:
                add()
                held, size = [], 0
    if held:
        add()
    held = []
    decided += [_decided(c) for c in family.finish()]
    if decided:
        every = in_place_order(join(decided))
        found = _by_part(every, _group(every["doc"], groups))
        if rows := [(part, 0, pack(c, steps=True)) for part, c in found]:
            yield _blobs(rows)


def _joined(columns: Columns) -> Columns:
    """Runs in order of document, tag and mark; those that touch or overlap, as copies of a row make, are joined."""
    c = take(columns, _order(*(columns[k] for k in ("doc", "tag", "marked", "start"))))
    if not len(c["doc"]):
        return c
    # One line for all: each document, tag and mark has a stretch of its own.
    base = np.cumsum(_firsts(c["doc"], c["tag"], c["marked"])) << 33
    start = base + c["start"]
    end = np.maximum.accumulate(start + c["count"])
    first = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
    count = end[np.append(first[1:], len(end)) - 1] - start[first]
    return take(c, first) | {"count": count.astype(np.uint32)}


class _Decisions:
    """Decisions of a group, found by document."""

    def __init__(self, parts: list[Columns]) -> None:
        c = self.columns = _joined(join([{name: np.empty(0, kind) for name, kind in RUN.items()}, *parts]))
        first = np.flatnonzero(_firsts(c["doc"], c["tag"]))
        keys = zip(c["doc"][first].tolist(), c["tag"][first].tolist(), strict=True)
        self.at = dict(zip(keys, zip(first.tolist(), [*first[1:].tolist(), len(c["doc"])], strict=False), strict=False))

    def of(self, doc: int, tag: int) -> Columns:
        a, b = self.at.get((doc, tag), (0, 0))
        return {name: x[a:b] for name, x in self.columns.items()}


def kept_bytes(text: bytes, start: np.ndarray, count: np.ndarray) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, removed stretches) when windows from ``start`` on are removed."""
    if not len(start):
        return text, 0, 0
    order = np.argsort(start, kind="stable")
    a = start[order].astype(np.int64)
    b = np.maximum.accumulate(a + count[order] + (LENGTH - 1))
    first = np.flatnonzero(np.append(True, a[1:] > b[:-1]))
    a, b = a[first], b[np.append(first[1:], len(b)) - 1]
    begins, ends = a.tolist(), b.tolist()
    kept = b"".join([text[x:y] for x, y in zip([0, *ends], [*begins, len(text)], strict=True)])
    return kept, int((b - a).sum()), len(begins)


OUTCOME = {
    "kind": pa.string(),
    "part": pa.int32(),
    "id": pa.int64(),
    "doc": pa.int64(),
    "tag": pa.int64(),
    "n_bytes": pa.int64(),
    "n_removed": pa.int64(),
    "n_spans": pa.int64(),
    "kept": pa.binary(),
    "kept_sha256": pa.string(),
    "blob": pa.binary(),
    "marks": pa.binary(),
    "wide": pa.int64(),
}
OUTCOME_DDL = (
    "kind string, part int, id long, doc long, tag long, n_bytes long, n_removed long, n_spans long, "
    "kept binary, kept_sha256 string, blob binary, marks binary, wide long"
)


def _outcome(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(name) for r in rows], kind) for name, kind in OUTCOME.items()], list(OUTCOME)
    )


def _done(row: dict, text: bytes, start: np.ndarray, count: np.ndarray, texts: bool) -> dict:
    kept, removed, spans = kept_bytes(text, start, count)
    return row | {
        "kind": "done",
        "n_bytes": len(text),
        "n_removed": removed,
        "n_spans": spans,
        "kept": kept if texts else None,
        "kept_sha256": hashlib.sha256(kept).hexdigest(),
    }


def _windows(rows: list[tuple[int, int, bytes, Columns]]) -> Columns:
    """All windows of the marked runs of (doc, tag, text, marked runs) rows. Runs do not overlap."""
    parts = [{name: np.empty(0, kind) for name, kind in WINDOW.items()}]
    docs = np.array([r[0] for r in rows], np.int64)
    tags = np.array([r[1] for r in rows], np.uint32)
    # Only the bytes of marked runs are hashed.
    stretches = (
        (i, a, a + n, text)
        for i, (_, _, text, run) in enumerate(rows)
        for a, n in zip(run["start"].tolist(), run["count"].tolist(), strict=True)
    )
    for data, begins, ends, numbers, places in _pieces(stretches):
        sizes = ends - begins - LENGTH + 1
        part = np.repeat(np.arange(len(sizes)), sizes)
        inside = np.arange(len(part)) - (np.cumsum(sizes) - sizes)[part]
        at, number = inside + begins[part], numbers[part]
        parts.append(
            {
                "one": Hashes(data).fixed(LENGTH)[at],
                "two": (Hashes(data, 1).fixed(LENGTH)[at] >> np.uint64(32)).astype(np.uint32),
                "doc": docs[number],
                "tag": tags[number],
                "start": (inside + places[part]).astype(np.uint32),
            }
        )
    return join(parts)


def _later(windows: Columns) -> tuple[Columns, np.ndarray]:
    """Windows, and which of them a smaller document has."""
    one, two, doc = windows["one"], windows["two"], windows["doc"]
    later = np.zeros(len(one), bool)
    if not len(one):
        return windows, later
    order = np.argsort(one)
    new = _firsts(one[order])
    if (~new[1:] & (two[order[1:]] != two[order[:-1]])).any():
        order = np.lexsort((two, one))
        new = _firsts(one[order], two[order])
    doc = doc[order]
    least = np.minimum.reduceat(doc, np.flatnonzero(new))
    later[order] = doc > least[np.cumsum(new) - 1]
    return windows, later


def _removed(windows: Columns) -> Columns:
    """Windows as runs; neighbours are joined."""
    n = len(windows["doc"])
    place = {name: windows[name] for name in ("doc", "tag", "start")}
    return _joined(place | {"count": np.ones(n, np.uint32), "marked": np.zeros(n, np.uint8)})


def _judge(batches: Iterator[pa.RecordBatch], groups: int, texts: bool) -> Iterator[pa.RecordBatch]:
    """Decisions of a group, then its texts: those without marked runs are done, the others wait for
    the comparison of their windows."""
    parts: list[Columns] = []
    decisions: _Decisions | None = None
    for batch in batches:
        rows, size = [], 0
        for r in batch.to_pylist():
            if r["text"] is None:
                parts.append(unpack(r["blob"], RUN, steps=True))
                continue
            decisions = decisions or _Decisions(parts)
            run = decisions.of(r["doc"], r["tag"])
            marked = run["marked"] > 0
            row = {"id": r["id"], "doc": r["doc"], "tag": r["tag"]}
            whole = {name: c[~marked] for name, c in run.items()}
            if not marked.any():
                rows.append(_done(row, r["text"], whole["start"], whole["count"], texts))
            else:
                packed = pa.compress(r["text"], codec="zstd", asbytes=True)
                part = int(_group(np.array([r["doc"]]), groups)[0])
                rows.append(
                    row
                    | {"kind": "waiting", "part": part, "n_bytes": len(r["text"]), "kept": packed}
                    | {"blob": np.stack((whole["start"], whole["count"])).tobytes()}
                    | {"marks": np.stack((run["start"][marked], run["count"][marked])).tobytes()}
                    | {"wide": int(run["count"][marked].sum())}
                )
            size += len(r["text"])
            if size >= SENT:
                yield _outcome(rows)
                rows, size = [], 0
        if rows:
            yield _outcome(rows)


def _send(batches: Iterator[pa.RecordBatch], buckets: int, turns: int, turn: int) -> Iterator[pa.RecordBatch]:
    """A turn's windows of the marked runs of waiting texts, cut by hash (kind 0), and those that a smaller
    document among the texts at hand has, as runs (kind 1)."""
    width = np.uint64((1 << 64) // buckets + 1)
    waiting: list[tuple[int, int, bytes, Columns]] = []
    held = wide = 0

    def flush() -> pa.RecordBatch:
        waiting.sort(key=lambda w: w[:2])
        windows = _windows(waiting)
        if turns > 1:
            windows = take(windows, np.flatnonzero(windows["two"] % np.uint32(turns) == turn))
        windows, later = _later(windows)
        sent = take(windows, np.flatnonzero(~later))
        gone = _removed(take(windows, np.flatnonzero(later)))
        out = [(part, 0, pack(c, steps=True)) for part, c in _by_part(sent, (sent["one"] // width).astype(np.int64))]
        if len(gone["doc"]):
            # They only pass through a bucket, so they are sent to one.
            out.append((int(gone["start"].sum(dtype=np.int64)) % buckets, 1, pack(gone, steps=True)))
        return _blobs(out)

    for batch in batches:
        for r in batch.to_pylist():
            start, count = np.frombuffer(r["marks"], np.uint32).reshape(2, -1)
            text = pa.decompress(r["kept"], r["n_bytes"], codec="zstd", asbytes=True)
            waiting.append((r["doc"], r["tag"], text, {"start": start, "count": count}))
            held += len(text)
            wide += r["wide"]
            if held >= WAIT or wide >= WINDOWS:
                yield flush()
                waiting, held, wide = [], 0, 0
    if waiting:
        yield flush()


def _compare(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    """All windows of a bucket; those that a smaller document has are removed. Where they are many, a
    range of hashes is compared after another."""
    blobs, passed = [], []
    for batch in batches:
        for kind, blob in zip(batch.column("kind"), batch.column("blob"), strict=True):
            if kind.as_py():
                passed.append(unpack(blob.as_py(), RUN, steps=True))
            else:
                blobs.append(blob.as_py())
    turns = 1 + sum(map(packed_rows, blobs)) // (4 * WINDOWS)
    parts = []
    for turn in range(turns):
        some = [unpack(b, WINDOW, steps=True) for b in blobs] if turns == 1 else [
            take(w, np.flatnonzero(_mix(w["one"]) % np.uint64(turns) == turn))
            for w in (unpack(b, WINDOW, steps=True) for b in blobs)
        ]
        if some:
            windows, later = _later(join(some))
            parts.append(take(windows, np.flatnonzero(later)))
    if parts:
        passed.append(_removed(join(parts)))
    if passed:
        gone = _joined(join(passed))
        rows = [(part, 0, pack(c, steps=True)) for part, c in _by_part(gone, _group(gone["doc"], groups))]
        if rows:
            yield _blobs(rows)


def _finish(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    """Removed windows of a group, then the texts that waited for them."""
    parts: list[Columns] = []
    decisions: _Decisions | None = None
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if r["kept"] is None:
                parts.append(unpack(r["blob"], RUN, steps=True))
                continue
            decisions = decisions or _Decisions(parts)
            text = pa.decompress(r["kept"], r["n_bytes"], codec="zstd", asbytes=True)
            (start, count), more = np.frombuffer(r["blob"], np.uint32).reshape(2, -1), decisions.of(r["doc"], r["tag"])
            start, count = np.append(start, more["start"]), np.append(count, more["count"])
            rows.append(_done({"id": r["id"]}, text, start, count, texts))
        if rows:
            yield _outcome(rows)


@contextmanager
def _settings(spark: SparkSession) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", texts: bool = True) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept binary), a row each; ``kept`` holds the bytes
    that stay (null with ``texts=False``).

    A null text counts as the empty one. Rows of one id never remove from each other; null ids come
    after all others. Matches never cross documents. Very long texts are hashed in overlapping pieces.
    """
    spark = docs.sparkSession
    facts = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    repeated = docs.groupBy(id_col).count().where("count > 1").limit(1).count() > 0
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(shuffles, (facts["bytes"] or 0) // PART_BYTES)
    groups = buckets | 1
    last = F.lit((1 << 63) - 1)
    tag = F.xxhash64("text").bitwiseAND(F.lit((1 << 32) - 1)) if repeated else F.lit(0)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(id_col).cast("long"), last).alias("doc"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).select("id", "doc", tag.cast("long").alias("tag"), F.col("text").cast("binary").alias("text"))
    blobs = "part int, kind int, blob binary"
    with _settings(spark):
        runs_found = write_and_read(
            rows.select("doc", "tag", "text")
            .mapInArrow(lambda b: _index(b, buckets), blobs)
            .repartitionById(buckets, F.col("part"))
            .mapInArrow(lambda b: _scan(b, groups), blobs),
            "suffix-runs",
        )
        group = F.pmod(F.col("doc").bitwiseXOR(F.shiftright("doc", 11)), F.lit(groups)).cast("int")
        both = rows.select("id", "doc", "tag", "text", group.alias("part"), F.lit(None).cast("binary").alias("blob"))
        none = F.lit(None).cast("long")
        found = runs_found.select(
            none.alias("id"), none.alias("doc"), none.alias("tag"), F.lit(None).cast("binary").alias("text"), "part", "blob"
        )
        outcome = write_and_read(
            found.unionByName(both)
            .repartitionById(groups, F.col("part"))
            .sortWithinPartitions(F.col("text").isNotNull())
            .select("id", "doc", "tag", "text", "blob")
            .mapInArrow(lambda b: _judge(b, groups, texts), OUTCOME_DDL),
            "suffix-outcome",
        )
        waiting = outcome.where("kind = 'waiting'")
        wide = waiting.agg(F.sum("wide")).first()[0] or 0
        turns = max(1, -(-wide * WINDOW_BYTES * TURN_SHARE // max(1, facts["bytes"] or 0)))
        compared = [
            write_and_read(
                waiting.select("doc", "tag", "n_bytes", "kept", "marks", "wide")
                .mapInArrow(lambda b, turn=turn: _send(b, buckets, turns, turn), blobs)
                .repartitionById(buckets, F.col("part"))
                .mapInArrow(lambda b: _compare(b, groups), blobs),
                "suffix-windows",
            )
            for turn in range(turns)
        ]
    gone = reduce(DataFrame.unionByName, compared).select("part", "blob")
    columns = ["part", "id", "doc", "tag", "n_bytes", "kept", "blob"]
    gone = gone.select("part", *(none.alias(c) for c in columns[1:5]), F.lit(None).cast("binary").alias("kept"), "blob")
    finished = (
        gone.unionByName(waiting.select(*columns))
        .repartitionById(groups, F.col("part"))
        .sortWithinPartitions(F.col("kept").isNotNull())
        .mapInArrow(lambda b: _finish(b, texts), OUTCOME_DDL)
    )
    return (
        outcome.where("kind = 'done'")
        .unionByName(finished)
        .select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
    )
