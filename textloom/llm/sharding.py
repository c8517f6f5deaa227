"""Shards of near equal size: the minimax partition of ordered atomic groups into runs.

Groups (rows of equal text) are ordered by a 64-bit hash of the text. The smallest capacity for which
a greedy pass needs no more than the wanted number of shards is found by binary search, and the
greedy pass with that capacity gives the cuts.

The ordered list is never on the driver. The search sees sums over ranges of the hash: a range with
more than one group can be cut later, so a pass that treats ranges as atomic gives an upper bound and
one that splits them freely a lower bound of where each cut can fall. Only the ranges between the two
bounds are read again, 64 times finer, until none of them holds more than one group. The result is
that of the search over all groups.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import write_and_read

# First ranges (bits of the hash), bits added in each round, and the slots' counting buckets.
FIRST_BITS, MORE_BITS = 12, 6
SLOT_BUCKETS = 256
# Ranges on the driver at most; reached only if thousands of shards are asked for.
MAX_RANGES = 1 << 18

# A range: (first hash position, bits, bytes, groups, largest group)
Range = tuple[int, int, int, int, int]


def _position(bits: int) -> str:
    """The first ``bits`` bits of ``h`` taken as an unsigned number."""
    return f"shiftrightunsigned(h, {64 - bits})"


def _sums(groups: DataFrame, bits: int) -> list[Range]:
    rows = (
        groups.groupBy(F.expr(_position(bits)).alias("p"))
        .agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.max("size").alias("most"))
        .collect()  # one row a range, at most MAX_RANGES
    )
    return sorted((r["p"] << (64 - bits), bits, int(r["size"]), r["n"], int(r["most"])) for r in rows)


def _greedy(ends: list[int], capacity: int, shards: int) -> list[int]:
    """Positions after each shard's last range when every range is atomic."""
    cuts, at = [], 0
    for _ in range(shards):
        done = ends[at - 1] if at else 0
        at = bisect_left(ends, done + capacity + 1, lo=at)
        cuts.append(at)
    return cuts


def _least_capacity(ranges: list[Range], shards: int) -> int:
    """The smallest capacity with which a greedy pass over atomic ranges takes all of them."""
    ends = list(accumulate(r[2] for r in ranges))
    total = ends[-1]
    low = max(max(r[2] for r in ranges), -(-total // shards))
    high = total
    while low < high:
        middle = (low + high) // 2
        if _greedy(ends, middle, shards)[-1] == len(ranges):
            high = middle
        else:
            low = middle + 1
    return low


def _open_ranges(ranges: list[Range], shards: int) -> set[int]:
    """Ranges of several groups in which a cut can fall, by the bounds of every cut.

    With the least capacity between ``low`` and ``high``, cut j lies between the atomic pass with
    ``low`` and the freely splitting pass with ``high``; a range of one group is never split.
    """
    ends = list(accumulate(r[2] for r in ranges))
    total = ends[-1]
    high = _least_capacity(ranges, shards)
    low = max(max(r[4] for r in ranges), -(-total // shards))
    least = _greedy(ends, low, shards)
    out: set[int] = set()
    reach = 0
    for j in range(shards):
        reach = min(total, reach + high)
        last = bisect_left(ends, reach)
        if last < len(ranges) and ranges[last][3] == 1 and ends[last] != reach:
            reach = ends[last - 1] if last else 0
        out.update(i for i in range(least[j], min(last + 1, len(ranges))) if ranges[i][3] > 1)
    return out


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """(capacity, first hash position of shards 1, 2, ...) for a table (h, size) of distinct h.

    Positions are unsigned; a shard without groups starts where the next one does.
    """
    ranges = _sums(groups, FIRST_BITS)
    if not ranges:
        return 0, [1 << 64] * (shards - 1)
    while todo := _open_ranges(ranges, shards):
        finer = []
        for bits in sorted({ranges[i][1] for i in todo}):
            starts = [ranges[i][0] >> (64 - bits) for i in todo if ranges[i][1] == bits]
            part = groups.where(F.expr(_position(bits)).isin(starts))
            finer += _sums(part, min(64, bits + MORE_BITS))
        ranges = sorted([r for i, r in enumerate(ranges) if i not in todo] + finer)
        if len(ranges) > MAX_RANGES:
            raise ValueError(f"{shards} shards need more than {MAX_RANGES} ranges")
    capacity = _least_capacity(ranges, shards)
    cuts = _greedy(list(accumulate(r[2] for r in ranges)), capacity, shards)
    return capacity, [ranges[c][0] if c < len(ranges) else 1 << 64 for c in cuts[:-1]]


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id") -> DataFrame:
    """(id, size long, text_crc32 long, law, shard int, slot long, grown_shard int), a row each.

    Size is the UTF-8 bytes of ``text`` plus 8; a null text counts as the empty one. Equal texts share
    a shard (as do texts of one 64-bit hash). ``slot`` counts the rows of a shard from 0. Rows are
    counted in buckets of the id's hash, so that no task orders a whole shard; an id that is repeated
    or null gets slots like any other. An empty table gives an empty one.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col(id_col),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
    )
    rows = write_and_read(rows, "shard-rows")
    groups = write_and_read(rows.groupBy("h").agg(F.sum("size").alias("size")), "shard-groups")
    _, cuts = minimax_cuts(groups, shards)
    # Unsigned order is signed order after the highest bit is flipped.
    signed = [c - (1 << 63) for c in cuts if c < 1 << 64]
    flipped = F.expr("h ^ -9223372036854775808")
    shard = F.lit(0)
    for c in signed:
        shard = shard + F.when(flipped >= F.lit(c), 1).otherwise(0)
    rows = rows.withColumns(
        {
            "shard": shard.cast("int"),
            "bucket": F.pmod(F.xxhash64(id_col, "text_crc32"), F.lit(SLOT_BUCKETS)),
        }
    )
    # At most shards x SLOT_BUCKETS rows.
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .drop("n")
    )
    inside = Window.partitionBy("shard", "bucket").orderBy(id_col, "text_crc32")
    return rows.join(F.broadcast(starts), ["shard", "bucket"]).select(
        id_col,
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("start") + F.row_number().over(inside) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
