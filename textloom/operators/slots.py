"""Exact file slots: each row gets the number of the file that it belongs to, before it is moved.

Files of a dataset hold the same number of rows, all but its last, so their row groups are whole. The
rows of a dataset are taken in the order of a hash of a key that tells them apart. A histogram of hash
ranges gives each range its first position; only the ranges in which a file ends are ranked, by their
keys alone; and a row finds its slot from its range and the few cuts in it. What reaches all tasks is a
row a range of the datasets that need more than one file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import write_and_read

# Hash ranges of a dataset, as a power of two.
RANGE_BITS = 12
# A lookup table of more rows is joined without the broadcast hint.
MAX_LOOKUP = 1_000_000


def place_of_row() -> Column:
    """File and position of a row of a Parquet scan: a key that tells all rows apart, repeated ones too."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def _hinted(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= MAX_LOOKUP else table


def file_slots(df: DataFrame, by: list[str], key: str, rows_per_file: int, slot: str = "slot") -> tuple[DataFrame, int]:
    """``df`` with the number of each row's file, and how many files there are.

    Numbers run from 0 without gaps over all datasets (the values of ``by``, nulls being values), and a
    dataset of n rows has ceil(n / rows_per_file) of them. ``key`` is a column of any ordered type that
    tells rows apart; rows alike in it would stay together. An empty table has no file.
    """
    if rows_per_file < 1:
        raise ValueError("rows_per_file must be positive")
    hashed = F.xxhash64(key)
    group = F.struct(*by)
    keys = df.select(group.alias("g"), F.struct(hashed.alias("h"), F.col(key).alias("k")).alias("at"))
    keys = keys.withColumn("range", F.shiftrightunsigned("at.h", 64 - RANGE_BITS).cast("int"))
    counts = write_and_read(keys.groupBy("g", "range").agg(F.count(F.lit(1)).alias("n")), "slot-ranges")

    # One row a dataset, so the running sum over all of them is small.
    sizes = counts.groupBy("g").agg(F.ceil(F.sum("n") / rows_per_file).cast("bigint").alias("files"))
    before = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    firsts = write_and_read(
        sizes.select("g", "files", F.coalesce(F.sum("files").over(before), F.lit(0)).alias("first")), "slot-files"
    )
    total = firsts.agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]

    earlier = Window.partitionBy("g").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    ranges = counts.withColumn("start", start).withColumns(
        {
            "base": F.floor(F.col("start") / rows_per_file).cast("bigint"),
            "last": F.floor((F.col("start") + F.col("n") - 1) / rows_per_file).cast("bigint"),
        }
    )
    ranges = write_and_read(ranges, "slot-starts")
    cut = ranges.where("base < last").select("g", "range", "start")
    inside = Window.partitionBy("g", "range").orderBy("at")
    ranked = keys.join(_hinted(cut), ["g", "range"]).withColumn("n", F.row_number().over(inside))
    cuts = (
        ranked.where((F.col("n") > 1) & ((F.col("start") + F.col("n") - 1) % rows_per_file == 0))
        .groupBy("g", "range")
        .agg(F.collect_list("at").alias("cuts"))
    )
    lookup = ranges.where("last > 0").join(cuts, ["g", "range"], "left").select("g", "range", "base", "cuts")
    lookup = write_and_read(lookup, "slot-lookup")

    own = {f: f"_slot_{f}" for f in ("g", "range", "base", "cuts", "at")}
    rows = df.withColumns(
        {
            own["g"]: group,
            own["at"]: F.struct(hashed.alias("h"), F.col(key).alias("k")),
            own["range"]: F.shiftrightunsigned(hashed, 64 - RANGE_BITS).cast("int"),
        }
    )
    lookup = lookup.withColumnsRenamed({f: own[f] for f in ("g", "range", "base", "cuts")})
    firsts = firsts.select(F.col("g").alias(own["g"]), F.col("first").alias("_slot_first"))
    rows = rows.join(_hinted(lookup), [own["g"], own["range"]], "left").join(_hinted(firsts), own["g"], "left")
    passed = F.size(F.filter(own["cuts"], lambda c: c <= F.col(own["at"])))
    number = F.col("_slot_first") + F.coalesce(own["base"], F.lit(0)) + F.when(F.col(own["cuts"]).isNull(), 0).otherwise(passed)
    kept = [F.col(c) for c in df.columns if c != slot]
    return rows.select(*kept, number.cast("int").alias(slot)), total


def lay_out(df: DataFrame, by: list[str], key: str, rows_per_file: int) -> DataFrame:
    """``df`` moved once, so that every task holds the rows of one file; the key is dropped.

    Do this to raw texts and encode afterwards: then nothing that encoding adds is moved.
    """
    slot = "_slot"
    numbered, total = file_slots(df, by, key, rows_per_file, slot)
    return numbered.repartitionById(max(total, 1), F.col(slot)).drop(slot, key)
