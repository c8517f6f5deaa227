"""URL filter on a Bloom filter cascade: exact membership for a known universe, without a join.

Level 0 encodes the listed keys. Level 1 encodes the unlisted keys of the universe that pass level 0
by mistake, level 2 the listed keys that pass level 1 by mistake, and so on until no mistake is
left. A key is judged by the first level that it fails, so over the universe the answer is exact.
All of it is DataFrame code: bit positions are ``xxhash64`` columns, a level is a ``bit_or``
aggregate, and the test is an expression over a constant array.

A level is sent to every task, so its size is bounded. Keys of a longer list are dealt by a hash to
parts with a cascade each, and the rows of a part are judged by its cascade in a job of their own: a
task never holds more than one cascade, however long the list.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from textloom.session import drop_path, fresh_path, read_table, write_and_read

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bits a key and hashes, for level 0 and for the levels of mistakes.
FIRST = (10, 5)
LATER = (4, 2)
# A level is sent to every task, so its words are bounded; longer lists are dealt to several cascades.
MAX_WORDS = 1 << 17
MAX_LEVELS = 64
# Names the hash that deals keys to parts; level numbers, which name the others, are not negative.
PART_SEED = -1
# Share of a level's bound that parts are planned to fill: a hash does not deal them evenly.
FILL = 0.75


@dataclass(frozen=True)
class Level:
    number: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def passes(self, key: Column) -> Column:
        """True if the level may hold ``key``."""
        words = F.lit(list(self.words))
        tests = [
            F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), F.pmod(p, F.lit(64)).cast("int"))
            == 1
            for p in _positions(key, self.number, self.bits, self.hashes)
        ]
        return reduce(lambda a, b: a & b, tests)


def _positions(key: Column, number: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(number), F.lit(i), key), F.lit(bits)) for i in range(hashes)]


def _level(keys: DataFrame, number: int) -> Level | None:
    """The level that encodes ``keys``; None if there are none."""
    n = keys.count()
    if not n:
        return None
    per_key, hashes = LATER if number else FIRST
    bits = max(64, n * per_key)
    size = -(-bits // 64)
    if size > MAX_WORDS:
        raise TooLong(f"{n} keys need {size} words; {MAX_WORDS} are allowed")
    positions = F.explode(F.array(*_positions(F.col("key"), number, bits, hashes)))
    found = (
        keys.select(positions.alias("p"))
        .groupBy(F.shiftright("p", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(p % 64 AS INT))")).alias("bits"))
        .collect()  # at most MAX_WORDS rows
    )
    words = [0] * size
    for r in found:
        words[r["word"]] = r["bits"]
    return Level(number, bits, hashes, tuple(words))


class TooLong(ValueError):
    """The list does not fit the bound of a level."""


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        """Whether ``key`` is listed; exact for keys of the universe, false for null."""
        if not self.levels:
            return F.lit(False)
        # A key that passes every level belongs to the side of the last one.
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = F.when(level.passes(key), answer).otherwise(F.lit(level.number % 2 == 1))
        return F.coalesce(key.isNotNull() & answer, F.lit(False))


def build_cascade(universe: DataFrame, label: str = "cascade") -> Cascade:
    """The cascade of a table (key string, listed boolean) of distinct keys that are not null.

    Raises :class:`TooLong` if a level would exceed ``MAX_WORDS``. An empty list gives a cascade
    without levels, which contains nothing.
    """
    left = {side: universe.where("listed" if side else "NOT listed") for side in (True, False)}
    levels: list[Level] = []
    for number in range(MAX_LEVELS):
        level = _level(left[number % 2 == 0], number)
        if level is None:
            return Cascade(tuple(levels))
        levels.append(level)
        other = number % 2 == 1
        left[other] = left[other].where(level.passes(F.col("key")))
    raise RuntimeError("the cascade did not end")


def universe_of(keys: DataFrame, listed: DataFrame) -> DataFrame:
    """All distinct keys of the corpus and the list, marked, written once.

    ``keys`` and ``listed`` have one string column ``key``. The keys are combined before the shuffle,
    so a key that holds a third of the corpus is one row of each task.
    """
    both = keys.select("key", F.lit(False).alias("listed")).unionByName(
        listed.select("key", F.lit(True).alias("listed"))
    )
    marked = both.where("key IS NOT NULL").groupBy("key").agg(F.max("listed").alias("listed"))
    return write_and_read(marked, "url-keys")


def parts_needed(universe: DataFrame) -> int:
    """Parts of the keys whose first two levels are expected to fit the bound."""
    sizes = universe.agg(F.count_if("listed").alias("listed"), F.count_if(~F.col("listed")).alias("rest")).first()
    per_key, hashes = FIRST
    # A level with this many bits a key and hashes passes this share of other keys by mistake.
    mistakes = sizes["rest"] * (1 - math.exp(-hashes / per_key)) ** hashes
    words = max(sizes["listed"] * per_key, mistakes * LATER[0]) / 64
    return 1 if words <= MAX_WORDS else math.ceil(words / (MAX_WORDS * FILL))


def mark_listed(
    df: DataFrame, keys: Mapping[str, Column], universe: DataFrame, label: str = "cascade"
) -> DataFrame:
    """``df`` with a boolean column for every name in ``keys``: is that key listed in ``universe``?

    One cascade does it inside the scan. Where a list needs several, rows are written by the part of
    their key, and each part is read back, judged by its cascade and written: no join and no shuffle.
    A part that turns out too long has all keys dealt anew, to twice as many.
    """
    parts = parts_needed(universe)
    while True:
        try:
            if parts == 1:
                cascade = build_cascade(universe, label)
                return df.withColumns({name: cascade.contains(key) for name, key in keys.items()})
            return _mark_by_parts(df, keys, universe, parts, label)
        except TooLong:
            parts *= 2


def _part(key: Column, parts: int) -> Column:
    """The part of a key; null has one too."""
    return F.pmod(F.xxhash64(F.lit(PART_SEED), key), F.lit(parts)).cast("int")


def _write_parts(df: DataFrame, key: Column, parts: int, label: str) -> tuple[str, Callable[[int], DataFrame]]:
    """``df`` written with a folder for every part of ``key``; returns the path and a reader of one part."""
    spark, column = df.sparkSession, f"part_{uuid.uuid4().hex}"
    path = fresh_path(spark, label)
    df.withColumn(column, _part(key, parts)).write.partitionBy(column).parquet(path)
    schema = StructType([*df.schema.fields, StructField(column, IntegerType())])
    rows = read_table(spark, path, schema)
    return path, lambda part: rows.where(F.col(column) == part).select(*df.columns)


def _mark_by_parts(
    df: DataFrame, keys: Mapping[str, Column], universe: DataFrame, parts: int, label: str
) -> DataFrame:
    spark = df.sparkSession
    listed_path, listed = _write_parts(universe, F.col("key"), parts, f"{label}-keys")
    named = {f"key_{uuid.uuid4().hex}": (name, key) for name, key in keys.items()}
    # Keys are computed first: a name may replace a column that another key reads.
    df = df.withColumns({column: key for column, (_, key) in named.items()})
    for column, (name, _) in named.items():
        path, rows = _write_parts(df, F.col(column), parts, f"{label}-rows")
        out = fresh_path(spark, f"{label}-marked")
        for part in range(parts):
            cascade = build_cascade(listed(part), label)
            marked = rows(part).withColumn(name, cascade.contains(F.col(column)))
            marked.write.parquet(f"{out}/{part}")
        df = spark.read.schema(marked.schema).option("recursiveFileLookup", True).parquet(out)
        drop_path(spark, path)
    drop_path(spark, listed_path)
    return df.drop(*named)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def filter_urls(
    pages: DataFrame, rules: Mapping[str, str], blocked_hosts: DataFrame, url_col: str = "url"
) -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    ``rules`` maps ``host/path`` to ``allow`` or ``block``. A rule fits its host and all subdomains
    where the path starts with the rule's; the longest wins. Where none fits, the verdict is
    ``block`` for a host in ``blocked_hosts`` (column ``key``) and ``allow`` for any other, the
    empty host of a url without ``://`` included.

    The keys of a url are its host suffixes and path prefixes of the lengths that rules have. Both
    actions and the host list have a cascade each over all such keys of the corpus. Columns of the
    same names are replaced, others are kept, whatever they are called; repeated rows stay repeated.
    """
    own = f"url_{uuid.uuid4().hex}"
    parts = [rule.partition("/") for rule in rules]
    labels = sorted({host.count(".") + 1 for host, _, _ in parts})
    lengths = sorted({len(path) + 1 for _, _, path in parts})
    pages = pages.drop("host", "path", "rule", "verdict")
    pages = pages.withColumns({"host": url_host(F.col(url_col)), "path": url_path(F.col(url_col))})
    keys = {
        f"{own}_key_{n}_{m}": F.when(
            F.length("path") >= m,
            F.concat(F.substring_index("host", ".", -n), F.substring("path", 1, m)),
        )
        for n in labels
        for m in lengths
    }
    spark = pages.sparkSession
    hosts = pages.select("host", "path").distinct()
    hosts = write_and_read(hosts, "url-hosts")
    all_keys = hosts.select(F.explode(F.array(*keys.values())).alias("key"))
    out = pages.withColumns(keys)
    found = []
    for action in ("allow", "block"):
        listed = [(rule,) for rule, a in rules.items() if a == action]
        universe = universe_of(all_keys, spark.createDataFrame(listed, "key string"))
        marks = {f"{name}_{action}": F.col(name) for name in keys}
        out = mark_listed(out, marks, universe)
        found += [
            F.when(
                F.col(mark),
                F.struct(F.length(key).alias("n"), key.alias("rule"), F.lit(action).alias("verdict")),
            )
            for mark, key in marks.items()
        ]
    universe = universe_of(hosts.select(F.col("host").alias("key")), blocked_hosts)
    out = mark_listed(out, {f"{own}_listed": F.col("host")}, universe)
    best = F.array_max(F.array_compact(F.array(*found)))
    out = out.withColumn(f"{own}_best", best)
    other = F.when(F.col(f"{own}_listed"), "block").otherwise("allow")
    verdict = F.coalesce(f"{own}_best.verdict", other)
    kept = [c for c in pages.columns]
    return out.withColumns({"rule": F.col(f"{own}_best.rule"), "verdict": verdict}).select(
        *kept, "rule", "verdict"
    )


def insecure_hosts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """(key): the hosts that no page of the corpus names by https. The empty host is never listed."""
    return (
        pages.select(
            url_host(F.col(url_col)).alias("key"), F.col(url_col).startswith("https://").alias("safe")
        )
        .where("key <> ''")
        .groupBy("key")
        .agg(F.max("safe").alias("safe"))
        .where("NOT safe")
        .select("key")
    )
