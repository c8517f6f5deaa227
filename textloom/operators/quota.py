"""Quotas and the takes that fill them.

A take keeps the first rows of each stratum in the order of a numeric key and a tie-break, which is
total. It is a *histogram cut*: key ranges are counted per stratum, the range in which the quota runs
out is split again until it is small, and the key at which each stratum ends is looked up there. The
rows are then one filtered scan: no sort and no shuffle of the data, however large a stratum is.
Rows that share the last key are cut the same way by the tie-break.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from math import floor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from textloom.functions.formats import safe_ratio

# Samples in a vocabulary corpus, and in test mode per dataset.
CORPUS_SAMPLES = 1_000_000
TEST_SAMPLES = 5_000
# Members of the second and third group when none are named.
INDIC_LANGUAGES = ("hi", "ta", "te", "bn", "mr", "gu", "kn")
CODE_LANGUAGES = ("python", "javascript", "html", "css")
# Shares of the vocabulary corpus.
ENGLISH_RATIO, INDIC_RATIO, CODE_RATIO = 0.35, 0.55, 0.10

# Up to this many strata are also named in a plain filter, for partition pruning and pushdown.
_NAMED_STRATA = 1_000
# More strata than this are not gathered; a ranking window takes the same rows instead.
MAX_STRATA = 100_000
_RANGES = 1_024
_SMALL_RANGE = 50_000

PLAN_SCHEMA = StructType(
    [
        StructField("category", StringType(), False),
        StructField("stratum", StringType(), False),
        StructField("quota", LongType(), False),
    ]
)


@dataclass(frozen=True)
class Group:
    """A share of a corpus and the strata that split it evenly."""

    category: str
    ratio: float
    members: Sequence[str]


def vocabulary_groups() -> list[Group]:
    """The default mix of the vocabulary corpus."""
    return [
        Group("english", ENGLISH_RATIO, ("en",)),
        Group("indic", INDIC_RATIO, INDIC_LANGUAGES),
        Group("code", CODE_RATIO, CODE_LANGUAGES),
    ]


def group_quotas(total: int, groups: Sequence[Group]) -> list[tuple[str, str, int]]:
    """(category, stratum, quota): a group's share cut to whole rows, then split; remainders go."""
    return [
        (g.category, member, int(total * g.ratio) // len(g.members))
        for g in groups
        for member in g.members
    ]


def weight_quotas(total: int, weights: dict[str, float], category: str = "mix") -> list[tuple[str, str, int]]:
    """One stratum per weight, each cut to whole rows."""
    return [(category, name, floor(total * w)) for name, w in weights.items()]


def plan_table(spark: SparkSession, rows: Sequence[tuple[str, str, int]]) -> DataFrame:
    """A quota plan as a table."""
    return spark.createDataFrame(list(rows), PLAN_SCHEMA)


def _per_stratum(spark: SparkSession, rows: list[tuple], **types: pa.DataType) -> DataFrame:
    """A table with one row per stratum; broadcast only while there are at most MAX_STRATA.

    Arrow makes it a local relation, so joining it costs no job of its own.
    """
    columns = {name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(types.items())}
    table = spark.createDataFrame(pa.table(columns))
    return F.broadcast(table) if len(rows) <= MAX_STRATA else table


_LAST_KEY = 2**63 - 1


def _name(stratum: str | Sequence[str]) -> Column:
    """One text for a stratum; nulls are names of their own."""
    columns = [stratum] if isinstance(stratum, str) else list(stratum)
    return F.to_json(F.struct(*columns)) if len(columns) > 1 else F.coalesce(F.concat(F.lit("="), columns[0]), F.lit(""))


def stratum_name(*values: str | None) -> str:
    """The text that a stratum has in a plan, for one value or for none."""
    (value,) = values
    return "" if value is None else f"={value}"


def _place(key: str) -> Column:
    """What rows are ordered by: the key, null after all others."""
    return F.coalesce(F.col(key).cast("bigint"), F.lit(_LAST_KEY))


def _tie_break(df: DataFrame, key: str) -> Column:
    """Orders rows of one key: a hash of all other columns, the same for equal rows only."""
    others = sorted(f.name for f in df.schema.fields if f.name != key and f.dataType.typeName() != "map")
    return F.xxhash64(*others) if others else F.lit(0).cast("bigint")


def _window_take(
    df: DataFrame, quotas: DataFrame, top: int, stratum: str | Sequence[str], key: str
) -> DataFrame:
    """The take by ranking; the same rows as the cut. ``quotas`` has (_s, _quota), ``top`` at most."""
    order = Window.partitionBy("_s").orderBy(_place(key), _tie_break(df, key))
    ranked = df.withColumn("_s", _name(stratum)).withColumn("_rank", F.row_number().over(order))
    ranked = ranked.where(F.col("_rank") <= top)  # a plain bound, by which Spark limits the window
    return ranked.join(quotas, "_s").where(F.col("_rank") <= F.col("_quota")).select(*df.columns)


@dataclass
class _Open:
    """A stratum whose end is still being looked for, inside keys ``low`` to ``high``."""

    low: int
    high: int
    left: int

    @property
    def width(self) -> int:
        return -(-(self.high - self.low + 1) // _RANGES)

    def part(self, number: int, left: int) -> _Open:
        """The key range with this number, in which ``left`` rows are still wanted."""
        low = self.low + number * self.width
        return _Open(low, min(self.high, low + self.width - 1), left)


def _range_of(key: str, low: str, width: str) -> Column:
    """Number of the key range a key falls in (whole division of decimals: wide keys do not overflow)."""
    wide = "decimal(20,0)"
    return F.expr(f"cast((cast({key} as {wide}) - cast({low} as {wide})) div cast({width} as {wide}) as int)")


@dataclass(frozen=True)
class Cut:
    """Where a stratum ends: its last key, and how many rows of that key it keeps (None: all)."""

    last: int
    room: int | None


def cut_keys(keyed: DataFrame, quotas: dict[str, int]) -> dict[str, Cut | None]:
    """The end of each stratum of ``keyed`` (s text, k bigint); None when all of its rows fit.

    What comes to the driver is bounded by the number of strata times ``_RANGES`` and by one row for
    each stratum in the last step. A key that many rows share ends the search like any other.
    """
    spark = keyed.sparkSession

    def inside(spans: DataFrame, open_spans: dict[str, _Open]) -> DataFrame:
        # The outer bounds are plain values, so that sorted files are skipped.
        low, high = min(o.low for o in open_spans.values()), max(o.high for o in open_spans.values())
        near = keyed.where(F.col("k").between(low, high)).join(spans, "s")
        return near.where(F.col("k").between(F.col("lo"), F.col("hi")))

    bounds = keyed.groupBy("s").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("k").alias("n"))
    bounds = bounds.join(_per_stratum(spark, [(s,) for s in quotas], s=pa.string()), "s")
    cuts: dict[str, Cut | None] = {s: None for s in quotas}
    open_strata: dict[str, _Open] = {}
    small: dict[str, _Open] = {}

    def wait(s: str, span: _Open, n: int) -> None:
        if span.low == span.high:
            cuts[s] = Cut(span.low, span.left)
        else:
            (small if n <= _SMALL_RANGE else open_strata)[s] = span

    for row in bounds.collect():
        if quotas[row.s] <= 0:
            cuts[row.s] = Cut(row.lo, 0)
        elif quotas[row.s] < row.n:
            wait(row.s, _Open(row.lo, row.hi, quotas[row.s]), row.n)
    while open_strata:
        spans = _per_stratum(
            spark,
            [(s, o.low, o.high, o.left, Decimal(o.width)) for s, o in open_strata.items()],
            s=pa.string(),
            lo=pa.int64(),
            hi=pa.int64(),
            left=pa.int64(),
            width=pa.decimal128(20, 0),
        )
        histogram = inside(spans, open_strata).groupBy(
            "s", "left", _range_of("k", "lo", "width").alias("range")
        ).agg(F.count(F.lit(1)).alias("n"))
        running = F.sum("n").over(
            Window.partitionBy("s").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
        )
        edge = (
            histogram.withColumn("upto", running)
            .where((F.col("upto") >= F.col("left")) & (F.col("upto") - F.col("n") < F.col("left")))
            .select("s", "range", "n", (F.col("left") - F.col("upto") + F.col("n")).alias("left"))
        )
        for row in edge.collect():
            found = open_strata.pop(row.s).part(row["range"], row.left)
            if row.n == row.left:
                cuts[row.s] = Cut(found.high, None)
            else:
                wait(row.s, found, row.n)
    if small:
        spans = _per_stratum(
            spark,
            [(s, o.low, o.high, o.left) for s, o in small.items()],
            s=pa.string(),
            lo=pa.int64(),
            hi=pa.int64(),
            left=pa.int64(),
        )
        counted = inside(spans, small).groupBy("s", "left", "k").agg(F.count(F.lit(1)).alias("n"))
        running = F.sum("n").over(
            Window.partitionBy("s").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
        )
        before = F.col("upto") - F.col("n")
        ends = (
            counted.withColumn("upto", running)
            .where((F.col("upto") >= F.col("left")) & (before < F.col("left")))
            .select("s", "k", (F.col("left") - before).alias("room"), "n")
        )
        cuts.update({r.s: Cut(r.k, None if r.room == r.n else r.room) for r in ends.collect()})
    return cuts


def _cut_take(df: DataFrame, quotas: dict[str, int], stratum: str | Sequence[str], key: str) -> DataFrame:
    """Rows before each stratum's last key, and of the rows at that key the first by tie-break.

    Ties are cut by the same search over the tie-break. Only rows that are equal in every column
    are told apart by a ranking window.
    """
    spark = df.sparkSession
    named = df.withColumns({"_s": _name(stratum), "_k": _place(key)})
    cuts = cut_keys(named.select(F.col("_s").alias("s"), F.col("_k").alias("k")), quotas)
    names = {s[1:] for s in quotas if s[:1] == "="}
    if isinstance(stratum, str) and "" not in quotas and len(names) <= _NAMED_STRATA:
        # Other strata go early, where the scan can skip them.
        named = named.where(F.col(stratum).isin([s[1:] for s, q in quotas.items() if q > 0]))
    if cuts and None not in cuts.values() and max(c.last for c in cuts.values()) < _LAST_KEY:
        named = named.where(F.col(key) <= max(c.last for c in cuts.values()))
    ends = [(s, *((c.last, c.room) if c else (None, None))) for s, c in cuts.items()]
    table = _per_stratum(spark, ends, _s=pa.string(), _last=pa.int64(), _room=pa.int64())
    joined = named.join(table, "_s")
    whole = F.col("_last").isNull() | (F.col("_k") < F.col("_last"))
    whole = whole | ((F.col("_k") == F.col("_last")) & F.col("_room").isNull())
    kept = joined.where(whole).select(*df.columns)
    rooms = {s: c.room for s, c in cuts.items() if c is not None and c.room}
    if not rooms:
        return kept
    keys = {s: cuts[s].last for s in rooms}
    ties = _per_stratum(spark, list(keys.items()), _s=pa.string(), _last=pa.int64())
    tied = named.where(F.col("_k").between(min(keys.values()), max(keys.values()))).join(ties, "_s")
    tied = tied.where(F.col("_k") == F.col("_last")).withColumn("_tie", _tie_break(df, key))
    inner = cut_keys(tied.select(F.col("_s").alias("s"), F.col("_tie").alias("k")), rooms)
    ends = [(s, *((c.last, c.room) if c else (None, None))) for s, c in inner.items()]
    table = _per_stratum(spark, ends, _s=pa.string(), _end=pa.int64(), _left=pa.int64())
    tied = tied.join(table, "_s").where("_end IS NULL OR _tie <= _end")
    kept = kept.unionByName(tied.where("_end IS NULL OR _tie < _end OR _left IS NULL").select(*df.columns))
    if any(c is not None and c.room for c in inner.values()):
        order = Window.partitionBy("_s").orderBy("_tie")
        equal = tied.where("_tie = _end AND _left IS NOT NULL").withColumn("_rank", F.row_number().over(order))
        kept = kept.unionByName(equal.where("_rank <= _left").select(*df.columns))
    return kept


def stratified_take(
    df: DataFrame,
    quotas: dict[str | None, int],
    stratum: str = "stratum",
    key: str = "doc_id",
    method: str = "cut",
) -> DataFrame:
    """The first ``quotas[s]`` rows of each stratum ``s`` by a numeric key.

    The order is total: null keys come last, rows of one key follow by a hash of their other columns.
    None names the stratum of nulls; strata without a quota are dropped. ``method`` is ``cut`` or
    ``window``, a ranking that Spark can limit before its shuffle; both take the same rows.
    """
    return _take(df, {stratum_name(s): q for s, q in quotas.items()}, stratum, key, method)


def _take(
    df: DataFrame, quotas: dict[str, int], stratum: str | Sequence[str], key: str, method: str
) -> DataFrame:
    if method == "cut" and len(quotas) <= MAX_STRATA:
        return _cut_take(df, quotas, stratum, key)
    if method not in ("cut", "window"):
        raise ValueError(f"unknown method: {method}")
    plan = _per_stratum(df.sparkSession, list(quotas.items()), _s=pa.string(), _quota=pa.int64())
    return _window_take(df, plan, max(quotas.values(), default=0), stratum, key)


def take_with_room(
    df: DataFrame, room: DataFrame, stratum: Sequence[str], key: str = "doc_id"
) -> DataFrame:
    """A take whose quotas are a table: the stratum's columns and ``room`` (negative counts as 0).

    Up to MAX_STRATA quotas are gathered for the cut; more stay a table and rows are ranked, which
    takes the same rows.
    """
    named = room.select(_name(stratum).alias("_s"), F.greatest("room", F.lit(0)).alias("_quota"))
    rows = named.limit(MAX_STRATA + 1).collect()
    if len(rows) > MAX_STRATA:
        top = named.agg(F.max("_quota")).first()[0]
        return _window_take(df, named, top, stratum, key)
    return _cut_take(df, {r["_s"]: r["_quota"] for r in rows}, stratum, key)


def take_per_dataset(
    df: DataFrame, max_samples: int = TEST_SAMPLES, dataset: str = "dataset", key: str = "doc_id"
) -> DataFrame:
    """At most ``max_samples`` rows per dataset, a null dataset being one of them.

    Dataset names come from the data; the default is the limit of test mode.
    """
    room = df.select(dataset).distinct().withColumn("room", F.lit(max_samples).cast("bigint"))
    return take_with_room(df, room, [dataset], key)


def attainment(plan: DataFrame, taken: DataFrame, stratum: str = "stratum") -> DataFrame:
    """How far each quota was filled. Shortfall is reported, not spread over other strata."""
    counts = taken.groupBy(F.col(stratum).alias("stratum")).agg(F.count(F.lit(1)).alias("n"))
    collected = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    return (
        plan.join(counts, "stratum", "left")
        .withColumn("collected", collected)
        .select(
            "category",
            "stratum",
            "quota",
            "collected",
            (F.col("quota") - F.col("collected")).alias("shortfall"),
            safe_ratio(F.col("collected"), F.col("quota")).alias("attainment"),
        )
    )
