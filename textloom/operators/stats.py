"""Corpus statistics, running totals and storage totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.formats import safe_ratio


def category_counts(df: DataFrame, category: str = "category") -> DataFrame:
    """Rows per category with the share of all rows in percent, by category name."""
    counts = df.groupBy(F.col(category).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return with_share(counts).orderBy("category")


def with_share(counts: DataFrame, n: str = "n") -> DataFrame:
    """Add each row's share of the sum in percent. Meant for aggregated rows: one task sees all."""
    total = F.sum(n).over(Window.partitionBy())
    return counts.withColumn("pct", safe_ratio(F.col(n), total) * 100)


def breakdown(df: DataFrame, category: str = "category", member: str = "member", compat: bool = False) -> DataFrame:
    """Counts per category and per member of a category in one pass.

    ``level`` is 0 for a member and 1 for a category total. Shares are of the leaf total. With
    ``compat`` they are of the sum over all rows shown, which counts members and totals alike.
    """
    rows = df.groupingSets(
        [[F.col(category), F.col(member)], [F.col(category)]], F.col(category), F.col(member)
    ).agg(F.count(F.lit(1)).alias("n"), F.grouping(member).cast("int").alias("level"))
    rows = rows.select(
        F.col(category).alias("category"),
        F.when(F.col("level") == 0, F.col(member)).alias("member"),
        "level",
        "n",
    )
    counted = F.col("n") if compat else F.when(F.col("level") == 0, F.col("n"))
    total = F.sum(counted).over(Window.partitionBy())
    return rows.withColumn("pct", safe_ratio(F.col("n"), total) * 100)


def running_totals(
    df: DataFrame,
    keys: list[str],
    order: str,
    sums: dict[str, Column],
    lows: dict[str, Column] | None = None,
    block: int = 1_000,
) -> DataFrame:
    """Running sums per key in ``order``, in two levels so that a hot key is spread over tasks.

    Rows are summed within blocks of ``block`` order values; a window over the far smaller table
    of block totals gives each block its start. ``lows`` adds minima over all of a key's rows.
    ``order`` is a unique number.
    """
    lows = lows or {}
    inputs = {**{f"_in_{n}": v for n, v in sums.items()}, **{f"_low_{n}": v for n, v in lows.items()}}
    numbered = df.withColumns({"_block": F.expr(f"`{order}` div {block}"), **inputs})
    blocks = numbered.groupBy(*keys, "_block").agg(
        *[F.sum(f"_in_{n}").alias(f"_all_{n}") for n in sums],
        *[F.min(f"_low_{n}").alias(f"_low_{n}") for n in lows],
    )
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col("_block").alias("_key__block"),
        *[F.coalesce(F.sum(f"_all_{n}").over(before), F.lit(0)).alias(f"_start_{n}") for n in sums],
        *[F.min(f"_low_{n}").over(Window.partitionBy(*keys)).alias(n) for n in lows],
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = numbered.drop(*[f"_low_{n}" for n in lows]).withColumns(
        {f"_in_{n}": F.sum(f"_in_{n}").over(inside) for n in sums}
    )
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in [*keys, "_block"]]
    return local.join(starts, same).select(
        *df.columns, *[(F.col(f"_in_{n}") + F.col(f"_start_{n}")).alias(n) for n in sums], *lows
    )


def storage_totals(files: DataFrame) -> DataFrame:
    """File count, bytes and mean size of an inventory."""
    totals = files.agg(
        F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes")
    )
    return totals.withColumn("mean_bytes", safe_ratio(F.col("total_bytes"), F.col("n_files")))


def fertility(rows: DataFrame, by: str = "language") -> DataFrame:
    """Tokens per word by language from (language, tokens, words): ratio of sums and mean of ratios."""
    ratio = safe_ratio(F.col("tokens"), F.col("words"))
    return rows.groupBy(by).agg(
        F.sum("tokens").alias("tokens"),
        F.sum("words").alias("words"),
        F.count(F.lit(1)).alias("texts"),
        safe_ratio(F.sum("tokens"), F.sum("words")).alias("fertility"),
        F.avg(ratio).alias("mean_fertility"),
    )


def macro_average(per_language: DataFrame, languages: list[str], value: str = "fertility") -> DataFrame:
    """Plain mean of a figure over the named languages (one row per language comes in)."""
    return per_language.where(F.col("language").isin(languages)).agg(
        F.avg(value).alias(f"macro_{value}"), F.count(F.lit(1)).alias("languages")
    )
