"""Mixing sources to target weights by budgets that flow down a tree of groups.

A node's token budget is shared among its children by weight. A child that cannot use its share (its
tokens times the allowed epochs are fewer) gets what it has, and the rest goes to its siblings by
weight; only when all siblings are full does it go to the parent's siblings, because a parent is never
given more than its leaves can use. For sorted ratios of supply to weight the shares have a closed
form, so a level is two window sums, without iteration.

A leaf takes whole epochs and then the longest prefix of one more epoch that fits its budget. An epoch
is the leaf's documents in the order of a seeded hash; where the prefix ends is found from a histogram
of hash ranges, and only the range in which it ends is ordered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import write_and_read

# Hex digits of the hash that name a range.
DIGITS = 3
# Budgets are rounded down to whole tokens; shares this close below one count as that one.
CLOSE = 1e-6


def count_words(text: Column) -> Column:
    """Words between the six ASCII blanks; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _share(children: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """``children`` (supply, weight, budget of the parent as ``above``) with their own ``budget``."""
    by = Window.partitionBy(*parent)
    order = by.orderBy("ratio", name)
    full = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return (
        children.withColumn("ratio", F.col("supply") / F.col("weight"))
        .withColumn(
            "level",
            (F.col("above") - F.coalesce(F.sum("supply").over(full), F.lit(0)))
            / F.sum("weight").over(rest),
        )
        # The level rises while children are full and falls after, so its top is where it settles.
        .withColumn("level", F.max("level").over(by))
        .withColumn("budget", F.least(F.col("supply").cast("double"), F.col("weight") * F.col("level")))
        .drop("ratio", "level")
    )


def leaf_budgets(
    leaves: DataFrame,
    levels: Sequence[str],
    weights: Mapping[str, Mapping[str, float]],
    share: float,
    epochs: int,
) -> DataFrame:
    """``leaves`` (the levels' columns, tokens long) with ``budget`` long, in tokens.

    ``weights`` gives a weight by level and name; a name that is not listed, null included, weighs 1,
    and one of weight 0 or below gets nothing. ``share`` of all tokens is the budget of the root.
    """

    def weight(level: str) -> Column:
        out = F.lit(1.0)
        for name, value in weights.get(level, {}).items():
            out = F.when(F.col(level) == name, float(value)).otherwise(out)
        return out

    leaves = leaves.withColumns({f"_w{i}": weight(c) for i, c in enumerate(levels)})
    usable = " AND ".join(["tokens > 0"] + [f"_w{i} > 0" for i in range(len(levels))])
    live = leaves.where(usable).withColumn("supply", F.col("tokens") * epochs)
    sums = leaves.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("all"),
        F.coalesce(F.sum(F.when(F.expr(usable), F.col("tokens") * epochs)), F.lit(0)).alias("supply"),
    ).first()
    above = live.withColumn("above", F.lit(min(share * sums["all"], float(sums["supply"]))))
    # A node is named by its path, in which nulls are names like any other.
    paths = {f"_p{i}": F.to_json(F.struct(*levels[: i + 1])) for i in range(len(levels))}
    above = above.withColumns(paths)
    for i, level in enumerate(levels):
        node, parent = f"_p{i}", [f"_p{i - 1}"] if i else []
        children = above.groupBy(*parent, node, level).agg(
            F.sum("supply").alias("supply"), F.first(f"_w{i}").alias("weight"), F.max("above").alias("above")
        )
        shared = _share(children, parent, level).select(node, F.col("budget").alias("above"))
        above = above.drop("above").join(shared, node)
    leaf = f"_p{len(levels) - 1}"
    budgets = above.select(leaf, F.floor(F.col("above") + CLOSE).cast("long").alias("budget"))
    return (
        leaves.withColumn(leaf, paths[leaf])
        .join(budgets, leaf, "left")
        .select(*levels, "tokens", F.coalesce("budget", F.lit(0)).alias("budget"))
    )


def mix(
    docs: DataFrame,
    levels: Sequence[str],
    weights: Mapping[str, Mapping[str, float]],
    share: float = 0.5,
    epochs: int = 2,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: str | None = None,
) -> DataFrame:
    """(id, the levels' columns, tokens, budget of the leaf, copies), a row for every row of ``docs``.

    ``carry`` names a column, as a struct of whole rows, that is handed on with each row, so that rows
    need not be found again by ids that may repeat or be null.

    ``copies`` says how often the mix holds the document, 0 for not at all. Documents of equal hash
    order (repeated or null ids) follow by tokens. A document without words is taken with the prefix
    that it falls into. An empty table gives an empty one. Only leaves, ranges and the rows of one
    range a leaf are ordered; a leaf with a third of all rows is summed before it is shuffled.
    """
    carried = [] if carry is None else [F.col(carry).alias("carried")]
    rows = docs.select(
        F.col(id_col).alias("id"), *levels, count_words(F.col(text_col)).alias("tokens"), *carried
    )
    rows = write_and_read(rows.withColumn("leaf", F.to_json(F.struct(*levels))), "mix-rows")
    leaves = rows.groupBy("leaf", *levels).agg(F.sum("tokens").alias("tokens"))
    leaves = write_and_read(leaves, "mix-leaves")
    budgets = leaf_budgets(leaves, levels, weights, share, epochs)
    epoch = F.expr("CASE WHEN tokens > 0 THEN budget DIV tokens ELSE 0 END")
    plan = budgets.select(
        F.to_json(F.struct(*levels)).alias("leaf"),
        "budget",
        epoch.alias("epoch"),
        (F.col("budget") - epoch * F.col("tokens")).alias("left"),
    )
    plan = write_and_read(plan, "mix-plan")
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), "epoch", "id"))
    keyed = rows.join(plan, "leaf").withColumn("key", key)
    keyed = keyed.withColumn("range", F.substring("key", 1, DIGITS))
    ranges = keyed.groupBy("leaf", "range").agg(F.sum("tokens").alias("n"), F.max("left").alias("left"))
    running = Window.partitionBy("leaf").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        ranges.withColumn("upto", F.sum("n").over(running))
        .where("upto > left")
        .groupBy("leaf")
        .agg(F.min(F.struct("range", (F.col("upto") - F.col("n")).alias("before"))).alias("end"))
        .select("leaf", F.col("end.range").alias("last"), F.col("end.before").alias("before"))
    )
    ends = write_and_read(ends, "mix-ends")
    placed = keyed.join(ends, "leaf", "left")
    columns = ["id", *levels, "tokens", "budget"] + (["carried"] if carried else [])
    clear = placed.where("last IS NULL OR range <> last").select(
        *columns,
        (F.col("epoch") + F.expr("CASE WHEN last IS NULL OR range < last THEN 1 ELSE 0 END")).alias("copies"),
    )
    inside = (
        Window.partitionBy("leaf").orderBy("key", "tokens").rowsBetween(Window.unboundedPreceding, 0)
    )
    fits = F.col("before") + F.sum("tokens").over(inside) <= F.col("left")
    edge = placed.where("range = last").select(
        *columns, (F.col("epoch") + F.when(fits, 1).otherwise(0)).alias("copies")
    )
    out = clear.unionByName(edge)
    # A leaf that gets nothing takes no documents without words either.
    copies = F.when(F.col("budget") > 0, F.col("copies")).otherwise(0).cast("int")
    out = out.withColumn("copies", copies).withColumnRenamed("id", id_col)
    return out if carry is None else out.withColumnRenamed("carried", carry)
