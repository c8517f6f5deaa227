"""Connected components: of a link table, as Spark jobs that alternate two star contractions, and of
the links found within one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import drop_path, fresh_path, read_table

# Rounds grow with the logarithm of the longest chain; this bound is only a guard against a bug.
MAX_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _contract(edges: DataFrame, larger: bool) -> DataFrame:
    """Every node's neighbours are linked to the least id among them and itself.

    ``larger`` takes the neighbours above the node, else those below. The least id is a partially
    combined aggregate and comes back by a join whose large keys Spark can split, so a node with a
    third of all links is in no single task.
    """
    around = _both_ways(edges) if larger else edges
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    side = around.where("v > u") if larger else around
    pairs = side.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not larger:
        pairs = pairs.unionByName(least.select("u", F.col("m").alias("v")))
    return pairs.where("u > v").distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component): the least node that is reachable, for every node that has a link.

    ``edges`` holds two long columns u and v. Self links and nulls are dropped, an empty table gives
    an empty one. Lineage is cut by a table in the shared folder after each round.
    """
    edges = (
        edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    spark = edges.sparkSession

    def written(links: DataFrame) -> tuple[DataFrame, str]:
        path = fresh_path(spark, label)
        links.write.parquet(path)
        return read_table(spark, path, links.schema), path

    edges, path = written(edges)
    mark = None
    for _ in range(MAX_ROUNDS):
        before = path
        edges, path = written(_contract(_contract(edges, True), False))
        drop_path(spark, before)
        # Equal sums of both ends and equal counts: no link moved in this round.
        now = edges.agg(
            F.count("*"),
            F.sum(F.col("v").cast("decimal(38,0)")),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        ).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def merge_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least reachable position of each, after the links (a, b) are added."""
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            break
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        root = root.copy()
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(root, root[root]):
            root = root[root]
    return root
