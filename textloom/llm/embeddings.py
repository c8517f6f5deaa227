"""Embedding near-dedup: exact cosine links by tiled comparison in PCA order.

Vectors are scaled to length one and rotated to the axes of their second moment, largest first, so that
a few leading dimensions hold most of a product. A tile of pairs adds up leading dimensions; what the
others can add is at most the product of the two suffix norms, and a pair is dropped as soon as that
cannot reach the threshold. The few that are left are judged by the cosine of the given vectors in
double precision.

Which blocks are compared at all follows from the leading axis: linked vectors differ there by at most
the chord of the threshold, so the axis is cut into cells of that width and a cell meets itself and the
next. A crowded cell, or a label with a third of all rows, is split by a hash into blocks of bounded
size whose pairs are tasks of their own. Equal vectors are one row before all this, and a task returns
counts and a forest, never its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.components import components, merge_roots
from textloom.session import write_and_read

THRESHOLD = 0.98
# Dimensions after which a pair can be dropped; rows of a block, on average; rows of a tile's side.
STEPS = (8, 16, 32)
BLOCK_ROWS, TILE_ROWS = 4096, 512
# Slack for rounding in the rotated products and on the leading axis.
SLACK = 1e-9


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, lengths, good) of a list column: good vectors are not null, finite and not zero."""
    lengths = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    flat = column.flatten()
    bad = np.asarray(flat.is_null())
    values = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    bad = bad | ~np.isfinite(values)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    broken = np.bincount(owner[bad], minlength=len(lengths)) > 0
    filled = np.bincount(owner[values != 0], minlength=len(lengths)) > 0
    return values, lengths, ~broken & filled


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, safe for very large and very small values."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest for every vector that can link; null for the others."""
    for batch in batches:
        values, lengths, good = _matrix(batch.column("embedding"))
        good &= ~np.asarray(batch.column("label").is_null())
        ends = np.cumsum(lengths)
        values += 0.0  # no negative zero
        keys = [
            hashlib.blake2b(values[e - n : e].tobytes(), digest_size=16).digest() if g else None
            for e, n, g in zip(ends.tolist(), lengths.tolist(), good.tolist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, "key"])


def _by_width(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, unit vectors) of the rows of each length."""
    values, lengths, _ = _matrix(column)
    starts = np.cumsum(lengths) - lengths
    for width in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == width)
        yield at, _unit(values[starts[at][:, None] + np.arange(width)])


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for _, x in _by_width(batch.column("embedding")):
            sums[x.shape[1]] = sums.get(x.shape[1], 0) + x.T @ x
    widths = pa.array(list(sums), pa.int32())
    rows = pa.array([m.ravel().tolist() for m in sums.values()], pa.list_(pa.float64()))
    yield pa.RecordBatch.from_arrays([widths, rows], ["width", "moment"])


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Axes (columns, largest first) of the second moment, for each length of vector.

    Every task sums its rows; the sums are added in Spark, so width squared numbers reach the driver.
    """
    rows = (
        classes.select("embedding")
        .mapInArrow(_moments, "width int, moment array<double>")
        .select("width", F.posexplode("moment").alias("at", "value"))
        .groupBy("width", "at")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    out = {}
    for width in {r["width"] for r in rows}:
        moment = np.zeros(width * width)
        for r in rows:
            if r["width"] == width:
                moment[r["at"]] = r["value"]
        _, axes = np.linalg.eigh(moment.reshape(width, width))
        out[width] = axes[:, ::-1].copy()
    return out


def tile_links(
    x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Positions (rows of x, rows of y) of the pairs with a cosine of ``threshold`` or more.

    ``px`` and ``py`` are the rows scaled to length one and rotated; ``x`` and ``y`` as given.
    """
    width = px.shape[1]
    steps = [s for s in STEPS if s < width] + [width]
    tail = lambda p, s: np.sqrt((p[:, s:] ** 2).sum(axis=1))
    bound = threshold - SLACK
    product = px[:, : steps[0]] @ py[:, : steps[0]].T
    a, b = np.nonzero(product + tail(px, steps[0])[:, None] * tail(py, steps[0])[None, :] >= bound)
    sums = product[a, b]
    for low, high in zip(steps, steps[1:], strict=False):
        if not len(a):
            break
        sums = sums + np.einsum("ij,ij->i", px[a, low:high], py[b, low:high])
        keep = sums + tail(px, high)[a] * tail(py, high)[b] >= bound
        a, b, sums = a[keep], b[keep], sums[keep]
    xs, ys = x[a], y[b]
    lengths = np.sqrt((xs * xs).sum(axis=1)) * np.sqrt((ys * ys).sum(axis=1))
    keep = np.einsum("ij,ij->i", xs, ys) / lengths >= threshold
    return a[keep], b[keep]


def _compare(table: pa.Table, axes: dict[int, np.ndarray], threshold: float) -> pa.Table:
    """The links of one pair of blocks: for each vector how many vectors it links to, and a forest."""
    table = table.combine_chunks()
    node = table.column("node").to_numpy()
    copies = table.column("copies").to_numpy()
    right = np.asarray(table.column("right"))
    values, lengths, _ = _matrix(table.column("embedding").chunk(0))
    width = int(lengths[0])
    x = values.reshape(len(node), width)
    # Scaled by a power of two, which changes no cosine but keeps squares in range.
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    p = _unit(x) @ axes[width]
    cross = bool(right.any())
    lefts = np.flatnonzero(~right) if cross else np.arange(len(node))
    rights = np.flatnonzero(right) if cross else lefts
    links = np.zeros(len(node), np.int64)
    root = np.arange(len(node))
    for i in range(0, len(lefts), TILE_ROWS):
        rows = lefts[i : i + TILE_ROWS]
        for j in range(0 if cross else i, len(rights), TILE_ROWS):
            others = rights[j : j + TILE_ROWS]
            a, b = tile_links(x[rows], x[others], p[rows], p[others], threshold)
            a, b = rows[a], others[b]
            if not cross and i == j:
                a, b = a[a < b], b[a < b]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            root = merge_roots(root, a, b)
    kept = np.flatnonzero(links)
    # Rows are sorted by node, so the least position is the least node.
    return pa.table({"node": node[kept], "links": links[kept], "root": node[root[kept]]})


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id"
) -> DataFrame:
    """(id, n_links long, component_id long, kept boolean), a row each.

    Vectors are compared where labels are equal. One that is null, zero, holds a null or a number that
    is not finite, or has a null label links with nothing, and neither do vectors of unequal length.
    Repeated rows and equal vectors link with each other. An empty table gives an empty one.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), "label", "embedding")
    rows = rows.mapInArrow(_keys, _with_key(rows))
    keyed = write_and_read(rows.drop("embedding"), "vector-keys")
    classes = (
        rows.where("key IS NOT NULL")
        .groupBy("label", "key")
        .agg(
            F.min("id").alias("node"),
            F.count("*").alias("copies"),
            F.min("embedding").alias("embedding"),
        )
    )
    # Equal vectors without any id have nothing to be named by; they count but link no further.
    classes = write_and_read(classes, "vector-classes")
    named = classes.where("node IS NOT NULL")
    axes = principal_axes(named)
    width = float(np.sqrt(2 - 2 * threshold)) + 1e-6

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int64)
            size = np.zeros(batch.num_rows, np.int64)
            for at, x in _by_width(batch.column("embedding")):
                cell[at] = np.floor(x @ axes[x.shape[1]][:, 0] / width)
                size[at] = x.shape[1]
            extra = [pa.array(cell), pa.array(size)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "cell", "width"])

    found = _links(named, place, axes, threshold)
    found = write_and_read(found, "vector-links")
    parts = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")), "vector-parts")
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (
        classes.select("label", "key", "node", "copies")
        .join(sums, "node", "left")
        .join(parts, "node", "left")
        .select(
            "label",
            "key",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    return (
        keyed.join(named, ["label", "key"], "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
    )


def _with_key(rows: DataFrame) -> str:
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return f"{fields}, key binary"


def _links(named: DataFrame, place, axes: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """(node, links, root) from every pair of blocks that can hold a link."""
    columns = named.select("label", "node", "copies", "embedding")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns.schema.fields)
    placed = columns.mapInArrow(place, f"{fields}, cell long, width long")
    placed = write_and_read(placed, "vector-cells")
    counts = placed.groupBy("label", "width", "cell").agg(
        F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks")
    )
    counts = write_and_read(counts, "vector-cell-counts")
    near = lambda by, name: counts.select(
        "label", "width", (F.col("cell") - by).alias("cell"), F.col("blocks").alias(name)
    )
    on = ["label", "width", "cell"]
    rows = (
        placed.join(near(0, "own"), on)
        .join(near(1, "after"), on, "left")
        .join(near(-1, "before"), on, "left")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("own")).cast("int"))
    )
    # A pair of blocks is (cell of the left one, its block, step to the right one's cell, its block).
    pair = lambda cell, a, step, b, right: F.struct(
        cell.alias("at"), a.alias("a"), F.lit(step).alias("step"), b.alias("b"), right.alias("right")
    )
    cell, block = F.col("cell"), F.col("block")
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    same = F.transform(
        upto(F.col("own")),
        lambda b: pair(cell, F.least(block, b), 0, F.greatest(block, b), block > b),
    )
    ahead = F.transform(
        upto(F.coalesce("after", F.lit(0))), lambda b: pair(cell, block, 1, b, F.lit(False))
    )
    behind = F.transform(
        upto(F.coalesce("before", F.lit(0))), lambda b: pair(cell - 1, b, 1, block, F.lit(True))
    )
    sent = rows.select(
        "label", "width", "node", "copies", "embedding", F.explode(F.concat(same, ahead, behind)).alias("pair")
    ).select("label", "width", "pair.*", "node", "copies", "embedding")

    def compare(table: pa.Table) -> pa.Table:
        return _compare(table.sort_by("node"), axes, threshold)

    return sent.groupBy("label", "width", "at", "a", "step", "b").applyInArrow(
        compare, "node long, links long, root long"
    )
