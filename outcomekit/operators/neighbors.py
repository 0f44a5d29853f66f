"""Exact nearest neighbors over a table of vectors.

Points are parted into cells of a binary space partition drawn from a bounded
sample. A query first looks into its own cell; its k-th distance there bounds how
far any other neighbor can be, and only cells whose bounding box is that near are
looked into next. The partition decides the effort, never the result: a box that
could hold a nearer point is always visited.

Cells that hold many points are cut into tiles, and the queries that visit them
into chunks, so that a task holds one tile and one chunk, whatever the data.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcomekit.functions import draw
from outcomekit.session import stage

LEAF_ROWS = 4_096
# Cells beyond this are only filled more: the driver holds the tree, a sample for it, and the boxes.
MAX_LEAVES = 16_384
TILE_ROWS = 4_096
SAMPLE_PER_LEAF = 32
BLOCK_ROWS = 512


class Partition(NamedTuple):
    """A binary tree over space: cut of each node, its children, and the cell of each leaf (-1 inside)."""

    dims: np.ndarray
    cuts: np.ndarray
    below: np.ndarray
    above: np.ndarray
    cells: np.ndarray

    @property
    def leaves(self) -> int:
        return int((self.cells >= 0).sum())


def separating_cut(rows: np.ndarray) -> tuple[int, float] | None:
    """Dimension and threshold that part ``rows`` best: wide and even. None if all rows are equal.

    A threshold lies midway between two distinct values, next to the median, so both sides get rows
    whatever share of them has one value.
    """
    best, best_worth = None, 0.0
    for d in range(rows.shape[1]):
        values = np.sort(rows[:, d])
        if values[0] == values[-1]:
            continue
        middle = values[len(values) // 2]
        first, last = np.searchsorted(values, middle, "left"), np.searchsorted(values, middle, "right")
        at = min((k for k in (first, last) if 0 < k < len(values)), key=lambda k: abs(2 * k - len(values)))
        worth = (values[-1] - values[0]) * min(at, len(values) - at) / len(values)
        if worth > best_worth:
            cut = values[at - 1] + (values[at] - values[at - 1]) / 2
            best, best_worth = (d, float(min(cut, np.nextafter(values[at], -np.inf)))), worth
    return best


def space_partition(sample: np.ndarray, leaves: int) -> Partition:
    """Cut the cell with most sampled rows, again and again, until there are ``leaves`` cells."""
    nodes: list[list] = [[0, 0.0, -1, -1]]
    open_cells = [(-len(sample), 0, sample)]
    done: list[int] = []
    while open_cells and len(open_cells) + len(done) < leaves:
        _, node, rows = heapq.heappop(open_cells)
        cut = separating_cut(rows) if len(rows) > 1 else None
        if cut is None:
            done.append(node)
            continue
        right = rows[:, cut[0]] > cut[1]
        nodes[node] = [*cut, len(nodes), len(nodes) + 1]
        for side in (rows[~right], rows[right]):
            heapq.heappush(open_cells, (-len(side), len(nodes), side))
            nodes.append([0, 0.0, -1, -1])
    table = np.array(nodes, dtype=np.float64)
    below = table[:, 2].astype(np.int64)
    cells = np.where(below < 0, np.cumsum(below < 0) - 1, -1)
    return Partition(table[:, 0].astype(np.int64), table[:, 1], below, table[:, 3].astype(np.int64), cells)


def cell_of(vectors: np.ndarray, tree: Partition) -> np.ndarray:
    node = np.zeros(len(vectors), dtype=np.int64)
    inside = np.flatnonzero(tree.cells[node] < 0)
    while len(inside):
        at = node[inside]
        right = vectors[inside, tree.dims[at]] > tree.cuts[at]
        node[inside] = np.where(right, tree.above[at], tree.below[at])
        inside = inside[tree.cells[node[inside]] < 0]
    return tree.cells[node].astype(np.int32)


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.empty((0, width))


def _with_cell(df: DataFrame, tree: Partition, width: int) -> DataFrame:
    @F.pandas_udf("int")
    def cell(vec: pd.Series) -> pd.Series:
        return pd.Series(cell_of(_matrix(vec, width), tree))

    return df.withColumn("cell", cell("vec"))


def _candidates(q_ids, q_vecs, limits, p_ids, p_vecs, center, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (query, point) that hold all of the k nearest points within the limits, and few others.

    Squared distances come from one matrix product about ``center``; a bound on what this rounds off is given way by.
    """
    q, p = q_vecs - center, p_vecs - center
    q_square, p_square = (q * q).sum(axis=1), (p * p).sum(axis=1)
    slack = 32 * (p.shape[1] + 8) * np.finfo(np.float64).eps * (q_square + p_square.max())
    if np.isfinite(slack).all():
        dist = q @ p.T
        dist *= -2
        dist += p_square
        dist += q_square[:, None]
    else:
        slack, dist = np.zeros(len(q)), np.zeros((len(q), len(p)))
        for d in range(p.shape[1]):
            gap = q_vecs[:, d, None] - p_vecs[None, :, d]
            dist += gap * gap
    if p_ids.dtype == object or q_ids.dtype == object:
        dist[q_ids[:, None] == p_ids[None, :]] = np.inf
    else:
        # Points are in the order of their ids; no id equals a missing one.
        first, last = np.searchsorted(p_ids, q_ids, "left"), np.searchsorted(p_ids, q_ids, "right")
        for row in np.flatnonzero((last > first) & (q_ids == q_ids)):
            dist[row, first[row] : last[row]] = np.inf
    limits = limits + slack
    hit = dist <= limits[:, None]
    if np.count_nonzero(hit) > 4 * k * len(q):
        at = min(k, dist.shape[1]) - 1
        hit &= dist <= (np.partition(dist, at, axis=1)[:, at] + 2 * slack)[:, None]
    row, col = np.nonzero(hit)
    finite = np.isfinite(dist[row, col])
    return row[finite], col[finite]


def _nearest_in_tile(q_ids, q_vecs, limits, p_ids, p_vecs, k: int):
    """Rows (query, point, distance) of up to k nearest points per query, by (distance, id); points in order of ids.

    Distances are summed dimension by dimension, in order: the same figures a
    plain SQL expression gives. Only candidates have them computed.
    """
    found = []
    center = p_vecs.mean(axis=0)
    for start in range(0, len(q_ids), BLOCK_ROWS):
        q = slice(start, start + BLOCK_ROWS)
        row, col = _candidates(q_ids[q], q_vecs[q], limits[q], p_ids, p_vecs, center, k)
        near = np.zeros(len(row))
        for d in range(p_vecs.shape[1]):
            gap = q_vecs[row + start, d] - p_vecs[col, d]
            near += gap * gap
        kept = np.isfinite(near) & (near <= limits[row + start])
        row, col, near = _first_k(row[kept], col[kept], near[kept], k)
        found.append((row + start, col, near))
    return tuple(np.concatenate(part) for part in zip(*found))


def _first_k(row: np.ndarray, col: np.ndarray, near: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query the k nearest, by (distance, place of the point)."""
    order = np.lexsort((col, near, row))
    row, col, near = row[order], col[order], near[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row, side="left") < k
    return row[kept], col[kept], near[kept]


def _tile_counts(rows: DataFrame) -> dict[int, int]:
    """How many tiles (or chunks) the rows of each cell fill."""
    counts = rows.groupBy("cell").agg(F.count("*").alias("n")).collect()
    return {r["cell"]: -(-r["n"] // TILE_ROWS) for r in counts}


def _probe(
    visits: DataFrame, points: DataFrame, tiles: dict[int, int], chunks: dict[int, int], k: int, width: int
) -> DataFrame:
    """Nearest points of each (query, cell) visit, tile by tile."""
    spark = points.sparkSession
    plan = [(c, t, chunks[c]) for c, t in tiles.items() if chunks.get(c)]
    if not plan:
        plan = [(c, t, 1) for c, t in tiles.items()]
    # One row per cell, at most MAX_LEAVES.
    plan_df = F.broadcast(spark.createDataFrame(plan, "cell int, tiles int, chunks int"))
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = (
        visits.join(plan_df, "cell")
        .withColumn("chunk", F.pmod(F.xxhash64("id", F.lit("chunk")), F.col("chunks")).cast("int"))
        .withColumn("tile", each("tiles"))
        .select("cell", "tile", "chunk", "id", "vec", "bound")
    )
    right = (
        points.join(plan_df, "cell")
        .withColumn("tile", F.pmod(F.xxhash64("id", F.lit("tile")), F.col("tiles")).cast("int"))
        .withColumn("chunk", each("chunks"))
        # Fresh columns: both sides may stem from one table.
        .select(*[F.col(c).alias(c) for c in ("cell", "tile", "chunk", "id", "vec")])
    )
    id_type = points.schema["id"].dataType.simpleString()
    columns = ["id", "near_id", "distance", "near_vec"]

    def tile(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(p):
            return pd.DataFrame({c: pd.Series([], dtype=object) for c in columns})
        p = p.sort_values("id", kind="stable", ignore_index=True)
        row, col, near = _nearest_in_tile(
            q["id"].to_numpy(),
            _matrix(q["vec"], width),
            q["bound"].to_numpy(),
            p["id"].to_numpy(),
            _matrix(p["vec"], width),
            k,
        )
        return pd.DataFrame(
            {
                "id": q["id"].to_numpy()[row],
                "near_id": p["id"].to_numpy()[col],
                "distance": near,
                "near_vec": p["vec"].to_numpy()[col],
            }
        )

    keys = ["cell", "tile", "chunk"]
    schema = f"id {id_type}, near_id {id_type}, distance double, near_vec array<double>"
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(tile, schema)


def _closest(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query; partitions cut their own rows to k before the shuffle."""
    rank = F.row_number().over(W.partitionBy("id").orderBy("distance", "near_id"))
    return found.withColumn("rk", rank).where(F.col("rk") <= k)


def nearest_neighbors(
    queries: DataFrame,
    points: DataFrame,
    k: int,
    width: int,
    leaf_rows: int = LEAF_ROWS,
    seed: int = 42,
    at_most: int | None = None,
) -> DataFrame:
    """The k nearest points of each query by squared distance, ties by id; never the query itself.

    Both tables have ``id`` (unique) and ``vec`` (array of ``width`` doubles).
    ``at_most`` is a count that neither exceeds, if the caller knows one. Returns
    ``id`` and ``neighbors``, an array of (distance, near_id, near_vec) in ascending
    order.
    """
    n = points.count() if at_most is None else at_most
    leaves = min(MAX_LEAVES, max(1, -(-n // leaf_rows)))
    far = F.lit(float("inf"))
    home = queries.select("id", "vec").withColumn("bound", far)
    if leaves == 1:
        one = {0: max(1, -(-n // TILE_ROWS))}
        home, points = home.withColumn("cell", F.lit(0)), points.withColumn("cell", F.lit(0))
        asked = _tile_counts(home) if at_most is None else one
        return _as_arrays(_closest(_probe(home, points, one, asked, k, width), k))
    sample = points.orderBy(draw("id", seed, "sample"), "id").select("vec").limit(leaves * SAMPLE_PER_LEAF)
    tree = space_partition(_matrix(sample.toPandas()["vec"], width), leaves)
    points = stage(_with_cell(points, tree, width))
    edges = [f(F.col("vec")[d]).alias(f"{name}{d}") for d in range(width) for name, f in (("lo", F.min), ("hi", F.max))]
    boxes = points.groupBy("cell").agg(F.count("*").alias("n"), *edges).orderBy("cell").toPandas()
    tiles = {int(c): int(-(-m // TILE_ROWS)) for c, m in zip(boxes["cell"], boxes["n"])}
    home = stage(_with_cell(home, tree, width))
    first = stage(_closest(_probe(home, points, tiles, _tile_counts(home), k, width), k).drop("rk"))
    reach = first.groupBy("id").agg(F.max("distance").alias("far"), F.count("*").alias("n"))
    reach = reach.where(F.col("n") >= k).select("id", "far")
    bounded = home.drop("bound").join(reach, "id", "left")
    bounded = bounded.select("id", "vec", "cell", F.coalesce("far", far).alias("bound"))
    cells = boxes["cell"].to_numpy()
    low = boxes[[f"lo{d}" for d in range(width)]].to_numpy()
    high = boxes[[f"hi{d}" for d in range(width)]].to_numpy()

    def near_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), BLOCK_ROWS):
                part = batch.iloc[start : start + BLOCK_ROWS]
                vecs = _matrix(part["vec"], width)
                gap = np.zeros((len(part), len(cells)))
                for d in range(width):
                    v = vecs[:, d, None]
                    off = np.maximum(0.0, np.maximum(low[None, :, d] - v, v - high[None, :, d]))
                    gap += off * off
                visit = (gap <= part["bound"].to_numpy()[:, None]) & (part["cell"].to_numpy()[:, None] != cells)
                row, col = np.nonzero(visit)
                yield pd.DataFrame(
                    {
                        "id": part["id"].to_numpy()[row],
                        "vec": part["vec"].to_numpy()[row],
                        "cell": cells[col],
                        "bound": part["bound"].to_numpy()[row],
                    }
                )

    visits = stage(bounded.mapInPandas(near_cells, bounded.schema))
    further = _probe(visits, points, tiles, _tile_counts(visits), k, width)
    return _as_arrays(_closest(first.unionByName(further), k))


def _as_arrays(closest: DataFrame) -> DataFrame:
    entry = F.struct("distance", "near_id", "near_vec")
    return closest.groupBy("id").agg(F.sort_array(F.collect_list(entry)).alias("neighbors"))
