"""Nearest neighbors in many dimensions, by distances to pivots.

Bounding boxes prune little in many dimensions, but distances still obey the triangle inequality: if a
query is 5 from a pivot and all points of a cell are 1 to 2 from it, none of them is nearer than 3. A few
hundred pivots, spread out over a bounded sample, give each point a cell, that of its nearest pivot, and each
cell the least and greatest distance to every pivot. A query first looks into its own cell; its k-th
distance there is a bound, and only cells that no pivot rules out at that bound are looked into next. The
pivots decide the effort, never the result.

Cells are packed into groups of a bounded number of points. A query goes once to each group with a cell that it
has to look into, and tells which; a task holds a group, or a part of a large cell, and a bounded chunk of its
queries. Distances are matrix products with a bound on their rounding, and exact for what that leaves.

``approximate_neighbors`` is for tables where even that visits too much: random projections put near vectors
into the same buckets, with a chance, and the k nearest of what shares a bucket are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.functions import draw
from outcomekit.operators.neighbors import BLOCK_ROWS, _as_arrays, _closest, _first_k, _matrix, _nearest_in_tile
from outcomekit.session import stage

PIVOTS = 256
SAMPLE_ROWS = 8_192
#: Points of a group of cells, and queries of a chunk, that a task holds.
GROUP_ROWS = 16_384
#: Part of a distance by which a bound gives way, as distances are rounded.
SLACK = 1e-9


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of each row to each pivot, dimension by dimension: no cancellation between large squares."""
    out = np.zeros((len(rows), len(pivots)))
    for d in range(rows.shape[1]):
        gap = rows[:, d, None] - pivots[None, :, d]
        out += gap * gap
    return np.sqrt(out)


def spread_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` distinct rows of the sample, each the farthest from those before it."""
    if not len(sample):
        return sample
    chosen = [0]
    far = distances(sample, sample[:1])[:, 0]
    while len(chosen) < n and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def _with_pivot(df: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    @F.pandas_udf("struct<cell: int, far: array<double>>")
    def place(vec: pd.Series) -> pd.DataFrame:
        rows = _matrix(vec, width)
        cells, far = [], []
        for start in range(0, len(rows), BLOCK_ROWS):
            part = distances(rows[start : start + BLOCK_ROWS], pivots)
            cells += part.argmin(axis=1).tolist()
            far += list(part)
        return pd.DataFrame({"cell": np.array(cells, np.int32), "far": far})

    return df.withColumn("_at", place("vec")).select(*df.columns, "_at.cell", "_at.far")


def _rings(placed: DataFrame, n_pivots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells, and the least and greatest distance of their points to each pivot: cells x pivots figures."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            far = _matrix(batch["far"], n_pivots)
            for cell, at in batch.groupby("cell").indices.items():
                yield pd.DataFrame({"cell": [cell], "low": [far[at].min(axis=0)], "high": [far[at].max(axis=0)]})

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        low, high = np.stack(part["low"].to_numpy()).min(axis=0), np.stack(part["high"].to_numpy()).max(axis=0)
        return pd.DataFrame({"cell": [part["cell"].iloc[0]], "low": [low], "high": [high]})

    schema = "cell int, low array<double>, high array<double>"
    # A batch gives a cell one row, and there are at most as many cells as pivots.
    folded = placed.select("cell", "far").mapInPandas(fold, schema).groupBy("cell").applyInPandas(merge, schema)
    rows = folded.orderBy("cell").toPandas()
    return rows["cell"].to_numpy(), _matrix(rows["low"], n_pivots), _matrix(rows["high"], n_pivots)


def nearest_by_pivots(
    queries: DataFrame, points: DataFrame, k: int, width: int, pivots: int = PIVOTS, seed: int = 42
) -> DataFrame:
    """The k nearest points of each query by squared distance, ties by id; never the query itself.

    As :func:`outcomekit.operators.neighbors.nearest_neighbors`, for many dimensions: ``id`` is unique, ``vec``
    an array of ``width`` doubles. No points give no rows.
    """
    sample = points.orderBy(draw("id", seed, "pivot"), "id").select("vec").limit(SAMPLE_ROWS)
    chosen = spread_pivots(_matrix(sample.toPandas()["vec"], width), pivots)
    if not len(chosen):
        chosen = np.zeros((1, width))
    number = F.monotonically_increasing_id()
    held = stage(_with_pivot(points.select("id", "vec", number.alias("at")), chosen, width))
    cells, low, high = _rings(held, len(chosen))
    groups = cell_groups({r["cell"]: r["n"] for r in held.groupBy("cell").agg(F.count("*").alias("n")).collect()})
    held = held.select("cell", "at", "id", "vec")
    asked = stage(_with_pivot(queries.select("id", "vec", number.alias("no")), chosen, width))
    home = asked.withColumn("bound", F.lit(float("inf")))
    first = stage(_closest(_look(_with_cells(home, cells, groups), held, cells, groups, k, width), k).drop("rk"))
    reach = first.groupBy("id").agg(F.max("distance").alias("reach"), F.count("*").alias("n"))
    reach = reach.where(F.col("n") >= k).select("id", "reach")
    bounded = asked.join(reach, "id", "left").withColumn("bound", F.coalesce("reach", F.lit(float("inf")))).drop("reach")
    visits = stage(_with_cells(bounded, cells, groups, (low, high)))
    further = _look(visits, held, cells, groups, k, width)
    closest = _closest(first.unionByName(further), k).join(held.select("at", F.col("vec").alias("near_vec")), "at")
    return _as_arrays(closest)


def cell_groups(sizes: dict[int, int]) -> dict[int, list[int]]:
    """For each cell the group of each of its parts; neither a part nor a group has more than about GROUP_ROWS points."""
    out, group, filled = {}, 0, 0
    for cell, n in sorted(sizes.items()):
        parts = -(-n // GROUP_ROWS)
        out[cell] = []
        for _ in range(parts):
            size = -(-n // parts)
            if filled and filled + size > GROUP_ROWS:
                group, filled = group + 1, 0
            out[cell].append(group)
            filled += size
    return out


def _with_cells(
    asked: DataFrame, cells: np.ndarray, groups: dict[int, list[int]], rings: tuple[np.ndarray, np.ndarray] | None = None
) -> DataFrame:
    """Queries with the cells to look into, a bit each, and the groups of these: the own cell, or with ``rings``
    all others that could hold a point as near as the bound."""
    every = max((g for parts in groups.values() for g in parts), default=-1) + 1
    member = np.zeros((len(cells), every), bool)
    for i, cell in enumerate(cells):
        member[i, groups[cell]] = True

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), BLOCK_ROWS):
                part = batch.iloc[start : start + BLOCK_ROWS]
                own = part["cell"].to_numpy()[:, None] == cells
                visit = own
                if rings:
                    far = _matrix(part["far"], rings[0].shape[1])
                    gap = np.zeros((len(part), len(cells)))
                    for p in range(far.shape[1]):
                        d = far[:, p, None]
                        gap = np.maximum(gap, np.maximum(d - rings[1][None, :, p], rings[0][None, :, p] - d))
                    bound = np.sqrt(part["bound"].to_numpy())[:, None] * (1 + SLACK) + SLACK * far.max(axis=1, keepdims=True)
                    visit = (gap <= bound) & ~own
                bits = np.packbits(visit, axis=1)
                reached = visit.astype(np.float32) @ member.astype(np.float32) > 0
                yield pd.DataFrame(
                    {
                        "id": part["id"].to_numpy(),
                        "no": part["no"].to_numpy(),
                        "vec": part["vec"].to_numpy(),
                        "bound": part["bound"].to_numpy(),
                        "cells": [b.tobytes() for b in bits],
                        "groups": [np.flatnonzero(r).astype(np.int32) for r in reached],
                    }
                )

    kind = asked.schema["id"].dataType.simpleString()
    schema = f"id {kind}, no bigint, vec array<double>, bound double, cells binary, groups array<int>"
    return asked.select("id", "no", "vec", "bound", "cell", "far").mapInPandas(look, schema)


def _look(
    visits: DataFrame, points: DataFrame, cells: np.ndarray, groups: dict[int, list[int]], k: int, width: int
) -> DataFrame:
    """Rows (id, near_id, distance, at): up to k nearest points of each query in each group, of the cells it looks into."""
    spark = points.sparkSession
    sent = visits.select(F.explode("groups").alias("group")).groupBy("group").agg(F.count("*").alias("n")).collect()
    chunks = {r["group"]: -(-r["n"] // GROUP_ROWS) for r in sent}
    # As many rows as groups, and as parts of cells.
    chunk_plan = F.broadcast(spark.createDataFrame(list(chunks.items()), "group int, chunks int"))
    parts = [(int(c), len(own), i, g) for c, own in groups.items() for i, g in enumerate(own)]
    part_plan = F.broadcast(spark.createDataFrame(parts, "cell int, parts int, part int, group int"))
    left = (
        visits.select("no", "id", "vec", "bound", "cells", F.explode("groups").alias("group"))
        .join(chunk_plan, "group")
        .withColumn("chunk", F.pmod(F.xxhash64("no"), F.col("chunks")).cast("int"))
        .select("group", "chunk", "id", "vec", "bound", "cells")
    )
    right = (
        points.join(part_plan, "cell")
        .where(F.pmod(F.xxhash64("at"), F.col("parts")) == F.col("part"))
        .join(chunk_plan, "group")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        # Fresh columns: both sides may stem from one table.
        .select(*[F.col(c).alias(c) for c in ("group", "chunk", "cell", "at", "id", "vec")])
    )
    columns = ["id", "near_id", "distance", "at"]

    def meet(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(p):
            return pd.DataFrame({c: pd.Series([], dtype=object) for c in columns})
        p = p.sort_values("id", kind="stable", ignore_index=True)
        bits = np.unpackbits(np.stack([np.frombuffer(b, np.uint8) for b in q["cells"]]), axis=1)
        q_ids, q_vecs, limits = q["id"].to_numpy(), _matrix(q["vec"], width), q["bound"].to_numpy(copy=True)
        p_ids, p_vecs, place = p["id"].to_numpy(), _matrix(p["vec"], width), np.searchsorted(cells, p["cell"].to_numpy())
        best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for c in np.unique(place):
            rows, cols = np.flatnonzero(bits[:, c]), np.flatnonzero(place == c)
            if not len(rows):
                continue
            row, col, near = _nearest_in_tile(q_ids[rows], q_vecs[rows], limits[rows], p_ids[cols], p_vecs[cols], k)
            best = _first_k(*[np.concatenate(x) for x in zip(best, (rows[row], cols[col], near))], k)
            # What is farther than the k-th point so far is none of the k nearest.
            last = np.flatnonzero(np.bincount(best[0], minlength=len(q)) >= k)
            limits[last] = np.minimum(limits[last], best[2][np.searchsorted(best[0], last, side="right") - 1])
        row, col, near = best
        return pd.DataFrame({"id": q_ids[row], "near_id": p_ids[col], "distance": near, "at": p["at"].to_numpy()[col]})

    id_type = points.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, near_id {id_type}, distance double, at bigint"
    keys = ["group", "chunk"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, schema)


def compared_share(queries: DataFrame, points: DataFrame, width: int, pivots: int = PIVOTS, k: int = 5, seed: int = 42) -> float:
    """Part of all pairs of query and point whose distance a search by pivots computes."""
    near = nearest_by_pivots(queries, points, k, width, pivots, seed)
    sample = points.orderBy(draw("id", seed, "pivot"), "id").select("vec").limit(SAMPLE_ROWS)
    chosen = spread_pivots(_matrix(sample.toPandas()["vec"], width), pivots)
    held = stage(_with_pivot(points.select("id", "vec"), chosen, width))
    cells, low, high = _rings(held, len(chosen))
    sizes = {r["cell"]: r["n"] for r in held.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    asked = _with_pivot(queries.select("id", "vec"), chosen, width)
    reach = near.select("id", F.element_at("neighbors", -1)["distance"].alias("reach"))
    looked = 0
    for row in asked.join(reach, "id").select("cell", "far", "reach").toLocalIterator():
        far = np.array(row["far"])
        gap = np.maximum(far[None, :] - high, low - far[None, :]).max(axis=1)
        looked += sum(sizes[int(c)] for c, g in zip(cells, gap, strict=True) if g <= np.sqrt(row["reach"]) or c == row["cell"])
    return looked / max(queries.count() * points.count(), 1)


def approximate_neighbors(
    queries: DataFrame, points: DataFrame, k: int, bucket_length: float, tables: int = 8, within: float = float("inf"), seed: int = 42
) -> DataFrame:
    """The k nearest points of each query among those that share a bucket with it, in the form of the exact search.

    ``bucket_length`` is a few times the distance of a neighbor; more ``tables`` find more. ``within`` leaves
    out what is farther away.
    """
    lsh = BucketedRandomProjectionLSH(
        inputCol="features", outputCol="hashes", bucketLength=bucket_length, numHashTables=tables, seed=seed
    )
    vectors = [df.select("id", "vec", array_to_vector("vec").alias("features")) for df in (queries, points)]
    joined = lsh.fit(vectors[1]).approxSimilarityJoin(*vectors, threshold=within, distCol="apart")
    found = joined.select(
        F.col("datasetA.id").alias("id"),
        F.col("datasetB.id").alias("near_id"),
        (F.col("apart") * F.col("apart")).alias("distance"),
        F.col("datasetB.vec").alias("near_vec"),
    )
    return _as_arrays(_closest(found.where("id <> near_id"), k))
