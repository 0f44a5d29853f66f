"""Permutation importance of a forest, with only the trees scored again that a permuted feature can change.

A saved forest is a table of nodes. Read as arrays, its trees are walked down by all rows of a block at once,
and the walk tells at which node a row first meets each feature. For a permuted feature a vote stands unless the row
meets it and the new value lies on the other side of one of the tree's thresholds; only then it is walked again,
from the node where it met the feature. So no row is made anew: what leaves a block is a number of hits per
feature and repeat.

The model itself is what each task holds: its size is that of the forest, not of the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomekit.operators.explain import BLOCK_ROWS, _blocks, _drops, _with_donors
from outcomekit.operators.models import save_model
from outcomekit.session import new_stage

#: Rows whose votes by tree are held at a time.
VOTED_ROWS = 2_000


class Tree(NamedTuple):
    """Nodes of one tree: feature (-1 at a leaf), threshold, children, and the share of class 1 at each."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    shares: np.ndarray

    def votes(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """Share of class 1 at the leaf that each row comes to."""
        x = np.asarray(columns)
        return self.shares[self.walk(np.zeros(x.shape[1], np.int64), np.arange(x.shape[1]), x)]

    def walk(
        self,
        node: np.ndarray,
        rows: np.ndarray,
        x: np.ndarray,
        moved: tuple[int, np.ndarray] | None = None,
        met: np.ndarray | None = None,
    ) -> np.ndarray:
        """Leaf that each walk comes to, from ``node`` with the values of a row, a column of ``x``.

        ``moved`` is a feature and its value for each walk instead of the row's. ``met``, features x walks of -1,
        gets the node where a walk first meets a feature.
        """
        node = node.copy()
        walking = np.flatnonzero(self.feature[node] >= 0)
        while len(walking):
            at = node[walking]
            feature = self.feature[at]
            values = x[feature, rows[walking]]
            if moved:
                values = np.where(feature == moved[0], moved[1][walking], values)
            if met is not None:
                new = met[feature, walking] < 0
                met[feature[new], walking[new]] = at[new]
            node[walking] = np.where(values <= self.threshold[at], self.left[at], self.right[at])
            walking = walking[self.feature[node[walking]] >= 0]
        return node


def read_trees(model: RandomForestClassificationModel, spark: SparkSession) -> list[Tree]:
    """Trees of a forest of two classes on numeric features, from its saved form."""
    path, _ = new_stage(spark)
    save_model(model, path)
    # As many rows as the model has nodes.
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    trees: dict[int, list] = {}
    for r in rows:
        trees.setdefault(r["treeID"], []).append(r)
    out = []
    for _, nodes in sorted(trees.items()):
        if any(n["split"]["numCategories"] > 0 for n in nodes):
            raise ValueError("splits by category: only numeric features are read")
        cuts = [n["split"]["leftCategoriesOrThreshold"] for n in nodes]
        stats = np.array([n["impurityStats"][:2] for n in nodes], float)
        out.append(
            Tree(
                np.array([n["split"]["featureIndex"] for n in nodes]),
                np.array([c[0] if c else 0.0 for c in cuts]),
                np.array([n["leftChild"] for n in nodes]),
                np.array([n["rightChild"] for n in nodes]),
                stats[:, 1] / np.maximum(stats.sum(axis=1), 1e-300),
            )
        )
    return out


def trees_by_feature(trees: Sequence[Tree], width: int) -> list[list[int]]:
    """For each feature the trees that split by it."""
    used = [set(t.feature[t.feature >= 0].tolist()) for t in trees]
    return [[i for i, u in enumerate(used) if f in u] for f in range(width)]


def _changed_votes(tree: Tree, used: Sequence[int], own: np.ndarray, given: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Votes of a tree on the rows as they are; to ``change`` is added what its votes are more for given values.

    ``own`` is features x rows, ``given`` and ``change`` are features x repeats x rows.
    """
    n = own.shape[1]
    met = np.full((len(own), n), -1, np.int32)
    votes = tree.shares[tree.walk(np.zeros(n, np.int64), np.arange(n), own, met=met)]
    for f in used:
        rows = np.flatnonzero(met[f] >= 0)
        cuts = np.unique(tree.threshold[tree.feature == f])
        # Between the same two thresholds all ways are the same.
        values = given[f][:, rows]
        repeat, at = np.nonzero(np.searchsorted(cuts, values) != np.searchsorted(cuts, own[f, rows]))
        if len(at):
            mine = rows[at]
            leaf = tree.walk(met[f, mine].astype(np.int64), mine, own, (f, values[repeat, at]))
            change[f, repeat, mine] += tree.shares[leaf] - votes[mine]
    return votes


def forest_permutation_importance(
    model: RandomForestClassificationModel,
    df: DataFrame,
    key: str,
    label: str,
    features: Sequence[str],
    repeats: int = 10,
    seed: int = 42,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Mean drop in accuracy per feature, as :func:`outcomekit.operators.explain.permutation_importance` gives it."""
    names = list(features)
    trees = read_trees(model, df.sparkSession)
    by_tree = [[f for f in range(len(names)) if (t.feature == f).any()] for t in trees]
    blocks, n = _blocks(df, key, label, names, seed, block_rows)

    def hits(y: np.ndarray, x: np.ndarray, donors: np.ndarray, block: int) -> pd.DataFrame:
        counts = np.zeros((len(names), repeats), np.int64)
        as_is = 0
        for low in range(0, len(y), VOTED_ROWS):
            part = slice(low, low + VOTED_ROWS)
            own, given = np.ascontiguousarray(x[part].T), donors[:, :, part]
            total = np.zeros(own.shape[1])
            change = np.zeros(given.shape)
            for tree, used in zip(trees, by_tree, strict=True):
                total += _changed_votes(tree, used, own, given, change)
            half = len(trees) / 2
            as_is += int(((total > half) == y[part]).sum())
            counts += ((total + change > half) == y[part]).sum(axis=2)
        rows = [("", 0, as_is, len(y))]
        rows += [(name, r, int(counts[f, r]), len(y)) for f, name in enumerate(names) for r in range(repeats)]
        return pd.DataFrame(rows, columns=["feature", "repeat", "hits", "n"])

    counted = _with_donors(
        blocks, n, names, repeats, seed, block_rows, hits, "feature string, repeat int, hits bigint, n bigint"
    )
    totals = counted.groupBy("feature", "repeat").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n"))
    return _drops(totals)
