"""Permutation importance.

Rows are ranked in a hash order. A feature is permuted by rotating its column by a
drawn number of places: in a random order that gives every row the value of a
random other row, and the whole is a permutation of the table's column. Ranks are
kept in blocks; a block sends each rotated column to the one or two blocks that its
values move to, so the figures do not depend on the size of a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcomekit.functions import DRAW_SPAN, draw
from outcomekit.operators.ranking import with_rank
from outcomekit.session import stage

BLOCK_ROWS = 20_000
# Rows of a block are handed a value for every feature and repeat before a model scores them.
SCORED_BLOCK_ROWS = 2_000


def rotation(feature: str, repeat: int, seed: int, rows: int) -> int:
    """Places to rotate by, from 1 to rows - 1; the draw of the key ``feature:repeat``."""
    digest = hashlib.md5(f"{feature}:{repeat}|{seed}|shift".encode()).hexdigest()
    return 1 + int(int(digest[:8], 16) / DRAW_SPAN * (rows - 1)) if rows > 1 else 0


def _blocks(
    df: DataFrame, key: str, label: str, features: Sequence[str], seed: int, block_rows: int
) -> tuple[DataFrame, int]:
    """Staged rows (block, y, x): the labels and the features of the ranks of a block; and the number of rows."""
    rows = stage(
        df.select(
            F.col(key).alias("k"),
            F.col(label).cast("int").alias("y"),
            draw(key, seed, "permute").alias("u"),
            F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("x"),
        )
    )
    n = rows.count()
    ranked = with_rank(rows, "u", "k", n).withColumn("block", F.expr(f"rank DIV {block_rows}"))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("rank")
        y = (part["y"] == 1).to_numpy()
        x = np.stack(part["x"].to_numpy()).astype(np.float64)
        return pd.DataFrame({"block": [part["block"].iloc[0]], "y": [y.tobytes()], "x": [x.tobytes()]})

    packed = ranked.select("block", "rank", "y", "x").groupBy("block").applyInPandas(pack, "block long, y binary, x binary")
    return stage(packed), n


def _with_donors(
    blocks: DataFrame, n: int, names: Sequence[str], repeats: int, seed: int, block_rows: int, work, schema: str
) -> DataFrame:
    """Rows that ``work`` makes of a block's labels, features and rotated columns, by feature and repeat."""
    shifts = [(j, r, rotation(name, r, seed, n)) for j, name in enumerate(names) for r in range(repeats)]
    width = len(names)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, data in zip(batch["block"], batch["x"], strict=True):
                x = np.frombuffer(data).reshape(-1, width)
                out = []
                for j, r, shift in shifts:
                    to = (block * block_rows - shift + np.arange(len(x))) % n
                    # Runs of places of one block; the last place is followed by the first.
                    heads = np.flatnonzero((np.diff(to, prepend=to[0]) != 1) | (to % block_rows == 0))
                    for a, b in zip(heads, [*heads[1:], len(x)], strict=True):
                        out.append((to[a] // block_rows, j, r, int(to[a] % block_rows), x[a:b, j].tobytes()))
                yield pd.DataFrame(out, columns=["block", "feature", "repeat", "place", "values"])

    pieces = blocks.select("block", "x").mapInPandas(send, "block long, feature int, repeat int, place int, values binary")

    def meet(own: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        y = np.frombuffer(own["y"].iloc[0], dtype=bool)
        x = np.frombuffer(own["x"].iloc[0]).reshape(-1, width)
        donors = np.empty((width, repeats, len(y)))
        for j, r, place, values in zip(sent["feature"], sent["repeat"], sent["place"], sent["values"], strict=True):
            part = np.frombuffer(values)
            donors[j, r, place : place + len(part)] = part
        return work(y, x, donors, own["block"].iloc[0])

    return blocks.groupBy("block").cogroup(pieces.groupBy("block")).applyInPandas(meet, schema)


def _drops(totals: DataFrame) -> DataFrame:
    """Mean and spread over the repeats of the drop in accuracy.

    ``totals`` has features x repeats rows and one, without a feature, for the rows
    as they are.
    """
    accuracy = totals.withColumn("accuracy", F.col("hits") / F.col("n"))
    whole = W.partitionBy(F.lit(1))
    baseline = F.max(F.when(F.col("feature") == "", F.col("accuracy"))).over(whole)
    drops = accuracy.withColumn("drop", baseline - F.col("accuracy")).where(F.col("feature") != "")
    return drops.groupBy("feature").agg(F.avg("drop").alias("importance"), F.stddev_pop("drop").alias("importance_std"))


def linear_permutation_importance(
    df: DataFrame,
    key: str,
    label: str,
    weights: Mapping[str, float],
    intercept: float = 0.0,
    repeats: int = 10,
    seed: int = 42,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Mean drop in accuracy per feature of a linear classifier.

    Permuting a feature moves the margin by weight x (new value - old value), so no
    row is scored again.
    """
    names, w = list(weights), [float(v) for v in weights.values()]
    blocks, n = _blocks(df, key, label, names, seed, block_rows)

    def hits(y: np.ndarray, x: np.ndarray, donors: np.ndarray, block: int) -> pd.DataFrame:
        margin = np.full(len(y), intercept)
        for j, weight in enumerate(w):
            margin = margin + weight * x[:, j]
        out = [("", 0, int(((margin > 0) == y).sum()), len(y))]
        for j, name in enumerate(names):
            for r in range(repeats):
                moved = margin - w[j] * x[:, j] + w[j] * donors[j, r]
                out.append((name, r, int(((moved > 0) == y).sum()), len(y)))
        return pd.DataFrame(out, columns=["feature", "repeat", "hits", "n"])

    counts = _with_donors(
        blocks, n, names, repeats, seed, block_rows, hits, "feature string, repeat int, hits bigint, n bigint"
    )
    totals = counts.groupBy("feature", "repeat").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n"))
    return _drops(totals)


def permutation_importance(
    model: Model,
    df: DataFrame,
    key: str,
    label: str,
    features: Sequence[str],
    vector: str = "features",
    repeats: int = 10,
    seed: int = 42,
    block_rows: int = SCORED_BLOCK_ROWS,
) -> DataFrame:
    """Mean drop in accuracy per feature of any classifier that reads a feature vector.

    A task only hands each row its donors; rows with a permuted feature are made from them
    outside Python, one at a time, and scored. Of them only hits per feature and repeat are shuffled.
    """
    names = list(features)
    blocks, n = _blocks(df, key, label, names, seed, block_rows)

    def given(y: np.ndarray, x: np.ndarray, donors: np.ndarray, block: int) -> pd.DataFrame:
        each = np.ascontiguousarray(donors.reshape(-1, len(y)).T)
        return pd.DataFrame({"y": y.astype(int), "x": list(x), "donors": list(each)})

    rows = _with_donors(blocks, n, names, repeats, seed, block_rows, given, "y int, x array<double>, donors array<double>")
    # Place 0 is the row as it is; place 1 + j x repeats + r has feature j of repeat r.
    place = F.explode(F.sequence(F.lit(0), F.lit(len(names) * repeats)))
    made = rows.withColumn("place", place).withColumn("feature_at", F.expr(f"(place - 1) DIV {repeats}"))
    moved = F.transform("x", lambda v, i: F.when(i == F.col("feature_at"), F.get("donors", F.col("place") - 1)).otherwise(v))
    made = made.select("place", "y", F.when(F.col("place") == 0, F.col("x")).otherwise(moved).alias("x"))
    scored = model.transform(made.withColumn(vector, array_to_vector("x")))
    hit = F.col("prediction").cast("int") == F.col("y")
    counts = scored.groupBy("place").agg(F.count_if(hit).alias("hits"), F.count("*").alias("n"))
    feature = F.get(F.array(*[F.lit(name) for name in names]), F.expr(f"CAST((place - 1) DIV {repeats} AS INT)"))
    totals = counts.select(
        F.when(F.col("place") == 0, F.lit("")).otherwise(feature).alias("feature"),
        F.when(F.col("place") == 0, F.lit(0)).otherwise(F.pmod(F.col("place") - 1, F.lit(repeats))).alias("repeat"),
        "hits",
        "n",
    )
    return _drops(totals)
