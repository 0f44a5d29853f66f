"""Vectors joined by cosine similarity, found by Euclidean p-stable hashing and checked exactly.

Method
    Vectors are scaled to length one, where a cosine is a distance. A table hashes a vector by ``k``
    random projections, each shifted by a random offset and cut into steps of ``width``. Near vectors
    share all ``k`` steps with a chance that the law of the Gaussian gives; ``k`` follows the number of
    vectors so that far ones seldom do, and the number of tables follows from the recall asked for at
    the threshold itself. Nearer pairs are found more surely.

    Equal vectors are one class with a multiplicity. Vectors of one bucket are compared in blocks of
    bounded size: a bucket larger than a block is dealt into parts, and each pair of parts is a task's
    work. Small buckets, which are most, go to a task many at a time, and their pairs are compared at once.
    A pair counts in the first table in which it shares a bucket, so each link counts once. Links
    are not written: a task gives each vector its number of links and one vector that it is joined to.

Defined cases
    Null, empty, zero and non-finite vectors, and those with a null component, link with nothing.
    Vectors of different length do not link. Of rows with equal ``vec_id`` each is a vector of its own.
    A component is named by its smallest ``vec_id``; null ids never name one. Labels are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcomekit.llm.components import connect
from outcomekit.llm.text import STEP, mix
from outcomekit.session import stage

THRESHOLD = 0.9
WIDTH = 2.0
RECALL = 0.97
#: Far vectors that a vector may meet in a bucket, on average.
STRANGERS = 8
BLOCK = 1024
#: Vectors of the small buckets that a task compares at once, and the size up to which a bucket is small.
PACK_ROWS = 16_384
SMALL = 64
NO_ID = np.iinfo(np.int64).max


def same_step(distance: float, width: float) -> float:
    """Chance that a projection puts two vectors this far apart into one step."""
    ratio = width / distance
    below = 0.5 * math.erfc(ratio / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-ratio * ratio / 2))


def plan(rows: int, threshold: float, width: float, recall: float) -> tuple[int, int]:
    """Projections per table and number of tables for so many vectors."""
    near = same_step(math.sqrt(max(2 - 2 * threshold, 1e-9)), width)
    far = same_step(math.sqrt(2), width)
    k = max(1, math.ceil(math.log(max(rows / STRANGERS, 1) + 1) / -math.log(far)))
    return k, max(1, math.ceil(math.log(1 - recall) / math.log1p(-(near**k))))


def projections(dim: int, k: int, tables: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((dim, k * tables)), rng.uniform(0, width, k * tables)


def buckets(vectors: np.ndarray, k: int, tables: int, width: float, seed: int) -> np.ndarray:
    """Bucket of each vector in each table, as a 64-bit hash of its ``k`` steps."""
    directions, offsets = projections(vectors.shape[1], k, tables, width, seed)
    steps = np.floor((vectors @ directions + offsets) / width).astype(np.int64).astype(np.uint64)
    out = np.zeros((len(vectors), tables), np.uint64)
    for j in range(k):
        out = out * STEP + steps.reshape(len(vectors), tables, k)[:, :, j]
    return mix(out)


def unit_rows(data: list[bytes]) -> np.ndarray:
    """Vectors of one length as rows of doubles, scaled to length one."""
    rows = np.stack([np.frombuffer(d, np.float64) for d in data])
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def vector_classes(vectors: DataFrame) -> DataFrame:
    """Staged rows vec_id, vector: the components as bytes of doubles, null where nothing can link."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding").cast(pa.list_(pa.float64()))
            out = []
            for item in lists:
                values = item.values
                usable = values is not None and len(values) > 0 and values.null_count == 0
                array = values.to_numpy(zero_copy_only=False) + 0.0 if usable else None
                usable = usable and bool(np.isfinite(array).all()) and bool(array.any())
                out.append(array.tobytes() if usable else None)
            yield pa.record_batch(
                [pc.cast(batch.column("vec_id"), pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "vector"]
            )

    return stage(vectors.select("vec_id", "embedding").mapInArrow(convert, "vec_id long, vector binary"))


def bucket_rows(classes: DataFrame, k: int, tables: int, width: float, seed: int) -> DataFrame:
    """Rows (table, bucket, node, vector, copies, signature): a class in each of its buckets."""
    kind = classes.schema["node"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [x.as_py() for x in batch.column("vector")]
            lengths = np.array([len(d) for d in data])
            for length in np.unique(lengths):
                for at in np.array_split(*_pieces(np.flatnonzero(lengths == length))):
                    signs = buckets(unit_rows([data[i] for i in at]), k, tables, width, seed)
                    rows = pa.array(np.repeat(at, tables), pa.int64())
                    signatures = pa.array([s.tobytes() for s in signs], pa.binary())
                    yield pa.record_batch(
                        [
                            pa.array(np.tile(np.arange(tables, dtype=np.int32), len(at))),
                            pa.array(signs.ravel().view(np.int64)),
                            batch.column("node").take(rows),
                            batch.column("vector").take(rows),
                            batch.column("copies").take(rows),
                            signatures.take(pa.array(np.repeat(np.arange(len(at)), tables))),
                        ],
                        names=["table", "bucket", "node", "vector", "copies", "signature"],
                    )

    return classes.select("node", "vector", "copies").mapInArrow(
        run, f"table int, bucket long, node {kind}, vector binary, copies long, signature binary"
    )


def _pieces(at: np.ndarray) -> tuple[np.ndarray, int]:
    return at, max(1, -(-len(at) // 512))


def compare(table: pa.Table, threshold: float) -> pa.Table:
    """What the parts ``low`` and ``high`` of a bucket, or the one part that it has, tell of their classes' links.

    Rows (node, others, root): for each class with new links how many vectors these lead to, and a class of
    this task that it is joined to, directly or by others. So a group of many near vectors gives a row for each
    of them, not for each pair.
    """
    table = table.combine_chunks()
    first = table.column("table")[0].as_py()
    data = [x.as_py() for x in table.column("vector")]
    signs = np.stack([np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("signature")])
    side = table.column("part").to_numpy()
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    lengths = np.array([len(d) for d in data])
    a, b = [], []
    for length in np.unique(lengths):
        left = np.flatnonzero((lengths == length) & (side == low))
        right = left if low == high else np.flatnonzero((lengths == length) & (side == high))
        if len(left) == 0 or len(right) == 0:
            continue
        x = unit_rows([data[i] for i in left])
        y = x if low == high else unit_rows([data[i] for i in right])
        hit = x @ y.T >= threshold
        if low == high:
            hit = np.triu(hit, 1)
        i, j = np.nonzero(hit)
        i, j = left[i], right[j]
        # A pair that shares a bucket of an earlier table was compared there.
        new = ~(signs[i, :first] == signs[j, :first]).any(axis=1)
        a.append(i[new])
        b.append(j[new])
    i = np.concatenate(a) if a else np.zeros(0, np.int64)
    j = np.concatenate(b) if b else np.zeros(0, np.int64)
    return _told(table, i, j)


def compare_small(table: pa.Table, threshold: float) -> pa.Table:
    """As :func:`compare`, of all pairs in many small buckets of one table of hashes."""
    table = table.combine_chunks()
    first = table.column("table")[0].as_py()
    data = [x.as_py() for x in table.column("vector")]
    signs = np.stack([np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("signature")])
    bucket = table.column("bucket").to_numpy()
    lengths = np.array([len(d) for d in data])
    a, b = [], []
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        at = at[np.argsort(bucket[at], kind="stable")]
        x, here = unit_rows([data[i] for i in at]), bucket[at]
        # Each row with the one so many places on, as long as any is in the same bucket.
        for step in range(1, len(at)):
            i = np.flatnonzero(here[step:] == here[:-step])
            if len(i) == 0:
                break
            i = i[np.einsum("ij,ij->i", x[i], x[i + step]) >= threshold]
            i, j = at[i], at[i + step]
            new = ~(signs[i, :first] == signs[j, :first]).any(axis=1)
            a.append(i[new])
            b.append(j[new])
    i = np.concatenate(a) if a else np.zeros(0, np.int64)
    j = np.concatenate(b) if b else np.zeros(0, np.int64)
    return _told(table, i, j)


def _told(table: pa.Table, i: np.ndarray, j: np.ndarray) -> pa.Table:
    """Rows (node, others, root) of the classes that the pairs (i, j) of rows link."""
    copies, n = table.column("copies").to_numpy(), len(table)
    others = np.bincount(i, weights=copies[j], minlength=n) + np.bincount(j, weights=copies[i], minlength=n)
    root = joined(i, j, n)
    at = np.flatnonzero(others)
    nodes = table.column("node")
    return pa.table(
        {
            "node": nodes.take(pa.array(at)),
            "others": pa.array(others[at].astype(np.int64)),
            "root": nodes.take(pa.array(root[at])),
        }
    )


def joined(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` places the least one that the pairs (a, b) join it to."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def links(classes: DataFrame, k: int, tables: int, threshold: float, width: float, seed: int) -> DataFrame:
    """Rows (node, others, root) as :func:`compare` gives them; a pair of classes counts in one of them only."""
    packs = max(1, -(-classes.count() // PACK_ROWS))
    # Dealt once, by packs of buckets: sizes of buckets and the work on small ones need no other shuffle.
    rows = bucket_rows(classes, k, tables, width, seed).withColumn("pack", F.pmod(F.xxhash64("bucket"), F.lit(packs)))
    size = F.count("*").over(W.partitionBy("table", "pack", "bucket"))
    sized = rows.repartition("table", "pack").withColumn("n", size)
    kind = classes.schema["node"].dataType.simpleString()
    schema = f"node {kind}, others long, root {kind}"
    most = min(SMALL, BLOCK)
    small = (
        sized.where(F.col("n").between(2, most))
        .select("table", "pack", "bucket", "node", "vector", "copies", "signature")
        .groupBy("table", "pack")
        .applyInArrow(lambda t: compare_small(t, threshold), schema)
    )
    met = (
        sized.where(F.col("n") > most)
        .withColumn("parts", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    )
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = met.withColumn("other", other).select(
        "table",
        "bucket",
        F.least("part", "other").alias("low"),
        F.greatest("part", "other").alias("high"),
        "part",
        "node",
        "vector",
        "copies",
        "signature",
    )
    large = dealt.groupBy("table", "bucket", "low", "high").applyInArrow(lambda t: compare(t, threshold), schema)
    return small.unionByName(large)


def cosine_groups(
    vectors: DataFrame, threshold: float = THRESHOLD, width: float = WIDTH, recall: float = RECALL, seed: int = 5
) -> DataFrame:
    """Per row: vec_id, n_links, component_id and kept."""
    rows = vector_classes(vectors)
    number = F.coalesce("vec_id", F.lit(NO_ID))
    classes = stage(
        rows.where("vector IS NOT NULL")
        .groupBy("vector")
        .agg(F.min(number).alias("first"), F.count("*").alias("copies"))
        .select(F.struct("first", F.md5("vector").alias("class")).alias("node"), "vector", "copies")
    )
    k, tables = plan(classes.count(), threshold, width, recall)
    found = stage(links(classes, k, tables, threshold, width, seed))
    degree = found.groupBy("node").agg(F.sum("others").alias("others"))
    known = (
        classes.select("node", "copies")
        .join(degree, "node", "left")
        .join(connect(found.select(F.col("node").alias("a"), F.col("root").alias("b"))), "node", "left")
        .select(
            F.col("node.class").alias("class"),
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "node").getField("first").alias("found"),
        )
    )
    out = rows.select("vec_id", F.md5("vector").alias("class")).join(known, "class", "left")
    own = F.coalesce("found", number)
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(own != NO_ID, own).alias("component_id"),
        F.coalesce(own == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
