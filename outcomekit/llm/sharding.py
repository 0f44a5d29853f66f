"""Rows dealt into shards of near equal size by sampled splitters.

Method
    Rows lie on a line of keys, by default a hash of the text, so equal texts share a key. A sample of
    keys, drawn with a chance in proportion to size, gives splitters at quantiles. Exact sizes of the
    ranges between them are added up; a range over the tolerance is overfull and is divided by
    splitters sampled within it, until none is overfull or it is a single key. Shards are runs of
    ranges, cut where the exact running size comes nearest to the shard's share.

    A text whose copies hold more than the tolerance of a share is set apart first. If all its copies
    fit into the room that one shard has left they go there together, the largest first; otherwise its
    rows are spread over the line one by one. So copies stay together unless no shard has room for
    them, and sizes stay near equal either way.

Result
    ``shard`` 0 to ``n - 1``, ``slot`` without gaps from 0 in each shard, ``size`` in bytes.

Defined cases
    A null text has size ``overhead`` and shares its key with other null texts. Repeated rows are rows.
    An empty table gives no rows; a shard may be empty if there are few rows. Columns of the input keep
    their names and values; a column with the name of an added one is replaced.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomekit.session import stage

SHARDS = 40
OVERHEAD = 16
#: Splitters drawn per shard at first; sizes of the ranges between them reach the driver.
RANGES_PER_SHARD = 64
#: Share of a shard above which a range is overfull, and a text's copies are placed on their own.
TOLERANCE = 1 / 32
ROWS_PER_SLOT_RANGE = 100_000
ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def text_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(OVERHEAD)).cast("long")


def in_ranges(key: Column, splitters: list[int]) -> Column:
    """Number of the range of a key: how many splitters are at most the key."""
    cuts = np.array(splitters, np.int64)

    @F.pandas_udf("int")
    def number(keys: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in keys:
            yield pd.Series(np.searchsorted(cuts, part.to_numpy(np.int64), "right").astype(np.int32))

    return number(key)


def sampled(keyed: DataFrame, total: int, wanted: int, seed: int) -> list[int]:
    """About ``wanted`` keys, each row drawn with a chance in proportion to its size."""
    draw = F.pmod(F.xxhash64("key", "row_hash", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    rows = keyed.where(draw * F.lit(float(total)) < F.col("size") * F.lit(float(wanted))).select("key").distinct()
    return sorted(r.key for r in rows.toLocalIterator())


def range_sizes(keyed: DataFrame, splitters: list[int]) -> list[int]:
    """Exact size of each range."""
    out = [0] * (len(splitters) + 1)
    for row in keyed.groupBy(in_ranges(F.col("key"), splitters).alias("r")).agg(F.sum("size").alias("s")).collect():
        out[row.r] = row.s
    return out


def split_line(keyed: DataFrame, total: int, n: int, seed: int) -> tuple[list[int], list[int]]:
    """Splitters between which no range is overfull unless it is one key, and the sizes of the ranges."""
    limit = max(total * TOLERANCE / n, 1)
    splitters = sampled(keyed, total, n * RANGES_PER_SHARD, seed)
    # Keys that alone hold more than the limit: at most n / TOLERANCE.
    heavy: set[int] = set()
    while True:
        sizes = range_sizes(keyed, splitters)
        done = {bisect.bisect_right(splitters, k) for k in heavy}
        over = [i for i, s in enumerate(sizes) if s > limit and i not in done]
        if not over:
            return splitters, sizes
        seed += 1
        inside = stage(keyed.withColumn("r", in_ranges(F.col("key"), splitters)).where(F.col("r").isin(over)))
        ends = inside.groupBy("r").agg(F.min("key").alias("low"), F.max("key").alias("high")).collect()
        heavy |= {r.low for r in ends if r.low == r.high}
        wide = [r for r in ends if r.low < r.high]
        held = sum(sizes[r.r] for r in wide)
        drawn = sampled(inside.drop("r"), held, int(4 * held / limit) + 4 * len(wide), seed) if wide else []
        # The ends of an overfull range are splitters as well, so that every round divides it.
        splitters = sorted({*splitters, *drawn, *[k for r in wide for k in (r.low, r.low + 1, r.high)]})


def place_groups(groups: list[tuple[int, int]], share: float, n: int) -> tuple[dict[int, int], list[int]]:
    """Shards of texts with many copies, the largest first where there is most room; room taken."""
    taken, where = [0] * n, {}
    for size, key in sorted(groups, key=lambda g: (-g[0], g[1])):
        shard = min(range(n), key=lambda s: (taken[s], s))
        if taken[shard] + size <= share:
            taken[shard] += size
            where[key] = shard
    return where, taken


def shard_cuts(splitters: list[int], sizes: list[int], taken: list[int], total: int, n: int) -> list[int]:
    """Keys at which shards 1 to n - 1 begin: the running size nearest to what the shards before hold."""
    running = list(accumulate(sizes))
    cuts, goal = [], 0.0
    free = [max(total / n - t, 0.0) for t in taken]
    scale = (running[-1] / sum(free)) if sum(free) else 0.0
    for s in range(n - 1):
        goal += free[s] * scale
        at = bisect.bisect_left(running, goal, 0, max(len(running) - 1, 0))
        if at > 0 and goal - running[at - 1] <= running[at] - goal:
            at -= 1
        cuts.append(splitters[at] if at < len(splitters) else np.iinfo(np.int64).max)
    return [max(cuts[: i + 1]) for i in range(len(cuts))]


def shard_documents(docs: DataFrame, n: int = SHARDS, key: Column | None = None, seed: int = 1) -> DataFrame:
    """``docs`` with size, text_crc32, law, shard, slot and grown_shard (null: the law is ``bytes``).

    ``key`` is a long that places a row on the line; by default a hash of its text.
    """
    text_key = F.xxhash64("text") if key is None else key
    wide = docs.drop(*[c for c in ADDED if c in docs.columns])
    row = F.xxhash64(*[F.col(f"`{c}`") for c in wide.columns if not _is_map(wide, c)])
    base = wide.withColumns(
        {
            "size": text_size(),
            "text_crc32": F.crc32(F.coalesce("text", F.lit("")).cast("binary")),
            "_key": text_key,
            "_row": row,
        }
    )
    thin = stage(base.select(F.col("_key").alias("text_key"), F.col("_row").alias("row_hash"), "size"))
    total, rows = thin.agg(F.sum("size"), F.count("*")).first()
    total = total or 0
    share = total / n
    # At most n / TOLERANCE texts can each hold more than that part of a share.
    big = thin.groupBy("text_key").agg(F.sum("size").alias("s")).where(F.col("s") > share * TOLERANCE).collect()
    where, taken = place_groups([(r.s, r.text_key) for r in big], share, n)
    spread = [r.text_key for r in big if r.text_key not in where]

    def line_key(text_key: Column, row_hash: Column) -> Column:
        return F.when(_among(text_key, spread), F.xxhash64(text_key, row_hash)).otherwise(text_key)

    loose = thin.where(~_among(F.col("text_key"), list(where))).select(
        line_key(F.col("text_key"), F.col("row_hash")).alias("key"), "row_hash", "size"
    )
    rest = total - sum(taken)
    splitters, sizes = split_line(loose, rest, n, seed) if rest else ([], [0])
    cuts = shard_cuts(splitters, sizes, taken, total, n)
    ranged = in_ranges(line_key(F.col("_key"), F.col("_row")), cuts)
    placed = base.withColumn("shard", F.coalesce(_lookup(F.col("_key"), where), ranged))
    return _numbered(placed, rows).select(
        *[F.col(f"`{c}`") for c in wide.columns],
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _numbered(placed: DataFrame, rows: int) -> DataFrame:
    """Slots: rows of a shard are dealt into parts by hash, numbered there, and moved up by the parts before."""
    parts = max(1, -(-rows // ROWS_PER_SLOT_RANGE))
    dealt = placed.withColumn("_part", F.pmod(F.xxhash64("_row", F.lit(3)), F.lit(parts)))
    counted = stage(dealt.groupBy("shard", "_part").agg(F.count("*").alias("_n")))
    before = counted.select(
        "shard",
        "_part",
        F.expr(
            "sum(_n) OVER (PARTITION BY shard ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
            " - _n AS _before"
        ),
    )
    numbered = dealt.withColumn("_at", F.expr("row_number() OVER (PARTITION BY shard, _part ORDER BY _row) - 1"))
    return numbered.join(before, ["shard", "_part"]).withColumn("slot", (F.col("_at") + F.col("_before")).cast("long"))


def _is_map(df: DataFrame, name: str) -> bool:
    return "map<" in df.schema[name].dataType.simpleString()


def _among(key: Column, keys: list[int]) -> Column:
    return F.coalesce(key.isin(keys), F.lit(False)) if keys else F.lit(False)


def _lookup(key: Column, where: dict[int, int]) -> Column:
    if not where:
        return F.lit(None).cast("int")
    pairs = F.create_map(*[F.lit(x) for kv in where.items() for x in kv])
    return F.element_at(pairs, key)
