"""Repeatable splits with exact sizes per class.

A row's part follows from the rank of its draw within its class. Only the cut
points are looked up: the fit counts rows per (class, bucket of the draw) and
ranks just the buckets a cut falls into. Applying the split is then a projection
with literals, with no shuffle and no sort, whatever the size of a class.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcomekit.functions import draw
from outcomekit.operators.quantiles import value_at_rank
from outcomekit.operators.ranking import draw_bucket

# Leading bits of the draw that one counting pass resolves.
STEP_BITS = 12
# A cut is looked up by rank once its bucket holds no more rows than this.
RANKED_ROWS = 1_000_000
MAX_STRATA = 1_000
# Up to this many strata the cuts are literals of the projection.
LITERAL_STRATA = 20


@dataclass(frozen=True)
class Cut:
    """Last row, in the order of (draw, key), of the parts up to ``part``."""

    stratum: object
    part: str
    draw: int
    key: object


def _first_marks(totals: DataFrame, fractions: Mapping[str, float]) -> list[dict]:
    """For each class and part: rank of its last row, and the bucket of draws that row is in.

    The first part takes floor(n x f + 0.5) rows, each further one as many again.
    """
    # A class has at most 2^STEP_BITS totals.
    ordered = W.partitionBy("g").orderBy("b")
    upto = totals.select(
        "g", "b", "n", F.sum("n").over(ordered).alias("upto"), F.sum("n").over(W.partitionBy("g")).alias("n_g")
    )
    ends, reached = [], F.lit(0).cast("bigint")
    for part, fraction in fractions.items():
        size = F.floor(F.col("n_g") * F.lit(float(fraction)) + F.lit(0.5))
        reached = F.least(F.col("n_g"), reached + size)
        ends.append(F.struct(F.lit(part).alias("part"), reached.alias("r")))
    base = F.col("upto") - F.col("n")
    found = upto.select("g", "b", "n", base.alias("base"), "upto", F.inline(F.array(*ends)))
    limit = MAX_STRATA * len(fractions)
    rows = found.where((F.col("r") > F.col("base")) & (F.col("r") <= F.col("upto"))).drop("upto").limit(limit + 1)
    marks = [r.asDict() for r in rows.collect()]
    if len(marks) > limit:
        raise ValueError(f"more than {MAX_STRATA} strata")
    return marks


def _marks_table(df: DataFrame, marks: list[dict], rows: DataFrame) -> DataFrame:
    """The marks as a table: at most MAX_STRATA rows per part."""
    kind = rows.schema["g"].dataType.simpleString()
    cells = [(m["g"], m["part"], m["r"], m["b"], m["base"]) for m in marks]
    return F.broadcast(df.sparkSession.createDataFrame(cells, f"g {kind}, part string, r bigint, b bigint, base bigint"))


def _finer_marks(df: DataFrame, rows: DataFrame, marks: list[dict], bits: int) -> tuple[list[dict], int]:
    """Place the marks within buckets of more leading bits, from counts inside their present ones."""
    finer = min(32, bits + STEP_BITS)
    inside = rows.withColumn("b", draw_bucket(F.col("u"), bits)).alias("x").join(
        _marks_table(df, marks, rows).alias("w"), F.expr("x.g <=> w.g AND x.b = w.b")
    )
    counts = inside.groupBy("w.g", "w.part", "w.r", "w.base", draw_bucket(F.col("x.u"), finer).alias("b"))
    # A mark has at most 2^STEP_BITS counts; only the one its rank falls into is read.
    upto = F.col("base") + F.sum("n").over(W.partitionBy("g", "part").orderBy("b"))
    placed = counts.agg(F.count("*").alias("n")).withColumn("upto", upto)
    hit = placed.where("r <= upto AND r > upto - n").select("g", "part", "r", "b", "n", F.expr("upto - n").alias("base"))
    return [r.asDict() for r in hit.collect()], finer


@dataclass(frozen=True)
class HashSplit:
    key: str
    seed: int
    stratum: str | None
    parts: tuple[str, ...]
    rest: str
    cuts: tuple[Cut, ...]
    strata: tuple = (None,)

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        key: str,
        fractions: Mapping[str, float],
        stratum: str | None = None,
        seed: int = 42,
        rest: str = "train",
    ) -> HashSplit:
        """Find the cut points. ``fractions`` name the parts in the order they are cut off."""
        group = F.col(stratum) if stratum else F.lit(None).cast("string")
        rows = df.select(group.alias("g"), F.col(key).alias("k"), draw(key, seed, "split").alias("u"))
        totals = rows.groupBy("g", draw_bucket(F.col("u"), STEP_BITS).alias("b")).agg(F.count("*").alias("n"))
        marks = _first_marks(totals, fractions)
        if not marks:
            return cls(key, seed, stratum, tuple(fractions), rest, ())
        bits = STEP_BITS
        while bits < 32 and max(m["n"] for m in marks) > RANKED_ROWS:
            marks, bits = _finer_marks(df, rows, marks, bits)
        buckets = sorted({m["b"] for m in marks})
        # One bucket of one class per task, of about RANKED_ROWS rows at most.
        inside = F.row_number().over(W.partitionBy("g", "b").orderBy("u", "k"))
        near = rows.withColumn("b", draw_bucket(F.col("u"), bits)).where(F.col("b").isin(buckets))
        found = near.withColumn("i", inside).alias("x").join(
            _marks_table(df, marks, rows).alias("w"),
            F.expr("x.g <=> w.g AND x.b = w.b AND x.i + w.base = w.r"),
        )
        got = found.select("x.g", "w.part", "x.u", "x.k").collect()
        cuts = tuple(Cut(r["g"], r["part"], r["u"], r["k"]) for r in got)
        strata = tuple(dict.fromkeys(c.stratum for c in cuts))
        return cls(key, seed, stratum, tuple(fractions), rest, cuts, strata)

    def _part(self, u: Column, bounds: dict[str, tuple[Column, Column]]) -> Column:
        """The first part whose last row is not before this one."""
        k, here = F.col(self.key), F.lit(self.rest)
        for part in reversed(self.parts):
            if part in bounds:
                last_u, last_k = bounds[part]
                here = F.when((u < last_u) | ((u == last_u) & (k <= last_k)), part).otherwise(here)
        return here

    def transform(self, df: DataFrame, to: str = "split") -> DataFrame:
        drawn = df.withColumn("_u", draw(self.key, self.seed, "split"))
        u = F.col("_u")
        if self.stratum is None:
            mine = {c.part: (F.lit(c.draw), F.lit(c.key)) for c in self.cuts}
            return drawn.withColumn(to, self._part(u, mine)).drop("_u")
        if len(self.strata) > LITERAL_STRATA:
            return self._transform_by_join(drawn, df, to)
        out = F.lit(self.rest)
        for value in self.strata:
            mine = {c.part: (F.lit(c.draw), F.lit(c.key)) for c in self.cuts if c.stratum == value}
            out = F.when(F.col(self.stratum).eqNullSafe(F.lit(value)), self._part(u, mine)).otherwise(out)
        return drawn.withColumn(to, out).drop("_u")

    def _transform_by_join(self, drawn: DataFrame, df: DataFrame, to: str) -> DataFrame:
        """Look the cuts up in a broadcast table of at most MAX_STRATA rows."""
        kinds = {c: t for c, t in df.dtypes}
        names = [f"_{side}{i}" for i in range(len(self.parts)) for side in ("u", "k")]
        rows = []
        for value in self.strata:
            mine = {c.part: c for c in self.cuts if c.stratum == value}
            cells = [(mine[p].draw, mine[p].key) if p in mine else (-1, None) for p in self.parts]
            rows.append((value, *[x for cell in cells for x in cell]))
        columns = [f"`{n}` {'bigint' if n.startswith('_u') else kinds[self.key]}" for n in names]
        table = df.sparkSession.createDataFrame(rows, f"_g {kinds[self.stratum]}, " + ", ".join(columns))
        joined = drawn.join(F.broadcast(table), F.col(self.stratum).eqNullSafe(F.col("_g")), "left")
        bounds = {p: (F.col(f"_u{i}"), F.col(f"_k{i}")) for i, p in enumerate(self.parts)}
        return joined.withColumn(to, self._part(F.col("_u"), bounds)).drop("_u", "_g", *names)


def tail_split(
    df: DataFrame, order: str, fraction: float, to: str = "split", head: str = "train", tail: str = "validation"
) -> DataFrame:
    """Mark the last fraction of the rows in ascending order of a unique column."""
    n = df.select(order).count()
    keep = math.floor(n * (1.0 - fraction))
    if keep == 0 or keep >= n:
        return df.withColumn(to, F.lit(tail if keep == 0 else head))
    first_of_tail = value_at_rank(df, order, keep, n)
    return df.withColumn(to, F.when(F.col(order) >= F.lit(first_of_tail), tail).otherwise(head))
