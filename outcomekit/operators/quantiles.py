"""Exact order statistics by distributed selection.

``median`` and ``percentile`` gather every distinct value of a column in one
task. Here a sketch first names a narrow bracket around the wanted rank; the next
passes count what lies below it and keep only values inside it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SKETCH_ACCURACY = 10_000
# Twice the rank error the sketch allows, on either side of the wanted rank.
BRACKET_SLACK = 2.0 / SKETCH_ACCURACY
BRACKET_VALUES = 200_000

Bounds = dict[str, tuple]


def exact_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Median of each numeric column; nulls and NaN do not count, a middle pair is averaged.

    All columns share the scans: three, plus two for each time a bracket must be
    narrowed to at most ``BRACKET_VALUES`` values.
    """
    cols = list(dict.fromkeys(cols))
    value = lambda c: F.col(f"`{c}`").cast("double")
    typed = df.select(*[F.when(~F.isnan(value(c)), value(c)).alias(c) for c in cols])
    total, bounds = _sketch(typed, {c: 0.5 for c in cols}, {})
    out: dict[str, float | None] = {c: None for c in cols if total[c] == 0}
    ranks = {c: {(total[c] - 1) // 2, total[c] // 2} for c in cols if total[c]}
    if ranks:
        for c, found in _select(typed, ranks, total, bounds).items():
            out[c] = (found[0] + found[-1]) / 2.0
    return out


def value_at_rank(df: DataFrame, column: str, rank: int, total: int):
    """The value that stands at ``rank`` (from 0) of ``total`` values in ascending order."""
    typed = df.select(column).where(F.col(column).isNotNull())
    _, bounds = _sketch(typed, {column: rank / max(total - 1, 1)}, {})
    return _select(typed, {column: {rank}}, {column: total}, bounds)[column][0]


def _sketch(df: DataFrame, targets: Mapping[str, float], within: Bounds) -> tuple[dict, Bounds]:
    """Count of values and a (low, high) bracket around a target share of each column."""
    aggs = []
    for c, share in targets.items():
        x = F.when(F.col(c).between(*within[c]), F.col(c)) if c in within else F.col(c)
        probes = [max(0.0, share - BRACKET_SLACK), min(1.0, share + BRACKET_SLACK)]
        quantiles = F.percentile_approx(x, F.array(*[F.lit(p) for p in probes]), SKETCH_ACCURACY)
        aggs += [F.count(x).alias(f"n_{c}"), quantiles.alias(f"q_{c}")]
    row = df.agg(*aggs).first()
    return (
        {c: row[f"n_{c}"] for c in targets},
        {c: tuple(row[f"q_{c}"]) for c in targets if row[f"n_{c}"]},
    )


def _select(df: DataFrame, ranks: Mapping[str, set[int]], total: Mapping[str, int], bounds: Bounds) -> dict:
    """Values at the wanted ranks of each column, ascending."""
    out: dict[str, list] = {}
    bounds = dict(bounds)
    todo = list(ranks)
    # A bracket that missed its ranks is opened on that side and not narrowed again, so the rounds end.
    settled: set[str] = set()
    while todo:
        counts = _counts(df, todo, bounds)
        missed = _widened(todo, ranks, counts, bounds)
        if missed:
            bounds.update(missed)
            settled.update(missed)
            continue
        wide = [
            c for c in todo if counts[c][1] > BRACKET_VALUES and bounds[c][0] < bounds[c][1] and c not in settled
        ]
        narrower: Bounds = {}
        if wide:
            targets = {c: (min(ranks[c]) - counts[c][0]) / (counts[c][1] - 1) for c in wide}
            _, found = _sketch(df, targets, bounds)
            # A bracket that stays as it was is held open by ties: few values, many rows.
            narrower = {c: b for c, b in found.items() if b != bounds[c]}
        ready = [c for c in todo if c not in narrower]
        if ready:
            out.update(_pick(df, ready, ranks, bounds, counts))
        bounds.update(narrower)
        todo = list(narrower)
    return out


def _widened(cols: Sequence[str], ranks, counts, bounds: Bounds) -> Bounds:
    """Brackets that do not hold their ranks, opened on the side the ranks lie."""
    out: Bounds = {}
    for c in cols:
        (below, inside), (lo, hi) = counts[c], bounds[c]
        if below > min(ranks[c]):
            lo = float("-inf")
        if below + inside <= max(ranks[c]):
            hi = float("inf")
        if (lo, hi) != bounds[c]:
            out[c] = (lo, hi)
    return out


def _counts(df: DataFrame, cols: Sequence[str], bounds: Bounds) -> dict[str, tuple[int, int]]:
    """Rows below each bracket and rows inside it."""
    aggs = []
    for c in cols:
        lo, hi = bounds[c]
        aggs.append(F.count_if(F.col(c) < lo).alias(f"b_{c}"))
        aggs.append(F.count_if(F.col(c).between(lo, hi)).alias(f"i_{c}"))
    row = df.agg(*aggs).first()
    return {c: (row[f"b_{c}"], row[f"i_{c}"]) for c in cols}


def _pick(df: DataFrame, cols: Sequence[str], ranks, bounds: Bounds, counts) -> dict[str, list]:
    """Read the wanted ranks off the values inside the brackets, counted once each, in one scan of all columns."""
    held = [
        F.struct(F.lit(c).alias("c"), F.when(F.col(c).between(*bounds[c]), F.col(c)).alias("value")) for c in cols
    ]
    long = df.select(F.inline(F.array(*held))).where(F.col("value").isNotNull())
    values = long.groupBy("c", "value").agg(F.count("*").alias("n"))
    # One task per column, but over the distinct values of one narrow bracket.
    upto = F.sum("n").over(W.partitionBy("c").orderBy("value"))
    wanted = F.array().cast("array<bigint>")
    for c in cols:
        places = F.array(*[F.lit(r - counts[c][0]).cast("bigint") for r in sorted(ranks[c])])
        wanted = F.when(F.col("c") == c, places).otherwise(wanted)
    hit = F.exists("wanted", lambda r: (F.col("upto") > r) & (F.col("upto") - F.col("n") <= r))
    rows = values.withColumns({"upto": upto, "wanted": wanted}).where(hit).select("c", "value").collect()
    return {c: sorted(r["value"] for r in rows if r["c"] == c) for c in cols}
