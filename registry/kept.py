"""Figures from stored states, each state of one group and month."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from outcomekit.operators import kept
from outcomekit.session import scratch_dir
from registry.core import query, table
from registry.profiling import rounded


def stored(spark, states):
    """States as they are read back from storage."""
    path = os.path.join(scratch_dir(spark), f"states-{uuid.uuid4().hex}")
    kept.save_states(states, path)
    return kept.load_states(spark, path, states.schema)


def _by_month(df, day):
    return df.withColumn("month", F.date_format(day, "yyyy-MM"))


@query(
    "a08_kept_states",
    """SELECT o_orderpriority, count(*) AS n, round(avg(o_totalprice), 4) AS mean, min(o_totalprice) AS low,
          max(o_totalprice) AS high, true AS near_median FROM orders GROUP BY o_orderpriority""",
)
def kept_states(spark, sf):
    """Whole-table figures from months; the median must lie within the stated error of rank."""
    orders = _by_month(table(spark, sf, "orders"), "o_orderdate")
    merged = kept.merged_numbers(
        stored(spark, kept.number_states(orders, "o_totalprice", ["o_orderpriority"], "month")), ["o_orderpriority"]
    )
    guess = merged.select("o_orderpriority", "n", F.col("quantiles")[0].alias("guess"))
    # A rank per priority, of which there are few.
    ranks = orders.join(F.broadcast(guess.limit(1_000)), "o_orderpriority").groupBy("o_orderpriority").agg(
        F.count_if(F.col("o_totalprice") < F.col("guess")).alias("below"),
        F.count_if(F.col("o_totalprice") <= F.col("guess")).alias("upto"),
    )
    off = F.greatest(F.col("below") / F.col("n") - 0.5, 0.5 - F.col("upto") / F.col("n"))
    out = merged.join(ranks, "o_orderpriority")
    out = out.select("o_orderpriority", "n", "mean", "low", "high", (off <= kept.RANK_ERROR).alias("near_median"))
    return rounded(out, "mean", digits=4)


@query(
    "a13_kept_grid",
    """WITH c AS (SELECT l_returnflag, CASE WHEN l_quantity < 5 THEN -1 WHEN l_quantity > 45 THEN 2147483647
             ELSE least(19, CAST(floor((l_quantity - 5) / 2) AS INTEGER)) END AS cell, count(*) AS n FROM lineitem GROUP BY ALL),
        d AS (SELECT *, sum(CASE WHEN cell BETWEEN 0 AND 19 THEN n END) OVER (PARTITION BY l_returnflag) AS held FROM c)
        SELECT l_returnflag, cell,
          CASE WHEN cell BETWEEN 0 AND 19 THEN cell * 2.0::DOUBLE + 5 WHEN cell > 19 THEN 45.0::DOUBLE END AS lower,
          CASE WHEN cell BETWEEN 0 AND 19 THEN cell * 2.0::DOUBLE + 7 WHEN cell < 0 THEN 5.0::DOUBLE END AS upper, n,
          CASE WHEN cell BETWEEN 0 AND 19 THEN round(n / (held * 2.0::DOUBLE), 6) END AS density FROM d""",
)
def kept_grid(spark, sf):
    lines = _by_month(table(spark, sf, "lineitem"), "l_shipdate")
    states = stored(spark, kept.grid_states(lines, "l_quantity", ["l_returnflag"], "month", 5.0, 45.0, 20))
    return rounded(kept.merged_grid(states, 5.0, 45.0, 20, ["l_returnflag"]), "density")


@query(
    "e10_kept_auc",
    """WITH placed AS (SELECT l_returnflag, CASE WHEN l_extendedprice > 50000 THEN 1 ELSE 0 END AS label,
          least(199, greatest(1, CAST(ceil(l_quantity / 50.0::DOUBLE * 199) AS INTEGER))) AS place FROM lineitem),
        tallied AS (SELECT l_returnflag, place, sum(label) AS pos, sum(1 - label) AS neg FROM placed GROUP BY ALL),
        curve AS (SELECT l_returnflag, t.thr, coalesce(sum(pos) FILTER (WHERE place > t.thr), 0) AS tp,
              coalesce(sum(neg) FILTER (WHERE place > t.thr), 0) AS fp, sum(pos) AS p, sum(neg) AS n
            FROM tallied, (SELECT unnest(range(0, 200)) AS thr) t GROUP BY l_returnflag, t.thr),
        steps AS (SELECT *, lead(tp) OVER w AS tp2, lead(fp) OVER w AS fp2 FROM curve
            WINDOW w AS (PARTITION BY l_returnflag ORDER BY thr))
        SELECT l_returnflag, round(sum((fp - fp2)::DOUBLE / n * (tp + tp2)::DOUBLE / p / 2), 6) AS grid_auc
        FROM steps WHERE tp2 IS NOT NULL GROUP BY l_returnflag""",
)
def kept_auc(spark, sf):
    lines = _by_month(table(spark, sf, "lineitem"), "l_shipdate").select(
        "l_returnflag", "month", (F.col("l_quantity") / 50.0).alias("score"),
        (F.col("l_extendedprice") > 50000.0).cast("int").alias("label"),
    )
    states = stored(spark, kept.score_states(lines, ["l_returnflag"], "month"))
    return rounded(kept.merged_auc(states, ["l_returnflag"]), "grid_auc")
