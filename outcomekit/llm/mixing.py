"""Documents mixed to target weights of a domain, language and source tree.

Method
    A token budget is handed down the tree. Every node gets its weight's part of what its parent got,
    but no more than its leaves can give in ``max_epochs`` passes; what it cannot take goes to its
    siblings by their weights. A parent takes less than its part only if all its leaves are full, so
    shortages go to siblings first and to the ancestors' siblings after that. Shares are whole tokens:
    the remainders of a division go one token each to the first nodes by name.

    A leaf gives whole passes first. The rest comes from one more pass in an order of its own, seeded
    by the number of the pass: the longest prefix of documents that does not exceed the rest. The
    prefix is found as a cut in the order's keys, so documents are chosen by comparing with one row per
    leaf and are never shuffled.

Columns only, no Python in tasks.

Defined cases
    Null texts have no tokens, null languages and sources are the name ''. Documents of equal
    ``doc_id`` come together or not at all. Leaves without tokens give nothing. Weights default to 1;
    a weight of 0 leaves the node out. An empty table gives no rows. Extra columns are kept, except
    those named as an added one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcomekit.session import stage

LEVELS = ("domain", "lang", "source")
ROWS_PER_PART = 50_000
WORD = r"[^\x20\x09-\x0D]+"
WHOLE = "decimal(38,0)"

#: Weights by level and name. Sources are in four domains by the last digit of their number.
WEIGHTS: dict[str, dict[str, int]] = {
    "domain": {"web": 5, "books": 2, "forums": 2, "news": 3, "other": 1},
    "lang": {"en": 6, "fr": 2, "de": 2, "es": 1},
    "source": {"src0": 3, "src1": 2},
}
BUDGET_PERCENT = 80
MAX_EPOCHS = 4


def domain_of(source: str = "source") -> Column:
    digit = F.regexp_extract(source, "([0-9])$", 1)
    return (
        F.when(digit.isin("0", "4", "8"), "web")
        .when(digit.isin("1", "5", "9"), "books")
        .when(digit.isin("2", "6"), "forums")
        .when(digit.isin("3", "7"), "news")
        .otherwise("other")
    )


def order_key(seed: int, epoch: Column) -> Column:
    """Place of a document in a pass: text that sorts at random, the same for equal ids."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def weight_of(level: str, weights: dict[str, dict[str, int]]) -> Column:
    known = weights.get(level, {})
    out = F.lit(1)
    for name, weight in known.items():
        out = F.when(F.col(level) == name, F.lit(weight)).otherwise(out)
    return out


def leaves(docs: DataFrame) -> dict[str, Column]:
    return {
        "domain": domain_of(),
        "lang": F.coalesce("lang", F.lit("")),
        "source": F.coalesce("source", F.lit("")),
    }


def token_rows(docs: DataFrame) -> DataFrame:
    """Staged rows doc_id, domain, lang, source, n_tokens."""
    return stage(
        docs.select(
            "doc_id",
            *[c.alias(k) for k, c in leaves(docs).items()],
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
        )
    )


def share_out(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Hand ``budget`` of each parent to its nodes by ``weight``, none above ``cap``; adds ``grant``.

    In ascending order of cap per weight the full nodes come first: a node is full if its cap is not
    above its weight's part of what the nodes before it leave.
    """
    by = W.partitionBy(*parents) if parents else W.partitionBy(F.lit(0))
    rising = by.orderBy((F.col("cap") / F.col("weight")).cast("double"), name)
    before = rising.rowsBetween(W.unboundedPreceding, -1)
    after = rising.rowsBetween(W.currentRow, W.unboundedFollowing)
    zero = F.lit(0).cast(WHOLE)

    def whole(column: Column) -> Column:
        return column.cast(WHOLE)

    nodes = nodes.where("weight > 0 AND cap > 0").withColumns(
        {
            "_left": whole(F.col("budget")) - F.coalesce(whole(F.sum("cap").over(before)), zero),
            "_weights": whole(F.sum("weight").over(after)),
        }
    )
    full = whole(F.col("cap")) * F.col("_weights") <= F.col("_left") * F.col("weight")
    nodes = nodes.withColumn("_full", full)
    nodes = nodes.withColumns(
        {
            "_rest": whole(F.col("budget"))
            - F.coalesce(whole(F.sum(F.when(F.col("_full"), F.col("cap"))).over(by)), zero),
            "_open": F.sum(F.when(~F.col("_full"), F.col("weight"))).over(by),
        }
    )
    whole_part = F.expr("CAST(_rest AS BIGINT) * weight DIV _open")
    nodes = nodes.withColumn("_part", F.when(~F.col("_full"), whole_part))
    nodes = nodes.withColumns(
        {
            "_spare": F.col("_rest").cast("long") - F.sum("_part").over(by),
            "_rank": F.row_number().over(by.orderBy("_full", name)),
        }
    )
    grant = F.when(F.col("_full"), F.col("cap")).otherwise(
        F.col("_part") + (F.col("_rank") <= F.col("_spare")).cast("long")
    )
    return nodes.withColumn("grant", grant.cast("long")).drop(
        "_left", "_weights", "_full", "_rest", "_open", "_part", "_spare", "_rank"
    )


def budgets(
    tokens: DataFrame, weights: dict[str, dict[str, int]], budget_percent: int, max_epochs: int
) -> DataFrame:
    """Staged rows domain, lang, source, tokens, n_docs, grant, full: one per leaf that gives tokens."""
    leaf = tokens.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs"))
    leaf = stage(leaf.where("tokens > 0"))
    given = None
    for depth, level in enumerate(LEVELS):
        parents = list(LEVELS[:depth])
        nodes = leaf.groupBy(*parents, level).agg((F.sum("tokens") * max_epochs).alias("cap"))
        nodes = nodes.withColumn("weight", weight_of(level, weights).cast("long"))
        if given is None:
            share = f"(sum(cap) OVER () DIV {int(max_epochs)}) * {int(budget_percent)} DIV 100"
            nodes = nodes.withColumn("budget", F.expr(share))
        else:
            nodes = nodes.join(given, parents)
        given = share_out(nodes, parents, level).select(*parents, level, F.col("grant").alias("budget"))
    return stage(
        leaf.join(given, list(LEVELS))
        .withColumnRenamed("budget", "grant")
        .withColumn("full", F.expr("grant DIV tokens"))
    )


def prefix_cuts(tokens: DataFrame, given: DataFrame, seed: int) -> DataFrame:
    """Staged rows domain, lang, source, full, cut: the last key of each leaf's prefix, '' for none.

    Documents of a leaf are dealt into parts by the first digits of their key. Only the part in which
    the rest runs out is sorted.
    """
    digits = F.greatest(F.lit(1), F.ceil(F.log(16.0, F.greatest(F.col("n_docs") / ROWS_PER_PART, F.lit(1.0)))))
    given = given.select(
        *LEVELS, "full", F.expr("grant % tokens").alias("rest"), digits.cast("int").alias("digits")
    )
    keyed = tokens.join(given, list(LEVELS)).where("rest > 0")
    keyed = keyed.withColumn("key", order_key(seed, F.col("full") + 1)).withColumn(
        "part", F.expr("substring(key, 1, digits)")
    )
    parts = keyed.groupBy(*LEVELS, "part").agg(F.sum("n_tokens").alias("held"), F.max("key").alias("last"))
    parts = parts.join(given, list(LEVELS))
    sofar = W.partitionBy(*LEVELS).orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)
    parts = stage(parts.withColumn("upto", F.sum("held").over(sofar)))
    whole = parts.where("upto <= rest").groupBy(*LEVELS).agg(F.max("last").alias("cut"))
    cut = parts.where("upto > rest AND upto - held <= rest").select(
        *LEVELS, "part", (F.col("rest") - F.col("upto") + F.col("held")).alias("room")
    )
    inner = keyed.drop("rest", "full", "digits").join(cut, [*LEVELS, "part"])
    running = W.partitionBy(*LEVELS, "part").orderBy("key").rangeBetween(W.unboundedPreceding, W.currentRow)
    inner = inner.withColumn("upto", F.sum("n_tokens").over(running)).where("upto <= room")
    inner = inner.groupBy(*LEVELS).agg(F.max("key").alias("cut"))
    cuts = whole.union(inner).groupBy(*LEVELS).agg(F.max("cut").alias("cut"))
    return stage(
        given.select(*LEVELS, "full").join(cuts, list(LEVELS), "left").withColumn("cut", F.coalesce("cut", F.lit("")))
    )


def chosen(docs: DataFrame, cuts: DataFrame, seed: int) -> DataFrame:
    """``docs`` (with LEVELS) once for each pass that takes them, with its number ``epoch``."""
    passes = F.col("full") + (order_key(seed, F.col("full") + 1) <= F.col("cut")).cast("long")
    taken = docs.join(cuts, list(LEVELS)).withColumn("_passes", passes).where("_passes > 0")
    return taken.withColumn("epoch", F.explode(F.expr("sequence(1, CAST(_passes AS INT))"))).drop(
        "_passes", "full", "cut"
    )


def mix_documents(
    docs: DataFrame,
    weights: dict[str, dict[str, int]] = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 11,
) -> DataFrame:
    """``docs`` chosen by weight: all their columns and ``epoch``, a row for each pass that takes a document."""
    plain = docs.drop("epoch") if "epoch" in docs.columns else docs
    tokens = token_rows(plain)
    cuts = prefix_cuts(tokens, budgets(tokens, weights, budget_percent, max_epochs), seed)
    kept = [F.col(f"`{c}`") for c in plain.columns if c != "doc_id"]
    rows = plain.select("doc_id", F.struct(*kept).alias("_row"), *[c.alias(k) for k, c in leaves(plain).items()])
    out = chosen(rows, cuts, seed)
    named = [F.col("doc_id") if c == "doc_id" else F.col("_row").getField(c).alias(c) for c in plain.columns]
    return out.select(*named, "epoch")


def mixed_tokens(
    docs: DataFrame,
    weights: dict[str, dict[str, int]] = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 11,
) -> DataFrame:
    """Rows doc_id, domain, lang, source, n_tokens, epoch of the mix, without the texts."""
    tokens = token_rows(docs)
    cuts = prefix_cuts(tokens, budgets(tokens, weights, budget_percent, max_epochs), seed)
    return chosen(tokens, cuts, seed)
