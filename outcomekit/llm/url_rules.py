"""URLs judged by fixed rules, and elsewhere by association rules mined from labelled URLs.

Method
    A URL is a set of tokens: scheme, the last two labels of the host, the labels before them, words
    in those with a hyphen or digits, path segments with digits folded, names of query fields. Tokens
    of nearly every labelled URL tell nothing and are left out. FP-growth finds combinations of the
    others that often occur in labelled URLs together with the label ``bad``, of which at most about
    ``max_labelled`` are used, drawn by hash. A combination becomes a
    rule if it has the support and the confidence asked for, and is dropped if a part of it is a rule
    of at least the same confidence. Rules are filed under their rarest token, an inverted index; a URL
    looks up its tokens and is blocked if it has all tokens of a rule found.

    A fixed rule (host, path) fits the host and its subdomains if the path starts with the rule's; the
    longest that fits decides before any mined rule.

Columns and ``pyspark.ml`` only, no Python in tasks.

Defined cases
    A null URL or one without ``://`` has an empty host and path and is allowed. Labels with nulls only
    are not used. Without labels, or without one of both kinds, there are no mined rules. Repeated pages
    are rows of their own. Extra columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomekit.session import stage

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed rules: verdict, host, start of the path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BAD, GOOD = "=bad", "=good"
MIN_SUPPORT = 0.0005
#: Bad URLs that a rule must hold for, however few are labelled.
MIN_COUNT = 10
#: Part of the labelled URLs above which a token tells nothing.
COMMON = 0.9
MIN_CONFIDENCE = 0.8
#: Most labelled URLs that the rules are mined from; beyond it a sample by hash of about that many.
MAX_LABELLED = 2_000_000


def host_of(url: str = "url") -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def fixed_rule(rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """Struct (rule, verdict) of the longest fixed rule that fits ``host`` and ``path``, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        found = F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits & F.col("path").startswith(path), found).otherwise(out)
    return out


def url_tokens(url: str = "url") -> Column:
    """Distinct tokens of ``url`` with its ``host`` and ``path``; none for a URL without a host."""

    def named(kind: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))

    host, path = F.col("host"), F.translate(F.col("path"), UPPER, LOWER)
    before = F.split(F.regexp_replace(host, r"\.?[^.]+\.[^.]+$", ""), r"\.")
    mixed = F.filter(before, lambda x: x.rlike("[-_0-9]"))
    query = F.regexp_extract_all(F.coalesce(F.col(url), F.lit("")), F.lit(r"[?&]([A-Za-z0-9_.\-]+)="), F.lit(1))
    parts = [
        named("scheme ", F.array(F.coalesce(F.regexp_extract(url, r"(?s)^(.*?)://", 1), F.lit("")))),
        named("label ", before),
        named("word ", F.filter(F.flatten(F.transform(mixed, lambda x: F.split(x, "[-_0-9]+"))), lambda x: F.length(x) > 2)),
        named("end ", F.array(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1))),
        named("path ", F.transform(F.split(path, "/"), lambda x: F.regexp_replace(x, "[0-9]+", "0"))),
        named("field ", query),
    ]
    return F.when(host != "", F.array_distinct(F.concat(*parts))).otherwise(F.array().cast("array<string>"))


def mine_rules(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """Staged rows (items, key, support, confidence) from rows (tokens, bad); ``key`` is the rarest item.

    Of more than ``max_labelled`` rows about so many are drawn by hash of ``page_id`` and tokens (of the tokens
    alone if there is no such column), so another run on any partitions mines the same rules.
    """
    by = [c for c in ("page_id", "tokens") if c in labelled.columns]
    labelled = stage(labelled.where("bad IS NOT NULL AND size(tokens) > 0").select(*by, "bad"))
    n = labelled.count()
    if n > max_labelled:
        share = F.pmod(F.xxhash64(*by), F.lit(1_000_000))
        labelled = stage(labelled.where(share < F.lit(max_labelled * 1_000_000 // n)))
    spark = labelled.sparkSession
    empty = spark.createDataFrame([], "items array<string>, key string, support double, confidence double")
    kinds = labelled.agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")).first()
    if not kinds.bad or not kinds.good:
        return empty
    # A rule's support is the part of URLs with its items and the label, so items rarer than that in bad
    # URLs cannot be in one, and need not be searched.
    known = kinds.bad + kinds.good
    floor = max(MIN_COUNT, int(min_support * known))
    tokens = labelled.select("bad", F.explode("tokens").alias("item"))
    often = tokens.groupBy("item").agg(F.count("*").alias("n"), F.count_if("bad").alias("k"))
    often = often.where((F.col("k") >= floor) & (F.col("n") <= known * COMMON)).select("item")
    rows = labelled.withColumn("id", F.monotonically_increasing_id())
    rows = stage(rows)
    useful = rows.select("id", "bad", F.explode("tokens").alias("item")).join(often, "item")
    baskets = useful.groupBy("id", "bad").agg(F.collect_set("item").alias("tokens"))
    baskets = stage(
        baskets.select(F.concat("tokens", F.array(F.when(F.col("bad"), BAD).otherwise(GOOD))).alias("items"))
    )
    if baskets.isEmpty():
        return empty
    # Support is counted against all labelled URLs, also those without a useful token.
    held = baskets.count()
    model = FPGrowth(
        itemsCol="items", minSupport=min(1.0, floor / held), minConfidence=min_confidence
    ).fit(baskets)
    found = model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD)))
    found = stage(
        found.where(~F.array_contains("antecedent", GOOD)).select(
            F.array_sort("antecedent").alias("items"), "support", "confidence"
        )
    )
    return stage(_pruned(stage(_filed(found, useful))))


def _pruned(rules: DataFrame) -> DataFrame:
    """Rules without those of which a proper part is a rule of at least the same confidence."""
    part = rules.select(F.col("items").alias("part"), F.col("confidence").alias("sure"), "key")
    whole = rules.select("items", "confidence", F.explode("items").alias("key"))
    inside = (F.size("part") < F.size("items")) & (F.size(F.array_except("part", "items")) == 0)
    covered = whole.join(part, "key").where(inside & (F.col("sure") >= F.col("confidence"))).select("items").distinct()
    return rules.join(covered, "items", "left_anti")


def _filed(rules: DataFrame, useful: DataFrame) -> DataFrame:
    """Rules with their rarest item as key."""
    counts = useful.groupBy("item").agg(F.count("*").alias("n"))
    items = rules.select("items", F.explode("items").alias("item")).join(counts, "item")
    keys = items.groupBy("items").agg(F.min(F.struct("n", "item")).getField("item").alias("key"))
    return rules.join(keys, "items").select("items", "key", "support", "confidence")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``url`` of ``urls`` (url, tokens) that have all items of a rule."""
    tokens = urls.select("url", "tokens", F.explode("tokens").alias("key"))
    found = tokens.join(rules.select("items", "key"), "key")
    return found.where(F.size(F.array_except("items", "tokens")) == 0).select("url").distinct()


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """Per page: page_id, host, path, rule and verdict.

    ``labels`` has page_id, bad (boolean). Rules are mined from at most about ``max_labelled`` labelled pages.
    """
    parts = pages.select("page_id", "url").withColumns({"host": host_of(), "path": path_of()})
    known = labels.where("bad IS NOT NULL").select("page_id", "bad")
    mined = mine_rules(
        parts.join(known, "page_id").select("page_id", url_tokens().alias("tokens"), "bad"), min_support, min_confidence, max_labelled
    )
    open_urls = parts.withColumn("fixed", fixed_rule()).where("fixed IS NULL AND host <> ''")
    blocked = matched(
        open_urls.select("url", "host", "path").distinct().select("url", url_tokens().alias("tokens")), mined
    )
    found = parts.withColumn("fixed", fixed_rule()).join(blocked.withColumn("hit", F.lit(True)), "url", "left")
    by_method = F.when(F.coalesce("hit", F.lit(False)), "block").otherwise("allow")
    return found.select(
        "page_id",
        "host",
        "path",
        F.col("fixed.rule").alias("rule"),
        F.coalesce("fixed.verdict", by_method).alias("verdict"),
    )


def bad_pages(labels: DataFrame) -> DataFrame:
    """Labels (doc_id, quality, toxic) as (page_id, bad): bad if of low quality or toxic."""
    bad = reduce(
        lambda a, b: a | b, [F.coalesce(F.col("quality") == 0, F.lit(False)), F.coalesce(F.col("toxic") == 1, F.lit(False))]
    )
    known = F.col("quality").isNotNull() | F.col("toxic").isNotNull()
    return labels.where(known).select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
