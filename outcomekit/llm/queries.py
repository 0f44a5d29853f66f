"""One query per operator on its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from outcomekit.llm import (
    extract,
    jaccard,
    mixing,
    multiset,
    perplexity,
    pii,
    prefix_trie,
    pstable,
    recompress,
    sharding,
    spelling,
    tiling,
    url_rules,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes, copies together where a shard has room."""
    return sharding.shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def _weights(level: str) -> str:
    cases = " ".join(f"WHEN {level} = '{name}' THEN {w}" for name, w in mixing.WEIGHTS[level].items())
    return f"CASE {cases} ELSE 1 END"


def _share(depth: int) -> str:
    """One level of the tree: what each node gets of its parent's budget."""
    level, parents = mixing.LEVELS[depth], ", ".join(mixing.LEVELS[:depth])
    by = f"PARTITION BY {parents}" if parents else ""
    keys = ", ".join(mixing.LEVELS[: depth + 1])
    budget = (
        f"(SELECT sum(tokens) * {mixing.BUDGET_PERCENT} // 100 FROM leaf)" if not depth else "given"
    )
    source = "leaf" if not depth else f"leaf JOIN (SELECT {parents}, given FROM share{depth - 1}) USING ({parents})"
    more = ", given" if depth else ""
    return f"""
    node{depth} AS (
        SELECT *, cap::DOUBLE / weight::DOUBLE AS ratio FROM (
            SELECT {keys}, sum(tokens)::HUGEINT * {mixing.MAX_EPOCHS} AS cap, {_weights(level)}::HUGEINT AS weight,
                   {budget}::HUGEINT AS budget
            FROM {source} GROUP BY {keys}{more})),
    full{depth} AS (
        SELECT *, cap * sum(weight) OVER ({by} ORDER BY ratio, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                  <= weight * (budget - coalesce(sum(cap) OVER (
                      {by} ORDER BY ratio, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS is_full
        FROM node{depth}),
    rest{depth} AS (
        SELECT *, budget - coalesce(sum(cap) FILTER (is_full) OVER ({by}), 0) AS rest,
               sum(weight) FILTER (NOT is_full) OVER ({by}) AS open_weight
        FROM full{depth}),
    part{depth} AS (
        SELECT *, CASE WHEN NOT is_full THEN rest * weight // open_weight END AS part,
               row_number() OVER ({by} ORDER BY is_full, {level}) AS place
        FROM rest{depth}),
    share{depth} AS (
        SELECT {keys}, CASE WHEN is_full THEN cap
                            ELSE part + (place <= rest - sum(part) OVER ({by}))::INT END AS given
        FROM part{depth})"""


@query(
    rf"""
    WITH tokens AS (
        SELECT doc_id, CASE WHEN digit IN ('0', '4', '8') THEN 'web' WHEN digit IN ('1', '5', '9') THEN 'books'
                            WHEN digit IN ('2', '6') THEN 'forums' WHEN digit IN ('3', '7') THEN 'news'
                            ELSE 'other' END AS domain,
               coalesce(lang, '') AS lang, coalesce(source, '') AS source, n_tokens
        FROM (SELECT *, regexp_extract(source, '([0-9])$', 1) AS digit,
                     coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n_tokens
              FROM documents)),
    leaf AS (
        SELECT domain, lang, source, sum(n_tokens) AS tokens FROM tokens GROUP BY ALL HAVING sum(n_tokens) > 0),
    {",".join(_share(d) for d in range(3))},
    plan AS (
        SELECT domain, lang, source, given // tokens AS whole, given % tokens AS over
        FROM leaf JOIN share2 USING (domain, lang, source)),
    keyed AS (
        SELECT *, md5(concat_ws(':', '11', (whole + 1)::VARCHAR, doc_id::VARCHAR)) AS key
        FROM tokens JOIN plan USING (domain, lang, source)),
    running AS (
        SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM keyed)
    SELECT doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens,
           CAST(unnest(range(1, 1 + (whole + (over > 0 AND upto <= over)::INT)::BIGINT)) AS INT) AS epoch
    FROM running
    """
)
def op2_hierarchical_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents chosen to the weights of the domain, language and source tree, a row for each pass."""
    mixed = mixing.mixed_tokens(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")


@query()
def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under a model of trusted text, and which are rejected."""
    return perplexity.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, coalesce(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+'), []::VARCHAR[]) AS w
        FROM documents),
    sets AS (
        SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, p, p + 3), ' ')) AS shingle
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1) + 1))) AS p FROM words)),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    pairs AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o
        FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (
        SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * o >= 85 * (x.n + y.n - o)),
    both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (
        SELECT a AS doc_id, b AS other FROM both_ways
        UNION
        SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
    lowest AS (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
    FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)
    """
)
def op4_t_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of four-word shingles have a Jaccard similarity of 0.85 or more."""
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"))


@query()
def op5_association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: by the fixed rules, else by rules mined from labels."""
    labels = url_rules.bad_pages(table(spark, sf_dir, "labels"))
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), labels)


@query()
def op6_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract.extract_pages(table(spark, sf_dir, "pages"))


@query()
def op7_skip_chain_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find_personal_data(table(spark, sf_dir, "documents")).drop("redacted")


@query(
    """
    WITH words AS (
        SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []::VARCHAR[]) AS w
        FROM documents),
    begins AS (
        SELECT doc_id, p, md5(array_to_string(list_slice(w, p, p + 12), ' ')) AS name
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM words)),
    firsts AS (SELECT name, min(doc_id) AS first_doc FROM begins GROUP BY name),
    gone AS (
        SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS place
        FROM begins JOIN firsts USING (name) WHERE first_doc < doc_id),
    marks AS (SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id),
    kept AS (
        SELECT doc_id, len(w) AS n, coalesce(len(places), 0) AS removed,
               CASE WHEN places IS NULL THEN w
                    ELSE list_transform(
                        list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(places, i)),
                        lambda i: w[i]) END AS left_over
        FROM words LEFT JOIN marks USING (doc_id))
    SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(removed AS BIGINT) AS n_removed,
           sha256(array_to_string(left_over, ' ')) AS kept_sha256
    FROM kept
    """
)
def op8_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of passages of 13 words or more that begin in an earlier document, removed."""
    cut = recompress.cut_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query()
def op9_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the items and their coverage."""
    return tiling.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    """
    WITH RECURSIVE vectors AS (
        SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
        ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
    reach AS (
        SELECT a AS vec_id, b AS other FROM links
        UNION
        SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
    degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a),
    lowest AS (SELECT vec_id, min(other) AS low FROM reach GROUP BY vec_id)
    SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
           vec_id <= coalesce(low, vec_id) AS kept
    FROM vectors LEFT JOIN degree USING (vec_id) LEFT JOIN lowest USING (vec_id)
    """
)
def op10_p_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.9 or more."""
    return pstable.cosine_groups(table(spark, sf_dir, "embeddings"))


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a text of code points below 256, as UTF-8: eight shifts a byte."""
    code = f"flatten(list_transform(string_split({text}, ''), lambda s: CASE WHEN ord(s) < 128 THEN [ord(s)::BIGINT] ELSE [192 + (ord(s) >> 6)::BIGINT, 128 + (ord(s) & 63)::BIGINT] END))"
    shifts = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {code}), lambda c, b: {shifts}), 4294967295)"


@query(
    f"""
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                   md5(concat(strlen(coalesce(role, '')), ':', role, text))) AS place
        FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (
        SELECT conv_id, conv_id - conv_id % 100 AS lead, {_crc32("conv_id::VARCHAR")} % 6 AS h
        FROM (SELECT DISTINCT conv_id FROM turns)),
    heads AS (
        SELECT c.conv_id, h, place, role, text FROM convs c JOIN turns t ON t.conv_id = lead AND place <= h),
    rebuilt AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS d, role, text
        FROM (SELECT conv_id, false AS own, place, role, text FROM heads
              UNION ALL
              SELECT conv_id, true, place, role, text FROM turns JOIN convs USING (conv_id) WHERE place > h)),
    prefixes AS (
        SELECT conv_id, d, length(text) AS chars,
               md5(string_agg(md5(concat(strlen(role), ':', role, text)), ',') OVER (
                   PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING)) AS name
        FROM rebuilt
        UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
    nodes AS (
        SELECT name, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM prefixes GROUP BY name, d),
    last AS (SELECT conv_id, max(d) AS d FROM prefixes GROUP BY conv_id),
    ends AS (
        SELECT name, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
        FROM last JOIN prefixes USING (conv_id, d) GROUP BY name),
    above AS (SELECT n.conv_id, n.d, p.name, p.d AS up FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.d <= n.d),
    parents AS (
        SELECT a.conv_id, a.d, n.name AS up_name, n.conv_id AS parent
        FROM above a JOIN nodes n ON n.name = a.name WHERE a.up = a.d - 1),
    kids AS (SELECT up_name AS name, count(*) AS n FROM parents GROUP BY up_name),
    sums AS (
        SELECT a.name, sum((k.n IS NULL)::INT) AS leaves, sum((m.n_convs - 1) * m.chars) AS saved
        FROM above a JOIN nodes m USING (conv_id, d) LEFT JOIN kids k ON k.name = m.name GROUP BY a.name)
    SELECT n.conv_id, n.d AS depth, p.parent AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
           s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
    FROM nodes n JOIN sums s USING (name) LEFT JOIN parents p USING (conv_id, d) LEFT JOIN kids k ON k.name = n.name
    LEFT JOIN ends e ON e.name = n.name
    """
)
def op11_tree_contraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of conversations that share their first turns, with its subtree's totals."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query(
    rf"""
    WITH RECURSIVE runs AS (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
        FROM documents),
    counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
    drawn AS (SELECT *, {_crc32("concat(doc_id, ':', run)")} AS h FROM counted),
    words AS (
        SELECT word, sum(n)::BIGINT AS n FROM (
            SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                           ELSE run END AS word
            FROM drawn)
        WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    cuts AS (
        SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
        FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
    pairs AS (
        SELECT c.word AS a, w.word AS b FROM cuts c JOIN words w ON c.rest = w.word
        UNION SELECT w.word, c.word FROM cuts c JOIN words w ON c.rest = w.word
        UNION SELECT c.word, d.word FROM cuts c JOIN cuts d ON c.rest = d.rest AND c.i = d.i AND c.word <> d.word),
    near AS (
        SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, b) AS best, max(n) AS best_n
        FROM pairs JOIN words ON b = words.word GROUP BY a),
    forms AS (
        SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form,
               CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
        FROM words LEFT JOIN near USING (word)),
    path AS (
        SELECT word, coalesce(form, word) AS root, form IS NULL AS done FROM forms
        UNION ALL
        SELECT p.word, coalesce(f.form, p.root), f.form IS NULL FROM path p JOIN forms f ON f.word = p.root WHERE NOT p.done)
    SELECT word, form, root, n, n_near, form_n FROM forms JOIN path USING (word) WHERE done
    """
)
def op12_sorted_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the documents with the near words they are variants of."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query()
def op13_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and how alike it is to this and to the next document."""
    return multiset.compared(table(spark, sf_dir, "documents"))
