"""Trie of conversations that share their first turns, with totals of every subtree.

Method
    A conversation's turns are numbered, the first few are replaced by those of another one (see
    ``rebuilt``), and every prefix is named by the exclusive or of a 128-bit hash of (place, role,
    text) over its turns; equal prefixes have equal names. Numbers and names are running values in a
    table sorted over ranges (``scan``): a range goes on from what the ranges before it hold of the same
    conversation, so a conversation of any length is no single task's work. A node is a distinct name; its
    smallest member and its depth identify it from there on.

    Totals of subtrees come from parallel tree contraction. A round of joins rakes all leaves, whose
    totals are known, into their parents, and compresses chains: of the nodes with one child left, those
    are spliced out that come before both neighbors in an order in which every second depth of a chain
    is first. A chain halves with each round, so rounds grow with the logarithm of the depth, and a round
    has less to read than the one before. Spliced nodes remember their child and what lies between;
    going back through the rounds gives each its total from the child's.

    Messages to a parent are added up before the shuffle, and all other joins of a round are one to one
    on nodes, so a turn that many conversations begin with is no hot key there. Conversations that end at
    a node are joined to text in sorted pieces of bounded size before one task per node hashes them.

Result
    Per node conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

Defined cases
    Null role or text is empty. A null turn comes first; equal turns are ordered by a hash of role and
    text, so repeated rows are turns of their own. Rows without conv_id belong to no conversation. A table
    without conversations has no nodes, not even the root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomekit.session import stage

#: A conversation's first turns come from the conversation whose number ends in this many zeros.
FAMILY = 100
#: Fewer turns than this come from there.
MOST_SHARED = 6
#: Bytes of a piece of joined numbers.
PIECE_BYTES = 1 << 20
NODE = ("conv_id", "depth")
NODE_SCHEMA = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)


def hex_half(digest: Column, at: int) -> Column:
    """60 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("long")


def turns_of(conversations: DataFrame) -> DataFrame:
    """Staged narrow rows: conv_id, turn, two halves of a hash of role and text, code points of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("_digest"), F.length(text).cast("long").alias("chars")
    )
    return stage(
        rows.select("conv_id", "turn", hex_half(F.col("_digest"), 1).alias("a"), hex_half(F.col("_digest"), 16).alias("b"), "chars")
    )


def scan(rows: DataFrame, key: str, order: list[str], xored: dict[str, str]) -> DataFrame:
    """``rows`` with ``place``, from 1 in each ``key`` by ``order``, and running exclusive ors.

    ``xored`` gives for each column the name of its running value. Ranges of sorted rows are worked on
    at once; each notes what its last key has come to, and the few values that reach into a
    range's first key are broadcast: one row a range at most.
    """
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    added = ["place", *xored.values()]
    schema = ", ".join([*(f"{c} {t}" for c, t in kinds.items()), *(f"{c} long" for c in added)])
    schema += ", part int, is_first boolean, is_last boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last_key, last = None, None
        waiting = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            begins = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1) != 0)
            group = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(keys))))
            carried = last if keys[0] == last_key else None
            running = [np.arange(1, len(keys) + 1) - begins[group]]
            running[0][group == 0] += carried[0] if carried else 0
            for i, column in enumerate(xored):
                every = np.bitwise_xor.accumulate(batch.column(column).to_numpy())
                before = np.concatenate([[0], every])[begins].astype(np.int64)
                if carried:
                    before[0] ^= carried[i + 1]
                running.append(every ^ before[group])
            last_key, last = keys[-1], [int(r[-1]) for r in running]
            flags = np.zeros(len(keys), bool)
            first = flags.copy()
            first[0] = waiting is None
            if waiting is not None:
                yield pa.record_batch(waiting[0], names=waiting[1])
            columns = [*batch.columns, *(pa.array(r, pa.int64()) for r in running)]
            columns += [pa.array(np.full(len(keys), part, np.int32)), pa.array(first), pa.array(flags)]
            waiting = columns, [*batch.schema.names, *added, "part", "is_first", "is_last"]
        if waiting is not None:
            flags = np.zeros(len(waiting[0][0]), bool)
            flags[-1] = True
            yield pa.record_batch([*waiting[0][:-1], pa.array(flags)], names=waiting[1])

    ranged = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    held = stage(ranged.mapInArrow(run, schema))
    zero = F.lit(0).cast("long")
    ends = held.where("is_first").select(key, "part", F.lit(0).alias("end"), *(zero.alias(c) for c in added))
    ends = ends.union(held.where("is_last").select(key, "part", F.lit(1).alias("end"), *added))
    over = f"OVER (PARTITION BY {key} ORDER BY part, end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    totals = [f"sum(place) {over} AS _place", *(f"bit_xor({c}) {over} AS _{c}" for c in xored.values())]
    before = ends.selectExpr(key, "part", "end", *totals).where("end = 0 AND _place > 0").drop("end")
    found = held.join(F.broadcast(before), [key, "part"], "left")
    return found.select(
        *rows.columns,
        (F.col("place") + F.coalesce("_place", zero)).alias("place"),
        *(F.col(c).bitwiseXOR(F.coalesce(f"_{c}", zero)).alias(c) for c in xored.values()),
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged conversations (conv_id, n turns) and rows (conv_id, n, d, a, b, chars) of rebuilt ones.

    The first ``h`` turns of a conversation, ``h`` drawn by its number, are those of the conversation
    that leads its family; its own turns after its first ``h`` follow.
    """
    placed = stage(scan(turns, "conv_id", ["turn", "a", "b"], {}))
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED
    lengths = placed.groupBy("conv_id").agg(F.max("place").alias("own"))
    turn = F.struct("place", "a", "b", "chars")
    leads = placed.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < MOST_SHARED))
    leads = leads.groupBy(F.col("conv_id").alias("lead")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    known = lengths.withColumns({"lead": F.col("conv_id") - F.col("conv_id") % FAMILY, "h": shared}).join(leads, "lead", "left")
    taken = F.least(F.col("h"), F.coalesce(F.size("turns"), F.lit(0))).cast("long")
    convs = stage(
        known.withColumn("taken", taken).select(
            "conv_id",
            "h",
            "taken",
            (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"),
            F.expr("slice(coalesce(turns, array()), 1, int(taken))").alias("head"),
        )
    )
    heads = convs.select("conv_id", "n", F.explode("head").alias("t")).select(
        "conv_id", "n", F.col("t.place").alias("d"), "t.a", "t.b", "t.chars"
    )
    rest = placed.join(convs.select("conv_id", "h", "taken", "n"), "conv_id").where("place > h")
    rest = rest.select("conv_id", "n", (F.col("place") - F.col("h") + F.col("taken")).alias("d"), "a", "b", "chars")
    return convs.select("conv_id", "n"), heads.unionByName(rest)


def named(rows: DataFrame) -> DataFrame:
    """``rows`` with the names x, y of the prefix that ends there, and up_x, up_y of the one before."""
    tagged = rows.select(
        "conv_id",
        "n",
        "d",
        "chars",
        F.xxhash64("a", "b", "d", F.lit(1)).alias("u"),
        F.xxhash64("d", "b", "a", F.lit(2)).alias("v"),
    )
    run = scan(tagged, "conv_id", ["d"], {"u": "x", "v": "y"})
    return run.withColumns({"up_x": F.col("x").bitwiseXOR(F.col("u")), "up_y": F.col("y").bitwiseXOR(F.col("v"))}).drop("place", "u", "v")


def ends_digests(ends: DataFrame) -> DataFrame:
    """Rows (x, y, ends_sha256): hash of the ascending numbers of the conversations that end at a node."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, ids = (batch.column(c).to_numpy() for c in ("x", "y", "conv_id"))
            new = (np.diff(x, prepend=x[:1] - 1) != 0) | (np.diff(y, prepend=y[:1] - 1) != 0)
            most = PIECE_BYTES // 21
            begins = np.flatnonzero(new | (np.arange(len(x)) % most == 0))
            bounds = np.append(begins, len(x))
            texts = [",".join(map(str, ids[s:e])) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.record_batch(
                [pa.array(x[begins]), pa.array(y[begins]), pa.array(ids[begins]), pa.array(texts, pa.string())],
                names=["x", "y", "first", "ids"],
            )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out: list[tuple[tuple[int, int], str]] = []
            for x, y, ids in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "ids")), strict=True):
                if (x, y) != key:
                    if state is not None:
                        out.append((key, state.hexdigest()))
                    key, state = (x, y), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield digests(out)
        if state is not None:
            yield digests([(key, state.hexdigest())])

    def digests(out: list) -> pa.RecordBatch:
        columns = [[k[0] for k, _ in out], [k[1] for k, _ in out], [h for _, h in out]]
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["x", "y", "ends_sha256"])

    ranged = ends.repartitionByRange("x", "y", "conv_id").sortWithinPartitions("x", "y", "conv_id")
    joined = ranged.mapInArrow(pieces, "x long, y long, first long, ids string")
    dealt = joined.repartition("x", "y").sortWithinPartitions("x", "y", "first")
    return dealt.mapInArrow(hashed, "x long, y long, ends_sha256 string")


def nodes_of(convs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Staged nodes: conv_id, depth, parent_conv_id, x, y, n_convs and code points of the last text."""
    found = stage(
        prefixes.groupBy("x", "y", F.col("d").alias("depth")).agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.max("chars").alias("chars"),
            F.max("up_x").alias("up_x"),
            F.max("up_y").alias("up_y"),
        )
    )
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(
        zero.alias("x"), zero.alias("y"), zero.alias("depth"), "conv_id", "n_convs", zero.alias("chars"),
        zero.alias("up_x"), zero.alias("up_y"),
    )
    every = found.unionByName(root)
    above = every.select(
        F.col("x").alias("up_x"), F.col("y").alias("up_y"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id")
    )
    # Only the root has a parent of no depth, and a node of many children is split by adaptive execution.
    return stage(every.join(above, ["up_x", "up_y", "depth"], "left").drop("up_x", "up_y"))


def before(d: Column, e: Column) -> Column:
    """Whether depth ``d`` is spliced out before ``e``: odd depths first, then odd multiples of two, and so on."""
    low_d, low_e = (x.bitwiseAND(-x) for x in (d, e))
    return (e == 0) | (low_d < low_e) | ((low_d == low_e) & (d < e))


def subtree_sums(tree: DataFrame, values: list[str]) -> DataFrame:
    """Rows (conv_id, depth, *values): each node's values added up over its subtree.

    ``tree`` has conv_id, depth, parent_conv_id (null: root) and ``values``, longs. Nodes are
    identified by (conv_id, depth); a parent's depth is less by one.
    """
    own = [f"own_{v}" for v in values]
    up = [f"up_{v}" for v in values]
    state = tree.select(
        *NODE,
        "parent_conv_id",
        (F.col("depth") - 1).alias("parent_depth"),
        *(F.col(v).alias(o) for v, o in zip(values, own, strict=True)),
        *(F.lit(0).cast("long").alias(u) for u in up),
    )
    parents = tree.where("parent_conv_id IS NOT NULL").select(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")
    )
    inner = parents.distinct().withColumn("inner", F.lit(True))
    state = stage(state.join(inner, [*NODE], "left").withColumn("leaf", F.col("inner").isNull()).drop("inner"))
    rounds: list[tuple[DataFrame, DataFrame]] = []
    while not state.isEmpty():
        leaf = F.col("leaf")
        messages = state.where("parent_conv_id IS NOT NULL").groupBy("parent_conv_id", "parent_depth").agg(
            *(F.sum(F.when(leaf, F.col(o) + F.col(u)).otherwise(0)).alias(f"got_{o}") for o, u in zip(own, up, strict=True)),
            F.sum((~leaf).cast("int")).alias("rest"),
            F.min(F.when(~leaf, F.struct(*NODE, *up))).alias("kid"),
        )
        messages = messages.select(
            F.col("parent_conv_id").alias("conv_id"), F.col("parent_depth").alias("depth"), "rest", "kid", *(f"got_{o}" for o in own)
        )
        raked = state.where(~leaf).join(messages, [*NODE])
        single = (F.col("rest") == 1) & (F.col("depth") > 0)
        single &= before(F.col("depth"), F.col("parent_depth")) & before(F.col("depth"), F.col("kid.depth"))
        raked = stage(
            raked.select(
                *NODE,
                "parent_conv_id",
                "parent_depth",
                *((F.col(o) + F.col(f"got_{o}")).alias(o) for o in own),
                *up,
                (F.col("rest") == 0).alias("leaf"),
                F.when(single, F.col("kid")).alias("kid"),
            )
        )
        spliced = raked.where("kid IS NOT NULL")
        rounds.append((state.where(leaf), spliced))
        moved = spliced.select(
            F.col("kid.conv_id").alias("conv_id"),
            F.col("kid.depth").alias("depth"),
            F.col("parent_conv_id").alias("new_parent"),
            F.col("parent_depth").alias("new_depth"),
            *((F.col(o) + F.col(u)).alias(f"over_{u}") for o, u in zip(own, up, strict=True)),
        )
        kept = raked.where("kid IS NULL").join(moved, [*NODE], "left")
        state = stage(
            kept.select(
                *NODE,
                F.coalesce("new_parent", "parent_conv_id").alias("parent_conv_id"),
                F.coalesce("new_depth", "parent_depth").alias("parent_depth"),
                *own,
                *((F.col(u) + F.coalesce(f"over_{u}", F.lit(0))).alias(u) for u in up),
                "leaf",
            )
        )
    return expanded(rounds, values)


def expanded(rounds: list[tuple[DataFrame, DataFrame]], values: list[str]) -> DataFrame:
    """Totals of all nodes, from the last round back: leaves have theirs, spliced ones ask their child."""
    known = None
    for leaves, spliced in reversed(rounds):
        done = leaves.select(*NODE, *(F.col(f"own_{v}").alias(v) for v in values))
        if known is not None:
            below = known.select(
                F.col("conv_id").alias("kid_conv"), F.col("depth").alias("kid_depth"), *(F.col(v).alias(f"kid_{v}") for v in values)
            )
            asked = spliced.withColumns({"kid_conv": F.col("kid.conv_id"), "kid_depth": F.col("kid.depth")})
            got = asked.join(below, ["kid_conv", "kid_depth"]).select(
                *NODE, *((F.col(f"own_{v}") + F.col(f"kid.up_{v}") + F.col(f"kid_{v}")).alias(v) for v in values)
            )
            done = done.union(got).union(known)
        known = stage(done)
    return known


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Every node of the trie of rebuilt conversations, with the totals of its subtree."""
    convs, rows = rebuilt(turns_of(conversations))
    prefixes = stage(named(rows))
    nodes = nodes_of(convs, prefixes)
    if nodes.isEmpty():
        return conversations.sparkSession.createDataFrame([], NODE_SCHEMA)
    kids = nodes.where("parent_conv_id IS NOT NULL").groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")
    )
    tree = stage(nodes.join(kids.agg(F.count("*").alias("n_children")), [*NODE], "left").fillna(0, ["n_children"]))
    sums = subtree_sums(
        tree.select(
            *NODE,
            "parent_conv_id",
            (F.col("n_children") == 0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        ),
        ["n_leaves", "saved_tokens"],
    )
    none = F.lit(0).cast("long")
    ends = prefixes.where("d = n").select("x", "y", "conv_id").union(
        convs.where("n = 0").select(none, none, "conv_id")
    )
    digests = ends_digests(ends)
    empty = hashlib.sha256(b"").hexdigest()
    return (
        tree.join(sums, [*NODE])
        .join(digests, ["x", "y"], "left")
        .select(
            *NODE, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
        )
    )
