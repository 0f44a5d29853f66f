"""Documents joined by the Jaccard similarity of their word shingles, exactly, by T-occurrence search.

Method
    A document's set is its distinct shingles of ``size`` lower-cased words, or its whole sequence if
    it has fewer words. One shuffle counts in how many documents each shingle occurs. All sets are
    ordered from rare to frequent shingles; two sets as similar as asked share one of the rarest few
    of each, the prefix. Shingles of one document only lead nowhere, so an inverted list holds the
    documents that have a shared shingle in their prefix. Equal sets are one class with one entry.

    A class is a query against classes of its lists: their shingles form inverted lists again,
    DivideSkip merges the short ones and probes the long ones by binary search for documents that
    have been found often enough, and classes that reach the required overlap are linked.

    The first round queries the smallest class of each list, its hub, against the other classes of its
    lists, and joins what is linked. The second queries the classes that are then in another component
    than their hub against all classes of the hub's lists. Two classes of one list are in one hub's
    lists, so no link between components is lost, while near copies of a hub cost one query.

Defined cases
    Null, empty and blank texts have no shingles and link with nothing. A component is named by its
    smallest ``doc_id``; rows with a null ``doc_id`` never name it unless alone, and rows with equal
    ``doc_id`` are separate documents. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomekit.llm.blocks import (
    answer,
    ask,
    bucket_bounds,
    bucket_count,
    by_bucket,
    deflate,
    kept_rows,
    open_payload,
    pack,
    per_block,
    to_blocks,
    unpack,
    with_answers,
)
from outcomekit.llm.components import connect
from outcomekit.llm.text import LOWER, U64, find_words, mix, text_bytes, window_starts, windows, word_hashes
from outcomekit.session import stage

SIZE = 4
PERCENT = 85
NO_ID = np.iinfo(np.int64).max
#: Shingles of the candidates that one task compares with a query at a time.
SHINGLES_PER_TASK = 1_000_000
#: Cost ratio of the DivideSkip rule for how many lists are long.
MU = 0.0085

DOC_SCHEMA = (
    "block long, place long, doc_id long, n_shingles long, class binary, prefix array<long>, shingles binary"
)


class Sets:
    """Shingle sets of a block's documents: ``shingles[bounds[i]:bounds[i + 1]]``, ascending."""

    def __init__(self, payload: bytes, size: int) -> None:
        batch = open_payload(payload)
        self.ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64())
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
        data = LOWER[data]
        spans = find_words(data, offsets)
        words = word_hashes(data, spans)
        counts = np.diff(spans.first)
        begins = window_starts(spans.first, size)
        parts, owners = [windows(words, size)[begins]], [spans.owners()[begins]]
        for n in range(1, size):
            short = np.flatnonzero(counts == n)
            parts.append(windows(words, n, seed=n)[spans.first[short]])
            owners.append(short)
        owner, shingle = np.concatenate(owners), np.concatenate(parts)
        order = np.lexsort((shingle, owner))
        owner, shingle = owner[order], shingle[order]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1])
        self.owner, self.shingles = owner[new], shingle[new]
        self.bounds = np.searchsorted(self.owner, np.arange(len(self.ids) + 1))
        self.sizes = np.diff(self.bounds)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct shingles of the block, the place of each entry among them, documents that have each."""
        return np.unique(self.shingles, return_inverse=True, return_counts=True)

    def classes(self) -> list[bytes]:
        """128 bits that equal sets have in common."""
        first = np.concatenate([[U64(0)], np.cumsum(mix(self.shingles))])
        other = np.concatenate([[U64(0)], np.cumsum(mix(self.shingles ^ U64(0x5851F42D4C957F2D)))])
        a, b = (x[self.bounds[1:]] - x[self.bounds[:-1]] for x in (first, other))
        both = np.stack([mix(a + self.sizes.astype(np.uint64)), b], axis=1)
        return [row.tobytes() for row in both]


def needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Overlap that a set of ``n`` shares with any similar set, at least."""
    return -(-percent * n // 100)


def frequency_levels(asks: list[bytes]) -> list[bytes]:
    """For each asked shingle 0 if one document has it, else the whole part of log2 of their number."""
    parts = [unpack(a) for a in asks]
    sizes = [len(p["hash"]) for p in parts]
    names = np.concatenate([p["hash"] for p in parts])
    counts = np.ones(len(names), np.int64)
    for start, p in zip(np.cumsum([0, *sizes[:-1]]), parts, strict=True):
        counts[start + p["many"].astype(np.int64)] = p["counts"]
    values, place = np.unique(names, return_inverse=True)
    total = np.bincount(place, weights=counts, minlength=len(values))
    levels = np.floor(np.log2(np.maximum(total, 1))).astype(np.uint8)[place]
    ends = np.cumsum([0, *sizes])
    return [deflate(levels[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def read_levels(given: list[bytes], bounds: np.ndarray) -> np.ndarray:
    sizes = [int(n) for n in np.diff(bounds) if n]
    parts = [np.frombuffer(pa.decompress(g, n, codec="zstd"), np.uint8) for g, n in zip(given, sizes, strict=True)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint8)


def shingle_sets(blocks: DataFrame, size: int, percent: int) -> DataFrame:
    """Staged rows of DOC_SCHEMA, one per document of ``blocks``.

    ``class`` names the set, where another document shares a shingle of the prefix. The first document
    of a class in its block also has the shared shingles of its prefix and the whole set.
    """
    n = bucket_count(blocks)

    def ask_levels(row: dict) -> Iterator[tuple[int, bytes]]:
        names, _, counts = Sets(row["payload"], size).distinct()
        bounds = bucket_bounds(names, n)
        for k in np.flatnonzero(np.diff(bounds)):
            part = slice(bounds[k], bounds[k + 1])
            many = np.flatnonzero(counts[part] > 1)
            yield int(k), pack(
                {
                    # A bucket is a range of the upper bits. The lower 32 name a shingle in it; names that
                    # fall together only make a shingle seem more frequent, which no result depends on.
                    "hash": names[part].astype(np.uint32),
                    "many": many.astype(np.uint32),
                    "counts": counts[part][many].astype(np.uint32),
                }
            )

    def choose(row: dict) -> Iterator[pa.RecordBatch]:
        sets = Sets(row["payload"], size)
        names, place, _ = sets.distinct()
        levels = read_levels(by_bucket(row["levels"]), bucket_bounds(names, n))[place]
        order = np.argsort(sets.owner * 64 + levels, kind="stable")
        rank = np.arange(len(order)) - sets.bounds[:-1][sets.owner[order]]
        limit = (sets.sizes - needed(sets.sizes, percent) + 1)[sets.owner[order]]
        chosen = order[(rank < limit) & (levels[order] > 0)]
        ends = np.searchsorted(sets.owner[chosen], np.arange(len(sets.ids) + 1))
        keys, seen = sets.classes(), set()
        classes, prefixes, wholes = [], [], []
        for i in range(len(sets.ids)):
            mine = chosen[ends[i] : ends[i + 1]]
            first = len(mine) > 0 and keys[i] not in seen
            if first:
                seen.add(keys[i])
            classes.append(keys[i] if len(mine) else None)
            prefixes.append(sets.shingles[mine].view(np.int64) if first else None)
            wholes.append(sets.shingles[sets.bounds[i] : sets.bounds[i + 1]].tobytes() if first else None)
        yield pa.record_batch(
            [
                pa.array(np.full(len(keys), row["block"])),
                pa.array(np.arange(len(keys))),
                sets.ids,
                pa.array(sets.sizes, pa.int64()),
                pa.array(classes, pa.binary()),
                pa.array(prefixes, pa.list_(pa.int64())),
                pa.array(wholes, pa.binary()),
            ],
            names=["block", "place", "doc_id", "n_shingles", "class", "prefix", "shingles"],
        )

    known = with_answers(blocks, answer(ask(blocks, ask_levels), frequency_levels), "levels")
    return stage(per_block(known, choose, DOC_SCHEMA))


class Inverted:
    """Inverted lists over sets: for each shingle, ascending places of the sets that have it."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets], np.int64)
        entries = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.argsort(entries, kind="stable")
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.names, self.starts, self.lengths = np.unique(entries[order], return_index=True, return_counts=True)

    def divide_skip(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Places of the sets whose Jaccard similarity with ``query`` is at least ``percent`` / 100."""
        least = int(needed(len(query), percent))
        at = np.searchsorted(self.names, query)
        known = at < len(self.names)
        known[known] = self.names[at[known]] == query[known]
        at = at[known]
        if len(at) < least:
            return np.zeros(0, np.int64)
        starts, lengths = self.starts[at], self.lengths[at]
        n_long = min(int(least / (MU * np.log2(max(int(lengths.max()), 2)) + 1)), least - 1)
        by_length = np.argsort(lengths, kind="stable")
        short, long = by_length[: len(at) - n_long], by_length[len(at) - n_long :]
        # The short lists are sorted runs; merged, the entries of a set stand side by side and are counted.
        total = lengths[short]
        begin = np.concatenate([[0], np.cumsum(total)[:-1]]) if len(short) else total
        merged = np.arange(int(total.sum())) - np.repeat(begin, total) + np.repeat(starts[short], total)
        counts = np.bincount(self.owner[merged], minlength=len(self.sizes))
        found = np.flatnonzero((counts > 0) & (counts >= least - n_long))
        overlap = counts[found]
        # A set of the short lists may still lack overlap: the long lists are probed for it.
        for k in long[::-1].tolist():
            if len(found) == 0:
                break
            run = self.owner[starts[k] : starts[k] + lengths[k]]
            spot = np.minimum(np.searchsorted(run, found), len(run) - 1)
            overlap = overlap + (run[spot] == found)
        return found[100 * overlap >= percent * (len(query) + self.sizes[found] - overlap)]


def search(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among ``pairs`` (a, b): a is the query, b a class to be compared with it.

    A query with many partners is dealt over several tasks, each with a bounded part of their sets.
    """
    sets = classes.select(F.col("node").alias("b"), F.col("n_shingles").alias("n"), "shingles")
    share = (
        pairs.join(sets.select("b", "n"), "b")
        .groupBy("a")
        .agg(F.ceil(F.sum("n") / F.lit(SHINGLES_PER_TASK)).cast("int").alias("parts"))
    )
    share = stage(share)
    dealt = pairs.join(share, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part")
    )
    queries = share.select(
        "a", F.col("a").alias("b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    rows = dealt.union(queries).join(sets, "b").select("a", "part", "b", "shingles")

    def compare(table: pa.Table) -> pa.Table:
        asked = table.column("a")[0].as_py()
        partners = table.column("b").to_pylist()
        arrays = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
        own = partners.index(asked)
        others = [i for i in range(len(partners)) if i != own]
        hits = Inverted([arrays[i] for i in others]).divide_skip(arrays[own], percent).tolist()
        kept = table.select(["a", "b"]).take(pa.array([others[h] for h in hits], pa.int64()))
        return kept

    node = classes.schema["node"].dataType.simpleString()
    return rows.groupBy("a", "part").applyInArrow(compare, f"a {node}, b {node}")


def search_rest(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among ``members`` (hub, node, root, away) of one hub, where ``away`` marks the queries.

    Every query meets all members of its hub. Members and queries are dealt into parts of bounded size,
    a task for each pair of parts. A task gives no more links than it joins components.
    """
    sets = classes.select("node", F.col("n_shingles").alias("n"), "shingles")
    sizes = members.join(sets.select("node", "n"), "node").groupBy("hub").agg(
        *[
            F.greatest(F.ceil(F.sum(n) / SHINGLES_PER_TASK), F.lit(1)).cast("int").alias(name)
            for n, name in ((F.col("n"), "parts"), (F.when(F.col("away"), F.col("n")), "turns"))
        ]
    )
    sizes = stage(sizes.where("turns IS NOT NULL"))
    dealt = members.join(sizes, "hub").withColumn("lot", F.xxhash64("node"))
    each = "hub", "node", "root"

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    held = dealt.select(
        *each, F.lit(False).alias("asks"), F.pmod("lot", F.col("parts")).cast("int").alias("part"), every("turns").alias("turn")
    )
    asking = dealt.where("away").select(
        *each, F.lit(True).alias("asks"), every("parts").alias("part"), F.pmod("lot", F.col("turns")).cast("int").alias("turn")
    )
    rows = held.union(asking).join(sets.select("node", "shingles"), "node")

    def compare(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        arrays = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
        roots = [tuple(r.values()) for r in table.column("root").to_pylist()]
        joined = {r: r for r in roots}

        def top(r: tuple) -> tuple:
            while joined[r] != r:
                joined[r] = joined[joined[r]]
                r = joined[r]
            return r

        places = np.flatnonzero(~asks)
        index = Inverted([arrays[i] for i in places])
        a, b = [], []
        for q in np.flatnonzero(asks).tolist():
            for i in places[index.divide_skip(arrays[q], percent)].tolist():
                x, y = top(roots[q]), top(roots[i])
                if x != y:
                    joined[x] = y
                    a.append(q)
                    b.append(i)
        nodes = table.column("node").combine_chunks()
        return pa.table({"a": nodes.take(pa.array(a, pa.int64())), "b": nodes.take(pa.array(b, pa.int64()))})

    node = classes.schema["node"].dataType.simpleString()
    return rows.groupBy("hub", "part", "turn").applyInArrow(compare, f"a {node}, b {node}")


def grouped(blocks: DataFrame, size: int, percent: int) -> DataFrame:
    """Rows block, place, doc_id, n_shingles and group, null for a document that no other is like.

    The group is its smallest class, (first doc_id, name).
    """
    sets = shingle_sets(blocks, size, percent)
    firsts = sets.where("class IS NOT NULL").groupBy("class").agg(
        F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("first")
    )
    wholes = sets.where("prefix IS NOT NULL").select("class", "n_shingles", "prefix", "shingles")
    classes = stage(
        wholes.dropDuplicates(["class"])
        .join(firsts, "class")
        .select(F.struct("first", "class").alias("node"), "n_shingles", "prefix", "shingles")
    )
    entries = classes.select("node", F.col("n_shingles").alias("n"), F.explode("prefix").alias("shingle"))
    several = entries.groupBy("shingle").agg(F.count("*").alias("k")).where("k > 1").select("shingle")
    entries = stage(entries.join(several, "shingle"))
    # A list's hub is its smallest class. Two classes of one list are both members of its hub.
    hubs = entries.groupBy("shingle").agg(F.min(F.struct("node", "n")).alias("hub"))
    members = stage(
        entries.join(hubs, "shingle")
        .select(F.col("hub.node").alias("hub"), F.col("hub.n").alias("m"), "node", "n")
        .distinct()
    )
    like = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
    near = members.where((F.col("hub") != F.col("node")) & like)
    links = stage(search(near.select(F.col("hub").alias("a"), F.col("node").alias("b")), classes, percent))
    roots = connect(links)
    known = members.select("hub", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    of_hub = known.where("hub = node").select("hub", F.col("root").alias("of"))
    known = known.join(of_hub, "hub").withColumn("away", F.col("root") != F.col("of")).drop("of")
    apart = known.where("away").select("hub").distinct()
    rest = stage(known.join(apart, "hub"))
    roots = connect(links.union(search_rest(rest, classes, percent)))

    groups = classes.select("node").join(roots, "node", "left").select(
        F.col("node.class").alias("class"), F.coalesce("root", "node").alias("group")
    )
    return sets.select("block", "place", "doc_id", "n_shingles", "class").join(groups, "class", "left").drop("class")


def jaccard_groups(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id."""
    blocks = to_blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    own = F.coalesce(F.col("group.first"), "doc_id", F.lit(NO_ID))
    return grouped(blocks, size, percent).select(
        "doc_id", "n_shingles", F.when(own != NO_ID, own).alias("component_id")
    )


def one_of_each(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group, all columns kept: the first by doc_id, null last."""
    blocks = to_blocks(docs)
    rows = stage(grouped(blocks, size, percent).where("group IS NOT NULL"))
    mine = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "block", "place")
    first = rows.groupBy("group").agg(F.min(mine).alias("first"))
    spare = rows.join(first, "group").where(
        (F.col("block") != F.col("first.block")) | (F.col("place") != F.col("first.place"))
    )
    gone = spare.groupBy("block").agg(F.collect_list("place").alias("gone"))
    known = blocks.select("block", "payload").join(gone.hint("shuffle_hash"), "block", "left")
    return kept_rows(known, docs.schema)
