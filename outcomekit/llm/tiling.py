"""Documents that hold passages of benchmark items, found by greedy string tiling.

Method
    Texts are lower-cased words, cut at everything but letters, digits and bytes above 127. Running
    Karp-Rabin hashes of all windows of ``min_match`` words give the seeds that a document shares with
    an item. Seeds next to each other on a diagonal are one match; it is checked word by word. Greedy
    tiling takes the longest match, marks its words on both sides, cuts what overlaps it out of the
    others, and goes on until no match of ``min_match`` words is left. Matches may come in any order,
    so reordered passages count. An item leaks if the tiles cover enough of its words.

    An item of fewer than ``min_match`` words has no seed. It leaks as one whole sequence, found by the
    Karp-Rabin hash of windows of its own length; a single word is in too many texts to tell anything,
    so such an item leaks where it is all a document holds.

    Documents are read once, without a shuffle, against a part of the benchmark of bounded size. A
    benchmark of more words than ``PART_WORDS`` is dealt into such parts by hash, each its own pass.

Defined cases
    Null and empty documents hold nothing, and items without words are in none. Repeated items are searched for as one each; repeated documents are rows of their own. Of
    matches of one length the first in the item, then in the document, comes first. Columns of the
    documents are kept by :func:`without_leaks`, and not read by :func:`leaks`.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.llm.text import LOWER, find_words, give_back, parts, text_bytes, window_starts, windows, word_hashes
from outcomekit.session import stage

MIN_MATCH = 5
COVERAGE = 0.6
PART_WORDS = 1_000_000

OTHER = np.ones(256, dtype=bool)
OTHER[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = False
OTHER[128:] = False

ITEM_SCHEMA = "item_id long, n long, words binary"
LEAK_SCHEMA = "doc_id long, item_id long, n_item_words long, n_covered long, coverage double, tiles string"


def batch_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a batch of texts, and the index of the first word of each text."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    spans = find_words(data, offsets, OTHER)
    return word_hashes(data, spans), spans.first


class Seeds:
    """Windows of one length of some items, sorted by hash, and where each occurs."""

    def __init__(self, numbers: list[int], words: list[np.ndarray], size: int) -> None:
        self.size = size
        first = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        flat = np.concatenate(words) if words else np.zeros(0, np.uint64)
        begins = window_starts(first, size)
        seeds = windows(flat, size)[begins] if len(begins) else np.zeros(0, np.uint64)
        owner = np.searchsorted(first, begins, "right") - 1
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.at = seeds[order], (begins - first[owner])[order]
        self.owner = np.array(numbers, np.int64)[owner[order]]
        self.likely = np.zeros(1 << 20, bool)
        self.likely[(self.seeds >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``seeds`` and in the sorted seeds of the items that are equal, all combinations."""
        maybe = np.flatnonzero(self.likely[(seeds >> np.uint64(44)).astype(np.int64)])
        low = np.searchsorted(self.seeds, seeds[maybe], "left")
        high = np.searchsorted(self.seeds, seeds[maybe], "right")
        count = high - low
        held = count > 0
        maybe, low, count = maybe[held], low[held], count[held]
        begin = np.concatenate([[0], np.cumsum(count)[:-1]]) if len(count) else count
        inner = np.arange(int(count.sum())) - np.repeat(begin, count)
        return np.repeat(maybe, count), np.repeat(low, count) + inner


class Items:
    """A part of the benchmark: the seeds of its items, and its short items by length."""

    def __init__(self, ids: list[int | None], words: list[np.ndarray], min_match: int) -> None:
        self.ids, self.words, self.min_match = ids, words, min_match
        of_length: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            of_length.setdefault(min(len(w), min_match), []).append(k)
        self.by_length = {
            size: Seeds(mine, [words[k] for k in mine], size) for size, mine in sorted(of_length.items()) if size
        }


def chains(item_at: np.ndarray, doc_at: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Maximal matches (length, place in the item, place in the document) from the seeds they share."""
    order = np.lexsort((doc_at, doc_at - item_at))
    p, t = item_at[order], doc_at[order]
    new = np.ones(len(p), bool)
    new[1:] = (np.diff(t) != 1) | (np.diff(t - p) != 0)
    head = np.flatnonzero(new)
    length = np.diff(np.concatenate([head, [len(p)]])) + min_match - 1
    return list(zip(length.tolist(), p[head].tolist(), t[head].tolist(), strict=True))


def tile(
    item: np.ndarray, doc: np.ndarray, matches: list[tuple[int, int, int]], min_match: int
) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in the item, place in the document, length), longest first."""
    heap = [(-n, p, t) for n, p, t in matches if np.array_equal(item[p : p + n], doc[t : t + n])]
    heapq.heapify(heap)
    item_free, doc_free = np.ones(len(item), bool), np.ones(len(doc), bool)
    tiles = []
    while heap:
        length, p, t = heapq.heappop(heap)
        n = -length
        free = item_free[p : p + n] & doc_free[t : t + n]
        if free.all():
            item_free[p : p + n] = False
            doc_free[t : t + n] = False
            tiles.append((p, t, n))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], free.astype(np.int8), [0]])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= min_match:
                heapq.heappush(heap, (a - b, p + a, t + a))
    return tiles


def search(column: pa.Array, items: Items, coverage: float) -> list[tuple]:
    """Rows (text, item, covered words, tiles) of a batch where the tiles cover enough."""
    out = []
    for a, b in parts(column):
        words, first = batch_words(column.slice(a, b - a))
        out += [(a + d, *found) for d, *found in search_part(words, first, items, coverage)]
    return out


def search_part(words: np.ndarray, first: np.ndarray, items: Items, coverage: float) -> list[tuple]:
    out = []
    for size, seeds in items.by_length.items():
        begins = window_starts(first, size)
        if size == 1:
            begins = begins[(np.diff(first) == 1)[np.searchsorted(first, begins, "right") - 1]]
        if len(begins) == 0:
            continue
        found = search_tiles if size == items.min_match else search_whole
        out += found(words, first, begins, windows(words, size)[begins], seeds, items, coverage)
    return out


def search_whole(
    words: np.ndarray, first: np.ndarray, begins: np.ndarray, hashes: np.ndarray, seeds: Seeds, items: Items, _: float
) -> list[tuple]:
    """Items as long as the windows, at the first place in each document."""
    doc = np.searchsorted(first, begins, "right") - 1
    known = np.flatnonzero(np.isin(hashes, seeds.seeds))
    # A sequence that a document repeats is looked up once.
    order = known[np.lexsort((begins[known], hashes[known], doc[known]))]
    new = np.ones(len(order), bool)
    new[1:] = (doc[order][1:] != doc[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    once = order[new]
    spot, seed = seeds.hits(hashes[once])
    out = []
    for i, k in zip(once[spot].tolist(), seeds.owner[seed].tolist(), strict=True):
        at, d = int(begins[i]), int(doc[i])
        if np.array_equal(words[at : at + seeds.size], items.words[k]):
            out.append((d, k, seeds.size, [(0, at - int(first[d]), seeds.size)]))
    return out


def search_tiles(
    words: np.ndarray,
    first: np.ndarray,
    begins: np.ndarray,
    hashes: np.ndarray,
    seeds: Seeds,
    items: Items,
    coverage: float,
) -> list[tuple]:
    """Items that share seeds, where the tiles cover enough."""
    spot, seed = seeds.hits(hashes)
    if len(spot) == 0:
        return []
    at = begins[spot]
    doc = np.searchsorted(first, at, "right") - 1
    item = seeds.owner[seed]
    order = np.lexsort((at, item, doc))
    doc, item, at, seed = doc[order], item[order], at[order], seed[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
    heads = np.flatnonzero(new)
    out = []
    for a, b in zip(heads, np.concatenate([heads[1:], [len(doc)]]), strict=True):
        d, k = int(doc[a]), int(item[a])
        target = items.words[k]
        places = seeds.at[seed[a:b]]
        reach = np.zeros(len(target) + 1, np.int64)
        np.add.at(reach, places, 1)
        np.add.at(reach, places + items.min_match, -1)
        if (np.cumsum(reach)[:-1] > 0).sum() < coverage * len(target):
            continue
        text = words[first[d] : first[d + 1]]
        matches = chains(places, at[a:b] - first[d], items.min_match)
        tiles = tile(target, text, matches, items.min_match)
        covered = sum(n for _, _, n in tiles)
        if covered >= coverage * len(target):
            out.append((d, k, covered, tiles))
    return out


def benchmark_parts(benchmark: DataFrame, min_match: int) -> Iterator[Items]:
    """The benchmark's distinct items, in parts of about PART_WORDS words; one part at a time is in use."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, first = batch_words(batch.column("text"))
            texts = [words[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.record_batch(
                [batch.column("item_id"), pa.array(np.diff(first), pa.int64()), pa.array(texts, pa.binary())],
                names=["item_id", "n", "words"],
            )

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    rows = stage(rows.mapInArrow(convert, ITEM_SCHEMA).where("n > 0").distinct())
    total = rows.agg(F.sum("n")).first()[0] or 0
    n_parts = max(1, -(-total // PART_WORDS))
    for k in range(n_parts):
        held = rows.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(n_parts)) == k).orderBy("item_id", "words").collect()
        yield Items([r.item_id for r in held], [np.frombuffer(r.words, np.uint64) for r in held], min_match)


def leaks(
    docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE
) -> DataFrame:
    """Rows doc_id, item_id, n_item_words, n_covered, coverage, tiles (item:document:length, by place)."""
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def against(items: Items) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            give_back()
            for batch in batches:
                rows = search(batch.column("text"), items, coverage)
                sizes = [len(items.words[k]) for _, k, _, _ in rows]
                covered = [c for _, _, c, _ in rows]
                yield pa.record_batch(
                    [
                        batch.column("doc_id").take(pa.array([d for d, _, _, _ in rows], pa.int64())),
                        pa.array([items.ids[k] for _, k, _, _ in rows], pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(covered, pa.int64()),
                        pa.array([c / n for c, n in zip(covered, sizes, strict=True)], pa.float64()),
                        pa.array([",".join(f"{p}:{t}:{n}" for p, t, n in sorted(x)) for _, _, _, x in rows], pa.string()),
                    ],
                    names=["doc_id", "item_id", "n_item_words", "n_covered", "coverage", "tiles"],
                )

        return thin.mapInArrow(run, LEAK_SCHEMA)

    found = None
    for items in benchmark_parts(benchmark, min_match):
        rows = against(items)
        found = rows if found is None else found.union(rows)
    return found


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE
) -> DataFrame:
    """``docs`` without those that hold an item of the benchmark."""

    def against(rest: DataFrame, items: Items) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            give_back()
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text"))
                keep = np.ones(batch.num_rows, bool)
                keep[[d for d, _, _, _ in search(texts, items, coverage)]] = False
                yield batch.filter(pa.array(keep))
            give_back()

        return rest.mapInArrow(run, docs.schema)

    for items in benchmark_parts(benchmark, min_match):
        docs = against(docs, items)
    return docs
