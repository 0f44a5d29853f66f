"""Passages that repeat across documents, found by recompression.

Method
    Every document is a string of words. Rounds name parts of it by content, the same way everywhere:
    the first names runs of one word, later ones name pairs whose left symbol has a hash in the left
    half and whose right symbol has one in the right half. What is named within a passage, away from
    its edges, depends on the words of the passage alone, so equal passages have equal symbols inside.
    Each symbol carries the range of words that its name depends on.

    A shuffle finds which symbols occur in more than one document. A window of ``window`` words can
    only repeat in another document if all symbols that depend on words of the window alone do.
    Only those windows are named by 96 bits of hash and compared in a second shuffle, which verifies
    the repeats and finds the smallest document that has each.

Result
    A word goes if some window that covers it also begins in a document with a smaller ``doc_id``.

Defined cases
    Null and empty texts have no words. Texts shorter than the window lose nothing. Of rows with the
    same ``doc_id`` none is smaller. A null ``doc_id`` is larger than any other. Extra columns are
    not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.llm.blocks import (
    answer,
    ask,
    bucket_bounds,
    bucket_count,
    by_bucket,
    deflate,
    open_payload,
    pack,
    per_block,
    to_blocks,
    unpack,
    with_answers,
)
from outcomekit.llm.text import STEP, U64, find_words, mix, text_bytes, window_starts, windows, word_hashes

WINDOW = 13
ROUNDS = 3
LAST = np.iinfo(np.int64).max


class Symbols(NamedTuple):
    """Names of the parts of a block, the words that each name depends on, and its document."""

    name: np.ndarray
    low: np.ndarray
    high: np.ndarray
    doc: np.ndarray


def parse(words: np.ndarray, owners: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    """Name runs of equal words, then ``rounds`` times left-right pairs."""
    n = len(words)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Symbols(np.zeros(0, np.uint64), none, none, none)
    same = (words[1:] == words[:-1]) & (owners[1:] == owners[:-1])
    head = np.flatnonzero(np.concatenate([[True], ~same]))
    tail = np.concatenate([head[1:], [n]])
    run = (tail - head).astype(np.uint64)
    name = np.where(run > 1, mix(words[head] * STEP + run), words[head])
    low, high, doc = head - 1, tail + 1, owners[head]
    for r in range(rounds):
        salt = np.array([r + 1], np.uint64) * U64(0xD6E8FEB86659FD93)
        left = (mix(name + salt) >> U64(63)).astype(bool)
        pair = np.zeros(len(name), bool)
        pair[:-1] = left[:-1] & ~left[1:] & (doc[:-1] == doc[1:])
        second = np.concatenate([[False], pair[:-1]])
        one = np.flatnonzero(pair)
        before = np.concatenate([low[:1] - 1, low[:-1]])
        after = np.concatenate([high[1:], high[-1:] + 1])
        new_low = np.where(~left & ~pair, np.minimum(low, before), low)
        new_high = np.where(left & ~pair, np.maximum(high, after), high)
        new_name = name.copy()
        new_name[one] = mix(name[one] * STEP + name[one + 1] + U64(r))
        new_low[one] = np.minimum(low[one], low[one + 1])
        new_high[one] = np.maximum(high[one], high[one + 1])
        keep = ~second
        name, low, high, doc = new_name[keep], new_low[keep], new_high[keep], doc[keep]
    return Symbols(name, low, high, doc)


class Block:
    """Words of a block, in document order, and the documents they belong to."""

    def __init__(self, payload: bytes) -> None:
        batch = open_payload(payload)
        self.ids = [None if x is None else int(x) for x in batch.column("doc_id").to_pylist()]
        self.data, offsets = text_bytes(batch.column("text"))
        self.offsets = offsets
        spans = find_words(self.data, offsets)
        self.first = spans.first
        self.owners = spans.owners()
        self.words = word_hashes(self.data, spans)
        self.keys = np.array([LAST if x is None else x for x in self.ids], np.int64)

    def symbols(self) -> tuple[Symbols, np.ndarray, np.ndarray, np.ndarray]:
        """Symbols; their distinct names, the place of each among these, and which are in two documents."""
        found = parse(self.words, self.owners)
        order = np.argsort(found.name, kind="stable")
        ranked = found.name[order]
        new = np.ones(len(ranked), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        group = np.cumsum(new) - 1
        place = np.empty(len(ranked), np.int64)
        place[order] = group
        ids = self.keys[found.doc[order]]
        at = np.flatnonzero(new)
        several = (
            np.minimum.reduceat(ids, at) != np.maximum.reduceat(ids, at) if len(at) else np.zeros(0, bool)
        )
        return found, ranked[new], place, several

    def candidates(self, shared: np.ndarray, found: Symbols, place: np.ndarray, window: int) -> np.ndarray:
        """Begins of windows in which every symbol that depends on the window alone is shared."""
        begins = window_starts(self.first, window)
        inside = ~shared[place] & (found.high - window <= found.low)
        lows = np.maximum(found.high[inside] - window, 0)
        highs = found.low[inside] + 1
        ok = highs > lows
        n = len(self.words) + 2
        change = np.bincount(lows[ok], minlength=n) - np.bincount(highs[ok], minlength=n)
        return begins[np.cumsum(change)[begins] == 0]


class Repeats:
    """Distinct windows among a block's candidates, with the smallest document of each."""

    def __init__(self, block: Block, begins: np.ndarray, window: int) -> None:
        self.begins = begins
        first = windows(block.words, window)[begins]
        other = windows(block.words, window, seed=1)[begins].astype(np.uint32)
        order = np.lexsort((other, first))
        a, b = first[order], other[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        at = np.flatnonzero(new)
        self.place = np.empty(len(a), np.int64)
        self.place[order] = np.cumsum(new) - 1
        self.hash, self.check = a[new], b[new]
        self.ids = block.keys[block.owners[begins]]
        self.smallest = np.minimum.reduceat(self.ids[order], at) if len(at) else np.zeros(0, np.int64)


def smallest_type(values: np.ndarray) -> tuple[np.ndarray, int]:
    """``values`` less their minimum in the narrowest unsigned type, and the minimum."""
    base = int(values.min()) if len(values) else 0
    span = int(values.max()) - base if len(values) else 0
    kind = np.uint16 if span < 1 << 16 else np.uint32 if span < 1 << 32 else np.uint64
    return (values.astype(np.uint64) - np.array([base], np.int64).astype(np.uint64)).astype(kind), base


def shared_bits(asks: list[bytes]) -> list[bytes]:
    """Which of the asked symbols occur in more than one document, as bits in the order asked."""
    parts = [unpack(a) for a in asks]
    sizes = [len(p["hash"]) for p in parts]
    names = np.concatenate([p["hash"] for p in parts])
    several = np.concatenate([np.unpackbits(p["several"], count=n) for p, n in zip(parts, sizes, strict=True)])
    # The same document may lie in two blocks only if its id repeats; then the symbol counts as shared.
    values, place, counts = np.unique(names, return_inverse=True, return_counts=True)
    shared = counts > 1
    shared |= np.bincount(place, weights=several, minlength=len(values)) > 0
    marks = shared[place]
    ends = np.cumsum([0, *sizes])
    return [deflate(np.packbits(marks[a:b])) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def earlier_bits(asks: list[bytes]) -> list[bytes]:
    """Which of the asked windows begin in a document smaller than the asking block's smallest one."""
    parts = [unpack(a) for a in asks]
    sizes = [len(p["hash"]) for p in parts]
    first = np.concatenate([p["hash"] for p in parts])
    other = np.concatenate([p["check"] for p in parts])
    ids = np.concatenate([(p["ids"].astype(np.uint64) + p["base"].astype(np.uint64)).astype(np.int64) for p in parts])
    order = np.lexsort((ids, other, first))
    a, b, c = first[order], other[order], ids[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    marks = np.empty(len(a), bool)
    marks[order] = c[np.flatnonzero(new)[np.cumsum(new) - 1]] < c if len(a) else marks
    ends = np.cumsum([0, *sizes])
    return [deflate(np.packbits(marks[s:e])) for s, e in zip(ends[:-1], ends[1:], strict=True)]


def read_bits(given: list[bytes], bounds: np.ndarray) -> np.ndarray:
    """Answers of all buckets that were asked, put back in the order of the hashes."""
    sizes = [n for n in np.diff(bounds) if n]
    parts = [
        np.unpackbits(np.frombuffer(pa.decompress(g, (int(n) + 7) // 8, codec="zstd"), np.uint8), count=int(n))
        for g, n in zip(given, sizes, strict=True)
    ]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def mark_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Blocks of ``docs`` with the answers of both shuffles; input of :func:`cut_repeats`."""
    blocks = to_blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    n = bucket_count(blocks)

    def ask_symbols(row: dict) -> Iterator[tuple[int, bytes]]:
        _, names, _, several = Block(row["payload"]).symbols()
        bounds = bucket_bounds(names, n)
        for k in np.flatnonzero(np.diff(bounds)):
            part = slice(bounds[k], bounds[k + 1])
            yield int(k), pack({"hash": names[part], "several": np.packbits(several[part])})

    def ask_windows(row: dict) -> Iterator[tuple[int, bytes]]:
        block = Block(row["payload"])
        found, names, place, _ = block.symbols()
        shared = read_bits(by_bucket(row["symbols"]), bucket_bounds(names, n))
        repeats = Repeats(block, block.candidates(shared, found, place, window), window)
        bounds = bucket_bounds(repeats.hash, n)
        for k in np.flatnonzero(np.diff(bounds)):
            part = slice(bounds[k], bounds[k + 1])
            ids, base = smallest_type(repeats.smallest[part])
            asked = {"hash": repeats.hash[part], "check": repeats.check[part], "ids": ids}
            yield int(k), pack(asked | {"base": np.array([base], np.int64)})

    known = with_answers(blocks, answer(ask(blocks, ask_symbols), shared_bits), "symbols")
    earlier = answer(ask(known, ask_windows), earlier_bits)
    return with_answers(known, earlier, "earlier"), n


def cut_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and the kept text, its words joined by spaces."""
    marked, n = mark_repeats(docs, window)

    def cut(row: dict) -> Iterator[pa.RecordBatch]:
        block = Block(row["payload"])
        found, names, place, _ = block.symbols()
        shared = read_bits(by_bucket(row["symbols"]), bucket_bounds(names, n))
        repeats = Repeats(block, block.candidates(shared, found, place, window), window)
        earlier = read_bits(by_bucket(row["earlier"]), bucket_bounds(repeats.hash, n))
        gone = (repeats.smallest[repeats.place] < repeats.ids) | earlier[repeats.place]
        begins = repeats.begins[gone]
        size = len(block.words) + window + 1
        change = np.bincount(begins, minlength=size) - np.bincount(begins + window, minlength=size)
        keep = np.cumsum(change)[: len(block.words)] == 0
        raw = block.data.tobytes()
        kept, removed = [], []
        for i in range(len(block.ids)):
            words = raw[block.offsets[i] : block.offsets[i + 1]].split()
            mask = keep[block.first[i] : block.first[i + 1]]
            kept.append(b" ".join(words if mask.all() else compress(words, mask.tolist())))
            removed.append(int((~mask).sum()))
        yield pa.record_batch(
            [
                pa.array(block.ids, pa.int64()),
                pa.array(np.diff(block.first), pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
        )

    return per_block(
        marked, cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
