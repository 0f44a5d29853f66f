"""Counts of word pairs for a Kneser-Ney model, asked for by blocks of texts in one shuffle.

A block sends its distinct pairs, each with how often its training text has it, to shards that are
ranges of (first word, second word), and gets back how often all training text has each. Shards are cut
at quantiles of a sample, so a frequent first word is divided by its second words, and there are more
shards the more words there are. Pairs are sent in ``SLICES`` shuffles, one after another, so that only a
part of them lies on disk at a time.

What a shard knows of its training pairs is also added up by word: how often a word stands first, with
how many distinct pairs of one, two and more counts, and how many distinct pairs it ends. A second, smaller
shuffle sums this by ranges of the words and answers each block for its distinct words. So answers are
counts alone; discounts and probabilities are up to the block, once the few totals over all shards are known.

Words are compared by ``word_bits`` bits of hash, more in a larger corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.llm.blocks import ANSWER_SCHEMA, HASHES_PER_BUCKET, ask, deflate, open_payload, pack, per_block, unpack
from outcomekit.llm.text import STEP, U64, find_words, mix, text_bytes, word_hashes
from outcomekit.session import stage

#: Least bits of a word's hash, the most that an unsigned sum of steps may need, and bits beyond those of the number of words.
LEAST_BITS, MOST_BITS, MORE_BITS = 32, 48, 5
SLICES = 2
SAMPLE_BLOCKS, SAMPLE_PAIRS = 16, 4_096
#: Stands for the word before the first.
START = U64(0x5DEECE66D5DEECE6)
#: Stands for a block's number in the row that holds what a shard says of all text.
MODEL = -1
#: What is known of a word: pairs that it begins, distinct ones of count one, two and more, distinct ones that it ends.
FACTS = 5


class Pairs:
    """Words of a block with the word before each, as places among its distinct pairs of distinct words."""

    def __init__(self, payload: bytes, bits: int) -> None:
        batch = open_payload(payload)
        self.n_docs = batch.num_rows
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
        words = find_words(data, offsets)
        self.starts, self.first, self.offsets = words.starts, words.first, offsets
        self.owner = words.owners()
        hashes = np.append(word_hashes(data, words), START) >> U64(64 - bits)
        self.names, number = np.unique(hashes, return_inverse=True)
        start, number = number[-1], number[:-1]
        before = np.full(len(number), start)
        before[1:] = number[:-1]
        before[words.first[:-1][np.diff(words.first) > 0]] = start
        pairs, self.of = np.unique(before * len(self.names) + number, return_inverse=True)
        # Places of each distinct pair's words among the distinct words; pairs ascend as their words' hashes do.
        self.ahead, self.back = pairs // len(self.names), pairs % len(self.names)

    def counts(self, docs: np.ndarray) -> np.ndarray:
        """How often the marked documents have each distinct pair."""
        return np.bincount(self.of[docs[self.owner]], minlength=len(self.ahead))


def word_names(payload: bytes, bits: int) -> np.ndarray:
    """The distinct words of a block as ``Pairs`` names them, ascending."""
    batch = open_payload(payload)
    data, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
    return np.unique(np.append(word_hashes(data, find_words(data, offsets)), START) >> U64(64 - bits))


def word_bits(n_words: int) -> int:
    return min(max(LEAST_BITS, int(n_words).bit_length() + MORE_BITS), MOST_BITS)


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of bytes, of which the upper ones are mostly zero."""
    return deflate(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : MOST_BITS // 8].T)


def unpack_numbers(data: bytes, n: int) -> np.ndarray:
    out, width = np.zeros((n, 8), np.uint8), MOST_BITS // 8
    out[:, :width] = np.frombuffer(pa.decompress(data, width * n, codec="zstd"), np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()


def pack_pairs(ahead: np.ndarray, back: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending pairs and their counts: steps of the distinct first words, and of the second words of each."""
    new = np.diff(ahead, prepend=~ahead[:1]) != 0
    begins = np.flatnonzero(new)
    steps = np.diff(back, prepend=U64(0))
    steps[begins] = back[begins]
    return pack(
        {
            "n": np.array([len(begins), len(back)], np.int64),
            "ahead": pack_numbers(np.diff(ahead[begins], prepend=U64(0))),
            "each": pack_numbers(np.diff(np.append(begins, len(back)))),
            "back": pack_numbers(steps),
            "counts": pack_numbers(counts),
        }
    )


def unpack_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    part = unpack(data)
    n_first, n = map(int, part["n"])
    each = unpack_numbers(part["each"], n_first).astype(np.int64)
    ahead = np.repeat(np.cumsum(unpack_numbers(part["ahead"], n_first), dtype=np.uint64), each)
    total = np.cumsum(unpack_numbers(part["back"], n), dtype=np.uint64)
    begins = np.cumsum(each) - each
    before = np.concatenate([[U64(0)], total])[begins]
    return ahead, total - np.repeat(before, each), unpack_numbers(part["counts"], n).astype(np.int64)


def range_bounds(ahead: np.ndarray, back: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Where each range of ascending pairs begins, and their end; ``cuts`` are ascending pairs."""
    low, high = (np.searchsorted(ahead, cuts[:, 0], side) for side in ("left", "right"))
    at = [a + np.searchsorted(back[a:b], c) if b > a else a for a, b, c in zip(low, high, cuts[:, 1], strict=True)]
    return np.concatenate([[0], at, [len(ahead)]]).astype(np.int64)


def word_bounds(names: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Where each of ``n`` equal ranges of hashes begins in ascending words, and their end."""
    return np.searchsorted(names, np.arange(n + 1, dtype=object) * (1 << bits) // n).astype(np.int64)


def shard_cuts(blocks: DataFrame, n: int, bits: int) -> np.ndarray:
    """Pairs that cut all into ``n`` shards of about as many, from a sample of each of a few blocks."""
    every = blocks.count()
    few = blocks.where(F.pmod(F.xxhash64("block", F.lit(3)), F.lit(max(every // SAMPLE_BLOCKS, 1))) == 0)

    def draw(row: dict) -> Iterator[pa.RecordBatch]:
        pairs = Pairs(row["payload"], bits)
        at = np.random.default_rng(row["block"]).integers(0, max(len(pairs.ahead), 1), min(SAMPLE_PAIRS, len(pairs.ahead)))
        ahead, back = (pairs.names[x[at]].astype(np.int64) for x in (pairs.ahead, pairs.back))
        yield pa.record_batch({"ahead": pa.array(ahead), "back": pa.array(back)})

    rows = per_block(few.select("block", "payload"), draw, "ahead long, back long").collect()
    drawn = sorted((r.ahead, r.back) for r in rows)
    at = np.linspace(0, len(drawn), n + 1)[1:-1].astype(int) if drawn else []
    return np.unique(np.array([drawn[i] for i in at], np.uint64).reshape(-1, 2), axis=0)


def add_words(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Words of some parts and their facts added up."""
    names = np.concatenate([n for n, _ in parts]) if parts else np.zeros(0, np.uint64)
    every, at = np.unique(names, return_inverse=True)
    facts = np.zeros((len(every), FACTS), np.int64)
    for k in range(FACTS):
        values = np.concatenate([f[:, k] for _, f in parts]) if parts else np.zeros(0)
        facts[:, k] = np.bincount(at, weights=values, minlength=len(every))
    return every, facts


def pack_words(names: np.ndarray, facts: np.ndarray | None = None) -> bytes:
    """Ascending words, with facts or as a question."""
    part = {"n": np.array([len(names)], np.int64), "names": pack_numbers(np.diff(names, prepend=U64(0)))}
    return pack(part if facts is None else {**part, "facts": pack_facts(facts)})


def unpack_words(part: dict) -> np.ndarray:
    return np.cumsum(unpack_numbers(part["names"], int(part["n"][0])), dtype=np.uint64)


def pack_facts(facts: np.ndarray) -> bytes:
    """Facts of words less what follows for rare ones: most are small then."""
    first, one, two, more, ends = facts.T
    beyond, other = first - one - 2 * two - 3 * more, ends - one - two - more
    return pack_numbers(np.concatenate([beyond, one, two, more, np.where(other < 0, -2 * other - 1, 2 * other)]))


def unpack_facts(data: bytes, n: int) -> np.ndarray:
    beyond, one, two, more, other = unpack_numbers(data, n * FACTS).astype(np.int64).reshape(FACTS, n)
    other = np.where(other % 2 == 1, -(other + 1) // 2, other // 2)
    return np.stack([beyond + one + 2 * two + 3 * more, one, two, more, other + one + two + more], axis=1)


def count_pairs(asks: list[bytes]) -> tuple[list[bytes], bytes]:
    """Training counts of the pairs of each ask, and what the shard's training pairs tell of their words."""
    given = [unpack_pairs(a) for a in asks]
    keys = [mix(ahead * STEP + mix(back)) for ahead, back, _ in given]
    held = [counts > 0 for _, _, counts in given]
    every, first, at = np.unique(np.concatenate([k[h] for k, h in zip(keys, held, strict=True)]), return_index=True, return_inverse=True)
    ahead, back, weights = (np.concatenate([g[i][h] for g, h in zip(given, held, strict=True)]) for i in range(3))
    counts = np.bincount(at, weights=weights, minlength=len(every)).astype(np.int64)
    out = []
    for k in keys:
        spot = np.minimum(np.searchsorted(every, k), max(len(every) - 1, 0))
        found = np.where(every[spot] == k, counts[spot], 0) if len(every) else np.zeros(len(k), np.int64)
        out.append(pack_numbers(found))
    of_first = np.stack([counts, counts == 1, counts == 2, counts > 2, np.zeros(len(every))], axis=1)
    of_second = np.tile([0, 0, 0, 0, 1], (len(every), 1))
    names, facts = add_words([(ahead[first], of_first), (back[first], of_second)])
    sizes = np.bincount(np.minimum(counts, 5), minlength=6)[1:]
    return out, pack({"sizes": sizes.astype(np.int64), "words": pack_words(names, facts)})


def answered(asks: DataFrame, reply: Callable[[np.ndarray, list[bytes]], tuple[list[bytes], bytes]]) -> DataFrame:
    """Rows (bucket, block, answer) of ``asks``; what the shard says of all text stands at ``MODEL``."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        blocks = table.column("block").to_numpy()
        given, model = reply(blocks, [x.as_py() for x in table.column("ask")])
        own = blocks != MODEL
        return pa.table(
            {
                "bucket": pa.array(np.append(table.column("bucket").to_numpy()[own], table.column("bucket")[0].as_py())),
                "block": pa.array(np.append(blocks[own], MODEL)),
                "answer": pa.array([*given, model], pa.binary()),
            }
        )

    return asks.groupBy("bucket").applyInArrow(run, ANSWER_SCHEMA)


def tell_pairs(blocks: DataFrame, cuts: np.ndarray, bits: int) -> DataFrame:
    """Staged answers (bucket, block, answer) of all pairs; ``blocks`` has block, payload and training places."""
    upto = np.linspace(0, len(cuts) + 1, SLICES + 1).astype(int)

    def slice_of(low: int, high: int) -> DataFrame:
        def run(row: dict) -> Iterator[tuple[int, bytes]]:
            pairs = Pairs(row["payload"], bits)
            docs = np.zeros(pairs.n_docs, bool)
            docs[row["training"] or []] = True
            counts = pairs.counts(docs)
            ahead, back = pairs.names[pairs.ahead], pairs.names[pairs.back]
            bounds = range_bounds(ahead, back, cuts)
            for k in range(low, high):
                part = slice(bounds[k], bounds[k + 1])
                if part.stop > part.start:
                    yield k, pack_pairs(ahead[part], back[part], counts[part])

        return stage(answered(ask(blocks, run), lambda _, asks: count_pairs(asks)))

    return reduce(DataFrame.union, [slice_of(a, b) for a, b in zip(upto[:-1], upto[1:], strict=True) if b > a])


def ask_words(payload: bytes, n: int, bits: int) -> Iterator[tuple[int, bytes]]:
    """A block's questions about its distinct words, by range."""
    names = word_names(payload, bits)
    bounds = word_bounds(names, n, bits)
    for k in np.flatnonzero(np.diff(bounds)):
        yield int(k), pack_words(names[bounds[k] : bounds[k + 1]])


def tell_words(asks: DataFrame, told: DataFrame, n: int, bits: int) -> DataFrame:
    """Staged answers (bucket, block, answer) to ``ask_words``, from what the shards of pairs say of theirs."""

    def of_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column("answer"):
                part = unpack(unpack(x.as_py())["words"])
                names = unpack_words(part)
                facts = unpack_facts(part["facts"], len(names))
                bounds = word_bounds(names, n, bits)
                held = np.flatnonzero(np.diff(bounds))
                given = [pack_words(names[bounds[k] : bounds[k + 1]], facts[bounds[k] : bounds[k + 1]]) for k in held]
                yield pa.record_batch(
                    [pa.array(held), pa.array(np.full(len(held), MODEL)), pa.array(given, pa.binary())], names=["bucket", "block", "ask"]
                )

    def reply(at: np.ndarray, asks: list[bytes]) -> tuple[list[bytes], bytes]:
        parts = [unpack(a) for a in asks]
        known = [(unpack_words(p), unpack_facts(p["facts"], int(p["n"][0]))) for p, b in zip(parts, at, strict=True) if b == MODEL]
        every, facts = add_words(known)
        out = []
        for p, b in zip(parts, at, strict=True):
            if b != MODEL:
                names = unpack_words(p)
                spot = np.minimum(np.searchsorted(every, names), max(len(every) - 1, 0))
                found = np.where((every[spot] == names)[:, None], facts[spot], 0) if len(every) else np.zeros((len(names), FACTS), np.int64)
                out.append(pack_facts(found))
        ends = facts[:, FACTS - 1]
        sizes = [*np.bincount(np.minimum(ends, 5), minlength=6)[1:], ends.sum()]
        return out, pack({"sizes": np.array(sizes, np.int64)})

    said = told.where(F.col("block") == MODEL).select("answer").mapInArrow(of_pairs, "bucket long, block long, ask binary")
    return stage(answered(asks.union(said), reply))


def totals(told: DataFrame) -> list[int]:
    """Sums over all shards of the sizes that each of them tells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column("answer"):
                sizes = unpack(x.as_py())["sizes"]
                yield pa.record_batch({"entry": pa.array(np.arange(len(sizes))), "n": pa.array(sizes)})

    rows = told.where(F.col("block") == MODEL).select("answer").mapInArrow(run, "entry long, n long")
    got = {r.entry: r.n for r in rows.groupBy("entry").agg(F.sum("n").alias("n")).collect()}
    return [got.get(i, 0) for i in range(6)]


def shards_and_bits(blocks: DataFrame) -> tuple[int, int]:
    """Number of shards, and bits of a word's hash, for the words of all blocks."""
    words = blocks.agg(F.sum("n_words")).first()[0] or 0
    n = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(words) // HASHES_PER_BUCKET))
    return n, word_bits(words)


def answers_of(given: list[dict] | None, sizes: np.ndarray, read: Callable[[bytes, int], np.ndarray]) -> np.ndarray:
    """The answers of a block's shards, in the order asked."""
    asked = zip(given or [], sizes[sizes > 0], strict=True)
    return np.concatenate([read(x["answer"], int(n)) for x, n in asked])
