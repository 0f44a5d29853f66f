"""Documents kept or rejected by the perplexity of a model of trusted text.

Method
    An interpolated modified Kneser-Ney model of four-grams of bytes is trained on all trusted text
    but a fifth of the documents, which is held out. Counts and requests are joined in shards: a block
    of documents sends its distinct four-grams, with how often its training text has each, to the
    shard of the two bytes before the last. A shard has every count that the orders four and three need
    in such a context: it adds up the blocks' counts, and answers each block with the log-probability
    of each of its four-grams. Requests of many blocks are dealt over tasks, each with these counts.
    Orders two and one have at most 65,536 and 256 entries and are summed up before. Every byte of
    every document is scored; three line breaks stand before each text.

    Bytes do not see the order of words, so the same texts also train an interpolated modified
    Kneser-Ney model of word pairs; a word is a run of bytes without white space. One shuffle answers
    blocks with the training counts of their pairs, and a smaller one with what is known of their words:
    see ``word_pairs``. The order below pairs is the share of distinct pairs that a word ends, and leaves the
    rest to the bytes' model of the word and the white space after it.

    Neither says much of a word repeated again and again, as each pair is unseen once and for all. So a
    document's own earlier pairs are mixed in with weight ``OWN``, as a cache model: what they save,
    in bits, is its repetition. Copies of other documents save little, as the pairs are known already.

    A document's perplexities are those per byte, by bytes and by words; repetition is per byte, too,
    and as a power of two. Each has its limits, repetition only an upper one, and each rejects. Held-out trusted documents give its quantiles by
    language, a document counting by its bytes, exact to a thousandth of a bit. A document is rejected above the upper or below the lower
    quantile by more than ``margin`` times the distance of that quantile from the median: text of
    another kind is less likely than trusted text, endless repetition more. Short texts stray further
    by chance, so both limits give way by ``CHANCE`` over the root of the number of bytes.

Defined cases
    Null and empty texts have no perplexity and are kept. A language (null is one) with fewer than
    ``MIN_HELD_OUT`` held-out documents takes the quantiles of all languages; if these are as few,
    nothing is rejected. A document counts as trusted if it has a label and all its labels are of
    quality 1 and not toxic. Repeated rows are rows. Columns of the input are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomekit.llm import word_pairs
from outcomekit.llm.blocks import (
    ANSWER_SCHEMA,
    ASK_SCHEMA,
    ask,
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
from outcomekit.llm.text import mix, text_bytes
from outcomekit.llm.word_pairs import MODEL, Pairs
from outcomekit.session import stage, staged_run

ORDER = 4
START = 10
LOW, HIGH, MARGIN = 0.01, 0.99, 2.0
#: Bits per byte by which a text of one byte may be off by chance; of n bytes, that over the root of n.
CHANCE = 10.0
#: Held-out documents without which a language has no quantiles of its own.
MIN_HELD_OUT = 20
HELD_OUT_PERCENT = 20
#: Blocks whose requests one task answers; more blocks deal a shard's requests over several tasks.
BLOCKS_PER_TASK = 2_000
#: Bits per byte are kept as whole thousandths, so quantiles come from counts.
STEPS_PER_BIT = 1000
STAT_SCHEMA = "kind string, entry long, n long"
SCORE_SCHEMA = "block long, place long, doc_id long, lang string, n_bytes long, bits double, word_bits double, saved_bits double"
#: Cells of a table that finds places of four-grams; beyond it they are searched for.
TABLE_CELLS = 1 << 24
KEYS_AT_ONCE = 1 << 18
#: Weight of a document's own earlier pairs.
OWN = 0.1


class Grams:
    """Four-grams of a block: one per byte of its texts, as numbers whose upper half is the context."""

    def __init__(self, payload: bytes) -> None:
        self.batch = open_payload(payload)
        data, offsets = text_bytes(self.column("text"))
        self.sizes = np.diff(offsets)
        raw, edges = data.tobytes(), offsets.tolist()
        between = bytes([START]) * (ORDER - 1)
        texts = between + between.join(raw[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True))
        padded = np.frombuffer(texts, np.uint8).astype(np.uint32)
        # A four-gram at every byte but those between texts: the last byte, and before it the context.
        keys = padded[3:].copy()
        for back, shift in ((3, 8), (1, 16), (2, 24)):
            keys |= padded[3 - back : len(padded) - back] << np.uint32(shift)
        inside = np.ones(len(keys), bool)
        starts = (offsets[1:-1] + (ORDER - 1) * np.arange(len(offsets) - 2))[:, None]
        inside[(starts + np.arange(ORDER - 1)).ravel()] = False
        self.keys = keys[inside]
        self.names = np.unique(self.keys)

    def column(self, name: str) -> pa.Array:
        return self.batch.column(self.batch.schema.get_field_index(name))

    def finder(self) -> Callable[[np.ndarray], np.ndarray]:
        """What finds the places of keys among the distinct four-grams, by a table of halves where that is small."""
        half, low = np.uint32(16), np.uint32(0xFFFF)
        heads, tails = np.unique(self.names >> half), np.unique(self.names & low)
        if len(heads) * len(tails) > TABLE_CELLS:
            return lambda keys: np.searchsorted(self.names, keys)
        first, last = (np.zeros(1 << 16, np.int32) for _ in range(2))
        first[heads] = np.arange(len(heads), dtype=np.int32) * len(tails)
        last[tails] = np.arange(len(tails), dtype=np.int32)
        table = np.zeros(len(heads) * len(tails), np.int32)
        table[first[self.names >> half] + last[self.names & low]] = np.arange(len(self.names))
        return lambda keys: table[first[keys >> half] + last[keys & low]]

    def running(self, values: np.ndarray) -> np.ndarray:
        """Sums of the distinct four-grams' values up to each byte of the texts, from 0."""
        find, out = self.finder(), np.zeros(len(self.keys) + 1)
        for at in range(0, len(self.keys), KEYS_AT_ONCE):
            some = values[find(self.keys[at : at + KEYS_AT_ONCE])]
            out[at + 1 : at + 1 + len(some)] = out[at] + np.cumsum(some, dtype=np.float64)
        return out

    def counts(self, docs: np.ndarray) -> np.ndarray:
        """How often the marked documents have each distinct four-gram."""
        return np.bincount(self.finder()(self.keys[np.repeat(docs, self.sizes)]), minlength=len(self.names))


def earlier(keys: np.ndarray) -> np.ndarray:
    """How often each key stands at an earlier place."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    new = np.diff(sorted_keys, prepend=sorted_keys[:1]) != 0
    begins = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    out = np.empty(len(keys), np.int64)
    out[order] = np.arange(len(keys)) - begins
    return out


def saved_bits(pairs: Pairs, p: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Bits that each word costs less with the pairs earlier in its document mixed in."""
    same = earlier(pairs.owner * len(pairs.ahead) + pairs.of)
    first = earlier(pairs.owner * len(pairs.names) + pairs.ahead[pairs.of])
    mixed = (1 - OWN) * p + OWN * same / np.maximum(first, 1)
    cost = np.where(mixed > 1e-290, -np.log2(np.maximum(mixed, 1e-290)), bits - np.log2(1 - OWN))
    return np.where(first > 0, bits - cost, 0.0)


def shards(names: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of ascending numbers by shard of the upper half, and where each shard begins in it."""
    shard = mix((names >> names.dtype.type(16)).astype(np.uint64)) % np.uint64(n)
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(n + 1, dtype=np.uint64))


class Level(NamedTuple):
    """Discounts for counts of one, two and more."""

    one: float
    two: float
    more: float

    def of(self, count: np.ndarray) -> np.ndarray:
        return np.select([count == 0, count == 1, count == 2], [0.0, self.one, self.two], self.more)


def level(counts_of_counts: dict[int, int]) -> Level:
    """Discounts of the modified method from how many entries occur one to four times."""
    n1, n2, n3, n4 = (counts_of_counts.get(k, 0) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    two = 2 - 3 * y * n3 / n2 if n2 and n3 else 1.0
    more = 3 - 4 * y * n4 / n3 if n3 and n4 else 1.5
    one = 1 - 2 * y * n2 / n1 if n1 and n2 else 0.5
    return Level(min(max(one, 0.01), 0.99), min(max(two, 0.01), 1.99), min(max(more, 0.01), 2.99))


def backed_off(count: np.ndarray, context: np.ndarray, lower: np.ndarray, discount: Level) -> np.ndarray:
    """Probabilities of entries (``count``, ``context`` group) interpolated with the ``lower`` order.

    Entries with a count of 0 are asked for but unseen; a context without any count gives ``lower``.
    """
    total = np.bincount(context, weights=count, minlength=int(context.max(initial=-1)) + 1)
    held = np.bincount(context, weights=discount.of(count), minlength=len(total))
    total, held = total[context], held[context]
    seen = total > 0
    safe = np.where(seen, total, 1)
    return np.where(seen, (np.maximum(count - discount.of(count), 0) + held * lower) / safe, lower)


def pack_counts(names: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending numbers as compressed steps, and their counts."""
    steps = np.diff(names, prepend=names.dtype.type(0))
    size = np.array([len(names), names.itemsize], np.int64)
    columns = steps.view(np.uint8).reshape(-1, names.itemsize).T
    return pack({"n": size, "names": deflate(columns), "counts": deflate(counts.astype(np.int64))})


def unpack_counts(data: bytes) -> dict[str, np.ndarray]:
    part = unpack(data)
    n, width = map(int, part["n"])
    kind = np.dtype(f"u{width}")
    if n == 0:
        return {"names": np.zeros(0, kind), "counts": np.zeros(0, np.int64)}
    columns = np.frombuffer(pa.decompress(part["names"], width * n, codec="zstd"), np.uint8)
    steps = np.ascontiguousarray(columns.reshape(width, n).T).view(kind).ravel()
    counts = np.frombuffer(pa.decompress(part["counts"], 8 * n, codec="zstd"), np.int64)
    return {"names": np.cumsum(steps, dtype=kind), "counts": counts}


def summed(parts: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of some parts of a shard, and their counts added up."""
    every = np.unique(np.concatenate([p["names"] for p in parts]))
    counts = np.zeros(len(every), np.int64)
    for p in parts:
        counts[np.searchsorted(every, p["names"])] += p["counts"].astype(np.int64)
    return every, counts


def add_counts(asks: DataFrame, key: str) -> DataFrame:
    """Rows (bucket, block, ask) with the training counts of all asks of a ``key`` as one."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        every, counts = summed([unpack_counts(x.as_py()) for x in table.column("ask")])
        seen = counts > 0
        one = pack_counts(every[seen], counts[seen])
        return pa.table({"bucket": table.column(key).slice(0, 1), "block": pa.array([MODEL]), "ask": pa.array([one])})

    return asks.groupBy(key).applyInArrow(run, ASK_SCHEMA)


def trigrams(names: np.ndarray) -> np.ndarray:
    """The last three bytes of four-grams: context in the upper half, as there, then the last byte."""
    return (names >> 16).astype(np.uint64) << 8 | (names & 0xFF).astype(np.uint64)


def shard_statistics(part: dict) -> pa.RecordBatch:
    """What the lower orders and the discounts need of a shard: rows (kind, entry, n)."""
    seen, counts = part["names"], part["counts"]
    three, before = np.unique(trigrams(seen), return_counts=True)
    pairs, n = np.unique(three & np.uint64(0xFFFF), return_counts=True)
    rows = [("pair", pairs, n)]
    for kind, values in (("four", counts), ("three", before)):
        rows.append((kind, np.arange(1, 5), np.bincount(np.minimum(values, 5), minlength=6)[1:5]))
    return pa.record_batch(
        {
            "kind": pa.array([k for k, e, _ in rows for _ in e], pa.string()),
            "entry": pa.array(np.concatenate([e.astype(np.int64) for _, e, _ in rows])),
            "n": pa.array(np.concatenate([n.astype(np.int64) for _, _, n in rows])),
        }
    )


class Model(NamedTuple):
    """Discounts of orders four and three, and probabilities of a byte after each byte."""

    four: Level
    three: Level
    pairs: np.ndarray


def fit(counted: DataFrame) -> Model:
    """Sum up the shards' statistics: at most 65,536 pairs of bytes and eight counts of counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column("ask"):
                yield shard_statistics(unpack_counts(x.as_py()))

    rows = counted.select("ask").mapInArrow(run, STAT_SCHEMA)
    rows = rows.groupBy("kind", "entry").agg(F.sum("n").alias("n")).collect()
    of = {kind: {r.entry: r.n for r in rows if r.kind == kind} for kind in ("four", "three", "pair")}
    table = np.zeros(1 << 16)
    for entry, n in of["pair"].items():
        table[entry] = n
    table = table.reshape(256, 256)
    before = (table > 0).sum(axis=0)
    sizes = [dict(enumerate(np.bincount(np.minimum(x.astype(np.int64), 5), minlength=6))) for x in (table.ravel(), before)]
    one = backed_off(before.astype(float), np.zeros(256, np.int64), np.full(256, 1 / 256), level(sizes[1]))
    two = backed_off(table.ravel(), np.repeat(np.arange(256), 256), np.tile(one, 256), level(sizes[0]))
    return Model(level(of["four"]), level(of["three"]), two)


def shard_bits(counted: bytes, asks: list[bytes], model: Model) -> list[bytes]:
    """Bits (negative binary logarithms) of every asked four-gram, in the order asked."""
    names = [unpack_counts(a)["names"] for a in asks]
    empty = [{"names": n, "counts": np.zeros(len(n), np.int64)} for n in names]
    every, counts = summed([unpack_counts(counted), *empty])
    three, of_three = np.unique(trigrams(every), return_inverse=True)
    before = np.bincount(of_three, weights=counts > 0, minlength=len(three))
    _, context = np.unique(three >> np.uint64(8), return_inverse=True)
    lower = model.pairs[(three & np.uint64(0xFFFF)).astype(np.int64)]
    p3 = backed_off(before, context, lower, model.three)
    _, context = np.unique(every >> 8, return_inverse=True)
    p4 = backed_off(counts.astype(float), context, p3[of_three], model.four)
    bits = -np.log2(p4).astype(np.float32)
    return [pa.compress(bits[np.searchsorted(every, n)].tobytes(), codec="zstd", asbytes=True) for n in names]


class WordModel(NamedTuple):
    """Discounts of pairs and of words, the number of distinct pairs, and what words leave to their spelling."""

    two: Level
    one: Level
    pairs: int
    left: float

    def shares(self, counts: np.ndarray, total: np.ndarray, facts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Discounted share of each pair (``counts``, ``total`` of its first word), then of each word what it
        leaves to the order below as a first word, and its own share there; ``facts`` as in ``word_pairs``."""
        share = np.maximum(counts - self.two.of(counts), 0) / np.maximum(total, 1)
        held = facts[:, 1:4] @ np.array([self.two.one, self.two.two, self.two.more])
        left = np.where(facts[:, 0] > 0, held / np.maximum(facts[:, 0], 1), 1.0)
        ends = facts[:, 4]
        return share, left, np.maximum(ends - self.one.of(ends), 0) / max(self.pairs, 1)


def fit_words(pairs: list[int], words: list[int]) -> WordModel:
    """From how many pairs, and how many words by distinct pairs, have counts of one to four and more; pairs last."""
    two, one = (level(dict(enumerate(sizes[:5], 1))) for sizes in (pairs, words))
    every = words[5]
    held = one.one * words[0] + one.two * words[1] + one.more * sum(words[2:5])
    return WordModel(two, one, every, held / every if every else 1.0)


def answer_bits(
    asks: DataFrame, counted: DataFrame, reply: Callable[[bytes, list[bytes]], list[bytes]], salts: int, kind: type
) -> DataFrame:
    """Rows (bucket, block, answer): the asks of a bucket with the counts of its shard beside them."""
    spread = counted.select(
        F.explode(F.expr(f"sequence(bucket * {salts}, bucket * {salts} + {salts - 1})")).alias("bucket"), "block", "ask"
    )

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        given = table.column("block").to_numpy()
        own = table.column("ask").filter(pa.array(given == MODEL))
        asked = table.filter(pa.array(given != MODEL))
        none = pack_counts(np.zeros(0, kind), np.zeros(0, np.int64))
        bits = reply(own[0].as_py() if len(own) else none, [x.as_py() for x in asked.column("ask")])
        return pa.table(
            {"bucket": asked.column("bucket"), "block": asked.column("block"), "answer": pa.array(bits, pa.binary())}
        )

    return asks.union(spread).groupBy("bucket").applyInArrow(run, ANSWER_SCHEMA)


def trusted_documents(labels: DataFrame) -> DataFrame:
    """Distinct doc_id that have labels, all of quality 1 and none toxic."""
    good = (F.coalesce(F.col("quality") == 1, F.lit(False))) & (F.coalesce(F.col("toxic") == 0, F.lit(False)))
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(good).alias("good")).where("good").select("doc_id")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit(17)), F.lit(100)) < HELD_OUT_PERCENT


def score_blocks(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged blocks of ``docs`` and staged rows of SCORE_SCHEMA with ``trusted``, one per document."""
    blocks = to_blocks(docs)
    fields = blocks.select("block", "payload")

    def list_ids(row: dict) -> Iterator[pa.RecordBatch]:
        batch = open_payload(row["payload"])
        ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64())
        at = np.arange(batch.num_rows)
        yield pa.record_batch(
            [pa.array(np.full(len(at), row["block"])), pa.array(at), ids], names=["block", "place", "doc_id"]
        )

    trusted = trusted_documents(labels)
    places = per_block(fields, list_ids, "block long, place long, doc_id long").join(trusted, "doc_id")
    places = stage(places.withColumn("held_out", held_out()))
    training = places.where("NOT held_out").groupBy("block").agg(F.sort_array(F.collect_list("place")).alias("training"))
    known = fields.join(training.hint("shuffle_hash"), "block", "left")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_shards, bits = word_pairs.shards_and_bits(blocks)
    cuts = word_pairs.shard_cuts(fields, n_shards, bits)
    salts = max(1, -(-blocks.count() // BLOCKS_PER_TASK))

    def questions(row: dict) -> Iterator[tuple[int, bytes]]:
        for k, words in word_pairs.ask_words(row["payload"], n_shards, bits):
            yield -1 - k, words
        grams = Grams(row["payload"])
        marked = np.zeros(len(grams.sizes), bool)
        marked[row["training"] or []] = True
        counts = grams.counts(marked)
        order, bounds = shards(grams.names, n)
        for k in np.flatnonzero(np.diff(bounds)):
            part = order[bounds[k] : bounds[k + 1]]
            salt = row["block"] % salts
            yield int(k) * salts + salt, pack_counts(grams.names[part], counts[part])

    def by_words(row: dict, spent: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each document by words, and those saved, from the running and ``whole`` bits by bytes."""
        pairs = Pairs(row["payload"], bits)
        if not len(pairs.starts):
            return whole, np.zeros(pairs.n_docs)
        bounds = word_pairs.range_bounds(pairs.names[pairs.ahead], pairs.names[pairs.back], cuts)
        counts = word_pairs.answers_of(row["pairs"], np.diff(bounds), word_pairs.unpack_numbers).astype(np.int64)
        asked = np.diff(word_pairs.word_bounds(pairs.names, n_shards, bits))
        facts = word_pairs.answers_of(row["words"], asked, word_pairs.unpack_facts)
        share, left, lower = words_model.shares(counts, facts[pairs.ahead, 0], facts)
        # A word's spelling reaches to the next word or the end of its text; what is before the first has its own bits.
        ends = np.append(pairs.starts[1:], 0)
        held = np.flatnonzero(np.diff(pairs.first))
        ends[pairs.first[held + 1] - 1] = pairs.offsets[held + 1]
        spelling = spent[ends] - spent[pairs.starts]
        back, ahead = pairs.back[pairs.of], pairs.ahead[pairs.of]
        p = share[pairs.of] + left[ahead] * (lower[back] + words_model.left * np.exp2(-spelling))
        # Spellings of very long words are below the least float.
        least = spelling - np.log2(words_model.left) - np.log2(np.maximum(left[ahead], 1e-30))
        cost = np.where(p > 1e-290, -np.log2(np.maximum(p, 1e-290)), least)
        saved = np.bincount(pairs.owner, weights=saved_bits(pairs, p, cost), minlength=pairs.n_docs)
        total = np.bincount(pairs.owner, weights=cost - spelling, minlength=pairs.n_docs)
        return total + whole, saved

    def add_up(row: dict) -> Iterator[pa.RecordBatch]:
        grams = Grams(row["payload"])
        order, bounds = shards(grams.names, n)
        of_names = np.zeros(len(grams.names), np.float32)
        held = np.flatnonzero(np.diff(bounds))
        for k, given in zip(held, by_bucket(row["bits"]), strict=True):
            part = order[bounds[k] : bounds[k + 1]]
            of_names[part] = np.frombuffer(pa.decompress(given, 4 * len(part), codec="zstd"), np.float32)
        spent = grams.running(of_names)
        ends = np.cumsum(grams.sizes)
        total = spent[ends] - spent[ends - grams.sizes]
        word_bits, saved = by_words(row, spent, total)
        at = np.arange(len(grams.sizes))
        yield pa.record_batch(
            [
                pa.array(np.full(len(at), row["block"])),
                pa.array(at),
                grams.column("doc_id").cast(pa.int64()),
                grams.column("lang").cast(pa.string()),
                pa.array(grams.sizes, pa.int64()),
                pa.array(total),
                pa.array(word_bits.astype(float)),
                pa.array(saved.astype(float)),
            ],
            names=["block", "place", "doc_id", "lang", "n_bytes", "bits", "word_bits", "saved_bits"],
        )

    spark = docs.sparkSession
    # The largest shuffles come first, and questions are deleted once they are answered: less lies on disk at a time.
    told = word_pairs.tell_pairs(known, cuts, bits)
    with staged_run(spark) as forget:
        asked = stage(ask(known, questions))
    # Questions about words have buckets below zero.
    asks = asked.where("bucket >= 0")
    about_words = asked.where("bucket < 0").withColumn("bucket", -1 - F.col("bucket"))
    of_words = word_pairs.tell_words(about_words, told, n_shards, bits)
    words_model = fit_words(word_pairs.totals(told), word_pairs.totals(of_words))
    counted = stage(add_counts(add_counts(asks, "bucket").withColumn("bucket", F.expr(f"bucket DIV {salts}")), "bucket"))
    model = fit(counted)
    answers = stage(answer_bits(asks, counted, lambda c, a: shard_bits(c, a, model), salts, np.uint32))
    forget()
    given = with_answers(fields, answers, "bits")
    given = with_answers(given, told.where(F.col("block") != MODEL), "pairs")
    given = with_answers(given, of_words.where(F.col("block") != MODEL), "words")
    scored = per_block(given, add_up, SCORE_SCHEMA)
    marks = places.select("block", "place", "held_out")
    return blocks, stage(scored.join(marks, ["block", "place"], "left"))


def thresholds(scored: DataFrame, bits: str, low: float, high: float, margin: float) -> DataFrame:
    """Rows lang, known (false: for all languages), n, and the least and most steps that are kept."""
    held = scored.where("held_out AND n_bytes > 0").select(
        "lang", "n_bytes", F.floor(F.col(bits) / F.col("n_bytes") * STEPS_PER_BIT).alias("step")
    )
    counts = stage(held.groupBy("lang", "step").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("held")))
    some = counts.select(F.lit(True).alias("known"), "lang", "step", "n", "held")
    every = counts.groupBy("step").agg(F.sum("n").alias("n"), F.sum("held").alias("held"))
    every = every.select(F.lit(False).alias("known"), F.lit(None).cast("string").alias("lang"), "step", "n", "held")
    running = some.union(every).selectExpr(
        "known",
        "lang",
        "step",
        "sum(held) OVER (PARTITION BY known, lang ORDER BY step) AS upto",
        "sum(held) OVER (PARTITION BY known, lang) AS every",
        "sum(n) OVER (PARTITION BY known, lang) AS n",
    )

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.greatest(F.lit(1), F.ceil(F.col("every") * q)), F.col("step")))

    rows = running.groupBy("known", "lang", "n").agg(
        quantile(low).alias("low"), quantile(0.5).alias("mid"), quantile(high).alias("high")
    )
    return rows.where(F.col("n") >= MIN_HELD_OUT).select(
        "known",
        "lang",
        (F.col("low") - margin * (F.col("mid") - F.col("low"))).alias("least"),
        (F.col("high") + margin * (F.col("high") - F.col("mid"))).alias("most"),
    )


def judge_by(scored: DataFrame, bits: str, name: str, low: float, high: float, margin: float) -> DataFrame:
    """``scored`` with ``name``, least and most of it, and whether it is beyond these."""
    limits = stage(thresholds(scored, bits, low, high, margin))
    own = limits.where("known").select(F.col("lang").alias("_lang"), F.col("least").alias("_least"), F.col("most").alias("_most"))
    rest = limits.where("NOT known").first()
    found = scored.join(own, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    per_byte = F.when(F.col("n_bytes") > 0, F.col(bits) / F.col("n_bytes"))
    least, most = (
        F.coalesce(F.col(f"_{k}"), F.lit(rest[k] if rest else None).cast("double")) for k in ("least", "most")
    )
    chance = F.lit(CHANCE) / F.sqrt(F.greatest(F.col("n_bytes"), F.lit(1)))
    least, most = least / STEPS_PER_BIT - chance, most / STEPS_PER_BIT + chance
    return found.select(
        *scored.columns,
        F.pow(F.lit(2.0), per_byte).alias(name),
        F.pow(F.lit(2.0), least).alias(f"least_{name}"),
        F.pow(F.lit(2.0), most).alias(f"most_{name}"),
        F.coalesce((per_byte < least) | (per_byte > most), F.lit(False)).alias(f"odd_{name}"),
    )


def judge(scored: DataFrame, low: float, high: float, margin: float) -> DataFrame:
    """``scored`` with both perplexities and repetition, the least and most of each, and rejected."""
    by_bytes = judge_by(scored, "bits", "perplexity", low, high, margin)
    both = judge_by(by_bytes, "word_bits", "word_perplexity", low, high, margin)
    every = judge_by(both, "saved_bits", "repetition", low, high, margin)
    repeated = F.coalesce(F.col("repetition") > F.col("most_repetition"), F.lit(False))
    return every.withColumn("rejected", F.col("odd_perplexity") | F.col("odd_word_perplexity") | repeated)


def judge_documents(
    docs: DataFrame, labels: DataFrame, low: float = LOW, high: float = HIGH, margin: float = MARGIN
) -> DataFrame:
    """Per document: doc_id, lang, n_bytes, both perplexities, the limits of its language and rejected."""
    _, scored = score_blocks(docs.select("doc_id", "lang", "text"), labels)
    columns = [f"{k}{name}" for name in ("perplexity", "word_perplexity") for k in ("", "least_", "most_")]
    columns += ["repetition", "most_repetition"]
    return judge(scored, low, high, margin).select("doc_id", "lang", "n_bytes", *columns, "rejected")


def keep_likely(
    docs: DataFrame, labels: DataFrame, low: float = LOW, high: float = HIGH, margin: float = MARGIN
) -> DataFrame:
    """``docs`` without those rejected, all columns kept; texts are not shuffled again."""
    blocks, scored = score_blocks(docs, labels)
    rejected = judge(scored, low, high, margin).where("rejected")
    gone = rejected.groupBy("block").agg(F.collect_list("place").alias("gone"))
    known = blocks.select("block", "payload").join(gone.hint("shuffle_hash"), "block", "left")
    return kept_rows(known, docs.schema)
