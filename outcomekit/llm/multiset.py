"""Fingerprints of texts as sums over their paragraphs, and how alike two of them are.

Method
    A paragraph is a line that is not empty. It has a wide vector: ``SUMS`` numbers of 64 bits from a
    cryptographic hash of its bytes, and ``SIGNS`` small ones that add up a row of +1 and -1 drawn by the
    hash of each of its pieces; a piece ends after words that a hash picks, so an edit touches few. A
    fingerprint is the sum of its paragraphs' vectors, modulo 2^64 and modulo 2^32. So the order of
    paragraphs does not matter, equal multisets of paragraphs have equal fingerprints, unequal ones differ
    but by a hash collision, and paragraphs are put in or taken out by adding or subtracting their vectors:
    ``edit_fingerprints`` does so for a table, and an edited text's fingerprint here comes from the
    paragraphs that the edit touches alone.

    The mean square of the small numbers estimates the sum of squares of how often a text has each piece,
    and that of a difference of fingerprints how much two texts differ; likeness is one less the
    difference's share, from 0 to 1, within about a tenth.

    The next document is found by ranges: documents lie on a line by doc_id and a hash of the text, splitters
    sampled by size cut it, and the first document of each range is also sent to the range before. So
    every text is shuffled once, sorted within its range, and meets the next one there.

Result
    Per document doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

Defined cases
    A null text is empty; an empty text has no paragraphs and is like another such one (1.0). Null doc_ids
    come first; equal doc_ids are ordered by hash of the text. A table of one document has it as its own
    next one. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.llm.text import SPACES, STEP, U64, find_words, mix, parts, text_bytes, word_hashes
from outcomekit.session import stage

SUMS = 8
SIGNS = 256
#: One in so many words ends a piece.
PIECE_WORDS = 8
RANGE_BYTES = 128 << 20
#: Sampled keys of a range, the last of which cuts it off from the next.
DRAWS_PER_RANGE = 8
LINES = np.zeros(256, dtype=bool)
LINES[[0x0A, 0x0D]] = True
LEAST = np.iinfo(np.int64).min
RESULT_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


class Prints:
    """Fingerprints of some texts, one a row: sums modulo 2^64 and small numbers modulo 2^32."""

    def __init__(self, sums: np.ndarray, signs: np.ndarray) -> None:
        self.sums, self.signs = sums, signs

    def __add__(self, other: Prints) -> Prints:
        return Prints(self.sums + other.sums, self.signs + other.signs)

    def __sub__(self, other: Prints) -> Prints:
        return Prints(self.sums - other.sums, self.signs - other.signs)

    def rows(self, at: np.ndarray | slice) -> Prints:
        return Prints(self.sums[at], self.signs[at])

    def texts(self) -> list[str]:
        """One string each: the sums, then the small numbers in the least of 1, 2 or 4 bytes that holds all."""
        most = np.abs(self.signs.astype(np.int64)).max(axis=1, initial=0)
        out = []
        for i, m in enumerate(most):
            width = np.int8 if m < 1 << 7 else np.int16 if m < 1 << 15 else np.int32
            out.append(base64.b64encode(self.sums[i].tobytes() + self.signs[i].astype(width).tobytes()).decode())
        return out

    @classmethod
    def of_texts(cls, given: list[str]) -> Prints:
        raw = [base64.b64decode(g) for g in given]
        cut = SUMS * 8
        kinds = {SIGNS: np.int8, 2 * SIGNS: np.int16, 4 * SIGNS: np.int32}
        sums = np.array([np.frombuffer(r[:cut], np.uint64) for r in raw], np.uint64).reshape(-1, SUMS)
        signs = np.array([np.frombuffer(r[cut:], kinds[len(r) - cut]) for r in raw], np.int32).reshape(-1, SIGNS)
        return cls(sums, signs)

    def alike(self, other: Prints) -> np.ndarray:
        """Likeness of each row to the other's, 0 to 1."""
        change = (self.signs - other.signs).astype(np.float64)
        apart = np.square(change).sum(axis=1)
        both = np.square(self.signs.astype(float)).sum(axis=1) + np.square(other.signs.astype(float)).sum(axis=1)
        near = np.clip(1 - apart / np.where(both > 0, both, 1), 0, 1)
        near[(both == 0) | (apart >= both)] = 0
        near[(self.sums == other.sums).all(axis=1)] = 1
        return near


def added(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``values`` added up by ascending ``owner``, wrapping around."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    if len(owner):
        begins = np.flatnonzero(np.diff(owner, prepend=owner[0] - 1))
        out[owner[begins]] = np.add.reduceat(values, begins, axis=0, dtype=values.dtype)
    return out


def paragraph_prints(column: pa.Array) -> Prints:
    """The fingerprint of every text of a column."""
    n = len(column)
    total = Prints(np.zeros((n, SUMS), np.uint64), np.zeros((n, SIGNS), np.int32))
    for at, upto in parts(column):
        data, offsets = text_bytes(column.slice(at, upto - at))
        lines = find_words(data, offsets, LINES)
        raw = data.tobytes()
        hashes = b"".join(
            hashlib.blake2b(raw[s:e], digest_size=SUMS * 8).digest() for s, e in zip(lines.starts.tolist(), lines.ends.tolist(), strict=True)
        )
        total.sums[at:upto] = added(np.frombuffer(hashes, np.uint64).reshape(-1, SUMS), lines.owners(), upto - at)
        words = find_words(data, offsets, SPACES)
        if not len(words.starts):
            continue
        line = np.searchsorted(lines.starts, words.starts, "right")
        each = word_hashes(data, words)
        picked = each % U64(PIECE_WORDS) == 0
        begins = np.flatnonzero((np.diff(line, prepend=-1) != 0) | np.concatenate([[True], picked[:-1]]))
        within = np.arange(len(each)) - np.repeat(begins, np.diff(np.append(begins, len(each))))
        piece = np.add.reduceat(mix(each + within.astype(np.uint64) * STEP), begins)
        owner = words.owners()[begins]
        # Pieces in steps, so that their signs take a bounded part of memory.
        for low in range(0, len(piece), 1 << 14):
            some, who = piece[low : low + (1 << 14)], owner[low : low + (1 << 14)]
            bits = mix(some[:, None] + np.arange(1, SIGNS // 64 + 1, dtype=np.uint64) * STEP)
            signs = np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) * np.int8(2) - np.int8(1)
            span = slice(int(who[0]), int(who[-1]) + 1)
            total.signs[at:upto][span] += added_signs(signs, who - who[0], int(who[-1] - who[0]) + 1)
    return total


def added_signs(signs: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, signs.shape[1]), np.int32)
    begins = np.flatnonzero(np.diff(owner, prepend=owner[0] - 1))
    out[owner[begins]] = np.add.reduceat(signs, begins, axis=0, dtype=np.int32)
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, fingerprint), one per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = paragraph_prints(batch.column("text")).texts()
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "fingerprint": pa.array(prints, pa.string())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def edit_fingerprints(known: DataFrame, edits: DataFrame) -> DataFrame:
    """Rows (doc_id, fingerprint) after ``edits`` (doc_id, text, inserted): paragraphs put in or taken out.

    ``known`` has (doc_id, fingerprint), a doc_id once; one that only ``edits`` has begins empty, null
    is a doc_id like any other. Each task first adds up its batches' edits of a document, so a
    document with many of them is sent as one sum a batch.
    """

    def changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = paragraph_prints(batch.column("text"))
            put_in = batch.column("inserted").to_numpy(zero_copy_only=False).astype(bool)
            prints = Prints(
                np.where(put_in[:, None], prints.sums, U64(0) - prints.sums), np.where(put_in[:, None], prints.signs, -prints.signs)
            )
            yield by_document(batch.column("doc_id"), prints)

    def merged(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Prints(np.zeros((1, SUMS), np.uint64), np.zeros((1, SIGNS), np.int32))
        ids = None
        for batch in batches:
            ids = batch.column("doc_id")[:1]
            prints = Prints.of_texts(batch.column("fingerprint").to_pylist())
            total += Prints(prints.sums.sum(axis=0, dtype=np.uint64)[None], prints.signs.sum(axis=0, dtype=np.int32)[None])
        yield pa.record_batch({"doc_id": ids, "fingerprint": pa.array(total.texts(), pa.string())})

    def by_document(ids: pa.Array, prints: Prints) -> pa.RecordBatch:
        coded = ids.dictionary_encode(null_encoding="encode")
        number = coded.indices.to_numpy()
        order = np.argsort(number, kind="stable")
        n = len(coded.dictionary)
        total = Prints(added(prints.sums[order], number[order], n), added(prints.signs[order], number[order], n))
        return pa.record_batch({"doc_id": coded.dictionary, "fingerprint": pa.array(total.texts(), pa.string())})

    schema = "doc_id long, fingerprint string"
    rows = edits.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce("inserted", F.lit(True)).alias("inserted"),
    )
    changed = rows.mapInArrow(changes, schema).union(known.select("doc_id", "fingerprint"))
    return changed.groupBy("doc_id").applyInArrow(merged, schema)


def splitters(thin: DataFrame, n: int) -> np.ndarray:
    """About ``n`` ascending keys (id, hash) of ``thin`` (id, hash, size) that cut it into ranges of like size."""
    total = thin.agg(F.sum("size")).first()[0] or 0
    draw = F.pmod(F.xxhash64("id", "hash", F.lit(5)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    drawn = thin.where(draw * F.lit(float(total)) < F.col("size") * F.lit(float(n * DRAWS_PER_RANGE)))
    keys = sorted((r.id, r.hash) for r in drawn.select("id", "hash").distinct().toLocalIterator())
    return np.array(keys[DRAWS_PER_RANGE::DRAWS_PER_RANGE], np.int64).reshape(-1, 2)


def range_numbers(ids: np.ndarray, hashes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many of the ascending ``cuts`` are at most each key (id, hash)."""
    low, high = (np.searchsorted(cuts[:, 0], ids, side) for side in ("left", "right"))
    out = low.copy()
    for i in np.unique(ids[high > low]):
        same = ids == i
        at, upto = (np.searchsorted(cuts[:, 0], i, side) for side in ("left", "right"))
        out[same] = at + np.searchsorted(cuts[at:upto, 1], hashes[same], "right")
    return out


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, id, hash, range, guest) by range; a guest is the document after a range's last."""
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    keyed = base.withColumns({"id": F.coalesce("doc_id", F.lit(LEAST)), "hash": F.xxhash64("text")})
    thin = stage(keyed.select("id", "hash", F.octet_length("text").cast("long").alias("size")))
    total = thin.agg(F.sum("size")).first()[0] or 0
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // RANGE_BYTES))
    cuts = splitters(thin, n)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = range_numbers(batch.column("id").to_numpy(), batch.column("hash").to_numpy(), cuts)
            yield pa.record_batch([batch.column("id"), batch.column("hash"), pa.array(r)], names=["id", "hash", "range"])

    firsts = thin.select("id", "hash").mapInArrow(number, "id long, hash long, range long")
    rows = firsts.groupBy("range").agg(F.min(F.struct("id", "hash")).alias("first")).orderBy("range").collect()
    # The first document of a range is the one after the last of the range before; that of all follows the last.
    first = np.full((len(cuts) + 1, 2), LEAST)
    goes_to = np.zeros(len(cuts) + 1, np.int64)
    for before, row in zip(rows[-1:] + rows[:-1], rows, strict=True):
        first[row['range']], goes_to[row['range']] = tuple(row['first']), before['range']

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("id").to_numpy(), batch.column("hash").to_numpy()
            ranges = range_numbers(ids, hashes, cuts)
            names = [*batch.schema.names, "range", "guest"]
            yield pa.record_batch([*batch.columns, pa.array(ranges), pa.array(np.zeros(len(ids), bool))], names=names)
            at = np.flatnonzero((first[ranges, 0] == ids) & (first[ranges, 1] == hashes))
            at = at[np.unique(ranges[at], return_index=True)[1]]
            guests = batch.take(pa.array(at))
            columns = [*guests.columns, pa.array(goes_to[ranges[at]]), pa.array(np.ones(len(at), bool))]
            yield pa.record_batch(columns, names=names)

    return keyed.mapInArrow(deal, "doc_id long, text string, id long, hash long, range long, guest boolean")


def compared(docs: DataFrame) -> DataFrame:
    """Every document with its own fingerprint, that of its edited text, and how alike these and the next one are.

    The edited text has the last half of the code points replaced by the first as many of the next document.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            column = batch.column("text")
            for at, upto in parts(column):
                rows = batch.slice(at, upto - at)
                ids, texts = rows.column("doc_id"), rows.column("text")
                prints = paragraph_prints(texts)
                held = Rows(ids.to_pylist(), texts.to_pylist(), rows.column("range").to_pylist(), rows.column("guest").to_pylist(), prints)
                if waiting is not None:
                    held = waiting.followed(held)
                yield held.result()
                waiting = held.last()

    ordered = with_next(docs).repartition("range").sortWithinPartitions("range", "guest", "id", "hash")
    return ordered.select("doc_id", "text", "range", "guest").mapInArrow(pairs, RESULT_SCHEMA)


class Rows:
    """Consecutive rows of a range, each to be compared with the one after it; the last one waits."""

    def __init__(self, ids: list, texts: list[str], ranges: list[int], guests: list[bool], prints: Prints) -> None:
        self.ids, self.texts, self.ranges, self.guests, self.prints = ids, texts, ranges, guests, prints

    def followed(self, other: Rows) -> Rows:
        both = Prints(
            np.concatenate([self.prints.sums, other.prints.sums]), np.concatenate([self.prints.signs, other.prints.signs])
        )
        return Rows(
            self.ids + other.ids, self.texts + other.texts, self.ranges + other.ranges, self.guests + other.guests, both
        )

    def last(self) -> Rows:
        return Rows(self.ids[-1:], self.texts[-1:], self.ranges[-1:], self.guests[-1:], self.prints.rows(slice(-1, None)))

    def result(self) -> pa.RecordBatch:
        """One row for each document whose next one is here; guests are no rows of their own."""
        at = [i for i in range(len(self.ids) - 1) if not self.guests[i] and self.ranges[i] == self.ranges[i + 1]]
        old, new, digests = [], [], []
        for i in at:
            text, following = self.texts[i], self.texts[i + 1]
            half = len(text) // 2
            kept, put_in = text[: len(text) - half], following[:half]
            digests.append(hashlib.sha256((kept + put_in).encode()).hexdigest())
            # Paragraphs before the one that the edit cuts are in both texts.
            begin = max(kept.rfind("\n"), kept.rfind("\r")) + 1
            old.append(text[begin:])
            new.append(kept[begin:] + put_in)
        own = self.prints.rows(np.array(at, np.int64))
        following = self.prints.rows(np.array(at, np.int64) + 1)
        edited = own - paragraph_prints(pa.array(old, pa.string())) + paragraph_prints(pa.array(new, pa.string()))
        return pa.record_batch(
            {
                "doc_id": pa.array([self.ids[i] for i in at], pa.int64()),
                "n_chars": pa.array([len(self.texts[i]) for i in at], pa.int64()),
                "edited_sha256": pa.array(digests, pa.string()),
                "fingerprint": pa.array(own.texts(), pa.string()),
                "edited_fingerprint": pa.array(edited.texts(), pa.string()),
                "near_edited": pa.array(own.alike(edited)),
                "near_next": pa.array(own.alike(following)),
            }
        )
