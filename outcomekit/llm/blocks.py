"""Texts in compressed blocks, and a shuffle that asks about hashes and gets answers in the same order.

Several operators need one fact about every word window of the corpus: in how many documents it
occurs, or how likely a model finds it. Rows of (hash, document) would cost more disk than the texts.
Here a task sends, for a block of documents, only the sorted distinct hashes, cut into buckets; a
bucket's task sees the hashes of all blocks together and answers each block with one small value per
hash, in the order asked. The block then computes its hashes once more and reads the answers.

A hash costs its block one entry however often it occurs, so a hot window or a third of all documents
being copies adds at most one entry a block to one bucket. The number of buckets follows the number of
words, so a bucket stays a few MB at any size. Blocks are written to the shared folder once, bucketed
by block number, and joins with answers move only the answers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from outcomekit.llm.text import find_words, text_bytes
from outcomekit.session import new_stage

BLOCK_BYTES = 4 << 20
HASHES_PER_BUCKET = 2_000_000

BLOCK_SCHEMA = "block long, n_docs long, n_words long, payload binary"
ASK_SCHEMA = "bucket long, block long, ask binary"
ANSWER_SCHEMA = "bucket long, block long, answer binary"


def deflate(array: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(array).tobytes(), codec="zstd", asbytes=True)


def pack(value: dict[str, np.ndarray | bytes]) -> bytes:
    """Named arrays as one record-batch stream, compressed."""
    names, parts = list(value), [v if isinstance(v, bytes) else v.tobytes() for v in value.values()]
    kinds = {n: "" if isinstance(v, bytes) else v.dtype.str for n, v in value.items()}
    batch = pa.record_batch([pa.array([p], pa.large_binary()) for p in parts], names=names)
    batch = batch.replace_schema_metadata(kinds)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> dict[str, np.ndarray | bytes]:
    batch = pa.ipc.open_stream(data).read_next_batch()
    kinds = {k.decode(): v.decode() for k, v in (batch.schema.metadata or {}).items()}
    out: dict[str, np.ndarray | bytes] = {}
    for name, column in zip(batch.schema.names, batch.columns, strict=True):
        raw = column[0].as_buffer()
        out[name] = np.frombuffer(raw, kinds[name]) if kinds.get(name) else raw.to_pybytes()
    return out


def close_payload(docs: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
    with pa.ipc.new_stream(sink, docs.schema, options=options) as out:
        out.write_batch(docs)
    return sink.getvalue().to_pybytes()


def open_payload(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(payload).read_next_batch()


def to_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, buckets: int | None = None) -> DataFrame:
    """Stage ``docs`` (with a column ``text`` and any others) as compressed blocks of whole documents.

    A document larger than ``block_bytes`` has a block of its own.
    """
    spark = docs.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        held: list[pa.RecordBatch] = []
        size = 0

        def emit() -> pa.RecordBatch:
            nonlocal number, held, size
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            data, offsets = text_bytes(whole.column(whole.schema.get_field_index("text")))
            words = find_words(data, offsets)
            row = [[number], [whole.num_rows], [len(words.starts)], [close_payload(whole)]]
            number, held, size = number + 1, [], 0
            return pa.record_batch(
                [pa.array(v, t) for v, t in zip(row, (pa.int64(),) * 3 + (pa.binary(),), strict=True)],
                names=["block", "n_docs", "n_words", "payload"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            _, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
            at = 0
            while at < batch.num_rows:
                upto = int(np.searchsorted(offsets, offsets[at] + block_bytes - size, "right")) - 1
                upto = min(max(upto, at + (size == 0)), batch.num_rows)
                if upto > at:
                    held.append(batch.slice(at, upto - at))
                    size += int(offsets[upto] - offsets[at])
                if upto < batch.num_rows or size >= block_bytes:
                    yield emit()
                at = upto
        if held:
            yield emit()

    path, name = new_stage(spark)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = docs.mapInArrow(cut, BLOCK_SCHEMA)
    blocks.write.bucketBy(n, "block").option("path", path).saveAsTable(name)
    return spark.table(name)


def bucket_count(blocks: DataFrame) -> int:
    """Buckets for about one hash a word: in proportion to the words, at least one a shuffle partition."""
    words = blocks.agg(F.sum("n_words")).first()[0] or 0
    return max(
        int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        -(-int(words) // HASHES_PER_BUCKET),
    )


def bucket_bounds(hashes: np.ndarray, n: int) -> np.ndarray:
    """Where each bucket begins in sorted 64-bit ``hashes``: a bucket is a range of hashes."""
    of = ((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    return np.searchsorted(of, np.arange(n + 1, dtype=np.uint64))


def ask(blocks: DataFrame, questions: Callable[[dict], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """Rows (bucket, block, ask); ``questions`` gets a block's row and yields its asks by bucket."""
    names = blocks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(k)[i].as_py() for k, c in enumerate(names)}
                asked = list(questions(row))
                pa.default_memory_pool().release_unused()
                yield pa.record_batch(
                    [
                        pa.array([b for b, _ in asked], pa.int64()),
                        pa.array([row["block"]] * len(asked), pa.int64()),
                        pa.array([a for _, a in asked], pa.binary()),
                    ],
                    names=["bucket", "block", "ask"],
                )

    return blocks.mapInArrow(run, ASK_SCHEMA)


def answer(asks: DataFrame, reply: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """Rows (bucket, block, answer); ``reply`` gets all asks of a bucket and answers each."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        given = reply([x.as_py() for x in table.column("ask")])
        return pa.table(
            {
                "bucket": table.column("bucket"),
                "block": table.column("block"),
                "answer": pa.array(given, pa.binary()),
            }
        )

    return asks.groupBy("bucket").applyInArrow(run, ANSWER_SCHEMA)


def with_answers(blocks: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """Every block with the answers to its asks, an array of (bucket, answer)."""
    given = answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "answer"))).alias(name))
    return blocks.join(given.hint("shuffle_hash"), "block", "left")


def by_bucket(given: list[dict] | None) -> list[bytes]:
    return [x["answer"] for x in given or []]


def per_block(
    blocks: DataFrame, work: Callable[[dict], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """Rows that ``work`` makes of each block, one block at a time."""
    names = blocks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from work({c: batch.column(k)[i].as_py() for k, c in enumerate(names)})
                pa.default_memory_pool().release_unused()

    return blocks.mapInArrow(run, schema)


def kept_rows(known: DataFrame, schema: StructType) -> DataFrame:
    """Rows of blocks (payload, ``gone``: places to leave out), with the columns that were packed."""

    def choose(row: dict) -> Iterator[pa.RecordBatch]:
        batch = open_payload(row["payload"])
        keep = np.ones(batch.num_rows, bool)
        keep[row["gone"] or []] = False
        yield batch.filter(pa.array(keep))

    return per_block(known, choose, schema)
