"""Words of a corpus joined to the words they are misspelt from.

Method
    Two words are near if one edit (a letter inserted, deleted or replaced) turns one into the other. An
    edit leaves the first or the last half of a word as it is. So each word goes to sorted lists of the
    words that share its first half, and its last half: the halves are those of the shorter of two
    words, hence a word takes part with its own length and with one less. A list longer than ``LIST_ROWS``
    is divided again by the halves of what its words do not share, until what is left is one letter, so
    no list is longer than the alphabet allows.

    A sorted list is scanned by dynamic programming. Words with the same beginning share the rows of the
    edit matrix that belong to it: a row is computed once for a whole range of the list, and only the
    band of three cells that one edit can reach. Ranges are parted where the longest common prefix
    of adjacent words ends; a range whose row holds no cell of one edit or less is skipped with all its
    words. All words of a batch of lists step forward at once, one letter a step.

    A pair is found in one list only: in the one of the first half if that is shared, else in the other.
    Lists give the number of near words and the best one for each word, added up by word; pairs are not
    written. The word that a word goes back to is at least ten times as frequent, so chains of forms are
    as short as the logarithm of the largest count, and are followed by doubling joins.

Result
    Per word: word, form, root, n, n_near, form_n.

Defined cases
    A null text has no words. A null doc_id draws as an empty one. Rows of one doc_id draw alike, so
    equal rows count as often as they stand there. An empty table has no words. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.session import small_table, stage

MIN_LETTERS = 7
MIN_COUNT = 2
RATIO = 10
#: One in so many runs of letters, drawn by document and run, loses a letter.
NOISE = 31
#: Rows of a sorted list that one task scans. Two letters, the least that is not divided, make fewer.
LIST_ROWS = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Edits are counted up to this, which means too many.
FAR = np.int8(2)


def vocabulary(
    docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, noise: int = NOISE
) -> DataFrame:
    """Staged rows (word, n): words of at least ``min_letters`` and how often the texts have each."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(
            F.regexp_extract_all(
                F.translate(F.col("text").cast("string"), UPPER, LOWER),
                F.lit(f"[a-z\\u00C0-\\u00FF]{{{min_letters},}}"),
                F.lit(0),
            )
        ).alias("run"),
    )
    drawn = runs.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    cut = F.expr("concat(substr(run, 1, int(h % length(run))), substr(run, int(h % length(run)) + 2))")
    words = drawn.select(F.when(F.col("h") % noise == 0, cut).otherwise(F.col("run")).alias("word"))
    words = words.where(F.length("word") >= min_letters)
    return stage(words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count))


def lists(words: DataFrame) -> DataFrame:
    """Rows (key, least, cut, rest, word, n): each word in the lists of its length and of one less.

    ``rest`` is what the words of a list do not share, ``least`` or one more letters long; in lists with
    ``cut``, a pair that differs by the last letter of the longer rest belongs to another list.
    """
    length = F.length("word")
    whole = words.select(
        F.explode(F.array(length, length - 1)).alias("least"), F.lit(False).alias("cut"), F.col("word").alias("rest"), "word", "n"
    )
    return divided(whole.select(F.col("least").cast("string").alias("key"), *whole.columns))


def divided(rows: DataFrame) -> DataFrame:
    """Every list as two kinds of lists: by the first half of the rest, and by the last half."""
    first = "least DIV 2"
    last = f"least - {first}"
    halves = [
        ("p", first, f"substr(rest, 1, {first})", f"substr(rest, {first} + 1)", last, "cut"),
        ("s", last, f"right(rest, {last})", f"left(rest, length(rest) - ({last}))", first, "true"),
    ]
    parts = [
        f"struct(concat(key, '|{side}', {size}, ':', {shared}) AS key, int({least}) AS least, {cut} AS cut, {rest} AS rest)"
        for side, size, shared, rest, least, cut in halves
    ]
    both = rows.select(F.explode(F.expr(f"array({', '.join(parts)})")).alias("part"), "word", "n")
    return both.select("part.*", "word", "n")


def short_lists(rows: DataFrame, most: int) -> DataFrame:
    """``rows`` with lists of more than ``most`` words divided until none is."""
    done = []
    while True:
        long = rows.where("least > 1").groupBy("key").agg(F.count("*").alias("_n")).where(F.col("_n") > most)
        long = stage(long.select("key"))
        if long.isEmpty():
            return reduce(DataFrame.unionByName, [*done, rows])
        known = small_table(long)
        done.append(rows.join(known, "key", "left_anti"))
        rows = stage(divided(rows.join(known, "key", "left_semi")))


class SortedLists:
    """Sorted lists one after another: letters of all rests, and how much each shares with the one before."""

    def __init__(self, lists: np.ndarray, rests: list[str]) -> None:
        self.sizes = np.fromiter(map(len, rests), np.int64, len(rests))
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        # Three letters that no word has stand for what lies beyond the last one.
        self.letters = np.concatenate([np.frombuffer("".join(rests).encode("utf-32-le"), np.uint32), [0, 0, 0]])
        self.begins = np.diff(lists, prepend=lists[:1] - 1) != 0
        self.shared = np.where(self.begins, -1, 0)
        alive, depth = np.flatnonzero(~self.begins), 0
        while len(alive):
            inside = (self.sizes[alive] > depth) & (self.sizes[alive - 1] > depth)
            alive = alive[inside]
            alive = alive[self.letters[self.starts[alive] + depth] == self.letters[self.starts[alive - 1] + depth]]
            depth += 1
            self.shared[alive] = depth

    def letter(self, row: np.ndarray, place: np.ndarray | int) -> np.ndarray:
        """Letter of each row at a place; 0 beyond its end or before its beginning."""
        inside = (place >= 0) & (place < self.sizes[row])
        return np.where(inside, self.letters[np.where(inside, self.starts[row] + place, 0)], 0)

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """All ordered pairs of rows of a list whose rests are one edit apart."""
        rows = np.arange(len(self.sizes))
        begin = np.maximum.accumulate(np.where(self.begins, rows, 0))
        ends = np.append(np.flatnonzero(self.begins), len(rows))
        # A range of a list has the row of the edit matrix for its common beginning, against each word.
        word, low = rows, begin
        high = ends[np.searchsorted(ends, begin, "right")]
        left = np.full(len(rows), FAR)
        mid = np.zeros(len(rows), np.int8)
        right = np.where(self.sizes > 0, np.int8(1), FAR)
        found, depth = [], 0
        while len(word):
            beyond = self.sizes[word] - depth
            cost = np.select([beyond == -1, beyond == 0, beyond == 1], [left, mid, right], FAR)
            hit = (self.sizes[low] == depth) & (cost == 1)
            found.append((word[hit], low[hit]))
            # The range is parted where the common prefix of adjacent words ends.
            parts = np.flatnonzero((self.shared <= depth) & (self.sizes > depth))
            first, last = np.searchsorted(parts, low), np.searchsorted(parts, high)
            n = last - first
            of = np.repeat(np.arange(len(word)), n)
            part = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            low = parts[part]
            high = np.minimum(np.append(parts, len(rows))[part + 1], high[of])
            word, left, mid, right = word[of], left[of], mid[of], right[of]
            letter = self.letters[self.starts[low] + depth]
            size = self.sizes[word]
            new_left = np.minimum(mid + 1, left + (letter != self.letter(word, depth - 1)))
            new_mid = np.minimum(np.minimum(right, new_left) + 1, mid + (letter != self.letter(word, depth)))
            new_right = np.minimum(new_mid + 1, right + (letter != self.letter(word, depth + 1)))
            depth += 1
            left = np.where(depth - 1 > size, FAR, np.minimum(new_left, FAR)).astype(np.int8)
            mid = np.where(depth > size, FAR, np.minimum(new_mid, FAR)).astype(np.int8)
            right = np.where(depth + 1 > size, FAR, np.minimum(new_right, FAR)).astype(np.int8)
            alone = (high - low == 1) & (low == word)
            on = (np.minimum(np.minimum(left, mid), right) <= 1) & ~alone
            word, low, high, left, mid, right = (x[on] for x in (word, low, high, left, mid, right))
        return np.concatenate([w for w, _ in found]), np.concatenate([e for _, e in found])


def scanned(table: pa.Table) -> pa.RecordBatch:
    """Near words of each row within its list: word, how many, and the most frequent one."""
    keys = table.column("key").combine_chunks().dictionary_encode()
    keys = (keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys).indices.to_numpy()
    rests = table.column("rest").to_pylist()
    words, counts = table.column("word").to_pylist(), table.column("n").to_pylist()
    least, cut = table.column("least").to_numpy(), table.column("cut").to_numpy()
    sorted_lists = SortedLists(keys, rests)
    a, b = sorted_lists.near()
    # Two words of the longer length belong to a list of their own length.
    own = (sorted_lists.sizes[a] == least[a]) | (sorted_lists.sizes[b] == least[b])
    n_near: dict[int, int] = {}
    best: dict[int, tuple[int, str]] = {}
    for i, j in zip(a[own].tolist(), b[own].tolist(), strict=True):
        if cut[i] and (rests[i].startswith(rests[j]) or rests[j].startswith(rests[i])):
            continue
        n_near[i] = n_near.get(i, 0) + 1
        other = -counts[j], words[j]
        best[i] = min(best.get(i, other), other)
    at = list(n_near)
    columns = [[words[i] for i in at], [n_near[i] for i in at], [best[i][0] for i in at], [best[i][1] for i in at]]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    names = ["word", "n_near", "minus_n", "near"]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def scan_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows in passes of whole lists."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = batch.column("key")[-1].as_py()
        keys = batch.column("key").to_pylist()
        at = keys.index(last)
        if at or (held and held[-1].column("key")[-1].as_py() != last):
            whole = [*held, batch.slice(0, at)] if at else held
            if sum(b.num_rows for b in whole) >= LIST_ROWS // 2:
                yield scanned(pa.Table.from_batches(whole))
                held, batch = [], batch.slice(at)
        held.append(batch)
    if held:
        yield scanned(pa.Table.from_batches(held))


def near_words(words: DataFrame, list_rows: int = LIST_ROWS) -> DataFrame:
    """Rows (word, n_near, form, form_n) of all words (word, n) that have near ones; the form is the most frequent."""
    rows = short_lists(lists(words), list_rows)
    dealt = rows.repartition("key").sortWithinPartitions("key", "rest")
    found = dealt.mapInArrow(scan_lists, "word string, n_near long, minus_n long, near string")
    by_word = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("minus_n", "near")).alias("best"))
    return by_word.select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.minus_n")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """Rows (word, root) of links (word, form): the last form that a word leads to."""
    now = stage(links.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stage(now.join(on, "root", "left").select("word", "root", "further"))
        if moved.where("further IS NOT NULL").isEmpty():
            return now
        now = stage(moved.select("word", F.coalesce("further", "root").alias("root")))


def variant_groups(words: DataFrame, ratio: int = RATIO, list_rows: int = LIST_ROWS) -> DataFrame:
    """``words`` (word, n) with form, root, n_near and form_n."""
    near = near_words(words, list_rows)
    rows = words.join(near, "word", "left").withColumn("_is_form", F.col("form_n") >= F.col("n") * ratio)
    rows = stage(
        rows.select(
            "word",
            F.when(F.col("_is_form"), F.col("form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("_is_form"), F.col("form_n")).alias("form_n"),
        )
    )
    last = roots(rows.where("form IS NOT NULL"))
    found = rows.join(last, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Words of all texts with the word each is a variant of."""
    return variant_groups(vocabulary(docs))
