"""Joins and repeats against brute force: recompression, T-occurrence, p-stable hashing, tiling."""

import hashlib
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from outcomekit.llm import jaccard, pstable, recompress, tiling
from outcomekit.llm.blocks import to_blocks
from outcomekit.llm.components import connect
from outcomekit.llm.text import STEP, windows
from outcomekit.session import staged_run

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def invented(rng, n, vocabulary=60):
    return [f"w{int(rng.paretovariate(0.7)) % vocabulary}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Random texts, copies, near copies, shared passages, runs of a word, odd and empty texts."""
    rng = random.Random(3)
    texts = [" ".join(invented(rng, rng.randint(1, 120))) for _ in range(60)]
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [f"{' '.join(invented(rng, 30))} {passage}\n{' '.join(invented(rng, 20))}" for _ in range(8)]
    long_one = invented(rng, 400, 100_000)
    for _ in range(12):
        near = list(long_one)
        for _ in range(rng.randint(0, 9)):
            near[rng.randrange(len(near))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(near))
    texts += [texts[0]] * 5 + ["a " * 50, "a " * 50, "a " * 30, "One Two", "one two", "ONE", "", "  \t\n", None, None]
    texts += ["ÉTÉ été x y z q " * 6, "\x0btab\x0cfeed " * 8]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts, strict=True))


def frame(spark, rows):
    data = [(i, t, "x", i) for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, n_words string, block long").repartition(5)


def expected_cut(rows, window):
    big = 1 << 62
    words = [(big if i is None else i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            first[key] = min(first.get(key, big), i)
    out = []
    for i, w in words:
        keep = [True] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < i:
                keep[p : p + window] = [False] * window
        kept = " ".join(x for x, k in zip(w, keep, strict=True) if k)
        out.append((None if i == big else i, len(w), keep.count(False), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [13, 4])
def test_repeats_equal_brute_force(spark, corpus, window):
    rows = corpus + [(None, corpus[3][1]), (corpus[5][0], corpus[5][1]), (None, "a " * 50)]
    got = recompress.cut_repeats(frame(spark, rows), window).drop("kept_text").collect()
    assert sorted((tuple(r) for r in got), key=str) == expected_cut(rows, window)


def test_the_check_hash_of_a_window_is_another_one():
    rng = np.random.default_rng(4)
    one = rng.integers(0, 2**63, 13, dtype=np.uint64)
    other, d = one.copy(), np.array([12345], np.uint64)
    other[11:12] -= d
    other[12:] += d * STEP
    assert windows(one, 13)[0] == windows(other, 13)[0]
    assert windows(one, 13, seed=1).astype(np.uint32)[0] != windows(other, 13, seed=1).astype(np.uint32)[0]


def test_blocks_leave_nothing_behind(spark, corpus):
    tables = {t.name for t in spark.catalog.listTables()}
    with staged_run(spark) as release:
        blocks = to_blocks(frame(spark, corpus))
        path = blocks.inputFiles()[0]
        assert blocks.count() and os.path.exists(path.removeprefix("file:"))
        release()
    assert not os.path.exists(path.removeprefix("file:"))
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_repeats_of_an_empty_table(spark):
    assert recompress.cut_repeats(frame(spark, [])).collect() == []


def test_equal_passages_have_equal_symbols_inside():
    rng = np.random.default_rng(1)
    passage = rng.integers(0, 2**63, 60, dtype=np.uint64)
    names = []
    for k in (3, 17):
        text = np.concatenate([rng.integers(0, 2**63, k, dtype=np.uint64), passage, rng.integers(0, 2**63, 9, dtype=np.uint64)])
        found = recompress.parse(text, np.zeros(len(text), np.int64))
        inside = (found.low >= k) & (found.high <= k + 60)
        names.append(set(zip(found.name[inside].tolist(), (found.low[inside] - k).tolist(), strict=True)))
    assert names[0] and names[0] == names[1]


def expected_groups(rows, size, percent):
    sets = []
    for i, t in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        grams = {tuple(w[p : p + size]) for p in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
        sets.append((i, grams))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(a)] = find(b)
    lowest = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            lowest[find(k)] = min(lowest.get(find(k), i), i)
    return sorted(((i, len(s), lowest.get(find(k))) for k, (i, s) in enumerate(sets)), key=str)


@pytest.mark.parametrize(("size", "percent", "task"), [(4, 85, 10**6), (5, 80, 300), (1, 50, 500)])
def test_groups_equal_brute_force(spark, corpus, monkeypatch, size, percent, task):
    monkeypatch.setattr(jaccard, "SHINGLES_PER_TASK", task)
    rows = corpus + [(None, corpus[70][1]), (None, "quite alone"), (corpus[5][0], "the same id again")]
    got = jaccard.jaccard_groups(frame(spark, rows), size, percent).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected_groups(rows, size, percent)


def test_one_of_each_keeps_all_columns(spark, corpus):
    rows = corpus + [corpus[2], (None, corpus[2][1])]
    docs = frame(spark, rows)
    kept = jaccard.one_of_each(docs, 4, 85)
    assert kept.columns == docs.columns
    want = [i for i, n, c in expected_groups(corpus, 4, 85) if i == c]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert jaccard.one_of_each(frame(spark, [])).collect() == []


def test_divide_skip_equals_counting():
    rng = random.Random(5)
    for _ in range(50):
        query = sorted(rng.sample(range(200), rng.randint(1, 60)))
        sets = []
        for _ in range(20):
            s = set(query)
            for _ in range(rng.randint(0, 15)):
                s ^= {rng.randrange(200)}
            sets.append(sorted(s))
        index = jaccard.Inverted([np.array(s, np.uint64) for s in sets])
        got = index.divide_skip(np.array(query, np.uint64), 80).tolist()
        want = [k for k, s in enumerate(sets) if s and 100 * len({*s} & {*query}) >= 80 * len({*s} | {*query})]
        assert got == want


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(connect(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {k: 100 for k in range(100, 160)} | {200: 200, 201: 200}


def vectors(seed=2):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((30, 24))
    rows = [rng.standard_normal(24) for _ in range(200)]
    rows += [c + s * rng.standard_normal(24) for c in centers for s in (0.05, 0.2, 0.3, 0.4)]
    rows += [rows[0], rows[0], rows[0] * 3.0]
    out = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    n = len(out)
    out += [(n, None), (n + 1, [0.0] * 24), (n + 2, [float("nan")] + [1.0] * 23), (n + 3, []), (n + 4, [1.0] * 7)]
    out += [(n + 5, [None] + [1.0] * 23), (n + 6, [1e300] * 24), (n + 7, [1e-300] * 24), (3, out[9][1]), (None, out[0][1])]
    return out


def test_vector_links_against_brute_force(spark):
    rows = vectors()
    data = [(i, v, 0) for i, v in rows]
    got = pstable.cosine_groups(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")).collect()
    usable = [
        np.array(v) if v and None not in v and np.isfinite(v).all() and any(v) else None for _, v in rows
    ]
    unit = [None if v is None else v / np.abs(v).max() for v in usable]
    unit = [None if v is None else v / np.linalg.norm(v) for v in unit]
    degree = [
        sum(b != a and y is not None and len(x) == len(y) and x @ y >= 0.9 for b, y in enumerate(unit)) if x is not None else 0
        for a, x in enumerate(unit)
    ]
    found = {}
    for r in got:
        found.setdefault(r.vec_id, []).append(r)
    assert len(got) == len(rows)
    assert sum(r.n_links for r in got) >= 0.97 * sum(degree)
    for (i, _), n in zip(rows, degree, strict=True):
        assert any(r.n_links <= n for r in found[i])
        assert all(r.component_id is None or r.component_id <= (i if i is not None else 1 << 60) for r in found[i])
    assert all(found[i][0].n_links == 0 for i in range(len(rows) - 10, len(rows) - 5))
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_large_buckets_are_dealt_into_parts(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.standard_normal(16)
    rows = [(i, (base + 0.02 * rng.standard_normal(16)).tolist()) for i in range(150)]
    monkeypatch.setattr(pstable, "BLOCK", 16)
    got = pstable.cosine_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.n_links for r in got} == {149} and {r.component_id for r in got} == {0}


def test_no_vectors(spark):
    assert pstable.cosine_groups(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def slow_tiles(item, doc, least):
    """Greedy tiling by looking at all pairs of places again after every tile."""
    free_item, free_doc, tiles = [True] * len(item), [True] * len(doc), []
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for t in range(len(doc)):
                n = 0
                while (
                    p + n < len(item) and t + n < len(doc) and item[p + n] == doc[t + n] and free_item[p + n] and free_doc[t + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, p, t)
        n, p, t = best
        if n < least:
            return tiles
        tiles.append((p, t, n))
        free_item[p : p + n] = [False] * n
        free_doc[t : t + n] = [False] * n


def test_tiles_equal_brute_force():
    rng = random.Random(8)
    for _ in range(60):
        item = np.array([rng.randrange(6) for _ in range(rng.randint(4, 25))], np.uint64)
        doc = np.array([rng.randrange(6) for _ in range(rng.randint(1, 40))], np.uint64)
        least = rng.choice([2, 3])
        spots = [
            (p, t)
            for p in range(len(item) - least + 1)
            for t in range(len(doc) - least + 1)
            if (item[p : p + least] == doc[t : t + least]).all()
        ]
        matches = tiling.chains(*(np.array([s[k] for s in spots], np.int64) for k in (0, 1)), least) if spots else []
        assert tiling.tile(item, doc, matches, least) == slow_tiles(item.tolist(), doc.tolist(), least)


def test_short_items_leak_as_whole_sequences(spark):
    rng = random.Random(12)
    vocabulary = ["a", "b", "c"]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(0, 4)))) for k in range(40)]
    items += [(k, t) for k, t in items[:5]] + [(50, "A-b")]
    docs = [(d, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 5, 9])))) for d in range(60)] + [(60, "b, A. B")]
    got = tiling.leaks(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    want = set()
    for d, text in docs:
        held = re.findall("[a-z]+", text.lower())
        for k, item in items:
            asked = re.findall("[a-z]+", item.lower())
            places = [t for t in range(len(held) - len(asked) + 1) if held[t : t + len(asked)] == asked]
            if asked and places and (len(asked) > 1 or len(held) == 1):
                want.add((d, k, len(asked), f"0:{places[0]}:{len(asked)}"))
    assert len(got) == len(want) and {(r.doc_id, r.item_id, r.n_covered, r.tiles) for r in got} == want
    assert any(n == 1 for _, _, n, _ in want) and any(n == 4 for _, _, n, _ in want)


def test_leaks_are_found_in_any_order(spark, monkeypatch):
    rng = random.Random(9)
    items = [(k, " ".join(invented(rng, 40, 100_000))) for k in range(6)] + [(6, "too short"), (7, None), (None, " ".join(f"n{i}" for i in range(20)))]
    halves = items[0][1].split()
    docs = [
        (0, f"start {items[0][1].upper()} end"),
        (1, f"{' '.join(halves[20:])} something between {' '.join(halves[:20])}"),
        (2, " ".join(halves[:12])),
        (3, items[1][1].replace(" ", ", ") + "! " + items[2][1]),
        (4, None),
        (5, ""),
        (None, items[3][1]),
        (0, items[8][1]),
        (8, "too short"),
    ]
    frame_docs = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id long").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = [(0, 0, 1.0), (0, None, 1.0), (1, 0, 1.0), (3, 1, 1.0), (3, 2, 1.0), (8, 6, 1.0), (None, 3, 1.0)]
    for words in (1_000_000, 60):
        monkeypatch.setattr(tiling, "PART_WORDS", words)
        got = tiling.leaks(frame_docs, bench).collect()
        assert sorted(((r.doc_id, r.item_id, r.coverage) for r in got), key=str) == sorted(want, key=str)
        kept = tiling.without_leaks(frame_docs, bench)
        assert kept.columns == frame_docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert tiling.leaks(frame_docs, empty).count() == 0 and tiling.without_leaks(frame_docs, empty).count() == len(docs)


def test_places_are_joined_to_the_least_one():
    rng = np.random.default_rng(9)
    for n, m in ((1, 0), (50, 20), (300, 290), (200, 199)):
        a, b = (rng.integers(0, n, m), rng.integers(0, n, m)) if m != 199 else (np.arange(199), np.arange(1, 200))
        root = list(range(n))
        for _ in range(n):
            for x, y in zip(a, b, strict=True):
                root[x] = root[y] = min(root[x], root[y])
        assert pstable.joined(a, b, n).tolist() == root


def test_small_buckets_are_compared_many_at_a_time(spark, monkeypatch):
    rng = np.random.default_rng(12)
    centers = rng.normal(size=(300, 24))
    rows = [c + rng.normal(scale=0.02, size=24) for c in centers for _ in range(1 + int(rng.integers(3)))]
    data = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    calls = spark.sparkContext.accumulator(0)
    small, large = pstable.compare_small, pstable.compare
    monkeypatch.setattr(pstable, "compare_small", lambda *a: calls.add(1) or small(*a))
    monkeypatch.setattr(pstable, "compare", lambda *a: calls.add(1_000) or large(*a))
    classes = pstable.vector_classes(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    classes = classes.select(F.struct(F.col("vec_id").alias("first")).alias("node"), "vector", F.lit(1).cast("long").alias("copies"))
    k, tables = 6, 12
    packed = pstable.links(classes, k, tables, 0.9, pstable.WIDTH, 5)
    sums = {r["first"]: r["n"] for r in packed.groupBy("node.first").agg(F.sum("others").alias("n")).collect()}
    assert 0 < calls.value <= tables
    monkeypatch.setattr(pstable, "SMALL", 0)
    alone = pstable.links(classes, k, tables, 0.9, pstable.WIDTH, 5)
    assert sums == {r["first"]: r["n"] for r in alone.groupBy("node.first").agg(F.sum("others").alias("n")).collect()}
