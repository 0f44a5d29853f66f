"""Prefix trie, spelling variants and fingerprints against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from outcomekit.llm import multiset, prefix_trie, spelling

LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def expected_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, name, (role, text)))
    turns = {c: [x[-1] for x in sorted(given)] for c, given in convs.items()}
    members, ends, kids = defaultdict(list), defaultdict(list), Counter()
    leaves, saved = Counter(), Counter()
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(turns.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
            leaves[p[:d]] += not kids[p]
    return sorted(
        (
            (
                min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
            )
            for p, m in members.items()
        ),
        key=str,
    )


CONVERSATION = "conv_id long, turn long, role string, text string"


def trie(spark, rows, parts=5):
    found = prefix_trie.prefix_trie(spark.createDataFrame(rows, CONVERSATION).repartition(parts))
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.fixture(scope="module")
def conversations():
    """Random small ones, null fields, two long ones with a common beginning, and one of equal rows."""
    rng = random.Random(1)
    rows = []
    for c in [*range(-120, 130, 7), 0, 100, -100]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", None, ""]), rng.choice(["a", "bb", None, "éé"])))
    rows += [(200, t, "user", f"x{t}") for t in range(130)] + [(201, t, "user", f"x{t}") for t in range(120)]
    rows += [(1999, 1, "u", "same")] * 400 + rows[:20] + [(None, 1, "u", "lost")]
    return rows


def test_trie_equals_brute_force(spark, conversations):
    assert trie(spark, conversations) == expected_trie(conversations)


def test_trie_of_copies_and_of_nothing(spark):
    copies = [(c, t, "user", f"turn {t}") for c in range(1000, 1600) for t in range(7)]
    assert trie(spark, copies, 1) == expected_trie(copies)
    empty = spark.createDataFrame([], CONVERSATION)
    assert prefix_trie.prefix_trie(empty).collect() == []
    assert prefix_trie.prefix_trie(empty).dtypes == prefix_trie.prefix_trie(spark.createDataFrame(copies[:3], CONVERSATION)).dtypes


def test_trie_ignores_other_columns(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "a")]
    more = spark.createDataFrame([(*r, 9, "z", None) for r in rows], f"{CONVERSATION}, depth long, x string, n_convs long")
    assert sorted((tuple(r) for r in prefix_trie.prefix_trie(more).collect()), key=str) == expected_trie(rows)


@pytest.mark.parametrize("shape", ["path", "star", "caterpillar", "random"])
def test_subtree_sums(spark, shape):
    rng = random.Random(5)
    parent = {0: None}
    for i in range(1, 300):
        parent[i] = {"path": i - 1, "star": 0, "caterpillar": max(0, i - 2 + i % 2), "random": rng.randrange(max(0, i - 40), i)}[shape]
    depth, total = {0: 0}, {i: 10**i.bit_length() + i for i in parent}
    for i in range(1, 300):
        depth[i] = depth[parent[i]] + 1
    rows = [(i, depth[i], p, total[i]) for i, p in parent.items()]
    for i in range(299, 0, -1):
        total[parent[i]] += total[i]
    tree = spark.createDataFrame(rows, "conv_id long, depth long, parent_conv_id long, v long")
    got = {r.conv_id: r.v for r in prefix_trie.subtree_sums(tree, ["v"]).collect()}
    assert got == total


def test_running_values_go_on_over_ranges(spark):
    rng = random.Random(2)
    rows = [(k, i, rng.getrandbits(62)) for k in (1, 2, 3) for i in range(1 if k == 1 else 3000)]
    df = spark.createDataFrame(rows, "k long, i long, u long").repartition(7)
    got = {(r.k, r.i): (r.place, r.x) for r in prefix_trie.scan(df, "k", ["i"], {"u": "x"}).collect()}
    running = {}
    for k, i, u in rows:
        running[k] = running.get(k, 0) ^ u
        assert got[k, i] == (i + 1, running[k])


def expected_vocabulary(docs):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            p = h % len(run)
            counts[run[:p] + run[p + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def expected_variants(vocabulary):
    near, cuts = defaultdict(set), defaultdict(list)
    for w in vocabulary:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1 :]
            cuts[i, rest].append(w)
            if rest in vocabulary:
                near[w].add(rest)
                near[rest].add(w)
    for same in cuts.values():
        for a in same:
            near[a] |= set(same) - {a}
    form = {}
    for w, n in vocabulary.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-vocabulary[x], x))
            if vocabulary[best] >= 10 * n:
                form[w] = best
    out = []
    for w, n in vocabulary.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), vocabulary[form[w]] if w in form else None))
    return sorted(out)


def variants(spark, vocabulary, **more):
    words = spark.createDataFrame(list(vocabulary.items()), "word string, n long").repartition(3)
    return sorted(tuple(r) for r in spelling.variant_groups(words, **more).collect())


@pytest.mark.parametrize("list_rows", [20_000, 30])
def test_variants_equal_brute_force(spark, list_rows):
    rng = random.Random(4)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 8))) for _ in range(1500)}
    words |= {"x" * 300, "x" * 301, "x" * 150 + "y" + "x" * 149, "document" + "z" * 5}
    words |= {"document" + "".join(rng.choice("pqrs") for _ in range(5)) for _ in range(300)}
    vocabulary = {w: rng.choice([2, 2, 3, 20, 25, 200, 2500]) for w in sorted(words)}
    assert variants(spark, vocabulary, list_rows=list_rows) == expected_variants(vocabulary)


def test_ties_go_to_the_first_in_code_points(spark):
    vocabulary = {"abcdefg": 2, "abcdefz": 40, "abcdefÿ": 40, "ébcdefg": 3}
    got = {r[0]: r for r in variants(spark, vocabulary)}
    assert got["abcdefg"][1:] == ("abcdefz", "abcdefz", 2, 3, 40)


def test_vocabulary_equals_brute_force(spark):
    rng = random.Random(6)
    stems = ["wordiness", "WORDINESS", "Élégance", "élégance", "ABCDEFGH", "short", "naïveté×÷", "abcdefg" * 3]
    docs = [(i % 50 if i % 9 else None, rng.choice([" ", "\n", "1", "Ā", "_"]).join(rng.choices(stems, k=40))) for i in range(150)]
    docs += [(1, None), (2, ""), (3, "q" * 40_000), (4, "q" * 40_000), (5, "q" * 39_999), *docs[:5]]
    more = spark.createDataFrame([(i, t, 1, "w") for i, t in docs], "doc_id long, text string, n long, word string")
    got = {r.word: r.n for r in spelling.vocabulary(more).collect()}
    assert got == expected_vocabulary(docs)
    assert sorted(tuple(r) for r in spelling.spelling_variants(more).collect()) == expected_variants(got)
    assert spelling.spelling_variants(more.limit(0)).collect() == []


def fingerprint(text):
    return multiset.paragraph_prints(pa.array([text], pa.string())).texts()[0]


def expected_prints(rows):
    def key(row):
        return row[0] if row[0] is not None else -(1 << 63)

    rows = sorted(rows, key=key)
    out = {}
    for i, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out[doc] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprint(text), fingerprint(edited))
    return out


@pytest.mark.parametrize("partitions", [1, 9])
def test_fingerprints_equal_those_of_whole_texts(spark, partitions):
    rng = random.Random(8)

    def text():
        return "\n".join(" ".join(rng.choice(["é", "word", "many", "more", "𝒳", "of"]) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 9)))

    rows = [(i * 7 % 211, text()) for i in range(211)] + [(None, "a\r\nb"), (500, None), (501, ""), (502, "é" * 300_001), (-3, "line\n" * 50_000)]
    more = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, hash string, range long")
    got = multiset.compared(more.repartition(partitions)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in got} == expected_prints(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    same = {r.doc_id: r for r in got}
    assert same[500].near_next == 1.0 == same[500].near_edited


def test_order_of_paragraphs_does_not_count():
    lines = [f"line {i} of a text\tof some words" for i in range(40)]
    mixed = random.Random(1).sample(lines, 40)
    assert fingerprint("\n".join(lines)) == fingerprint("\r\n\n".join(mixed))
    assert len({fingerprint(t) for t in ("\n".join(lines), "\n".join(lines[1:]), "\n".join([*lines, lines[0]]), "a b\nc", "b a\nc", "")}) == 6


def test_likeness_follows_the_shared_part():
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(4000)]
    whole = multiset.paragraph_prints(pa.array([" ".join(words)]))
    for share in (0.25, 0.5, 0.9):
        kept = words[: int(4000 * share)] + [f"v{rng.randrange(10**6)}" for _ in range(4000 - int(4000 * share))]
        near = whole.alike(multiset.paragraph_prints(pa.array([" ".join(kept)])))[0]
        assert abs(near - share) < 0.15


def test_edits_of_a_table(spark):
    known = multiset.fingerprints(spark.createDataFrame([(1, "a b\nc d"), (None, "x"), (3, "y")], "doc_id long, text string"))
    edits = [(1, "c d", False), (1, "e\nf", True), (2, "q", None), (None, "x", False)] + [(3, "z", True)] * 3000
    changed = multiset.edit_fingerprints(known, spark.createDataFrame(edits, "doc_id long, text string, inserted boolean").repartition(4))
    got = {r.doc_id: r.fingerprint for r in changed.collect()}
    assert got == {1: fingerprint("f\ne\na b"), 2: fingerprint("q"), None: fingerprint(""), 3: fingerprint("y\n" + "z\n" * 3000)}


def test_fingerprints_of_few_rows(spark):
    one = spark.createDataFrame([(4, "ab")], "doc_id long, text string")
    row = multiset.compared(one).first()
    assert (row.n_chars, row.edited_sha256, row.near_next) == (2, hashlib.sha256(b"aa").hexdigest(), 1.0)
    assert multiset.compared(one.limit(0)).collect() == []
    twice = multiset.compared(one.union(one).union(spark.createDataFrame([(4, "cd")], one.schema))).collect()
    assert len(twice) == 3 and len({r.fingerprint for r in twice}) == 2


def test_ranges_part_equal_ids_by_hash():
    cuts = np.array([(3, 5), (3, 9), (4, 0)], np.int64)
    ids, hashes = np.array([2, 3, 3, 3, 4, 4, 9]), np.array([9, 4, 5, 9, -1, 0, 0])
    assert multiset.range_numbers(ids, hashes, cuts).tolist() == [0, 0, 1, 2, 2, 3, 3]
