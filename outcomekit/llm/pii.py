"""Personal data found by fixed patterns and a skip-chain conditional random field.

Method
    Patterns give the base spans of four kinds. They label the tokens that hold digits or ``@``; the
    field then labels the rest of these. Its variables are a document's marked tokens. A token has
    potentials from its shape, an edge to the marked token next to it, and a skip edge to the nearest
    earlier token that is the same without its punctuation, and to the nearest that ends in the same
    six letters or digits. Weights of shapes and of both sorts of edges maximise the pseudo-likelihood
    of the base labels of a bounded sample of documents, with a prior by which skip edges agree. Tokens
    that the patterns miss but a skip edge ties to a base span are left out there, as their label is
    what the field is for. Loopy message passing carries labels over the edges, with base spans as
    observed, so a number that is written in full once has the same kind where it is shortened or
    lacks its prefix. A token of sure marginal and with a skip edge to a token of that kind becomes a
    span; base spans always stay.

Result
    Spans as (kind, start, end) in code points, the end exclusive.

Defined cases
    Null and empty texts have no spans. Documents without a digit or ``@`` are not decoded. Repeated
    documents are rows of their own. If the sample has no base span, no spans are added. Extra columns
    are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomekit.llm.text import text_bytes

KINDS = ("email", "ip", "card", "phone")
#: About so many texts, at most twice as many, train the field.
MAX_TRAINING_DOCS = 1_000
SURE = 0.9
#: Weight of equal labels at both ends of a skip edge before any document is seen.
AGREE = 4.0
ROUNDS = 10
STEPS = 200

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MARKED = re.compile(r"[0-9@]")
#: A group of digits of a written number; such words in a row are one token.
NUMBER = re.compile(r"[+(]?[0-9]{1,4}\)?")
MARK = np.zeros(256, bool)
MARK[[*range(ord("0"), ord("9") + 1), ord("@")]] = True

Span = tuple[int, int, int]
SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, redacted string"
)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches around each ``@``: the local part is the whole run before it, the domain is greedy."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            end = found.end()
        else:
            # A run before the next ``@`` cannot reach over this one.
            end = max(end, at + 1)
        at = text.find("@", max(end, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def ascii_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Spans (kind, start, end) of the fixed patterns, by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = ascii_digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 8 <= len(ascii_digits(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


class Graph(NamedTuple):
    """Marked tokens of a document: places, shapes, base labels (0 none, else kind + 1) and edges."""

    spans: list[tuple[int, int]]
    shapes: np.ndarray
    labels: np.ndarray
    observed: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def shape(token: str, before: str, after: str) -> list[float]:
    token = token.strip(".,;:!?\"'")
    digits = sum("0" <= c <= "9" for c in token)
    letters = sum(c.isalpha() for c in token)
    return [
        1.0,
        "@" in token,
        token.count("."),
        token.count(".") == 3,
        token.count("-"),
        token[:1] == "+",
        "(" in token,
        digits == len(token),
        digits <= 3,
        4 <= digits <= 7,
        8 <= digits <= 15,
        digits >= 16,
        letters > 0,
        letters > digits,
        before[-1:] in "=\"'#/:",
        after[:1] in "\"'/%",
    ]


def core(token: str) -> str:
    return "".join(c for c in token.lower() if c.isalnum() or c == "@")


def tokens(text: str) -> list[tuple[int, int]]:
    """Places of the words that hold a digit or ``@``; a number written in groups of digits is one token."""
    out: list[tuple[int, int]] = []
    open_number = False
    for word in WORD.finditer(text):
        a, b = word.span()
        if not MARKED.search(text, a, b):
            open_number = False
            continue
        number = NUMBER.fullmatch(text, a, b - (text[b - 1] in ".,;:!?"))
        if number and open_number and a == out[-1][1] + 1 and text[a] != "+":
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
        # Punctuation at its end closes a number.
        open_number = bool(number) and number.end() == b
    return out


def graph(text: str, base: list[Span]) -> Graph:
    found = tokens(text)
    shapes, chain, skip = [], [], []
    last: dict[tuple[str, str], int] = {}
    for i, (a, b) in enumerate(found):
        token = text[a:b]
        shapes.append(shape(token, text[max(0, a - 2) : a].strip(), text[b : b + 2].strip()))
        if i and found[i - 1][1] + 1 >= a:
            chain.append((i - 1, i))
        name = core(token)
        for key in (("same", name), ("end", name[-6:])):
            if len(key[1]) >= 6:
                if key in last and (not skip or skip[-1] != (last[key], i)):
                    skip.append((last[key], i))
                last[key] = i
    labels = np.zeros(len(found), np.int64)
    starts = np.array([a for a, _ in found], np.int64)
    ends = np.array([b for _, b in found], np.int64)
    for kind, a, b in base:
        low, high = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b, "left")
        labels[low:high] = kind + 1
    pairs = [np.array(e, np.int64).reshape(-1, 2) for e in (chain, skip)]
    return Graph(found, np.array(shapes, np.float64).reshape(len(found), -1), labels, labels > 0, *pairs)


class Field(NamedTuple):
    """Weights of token shapes by label, and of the labels at both ends of each sort of edge."""

    shapes: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def train(graphs: list[Graph]) -> Field | None:
    """Pseudo-likelihood: every token's label given its shape and its neighbors' labels, by gradient steps."""
    n = len(KINDS) + 1
    graphs = [g for g in graphs if len(g.labels)]
    if not any(g.observed.any() for g in graphs):
        return None

    def around(g: Graph, edges: np.ndarray) -> np.ndarray:
        counts = np.zeros((len(g.labels), n))
        for a, b in ((0, 1), (1, 0)):
            np.add.at(counts, (edges[:, a], g.labels[edges[:, b]]), 1.0)
        return counts

    x = np.concatenate(
        [np.concatenate([g.shapes, around(g, g.chain), around(g, g.skip)], axis=1) for g in graphs]
    )
    y = np.eye(n)[np.concatenate([g.labels for g in graphs])]
    tied = x[:, -n + 1 :].any(axis=1)
    known = np.concatenate([g.observed for g in graphs]) | ~tied
    x, y = x[known], y[known]
    scale = np.maximum(np.abs(x).max(axis=0), 1.0)
    x = x / scale
    prior = np.zeros((x.shape[1], n))
    prior[-n:] = AGREE * np.eye(n) * scale[-n:, None]
    weights, speed = prior.copy(), np.zeros_like(prior)
    for _ in range(STEPS):
        score = x @ weights
        score = np.exp(score - score.max(axis=1, keepdims=True))
        score /= score.sum(axis=1, keepdims=True)
        speed = 0.9 * speed + x.T @ (y - score) / len(x) - 1e-3 * (weights - prior)
        weights = weights + 0.5 * speed
    weights = weights / scale[:, None]
    k = weights.shape[0] - 2 * n
    edges = [weights[k : k + n], weights[k + n :]]
    return Field(weights[:k], *[(e + e.T) / 2 for e in edges])


def marginals(g: Graph, field: Field) -> np.ndarray:
    """Chance of each label of each token by loopy message passing; observed labels are certain."""
    n = len(KINDS) + 1
    local = g.shapes @ field.shapes
    local = np.exp(local - local.max(axis=1, keepdims=True))
    local[g.observed] = np.eye(n)[g.labels[g.observed]]
    edges = np.concatenate([g.chain, g.skip])
    if len(edges) == 0:
        return local / local.sum(axis=1, keepdims=True)
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    tables = np.concatenate(
        [np.repeat(np.exp(t)[None], len(e), axis=0) for t, e in ((field.chain, g.chain), (field.skip, g.skip))]
    )
    tables = np.concatenate([tables, tables])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    message = np.full((len(source), n), 1.0 / n)

    def beliefs() -> np.ndarray:
        total = np.zeros_like(local)
        np.add.at(total, target, np.log(np.maximum(message, 1e-30)))
        out = local * np.exp(total - total.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)

    for _ in range(ROUNDS):
        cavity = beliefs()[source] / np.maximum(message[back], 1e-30)
        new = np.einsum("ei,eij->ej", cavity, tables)
        message = 0.5 * message + 0.5 * new / np.maximum(new.sum(axis=1, keepdims=True), 1e-300)
    return beliefs()


def added_spans(text: str, base: list[Span], field: Field | None) -> list[Span]:
    """Spans of tokens that the field is sure of and that a skip edge ties to a token of their kind."""
    if field is None or not base:
        return []
    g = graph(text, base)
    if len(g.skip) == 0 or g.observed.all():
        return []
    chance = marginals(g, field)
    label = chance.argmax(axis=1)
    sure = (chance.max(axis=1) >= SURE) & (label > 0) & ~g.observed
    tied = g.observed.copy()
    for a, b in g.skip.tolist():
        for i, j in ((a, b), (b, a)):
            if sure[i] and tied[j] and (g.labels[j] or label[j]) == label[i]:
                tied[i] = True
    out = []
    for i in np.flatnonzero(sure & tied):
        a, b = g.spans[i]
        while a < b and not (text[a].isalnum() or text[a] in "+("):
            a += 1
        while b > a and not text[b - 1].isalnum():
            b -= 1
        if a < b and all(b <= s or a >= e for _, s, e in base):
            out.append((int(label[i]) - 1, a, b))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with every span, and what overlapping spans cover together, replaced by its kind."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def marked(column: pa.Array) -> np.ndarray:
    """Which texts hold a digit or ``@``."""
    data, offsets = text_bytes(column)
    seen = np.concatenate([[0], np.cumsum(MARK[data])])
    return seen[offsets[1:]] > seen[offsets[:-1]]


def training_graphs(docs: DataFrame, max_docs: int) -> list[Graph]:
    """Graphs of about ``max_docs`` distinct texts that hold a digit or ``@``, drawn by hash of the text."""
    rows = docs.where(F.col("text").rlike("[0-9@]")).select("text")
    n = max(rows.count(), 1)
    drawn = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) < F.lit(max_docs * (1 << 40) // n)
    chosen = rows.where(drawn).distinct().limit(2 * max_docs).collect()
    return [graph(r.text, base_spans(r.text)) for r in sorted(chosen)]


def find_personal_data(docs: DataFrame, max_training_docs: int = MAX_TRAINING_DOCS) -> DataFrame:
    """Per document: doc_id, base counts, base_sha256, all spans and the text with spans replaced."""
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    field = train(training_graphs(thin, max_training_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            column = batch.column("text")
            counts = np.zeros((len(KINDS), batch.num_rows), np.int64)
            hashes, spans = [nothing] * batch.num_rows, [""] * batch.num_rows
            clean: dict[int, str] = {}
            for i in np.flatnonzero(marked(column)):
                text = column[int(i)].as_py()
                base = base_spans(text)
                if not base:
                    continue
                for kind, _, _ in base:
                    counts[kind, i] += 1
                hashes[i] = hashlib.sha256(joined(base).encode()).hexdigest()
                every = base + added_spans(text, base, field)
                spans[i] = joined(every)
                clean[int(i)] = redact(text, every)
            redacted = column.cast(pa.string())
            if clean:
                at = pa.array(np.isin(np.arange(batch.num_rows), list(clean)))
                redacted = pa.compute.replace_with_mask(redacted, at, pa.array([clean[k] for k in sorted(clean)], pa.string()))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array(hashes, pa.string()),
                    pa.array(spans, pa.string()),
                    redacted,
                ],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "redacted"],
            )

    return thin.mapInArrow(run, SCHEMA)
