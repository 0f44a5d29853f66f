"""Column expressions. All stay inside generated JVM code; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# A draw is a whole number in [0, DRAW_SPAN).
DRAW_SPAN = 1 << 32

# Text that reads as a number: sign, digits, fraction, exponent, or an infinity word.
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|inf|infinity)\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def draw(key: Column | str | Sequence[Column | str], seed: int, tag: str | Column) -> Column:
    """Repeatable pseudo-random whole number in [0, 2^32) for a row key.

    Depends on key, seed and tag only, so a draw is the same under any
    partitioning, retry or row order.
    """
    keys = [key] if isinstance(key, (Column, str)) else list(key)
    parts = [_col(k).cast("string") for k in keys]
    tag_col = F.lit(tag) if isinstance(tag, str) else tag.cast("string")
    digest = F.md5(F.concat_ws("|", *parts, F.lit(str(seed)), tag_col))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def lenient_double(c: Column | str, trim: bool = False) -> Column:
    """Text to double; whatever does not read as a number becomes NULL.

    The pattern keeps out forms only the JVM parser accepts, such as ``1d`` and
    ``nan``.
    """
    text = F.trim(_col(c)) if trim else _col(c)
    text = text.cast("string")
    return F.when(F.lower(text).rlike(NUMBER_PATTERN), text.try_cast("double"))


def map_values(c: Column | str, mapping: Mapping[str, int | float | str]) -> Column:
    """Look up each value; a value outside the mapping becomes NULL."""
    col = _col(c)
    items = list(mapping.items())
    out = F.when(col == F.lit(items[0][0]), F.lit(items[0][1]))
    for key, value in items[1:]:
        out = out.when(col == F.lit(key), F.lit(value))
    return out


def threshold_label(score: Column | str, threshold: float = 0.5, inclusive: bool = False) -> Column:
    """1 where the score is above the threshold (or on it, when inclusive), else 0."""
    s = _col(score)
    cut = F.lit(float(threshold))
    return (s >= cut if inclusive else s > cut).cast("int")


def any_substring(c: Column | str, needles: Sequence[str]) -> Column:
    """True where the text holds any of the needles; upper and lower case differ."""
    col = _col(c)
    return reduce(or_, [col.contains(n) for n in needles])


def first_match(c: Column | str, rules: Sequence[tuple[Sequence[str], str]], default: str) -> Column:
    """Text of the first rule of which one needle occurs in ``c``."""
    out = None
    for needles, text in rules:
        hit = any_substring(c, needles)
        out = F.when(hit, F.lit(text)) if out is None else out.when(hit, F.lit(text))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def _formatted(pattern: str, x: Column) -> Column:
    """Text of a number; NULL stays NULL, which the formatter itself would print."""
    return F.when(x.isNotNull(), F.format_string(pattern, x))


def fixed_decimals(c: Column | str, digits: int = 4) -> Column:
    return _formatted(f"%.{digits}f", _col(c).cast("double"))


def percent_text(c: Column | str, digits: int = 1) -> Column:
    """A share as percent text: 0.2634 -> ``26.3%``."""
    return _formatted(f"%.{digits}f%%", _col(c).cast("double") * F.lit(100.0))


def thousands_text(c: Column | str, digits: int = 0) -> Column:
    return F.format_number(_col(c), digits)


def sigmoid(margin: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(margin)))


def linear_margin(weights: Mapping[str, float], intercept: float = 0.0) -> Column:
    """intercept + sum of weight x column, added in the order given."""
    terms = [F.lit(float(intercept))]
    terms += [F.lit(float(w)) * F.col(name).cast("double") for name, w in weights.items()]
    return reduce(add, terms)


def bce_loss(label: Column | str, score: Column | str, eps: float = 1e-7) -> Column:
    """Binary cross-entropy of one row, the probability clipped away from 0 and 1."""
    y = _col(label).cast("double")
    p = F.greatest(F.lit(eps), F.least(F.lit(1.0 - eps), _col(score).cast("double")))
    return -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))


def squared_distance(a: Column, b: Column, width: int) -> Column:
    """Squared distance of two array columns, added dimension by dimension."""
    parts = [(a[i] - b[i]) * (a[i] - b[i]) for i in range(width)]
    return reduce(add, parts)
