"""Queries on the test tables, each beside the SQL it is checked against."""

from registry import cleaning, evaluating, kept, modeling, preparing, profiling, resampling  # noqa: F401
from registry.core import ORACLES, QUERIES  # noqa: F401
