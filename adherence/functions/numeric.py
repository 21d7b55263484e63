"""Numeric display helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def py_format(x, places: int) -> Column:
    """Text of ``x`` with ``places`` decimals exactly as Python's ``f"{x:.{places}f}"``: Spark's
    ``format_number`` rounds the exact binary value half-even like Python (grouping commas
    removed).  ``format_string('%.1f')`` would round the decimal text half-up (0.25 -> 0.3)."""
    c = F.col(x) if isinstance(x, str) else x
    return F.regexp_replace(F.format_number(c, places), ",", "")


def py_signed(x, places: int) -> Column:
    """Python's ``f"{x:+.{places}f}"``."""
    t = py_format(x, places)
    return F.when(t.startswith("-"), t).otherwise(F.concat(F.lit("+"), t))


def display_round(x, places: int) -> Column:
    """Round like pandas/numpy ``round``: scale, round half to even on the binary value, unscale.

    (Spark's ``round`` rounds the shortest decimal text half-up, so 1.025 -> 1.03, while the
    dashboard's pandas gives 1.02.)"""
    c = F.col(x) if isinstance(x, str) else x
    s = float(10 ** places)
    return F.rint(c * s) / s
