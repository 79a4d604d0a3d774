"""Filter predicates of the session task (age range, lists, equality).

Each builder returns ``None`` when its parameter is absent, meaning "no
constraint"; :func:`all_of` ANDs the rest into one filter expression.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoplens.functions.expr import col_of


def age_between(col, lo: int | None, hi: int | None, strict_bounds: bool = True) -> Column | None:
    """Inclusive range. With ``strict_bounds`` (the original rule) the range
    applies only when both ends are given; otherwise one end suffices."""
    c = col_of(col)
    if lo is not None and hi is not None:
        return c.between(lo, hi)
    if strict_bounds:
        return None
    if lo is not None:
        return c >= lo
    if hi is not None:
        return c <= hi
    return None


def in_list(col, values) -> Column | None:
    """Scalar column equal to any listed value; NULL data fails."""
    if not values:
        return None
    return F.coalesce(col_of(col).isin(list(values)), F.lit(False))


def overlaps(array_col, values, element_type: str) -> Column | None:
    """Array column sharing at least one element with ``values``."""
    if not values:
        return None
    wanted = F.array(*[F.lit(v) for v in values]).cast(f"array<{element_type}>")
    return F.coalesce(F.arrays_overlap(col_of(array_col), wanted), F.lit(False))


def equals(col, value) -> Column | None:
    if value is None or value == "":
        return None
    return F.coalesce(col_of(col) == F.lit(value), F.lit(False))


def all_of(*preds: Column | None) -> Column:
    kept = [p for p in preds if p is not None]
    return reduce(lambda a, b: a & b, kept, F.lit(True))
