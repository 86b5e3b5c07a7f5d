"""The one rule for 'these two values differ', used for row flags and for detail rows alike."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

from evenkeel.functions import sqltext
from evenkeel.functions.types import FLOATING, INTEGRAL, holds_map, with_sorted_maps


def differs(source: str, target: str, dtype: T.DataType, tolerance: float = 0.0) -> str:
    """SQL that is true when the values differ by more than the tolerance. Never null, and exact for
    integers and decimals: those are subtracted as decimals, so nothing hides behind 2^53."""
    if holds_map(dtype):  # maps have no equality
        return "NOT ({} <=> {})".format(*[sqltext.json(with_sorted_maps(e, dtype)) for e in (source, target)])
    same = f"{source} <=> {target}"
    if tolerance > 0 and isinstance(dtype, FLOATING):
        return f"NOT ({same} OR coalesce(abs({source} - {target}) <= {float(tolerance)!r}D, false))"
    if tolerance > 0 and (isinstance(dtype, T.DecimalType) or (isinstance(dtype, INTEGRAL) and tolerance >= 1)):
        a, b = source, target
        if isinstance(dtype, INTEGRAL):
            a, b = f"CAST({a} AS DECIMAL(20,0))", f"CAST({b} AS DECIMAL(20,0))"
        limit = format(Decimal(repr(float(tolerance))), "f")
        # a difference too large for a decimal is null here, and so counts as a difference
        return f"NOT ({same} OR coalesce(abs(try_subtract({a}, {b})) <= {limit}BD, false))"
    return f"NOT ({same})"
