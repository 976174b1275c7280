"""NST-1..3: map, array and struct access with NULL (not an error) when absent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def map_value(m: Column, key: str) -> Column:
    """``m[key]``; a missing key gives NULL."""
    return F.try_element_at(m, F.lit(key))


def array_at(a: Column, index0: int) -> Column:
    """Zero-based ``a[i]``; past the end gives NULL (plain ``[i]`` throws under ANSI)."""
    return F.get(a, index0)


def struct_field(s: Column, name: str) -> Column:
    return s.getField(name)
