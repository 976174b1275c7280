"""STR-1..9: tokenizing and string predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: words are maximal runs of ASCII word characters [A-Za-z0-9_].
NON_WORD = r"\W+"


def words(text: Column) -> Column:
    """Array of the tokens between non-word runs (empty tokens kept, drop them later)."""
    return F.split(text, NON_WORD, -1)


def ieq(a: Column, b: str) -> Column:
    """Case-insensitive equality with a constant."""
    return F.lower(a) == F.lit(b.lower())

