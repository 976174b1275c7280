"""FMT-1..3: money and percent text. Format exact decimals, not float sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def currency(x: Column) -> Column:
    """'$1,234.50' with thousands separators, rounded half-even to cents. A double's exact value is
    rounded, so do not round it before. NaN and the infinities have a text of their own."""
    d = x.cast("double")
    special = F.when(F.isnan(d), F.lit("$NaN")).when(d == float("inf"), F.lit("$Infinity")).when(d == float("-inf"), F.lit("-$Infinity"))
    return special.when(x < 0, F.concat(F.lit("-$"), F.format_number(-x, 2))).otherwise(
        F.concat(F.lit("$"), F.format_number(x, 2))
    )


def whole_percent(ratio: Column) -> Column:
    """0.254 -> '25%' (ratio x 100, no decimals, thousands separators)."""
    return F.concat(F.format_number(ratio.cast("double") * 100, 0), F.lit("%"))


def dollars_plain(x: Column) -> Column:
    """printf('$%.2f', x) -- no separators. The DECIMAL's own digits are printed, no double in between."""
    return F.concat(F.lit("$"), x.cast("decimal(38,2)").cast("string"))
