"""NUM-2..5: parsing numbers out of text, cap units, growth ratio."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
CAP = "decimal(38,2)"

# A market cap is written "$<number>" with an optional unit
# suffix, B (x 1e9) or M (x 1e6); "n/a" means unknown (counted as 0).
CAP_PATTERN = r"^\$([0-9]+\.?[0-9]*|\.[0-9]+)([MB]?)\z"
CAP_UNKNOWN = "n/a"
# Float text as the JVM reads it (blanks around allowed).
FLOAT_PATTERN = (r"^[\x00-\x20]*[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?|"
                 r"0[xX]([0-9a-fA-F]+\.?|[0-9a-fA-F]*\.[0-9a-fA-F]+)[pP][+-]?[0-9]+[fFdD]?)[\x00-\x20]*\z")


def try_float(s: Column) -> Column:
    """String -> FLOAT, NULL when the text is not a float (the cast alone also takes 'nan', 'inf' and any case)."""
    return F.when(s.rlike(FLOAT_PATTERN), s.try_cast("float"))


def float_or_zero(s: Column) -> Column:
    """PRJ-5: parse failure (or missing) -> 0."""
    return F.coalesce(try_float(s), F.lit(0.0).cast("float"))


def cap_unit(cap: str) -> Column:
    """'B', 'M' or '' for a well-formed cap in column ``cap``, NULL otherwise (n/a, garbage)."""
    return F.expr(f"CASE WHEN `{cap}` RLIKE '{_sql(CAP_PATTERN)}' "
                  f"THEN regexp_extract(`{cap}`, '{_sql(CAP_PATTERN)}', 2) END")


def cap_usd(cap: str) -> Column:
    """Cap in dollars as DECIMAL(38,2): unit taken from the actual suffix; n/a -> 0, other text -> NULL.

    The decimal point is moved in the text, so all of the amount's digits count, and the dollars are
    rounded once, half up, to cents ('$1.1234567891B' is 1,123,456,789.10). More dollars than the type
    holds give NULL. The expression is built as one SQL string (one call to the JVM instead of dozens)."""
    rx = _sql(CAP_PATTERN)
    number, unit = f"regexp_extract(`{cap}`, '{rx}', 1)", f"regexp_extract(`{cap}`, '{rx}', 2)"
    shift = f"CASE {unit} WHEN 'B' THEN 9 WHEN 'M' THEN 6 ELSE 0 END"
    # digits behind the point, as many as the shift needs and three: rounding half up to two looks at no more
    behind = f"rpad(concat_ws('', get(split({number}, '[.]'), 1)), {shift} + 3, '0')"
    dollars = f"concat('0', split({number}, '[.]')[0], left({behind}, {shift}), '.', substr({behind}, {shift} + 1, 3))"
    return F.expr(
        f"CASE WHEN lower(trim(`{cap}`)) = '{CAP_UNKNOWN}' THEN CAST(0 AS {CAP}) "
        f"WHEN `{cap}` RLIKE '{rx}' THEN try_cast({dollars} AS {CAP}) END"
    )


def _sql(pattern: str) -> str:
    """A regex as the body of a Spark SQL string literal."""
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def growth(low: Column, high: Column) -> Column:
    """NUM-4: (high - low) / low in float arithmetic; 0 when low is 0 or a value is unparsable."""
    lo = try_float(low)
    hi = try_float(high)
    ratio = ((hi - lo).cast("double") / lo.cast("double")).cast("float")
    return (
        F.when(lo.isNull() | hi.isNull(), F.lit(0.0).cast("float"))
        .when(lo == 0, F.lit(0.0).cast("float"))
        .otherwise(ratio)
    )
