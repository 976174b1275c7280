"""SRC-5: a table over regex capture groups (one STRING column per group).

A line must match the whole pattern; a line that does not match gives a row of
NULLs, as a regex-SerDe table does. In a matching line a group that took no part
in the match is NULL, one that matched nothing is ''.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The access-log pattern (IP, two ignored fields, bracketed time,
# quoted "METHOD URI PROTOCOL", status, bytes) and its column names.
ACCESS_LOG_PATTERN = r'^(\S+) \S+ \S+ \[([^\[]+)\] "(\w+) (\S+) (\S+)" (\d+) (\d+)'
ACCESS_LOG_COLUMNS = ["ip", "time_local", "method", "uri", "protocol", "status", "bytes_sent"]
# The same with a quoted referrer that a line may lack.
REFERRER_LOG_PATTERN = ACCESS_LOG_PATTERN + r'(?: "([^"]*)")?'
REFERRER_LOG_COLUMNS = [*ACCESS_LOG_COLUMNS, "referrer"]


_MARK = "\u0000"  # prefix that tells a rewritten (matching) line from an untouched one
_SEP = "\u0001"  # joins the captured groups in the rewritten line


def _anchored(pattern: str) -> str:
    """The whole line, alternatives included, to its very end (``$`` would stop before a line break)."""
    return rf"^(?:{pattern})\z"


def _took_part(line: Column, pattern: str, group: int) -> Column:
    """For a matching line whose group is '': whether the group took part in the match.

    A reference to a group that took no part fails; to one that matched nothing, it matches nothing. The
    match before it is atomic, so that it is not given up for one in which the group takes part.
    """
    return line.rlike(rf"^(?>(?:{pattern})\z)\{group}")


def _group(text: Column, line: Column, pattern: str, group: int) -> Column:
    return F.when((text != "") | _took_part(line, pattern, group), text)


def parse_regex_per_group(lines: DataFrame, pattern: str, names: list[str], line_col: str = "value") -> DataFrame:
    """Reference form: a whole-line ``rlike`` guard plus one ``regexp_extract`` per group."""
    rx = _anchored(pattern)
    line = F.col(line_col)
    ok = line.rlike(rx)
    return lines.select(*[F.when(ok, _group(F.coalesce(F.regexp_extract(line, rx, i + 1), F.lit("")), line, pattern, i + 1)).alias(n)
                          for i, n in enumerate(names)])


def parse_regex(lines: DataFrame, pattern: str, names: list[str], line_col: str = "value") -> DataFrame:
    """One row per line, one column per capture group, NULLs when the line does
    not match the whole pattern.

    The regex runs once per line: ``regexp_replace`` rewrites a matching line to
    MARK g1 SEP g2 SEP ... and leaves any other line as it is; the groups are
    then split out. A line that already contains MARK or SEP takes the
    per-group path. Only a group that comes out as '' is asked once more
    whether it took part in the match (NULL if not).
    """
    rx = _anchored(pattern)
    line = F.col(line_col)
    rewritten = F.regexp_replace(line, rx, _MARK + _SEP.join(f"${i + 1}" for i in range(len(names))))
    staged = lines.select(
        line.alias("_line"),
        ((F.instr(line, _MARK) == 0) & (F.instr(line, _SEP) == 0)).alias("_plain"),
        rewritten.alias("_rw"),
    )
    hit = F.col("_rw").startswith(_MARK)
    # the array is made once per line, in a projection of its own
    staged = staged.withColumn("_parts", F.when(hit, F.split(F.substring(F.col("_rw"), 2, 1 << 30), _SEP, -1)))
    slow_ok = F.col("_line").rlike(rx)
    cols = []
    for i, n in enumerate(names):
        slow = F.when(slow_ok, F.coalesce(F.regexp_extract(F.col("_line"), rx, i + 1), F.lit("")))
        text = F.when(F.col("_plain"), F.get("_parts", i)).otherwise(slow)
        cols.append(_group(text, F.col("_line"), pattern, i + 1).alias(n))
    return staged.select(*cols)


def parse_access_log(lines: DataFrame, line_col: str = "value") -> DataFrame:
    return parse_regex(lines, ACCESS_LOG_PATTERN, ACCESS_LOG_COLUMNS, line_col)


def parse_referrer_log(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """The access log with a referrer: NULL where a line has none, '' where it is empty."""
    return parse_regex(lines, REFERRER_LOG_PATTERN, REFERRER_LOG_COLUMNS, line_col)
