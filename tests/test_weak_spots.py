"""Group presence in regex tables, exact caps, header peeks (SRC-5, STR-9, NUM-3, SRC-8)."""

import os
import re
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cinder.functions.numbers import cap_usd
from cinder.sources import regex_log as R
from cinder.sources.text import first_line
from conftest import lines_df


@pytest.mark.parametrize("pattern, names, lines", [
    ("(a)(b)?", ["x", "y"], ["a", "ab", "b", "abb", ""]),
    ("(a)|(b)", ["x", "y"], ["a", "b", "axx", "xb"]),
    ("a?(a)?", ["x"], ["", "a", "aa", "aaa"]),  # what comes first takes the letter: the group takes no part
    ("(x*)(y*)?(z)?", ["x", "y", "z"], ["", "x", "y", "z", "xyz"]),
    ("(?:(a)|(b)|c)*", ["x", "y"], ["", "c", "ab", "ba", "ca"]),
    (R.REFERRER_LOG_PATTERN, R.REFERRER_LOG_COLUMNS, ['1.1.1.1 - - [d] "GET /u HTTP/1.0" 200 7' + t for t in ("", ' ""', ' "r"', ' "r', ' "\x00\x01"', "\n")]),
])
def test_absent_groups_are_null_and_empty_ones_are_not(spark, pattern, names, lines):
    want = [tuple(m.groups()) if (m := re.compile(f"(?:{pattern})\\Z").match(x)) else (None,) * len(names) for x in lines]
    for parse in (R.parse_regex, R.parse_regex_per_group):
        df = parse(lines_df(spark, lines).coalesce(1), pattern, names)
        assert df.columns == names
        assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, want)), parse.__name__


def test_group_numbers_over_nine(spark):
    pattern = "".join(f"({c})?" for c in "abcdefghijkl")
    got = R.parse_regex(lines_df(spark, ["abl"]), pattern, [f"g{i}" for i in range(12)]).first()
    assert tuple(got) == ("a", "b", *[None] * 9, "l")


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.from_regex(r"[0-9]{1,12}(\.[0-9]{0,30})?|\.[0-9]{1,30}", fullmatch=True), st.sampled_from(["", "M", "B"])), min_size=30, max_size=30))
def test_caps_are_exact(spark, caps):
    texts = [f"${n}{u}" for n, u in caps]
    got = spark.createDataFrame([(t,) for t in texts], "cap string").coalesce(1).select("cap", cap_usd("cap").alias("usd")).collect()
    scale = {"": 1, "M": 10 ** 6, "B": 10 ** 9}
    for r, (n, u) in zip(got, caps):
        assert r.usd == (Decimal(n) * scale[u]).quantize(Decimal("0.01"), ROUND_HALF_UP), r.cap


def test_cap_cases(spark):
    cases = {"$1.1234567891B": "1123456789.10", "$0.000000004B": "4.00", "$0.005": "0.01", "$0.0049999999999": "0.00", "$1.": "1.00", "$.5M": "500000.00",
             "n/a": "0.00", " N/A ": "0.00", "$": None, "$1,2M": None, "1M": None, "$1T": None, "$" + "9" * 30 + "B": None, "$" + "9" * 36: "9" * 36 + ".00"}
    got = spark.createDataFrame([(c,) for c in cases], "cap string").select("cap", cap_usd("cap").alias("usd")).collect()
    assert {r.cap: None if r.usd is None else str(r.usd) for r in got} == cases


def _read_by(spark, group, action):
    """What the action returns, and the rows its scans read, by stage."""
    sc = spark.sparkContext
    sc.setJobGroup(group, "")
    out = action()
    tracker, store = sc.statusTracker(), sc._jsc.sc().statusStore()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    sc.setJobGroup("", "")
    return out, [store.lastStageAttempt(s).inputRecords() for s in sorted(stages)]


def test_header_peek_reads_one_line_a_file(spark, tmp_dir):
    spark.range(0, 60_000, 1, 6).selectExpr("concat('line ', id, ' of a long file') AS value").write.text(f"{tmp_dir}/many")
    with open(f"{tmp_dir}/one file.txt", "w") as f:
        f.write("Symbol,Name\n" + "A,x\n" * 50_000)
    open(f"{tmp_dir}/empty.txt", "w").close()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    df = first_line(spark, f"{tmp_dir}/many", f"{tmp_dir}/one file.txt", f"{tmp_dir}/empty.txt")
    rows, read = _read_by(spark, "peek", df.collect)
    got = {os.path.basename(r.file): r.value for r in rows}
    parts = sorted(f for f in os.listdir(f"{tmp_dir}/many") if f.startswith("part-"))
    assert got == {"one%20file.txt": "Symbol,Name", **{f: f"line {10_000 * i} of a long file" for i, f in enumerate(parts)}}
    assert 7 <= sum(read) <= 8, read  # eight files, one of them empty
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert first_line(spark).count() == 0
