from cinder.operators.words import word_count, word_count_sorted
from conftest import lines_df, rows


def test_edges(spark):
    lines = ["", "...!!!", "  Hello, world!  ", "hello Hello", "café naïve", "a_b 42"]
    got = dict(word_count(lines_df(spark, lines)).collect())
    # case kept; '' never counted; accented letters are separators (ASCII \W)
    assert got == {"Hello": 2, "world": 1, "hello": 1, "caf": 1, "na": 1, "ve": 1, "a_b": 1, "42": 1}


def test_sorted_order(spark):
    out = [r.word for r in word_count_sorted(lines_df(spark, ["b a C", "a"], 4)).collect()]
    assert out == ["C", "a", "b"]  # byte order


def test_partition_independent(spark):
    lines = [f"w{i % 7} x{i % 3} the" for i in range(500)]
    assert rows(word_count(lines_df(spark, lines, 1))) == rows(word_count(lines_df(spark, lines, 8)))
