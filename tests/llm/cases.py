"""Small tables with every awkward row: nulls, empty and very long texts, ties, repeats, clashing columns."""

import random

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
EXTRA = "uid string, kept string, score string, ids string, values string, n string, grp string, node string"
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {EXTRA}"
LONG = "lorem ipsum dolor sit amet " * 8000
CLEAN = "The quick brown fox jumps over the lazy dog near the old river bank. " * 2


def edge_rows():
    near = [" ".join(random.Random(k).choices("alpha beta gamma delta eps zeta eta theta".split(), k=60)) for k in range(3)]
    texts = [None, "", "   \n\t ", "1 2 3", "a", "one two three four", "one two three four five", LONG, "x" * 70_000, CLEAN, CLEAN,
             near[0], near[0] + " tail", near[1], near[2], "mail me at jo.doe@example.com or +1 (555) 123-4567", "é" * 300,
             "<|endoftext|> İstanbul Σ 日本語 \x1c \u0085 x"]
    rows = [(k, t, "en" if k % 2 else None, "s", len(t or ""), *["z"] * 8) for k, t in enumerate(texts)]
    return [*rows, rows[9], rows[9], (None, CLEAN, "en", None, None, *["z"] * 8), (None, None, None, None, None, *[None] * 8), (40, near[0], None, None, None, *["z"] * 8)]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def table(name, columns=None):
    return pq.read_table(f"{SF}/{name}.parquet", columns=columns).to_pylist()
