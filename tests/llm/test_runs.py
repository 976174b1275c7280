import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cinder.llm import periodic_runs
from cinder.llm.queries import LLM_REGISTRY

from . import cases


def brute_runs(words):
    """(start, length, period) of every run, by trying every period on every word."""
    out, n = {}, len(words)
    ids = np.array([hash(w) for w in words], np.int64)
    for q in range(1, n // 2 + 1):
        same = np.concatenate([[0], ids[:-q] == ids[q:], [0]])
        edges = np.flatnonzero(np.diff(same))
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if stop - start + q >= max(12, 2 * q):
                out.setdefault((start, stop + q), q)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def brute_row(key, text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    h = zlib.crc32(str(key).encode())
    if key is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[:1]
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    first = (best[0][0], best[0][1], best[0][2], 1000 * best[0][1] // best[0][2]) if best else (None,) * 4
    return (key, len(runs), *first, sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def found(texts):
    flat, ids = [w for t in texts for w in t], {}
    got = periodic_runs.find(np.array([ids.setdefault(w, len(ids)) for w in flat], np.int64), np.array([len(t) for t in texts], np.int64))
    return [[tuple(r[1:]) for r in got.tolist() if r[0] == i] for i in range(len(texts))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=80), min_size=1, max_size=4))
def test_runs_of_few_words_equal_brute_force(texts):
    assert found(texts) == [brute_runs(t) for t in texts]


def test_planted_periods_equal_brute_force():
    rng = random.Random(11)
    for _ in range(250):
        texts = []
        for _ in range(3):
            n, k = rng.randrange(1, 300), rng.choice([1, 2, 4, 60])
            x = [rng.randrange(k) for _ in range(n)]
            for _ in range(rng.randrange(4)):
                a = rng.randrange(n)
                p, to = rng.randrange(1, (n - a) // 2 + 2), rng.randrange(a, n + 1)
                x[a:to] = [x[a + (i - a) % p] for i in range(a, to)]
            texts.append(x)
        assert found(texts) == [brute_runs(t) for t in texts]


def test_long_texts():
    same, pair, odd = ["a"] * 30_000, ["a", "b"] * 15_000, [str(i % 777) for i in range(30_000)]
    fib = ["a"], ["a", "b"]
    while len(fib[1]) < 3000:
        fib = fib[1], fib[1] + fib[0]
    got = found([same, pair, odd, fib[1]])
    assert got[:3] == [[(0, 30_000, 1)], [(0, 30_000, 2)], [(0, 30_000, 777)]]
    assert got[3] == brute_runs(fib[1])


@pytest.mark.parametrize("size", [2, 8, 64])
def test_squared_differences_are_exact(size):
    rng = np.random.default_rng(size)
    blocks, windows = rng.integers(0, 1 << 31, (size, 5)), rng.integers(0, 1 << 31, (3 * size - 1, 5))
    blocks, windows = blocks % int(periodic_runs.PRIME), windows % int(periodic_runs.PRIME)
    windows[size:2 * size, 2] = blocks[:, 2]
    got = periodic_runs.squared_differences(blocks.astype(np.uint64), windows.astype(np.uint64))
    for d in range(2 * size):
        for c in range(5):
            want = sum((int(x) - int(y)) ** 2 for x, y in zip(blocks[:, c], windows[d:d + size, c]))
            assert int(got[d, c]) == want % int(periodic_runs.PRIME)
    assert got[size, 2] == 0


def test_query_equals_brute_force(spark):
    got = LLM_REGISTRY["op11_periodic_runs"](spark, cases.SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = {r.doc_id: tuple(r) for r in got.collect()}
    want = {r["doc_id"]: brute_row(r["doc_id"], r["text"]) for r in cases.table("documents", ["doc_id", "text"])}
    assert rows == want and any(r[1] for r in rows.values())


def test_edges(spark):
    got = periodic_runs.digests(periodic_runs.run_rows(cases.edge_docs(spark), periodic_runs.planted)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(brute_row(*r[:2])) for r in cases.edge_rows())
    assert periodic_runs.run_rows(cases.empty_docs(spark)).count() == 0
    whole = periodic_runs.run_rows(cases.edge_docs(spark)).filter("doc_id = 7").first()
    assert [tuple(r) for r in whole.runs] == [(0, 40_000, 5)] and whole.collapsed == "lorem ipsum dolor sit amet"
