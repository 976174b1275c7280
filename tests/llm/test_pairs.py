import random
import re

import duckdb
import numpy as np
import pytest

from cinder.llm import minhash_bottomk, topk_mtree
from cinder.llm.queries import LLM_ORACLE, LLM_REGISTRY

from . import cases


def views():
    con = duckdb.connect()
    for name in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {name} AS FROM '{cases.SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_sql(spark, name):
    want = views().sql(LLM_ORACLE[name])
    got = LLM_REGISTRY[name](spark, cases.SF).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


# ---------------------------------------------------------------- search

def brute_top(rows, queries, k):
    """The k best (query vector, candidate row) pairs of each id, rows of one id and vector once."""
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = []
    for q in set(queries):
        scored = sorted((-int(np.dot(v, w)), i) for o, v in rows if o == q for i, w in rows if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_search_with_ties_copies_and_odd_rows(spark):
    rng = random.Random(3)
    rows = [(k, [float(rng.randrange(-3, 4)) for _ in range(4)]) for k in range(300)]
    rows += [(300 + k, [2.0, 2.0, 2.0, 2.0]) for k in range(100)] + [(5, rows[5][1]), (400, [1.0, 2.0]), (410, [3.0, 1.0])]
    odd = [(None, [1.0] * 4), (420, None), (430, []), (440, [1.0, None, 1.0, 1.0]), (450, [float("nan")] * 4), (460, [float("inf")] * 4)]
    df = spark.createDataFrame([(i, v, 1, "c") for i, v in rows + odd], "vec_id bigint, embedding array<float>, score int, vec string")
    got = topk_mtree.top_k(df, lambda c: c % 10 == 0, k=7, scale=1, pivots=20, n_cells=4, page_rows=40)
    want = brute_top(rows, [i for i, _ in rows if i % 10 == 0], 7)
    assert sorted(map(tuple, got.collect())) == want
    assert topk_mtree.top_k(df.limit(0), lambda c: c % 10 == 0).count() == 0


def test_ids_with_many_vectors(spark):
    """Ids that ask with 40 vectors, close to each other and better for each other than anything else; candidates with several vectors."""
    rng = random.Random(4)
    near = lambda far: [50.0 + rng.random() * far, 50.0, 0.0]
    rows = [(100, near(9)) for _ in range(40)] + [(200, near(9)) for _ in range(40)] + [(k, near(0.5)) for k in (7, 7, 7, 8)]
    rows += [(300 + k, [rng.random(), rng.random(), rng.random()]) for k in range(1, 90)] + [(300, rows[0][1]), (400, rows[0][1]), (400, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    con = duckdb.connect()
    con.register("embeddings", df.toArrow())
    whole = [(i, tuple(int(np.floor(1024 * float(np.float32(x)))) for x in v)) for i, v in rows]
    for settings in ({}, {"pivots": 60, "n_cells": 5, "page_rows": 20}):
        got = sorted(map(tuple, topk_mtree.top_k(df, lambda c: c % 100 == 0, k=10, **settings).collect()))
        assert got == brute_top(whole, [100, 200, 300, 400], 10) and len(got) == 40
        assert got == sorted(con.execute(LLM_ORACLE["op1_mtree_topk"]).fetchall())


def test_search_by_shells_moves_only_what_can_win(spark, monkeypatch):
    """Clusters of rows on rings around their centres, one cluster of a third of all rows: cells, several shells and several pages of one shell."""
    rng = random.Random(8)
    centres = [[rng.randrange(-900, 900) for _ in range(6)] for _ in range(12)]
    rows = []
    for k in range(900):
        centre = centres[0] if k % 3 == 0 else rng.choice(centres)
        rows.append((k, [float(x + rng.choice((1, 20)) * rng.choice((-1, 1))) for x in centre]))
    rows += [(900 + k, rows[k % 7][1]) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    staged = {}

    def watched(frame, name, stage=topk_mtree.stage):
        out = stage(frame, name)
        staged.setdefault(name, []).append(out)
        return out
    monkeypatch.setattr(topk_mtree, "stage", watched)
    got = topk_mtree.top_k(df, lambda c: c % 10 == 0, k=5, scale=1, pivots=30, n_cells=6, page_rows=15, n_shells=4)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, [i for i, _ in rows if i % 10 == 0], 5)
    first, rest = (x.count() for x in staged["routed"])
    asked, cells = staged["queries"][0].select("q").distinct().count(), [r["count"] for r in staged["cells"][0].groupBy("cell").count().collect()]
    shells = sum(min(4, -(-n // 15)) for n in cells)
    assert first == asked and len(cells) > 6 and len(cells) < shells and rest < asked * shells / 2, (first, rest, asked, shells)


def test_tree_equals_brute_force():
    rng = np.random.default_rng(2)
    for dims, size, spread in ((3, 900, 6), (16, 1500, 300), (2, 600, 1)):
        rows = np.round(rng.normal(size=(size, dims)) * spread).astype(np.int64)
        tree = topk_mtree.Tree(rows)
        for q in rows[::150]:
            best = sorted((-s, r) for s, r in tree.search(q, 9, -2.0 ** 63))[:9]
            assert best == sorted(zip((-(rows @ q)).tolist(), range(size)))[:9]
    huge = np.array([[2 ** 31, 2 ** 31], [2 ** 31, 1]] * 300, np.int64)
    assert max(topk_mtree.Tree(huge).search(huge[0], 1, -2.0 ** 63))[0] == 2 ** 63 - 1


# ---------------------------------------------------------------- near-duplicates

def brute_components(rows):
    sets = []
    for _, text in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((key, len(sets[i]), min(ids) if ids else None))
    return out


def check(spark, rows, **columns):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, uid string, n int")
    got = minhash_bottomk.near_duplicates(df.repartition(3))
    want = brute_components(rows)
    assert sorted(map(str, ((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()))) == sorted(map(str, want))
    assert all(r.kept == (r.component_id is None or r.doc_id == r.component_id) for r in got.collect())


def test_dedup_edges(spark):
    rows = [r[:2] for r in cases.edge_rows()]
    check(spark, [r for r in rows if r[0] is not None])
    assert minhash_bottomk.near_duplicates(cases.empty_docs(spark)).count() == 0


def test_dedup_null_ids(spark):
    check(spark, [(None, "a b c d e f"), (7, "a b c d e f"), (None, None), (3, ""), (9, "q r s"), (9, "a b c d e f")])


def edited(words, rng, n):
    words = words[:]
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10 ** 6)}"
    return " ".join(words)


def test_dedup_large_group_of_near_copies(spark, monkeypatch):
    """Long lists: leaders, differences, further rounds; the full pairing and the join with texts where rounds or the filter can't do."""
    rng = random.Random(9)
    vocabulary = [f"v{k}" for k in range(4000)]
    original = rng.choices(vocabulary, k=150)
    texts = [" ".join(original)] + [edited(original, rng, rng.randrange(0, 9)) for _ in range(130)]
    second = texts[5].split()
    texts += [edited(second, rng, rng.randrange(0, 7)) for _ in range(60)]  # copies of a copy
    common = rng.choices(vocabulary, k=50)
    texts += [" ".join(rng.choices(vocabulary, k=60) + common + rng.choices(vocabulary, k=40)) for _ in range(90)]  # a shared passage
    texts += [edited(rng.choices(vocabulary, k=8), rng, 0) for _ in range(20)] + texts[:10]
    rows = list(enumerate(rng.sample(texts, len(texts))))
    check(spark, rows)
    monkeypatch.setattr(minhash_bottomk, "SHORT", 4)
    monkeypatch.setattr(minhash_bottomk, "LOOSE", 1)
    rounds, recentred = [], minhash_bottomk.recentred
    monkeypatch.setattr(minhash_bottomk, "recentred", lambda *x: rounds.append(1) or recentred(*x))
    check(spark, rows)
    assert len(rounds) > 1  # long lists of long lists: no fixed number of rounds
    monkeypatch.setattr(minhash_bottomk, "SHRINK", 0)
    monkeypatch.setattr(minhash_bottomk, "FILTER_BITS", 0)
    check(spark, rows)
