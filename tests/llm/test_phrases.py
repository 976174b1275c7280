import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from cinder.llm import phrase_automata
from cinder.llm.queries import LLM_ORACLE, LLM_REGISTRY

from . import cases

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least=30, top=2000):
    """Rows of the result from (lang, text) pairs, by plain counting."""
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(SMALL)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for n in (1, 2, 3, 4):
                counts[lang].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = {p[i:i + n] for p, a in cands.items() for n in range(2, len(p)) for i in range(len(p) - n + 1) if 100 * a >= 80 * f[p[i:i + n]]}
        scored = []
        for p, a in cands.items():
            if p not in dropped:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def test_query_equals_brute_force_and_sql(spark):
    got = found(LLM_REGISTRY["op13_phrase_automata"](spark, cases.SF))
    rows = cases.table("documents", ["lang", "text"])
    assert got and got == brute([(r["lang"], r["text"]) for r in rows])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{cases.SF}/documents.parquet')")
    assert got == sorted(con.execute(LLM_ORACLE["op13_phrase_automata"]).fetchall())


def skewed_rows():
    """One language and one phrase in a third of all rows, copies, a frequent first word that many ranges share."""
    rng = random.Random(13)
    words = [f"w{k}" for k in range(30)]
    rows = []
    for k in range(300):
        text = " ".join("the " + rng.choice(words) if rng.random() < 0.6 else rng.choice(words) + rng.choice(["", "", ",", ".\n", "\x0b"]) for _ in range(60))
        rows.append(("aa" if k % 3 else None, text if k % 4 else "New York City Hall is in New York City. The end"))
    return rows


@pytest.mark.parametrize("shard_words, range_words", [(1 << 21, 1 << 21), (500, 300), (97, 1 << 21), (1 << 21, 64)])
def test_any_shards_and_ranges(spark, shard_words, range_words):
    rows = skewed_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = found(phrase_automata.collocations(docs, min_count=5, top=50, shard_words=shard_words, range_words=range_words))
    assert got == brute(rows, 5, 50) and len(got) > 60
    if range_words < 1000:
        assert sum(map(len, phrase_automata.range_bounds(docs, range_words).values())) > 20


def test_edges(spark):
    docs, rows = cases.edge_docs(spark), [(r[2], r[1]) for r in cases.edge_rows()]
    assert found(phrase_automata.collocations(docs, min_count=1, top=10_000)) == brute(rows, 1, 10_000)
    assert found(phrase_automata.collocations(docs, min_count=10 ** 9)) == []
    assert found(phrase_automata.collocations(cases.empty_docs(spark))) == []
    bare = spark.createDataFrame([(None, None), ("en", ""), ("en", " .,\n\t")], "lang string, text string")
    assert found(phrase_automata.collocations(bare, min_count=1)) == []


def random_windows(rng, words, n):
    rows = Counter()
    for _ in range(n):
        size = rng.randrange(1, 5)
        rows[tuple(rng.choices(range(1, len(words) + 1), k=size)) + (0,) * (4 - size)] += rng.randrange(1, 9)
    keys = sorted(rows)
    labels = np.array(keys, np.uint64).T
    top = np.uint64(32)
    return rows, (labels[0] << top | labels[1], labels[2] << top | labels[3], np.array([rows[k] for k in keys], np.int64))


def test_transducers_keep_their_paths_and_merge_states():
    rng = random.Random(5)
    words = sorted(f"word{k}".encode() for k in range(12))
    for n in (1, 5, 200):
        rows, windows = random_windows(rng, words, n)
        known, labels, weight = phrase_automata.paths(phrase_automata.build(words, windows))
        as_words = lambda key: tuple(words[k - 1] if k else b"" for k in key)
        back = {tuple(known[k - 1] if k else b"" for k in key): w for key, w in zip(labels.T.tolist(), weight.tolist())}
        assert back == {as_words(k): w for k, w in rows.items()}
    # Two groups of arcs that are alike, one that is not: two states.
    state, sizes, arcs = phrase_automata.merge_states(np.array([0, 2, 4]), np.array([1, 2, 1, 2, 1]), np.array([7, 7, 7, 7, 7]))
    assert state[0] == state[1] != state[2] and sorted(sizes.tolist()) == [1, 2] and len(arcs[0]) == 3


def test_union_and_composition():
    rng = random.Random(6)
    words = sorted(f"word{k}".encode() for k in range(9))
    other = sorted(f"word{k}".encode() for k in range(5, 14))
    a, wa = random_windows(rng, words, 80)
    b, wb = random_windows(rng, other, 80)
    spell = lambda rows, ws: {tuple(ws[k - 1] for k in key if k): n for key, n in rows.items()}
    left, right = spell(a, words), spell(b, other)
    blobs = [phrase_automata.build(words, wa), phrase_automata.build(other, wb)]
    united, windows = phrase_automata.unite(blobs)
    assert dict(zip(phrase_automata.phrase_texts(united, *windows[:2]), windows[2].tolist())) == {
        b" ".join(k).decode(): left.get(k, 0) + right.get(k, 0) for k in {*left, *right}}
    texts, weights = phrase_automata.compose(*blobs)
    assert dict(zip(texts, weights.tolist())) == {b" ".join(k).decode(): right[k] for k in left if k in right}
