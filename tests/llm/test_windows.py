import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cinder.llm import packing_windows
from cinder.llm.queries import LLM_REGISTRY
from cinder.llm.tokenizer import load, vocabulary_path, word_table

from . import cases


def padding(n, capacity):
    return 0 if n & (n - 1) == 0 else capacity - n


def library_ids(text):
    return [*load(vocabulary_path()).encode(text or "", add_special_tokens=False).ids, 1]


@settings(max_examples=300, deadline=None)
@given(st.sampled_from([8, 20, 64]), st.lists(st.tuples(st.integers(1, 8), st.sampled_from([0, 2, 9])), min_size=1, max_size=25), st.booleans())
def test_cuts_are_the_cheapest(capacity, steps, open_end):
    places = np.cumsum([0, *[s for s, _ in steps]])
    penalties = np.array([0, *[p for _, p in steps]])
    cuts, cost = packing_windows.best_cuts(places, penalties, capacity, open_end)
    best = [0] + [10 ** 9] * len(steps)
    for j in range(1, len(best)):
        for i in range(j):
            n = int(places[j] - places[i])
            if n <= capacity:
                best[j] = min(best[j], best[i] + padding(n, capacity) + int(penalties[j]))
    lengths = np.diff([0, *places[cuts]]).tolist()
    assert all(0 < n <= capacity for n in lengths)
    assert cost == sum(padding(n, capacity) for n in lengths) + int(penalties[cuts].sum())
    if open_end:
        assert cost == min(b for b, p in zip(best, places) if p >= places[-1] - capacity)
    else:
        assert cost == best[-1] and cuts[-1] == len(steps)


def check(got, rows, capacity):
    """Every id in one piece, the pieces of a sequence without gaps, at most ``capacity`` ids in it; the share of padding."""
    held, bins = defaultdict(list), defaultdict(list)
    for r in got:
        held[str(r.doc_id)].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        bins[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for key, text in rows:
        want[str(key)].append(library_ids(text))
    assert held.keys() == want.keys()
    for key, texts in want.items():
        pieces = sorted(held[key])
        if len(texts) > 1:  # repeated ids: their pieces cannot be told apart
            assert sum(p[1] for p in pieces) == sum(map(len, texts))
            continue
        at = 0
        for start, n, crc, total in pieces:
            assert (start, total) == (at, len(texts[0])) and n > 0
            assert crc == zlib.crc32(np.array(texts[0][at:at + n], "<u4").tobytes())
            at += n
        assert at == len(texts[0])
    lengths = []
    for pieces in bins.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= capacity
        lengths.append(at)
    return sum(padding(n, capacity) for n in lengths) / max(1, sum(lengths))


def test_query(spark):
    got = LLM_REGISTRY["op12_window_packing"](spark, cases.SF)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = [(r["doc_id"], r["text"]) for r in cases.table("documents", ["doc_id", "text"])]
    assert check(got.collect(), rows, 2048) < 0.02


def test_edges_and_short_stretches(spark):
    docs, rows = cases.edge_docs(spark), [r[:2] for r in cases.edge_rows()]
    for capacity, stretch in ((64, 256), (2048, 1), (100, 1 << 20)):
        check(packing_windows.pack(docs.repartition(3), vocabulary_path(), 1, capacity, stretch=stretch).collect(), rows, capacity)
    assert packing_windows.pack(cases.empty_docs(spark), vocabulary_path()).count() == 0


def test_cuts_fall_on_sentences_and_order_stays():
    """One task's stream: documents in order; a cut inside a document stands at a sentence's end where one is near."""
    table, end = word_table(vocabulary_path()), b"\1\0\0\0"
    texts = [" ".join(f"word number {k} of sentence {s} goes here." for s in range(40)) for k in range(30)]
    stream = packing_windows.Stream(256, 0, stretch=1024)
    rows, marks = [], []
    for k, text in enumerate(texts):
        ids = packing_windows.sentence_ids(text, table, end)
        assert b"".join(ids) == table.ids(text) + end and len(ids) == 40
        marks.append({0, *np.cumsum([len(b) // 4 for b in ids]).tolist()})
        stream.add(k, ids)
        rows += stream.windows(last=False)
    early = len(rows)
    rows += stream.windows(last=True)
    assert 0 < early < len(rows)
    assert [(r[0], r[1]) for r in rows] == sorted((r[0], r[1]) for r in rows)
    assert [r[5] for r in rows] == sorted(r[5] for r in rows)
    assert all(start + n in marks[k] for k, start, n, *_ in rows)


def test_sentences_lose_white_space_only():
    text = 'One. Two! "Three?" Four (five.) six\nseven 3.14 e.g. eight'
    parts = packing_windows.sentences(text)
    assert parts == ["One.", "Two!", '"Three?"', "Four (five.)", "six", "seven 3.14 e.g.", "eight"]
    assert " ".join(parts).split() == text.split()
