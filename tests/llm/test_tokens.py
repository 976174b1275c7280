import hashlib
import json
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from cinder.llm import bpe_rank_array, packing_certified, token_files
from cinder.llm.queries import LLM_REGISTRY
from cinder.llm.tokenizer import WordTable, load, vocabulary_path, word_table

from . import cases

ODD = ["áb ç", "İstanbul ΣΑΣ Σ", "x\x1cy \x1d", "<|endoftext|> a<|startoftext|>b<|x", "don't WE'LL 'S a's 12ab", "ﬁ ½ ² ª µ × ÷ ÿ ß", "日本語", "é ́a",
       "x y　z\u0085k", "", "  ", "🙂👩‍👩‍👧 ok", "a" * 300, "1٣٤ _a_b", "ab" * 3000, "\x00a\x01 \x7f", "Ǆ ſ K Å"]


def library_ids(text):
    return load(vocabulary_path()).encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def codec():
    return bpe_rank_array.RankArrayCodec(vocabulary_path(), limit=64, longest=16)


def test_both_ways_equal_the_library(codec):
    texts = [r["text"] for r in cases.table("documents", ["text"])][:60] + ODD
    for text, ids in zip(texts, codec.encode_all(texts)):
        want = library_ids(text)
        assert ids.tolist() == want
        assert np.frombuffer(word_table(vocabulary_path()).ids(text), "<u4").tolist() == want
        assert codec.decode(want) == load(vocabulary_path()).decode(want, skip_special_tokens=False)


def test_words_and_pieces_share_a_table():
    table = WordTable(vocabulary_path())
    assert np.frombuffer(table.ids("hello, Hello hello don't , 7"), "<u4").tolist() == library_ids("hello, Hello hello don't , 7")
    held = {*table, *getattr(table, "pieces", ())}
    assert held == {"hello,", "hello", ",", "Hello", "don't", "don", "'t", "7"}
    assert len(held) == len(table) + len(getattr(table, "pieces", ()))  # nothing is kept twice


def test_plain_words_and_pieces_share_the_codecs_table(monkeypatch):
    """New words are cut together, by one call, and pieces learned with one word are not merged again for another."""
    one, cuts, learned = bpe_rank_array.RankArrayCodec(vocabulary_path()), [], []
    whole, learn = bpe_rank_array.LINE_PIECES, one.learn
    monkeypatch.setattr(bpe_rank_array, "LINE_PIECES", lambda text: cuts.append(text) or whole(text))
    monkeypatch.setattr(one, "learn", lambda pieces: learned.extend(sorted(pieces)) or learn(pieces))
    for text in ["hello, Hello hello don't , 7", "HELLO don's 't Été", "été hello€x"]:
        assert one.encode(text).tolist() == library_ids(text)
    assert len(cuts) == 2 and learned == ["'t", ",", "7", "don", "hello", "'s", "Ã©tÃ©", "hello", "x", "âĤ¬"]  # the last three of a word that is not plain
    assert {*one} == {"hello,", "hello", ",", "Hello", "don't", "don", "'t", "7", "HELLO", "don's", "'s", "Été", "été", "hello€x"}


def test_pieces_of_other_alphabets_stay_apart():
    """The Hebrew letter's bytes are written as the signs of a plain word."""
    for texts in (["ס", "×¡", "a×¡"], ["a×¡", "×¡", "ס"], ["ÿ ß ÷þ", "ס×¡ x"]):
        one = bpe_rank_array.RankArrayCodec(vocabulary_path())
        for text in texts * 2:
            assert one.encode(text).tolist() == library_ids(text)
        again = bpe_rank_array.RankArrayCodec(vocabulary_path())
        assert [ids.tolist() for ids in again.encode_all(texts)] == [library_ids(t) for t in texts]


def test_added_tokens_of_letters_are_no_pieces(tmp_dir):
    with open(vocabulary_path(), encoding="utf-8") as f:
        spec = json.load(f)
    spec["added_tokens"].append({**spec["added_tokens"][-1], "id": 1 + max(t["id"] for t in spec["added_tokens"]), "content": "qpad"})
    with open(f"{tmp_dir}/padded.json", "w", encoding="utf-8") as f:
        json.dump(spec, f)
    one = bpe_rank_array.RankArrayCodec(f"{tmp_dir}/padded.json")
    for text in ["QPAD x", "qpad", "a,Qpad,b qpad,qpad", "QPAD qpadding", "keyqpad QPADDING"]:
        assert one.encode(text).tolist() == load(f"{tmp_dir}/padded.json").encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("aéÉß×¡ס's7,.<|\u00a0Ω ", max_size=90), max_size=6), st.sampled_from([1, 3, 1 << 19]))
def test_many_texts_equal_the_library(texts, limit):
    one = bpe_rank_array.RankArrayCodec(vocabulary_path(), limit=limit, longest=5)
    got = one.encode_all(texts + texts)
    assert [ids.tolist() for ids in got] == [library_ids(t) for t in texts + texts]
    lists = pa.array([ids.tolist() for ids in got], pa.list_(pa.int32()))
    assert one.decode_all(lists).to_pylist() == [load(vocabulary_path()).decode(library_ids(t), skip_special_tokens=False) for t in texts + texts]


@pytest.mark.parametrize("limit", [1, 2, 7, 64])
def test_full_tables_stay_within_their_limit(limit):
    rng, table = random.Random(limit), WordTable(vocabulary_path(), limit)
    words = ["".join(rng.choices("theéaÉX,.'s7", k=rng.randrange(1, 12))) for _ in range(400)]
    for text in [" ".join(rng.choices(words, k=30)) for _ in range(40)] + ODD:
        assert np.frombuffer(table.ids(text), "<u4").tolist() == library_ids(text)
        assert len(table) + len(getattr(table, "pieces", ())) <= limit


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_the_library(text):
    one = bpe_rank_array.codec_of(vocabulary_path())
    assert one.encode(text).tolist() == library_ids(text)
    assert np.frombuffer(word_table(vocabulary_path()).ids(text), "<u4").tolist() == library_ids(text)


def test_rows_and_heap_merge_alike(codec):
    rng = random.Random(4)
    words = ["".join(rng.choices("thearnioshwx", k=rng.randrange(1, 33))) for _ in range(400)]
    assert codec.merge_rows(words) == [codec.merge(w) for w in words]


def test_round_trip_query(spark):
    got = {r.doc_id: r for r in LLM_REGISTRY["op2_bpe_rank_array"](spark, cases.SF).collect()}
    for row in cases.table("documents", ["doc_id", "text"]):
        ids = library_ids(row["text"])
        want = load(vocabulary_path()).decode(ids, skip_special_tokens=False)
        r = got[row["doc_id"]]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_encode_decode_edges(spark):
    docs = cases.edge_docs(spark)
    rows = bpe_rank_array.encode(docs, vocabulary_path()).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in rows) == sorted((r[0] is None, r[0] or 0, library_ids(r[1])) for r in cases.edge_rows())
    back = bpe_rank_array.decode(spark.createDataFrame([(1, None), (2, []), (3, [320, 999999])], "doc_id bigint, ids array<int>"), vocabulary_path())
    assert {r.doc_id: r.text for r in back.collect()} == {1: "", 2: "", 3: load(vocabulary_path()).id_to_token(320)}
    assert bpe_rank_array.round_trip(cases.empty_docs(spark), vocabulary_path()).count() == 0


def test_round_trip_edges(spark):
    rows = bpe_rank_array.round_trip(cases.edge_docs(spark), vocabulary_path()).collect()
    want = [(r[0], ids, load(vocabulary_path()).decode(ids, skip_special_tokens=False)) for r in cases.edge_rows() for ids in [library_ids(r[1])]]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids, r.decoded) for r in rows) == sorted((k is None, k or 0, ids, text) for k, ids, text in want)


# ---------------------------------------------------------------- files

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 32 - 1), max_size=70))
def test_control_bytes_round_trip(values):
    ranks = np.array(values, np.uint32)
    control, data = token_files.pack_ranks(ranks)
    assert token_files.unpack_ranks(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(ranks)).tolist() == values


def check_files(got, rows, end_id):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    at, want = 0, []
    for key, text in rows:
        ids = np.array([*library_ids(text), end_id], "<u4")
        want.append((key, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = sorted(map(tuple, got), key=lambda r: r[1])
    assert sorted(want, key=str) == sorted([(g[0], g[2], g[3]) for g in got], key=str)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == [int(x) for x in np.cumsum([0] + [g[2] for g in got])[:-1]]


def test_token_files_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in cases.table("documents", ["doc_id", "text"])]
    check_files(LLM_REGISTRY["op8_token_files"](spark, cases.SF).collect(), rows, 2)


def test_token_files_edges(spark, tmp_dir):
    token_files.write_token_files(cases.edge_docs(spark), f"{tmp_dir}/a", f"{tmp_dir}/w", vocabulary_path(), 2)
    check_files(token_files.digests(token_files.read_token_files(spark, f"{tmp_dir}/a")).collect(), [r[:2] for r in cases.edge_rows()], 2)
    token_files.write_token_files(cases.empty_docs(spark), f"{tmp_dir}/b", f"{tmp_dir}/x", vocabulary_path(), 2)
    assert token_files.read_token_files(spark, f"{tmp_dir}/b").count() == 0


# ---------------------------------------------------------------- packing

def check_packing(got, rows, end_id, capacity):
    want = sorted((str(k), i, at, len(ids[at:at + capacity]), zlib.crc32(np.array(ids[at:at + capacity], "<u4").tobytes()))
                  for k, t in rows for ids in [[*library_ids(t), end_id]] for i, at in enumerate(range(0, len(ids), capacity)))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in cases.table("documents", ["doc_id", "text"])]
    bins = check_packing(LLM_REGISTRY["op6_best_fit_packing"](spark, cases.SF).collect(), rows, 0, 2048)
    assert bins <= 1 + -(-sum(len(library_ids(t)) + 1 for _, t in rows) // 2048)


def test_packing_edges_and_exchange(spark):
    docs, rows = cases.edge_docs(spark), [r[:2] for r in cases.edge_rows()]
    many = check_packing(packing_certified.pack(docs, vocabulary_path(), 0, 64, group_pieces=4).collect(), rows, 0, 64)
    one = check_packing(packing_certified.pack(docs, vocabulary_path(), 0, 64).collect(), rows, 0, 64)
    apart = check_packing(packing_certified.pack(docs, vocabulary_path(), 0, 64, group_pieces=4, rounds=1).collect(), rows, 0, 64)
    assert one <= many <= apart
    assert packing_certified.pack(cases.empty_docs(spark), vocabulary_path()).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_bound_never_exceeds_the_best_packing(lengths):
    def fits(left, rooms):
        if not left:
            return True
        return any(fits(left[1:], rooms[:i] + [r - left[0]] + rooms[i + 1:]) for i, r in enumerate(rooms) if r >= left[0] and r not in rooms[:i])
    best = next(n for n in range(1, 10) if fits(sorted(lengths, reverse=True), [20] * n))
    a = np.array(lengths)
    bins, offsets = packing_certified.best_fit_decreasing(a, 20)
    assert packing_certified.lower_bound(a, 20) <= best <= bins.max() + 1
    for b in set(bins.tolist()):
        at = 0
        for i in sorted(np.flatnonzero(bins == b), key=lambda i: offsets[i]):
            assert offsets[i] == at
            at += a[i]
        assert at <= 20


def test_packing_rounds_end_when_no_bin_is_saved(spark, monkeypatch):
    """Groups that grow from round to round and are never certified, so that more than four rounds save bins."""
    deal = packing_certified._pack
    monkeypatch.setattr(packing_certified, "_pack", lambda items, groups, salt, capacity: deal(items, max(2, 64 >> salt), salt, capacity)
                        .withColumn("bound", F.lit(0).cast("long")))
    words = "alpha beta gamma delta the of and to in is that for it was on are".split()
    texts = [" ".join(random.Random(k).choices(words, k=random.Random(k).randrange(2, 40))) for k in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bins = [packing_certified.pack(docs, vocabulary_path(), 0, 64, group_pieces=4, **bound).select("sequence_id").distinct().count() for bound in ({"rounds": 4}, {})]
    assert bins[1] < bins[0], bins


def test_token_files_of_one_id_on_a_third_of_the_rows(spark, tmp_dir):
    rows = [(7 if k % 3 == 0 else None if k % 50 == 1 else k, f"text {k % 100} of {'many ' * (k % 7)}rows") for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these rows would go to one part
    try:
        token_files.write_token_files(docs, f"{tmp_dir}/a", f"{tmp_dir}/w", vocabulary_path(), 2)
        parts = spark.read.parquet(f"{tmp_dir}/w").filter("doc_id = 7").select("part").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts > 2
    check_files(token_files.digests(token_files.read_token_files(spark, f"{tmp_dir}/a")).collect(), rows, 2)
