import corpus_pipeline as C
from cinder.llm import common, langid_centroid, minhash_bottomk, packing_certified, pii_weak, quality_llr, tokenizer
from cinder.llm.queries import LLM_REGISTRY

from . import cases


def test_stages_follow_their_operators(spark):
    docs = spark.read.parquet(f"{cases.SF}/documents.parquet")
    names = [n for n, _ in C.STAGES]
    assert names == ["quality_rules", "language_id", "near_dedup", "personal_data", "best_fit_packing"]
    labels = spark.read.parquet(f"{cases.SF}/labels.parquet")
    kept = {r.doc_id for r in quality_llr.score(docs, labels).collect() if r.kept}
    one = C.quality_rules(spark, docs, cases.SF)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == kept
    two = C.language_id(spark, one, cases.SF)
    known = {r.doc_id for r in langid_centroid.predict(one, langid_centroid.fit(one)).collect() if not r.rejected}
    assert two.columns == docs.columns and {r.doc_id for r in two.collect()} == known
    three = C.near_dedup(spark, two, cases.SF)
    alone = {r.doc_id for r in minhash_bottomk.near_duplicates(two).collect() if r.kept}
    assert three.columns == docs.columns and sorted(r.doc_id for r in three.collect()) == sorted(alone)
    four = C.personal_data(spark, three, cases.SF)
    model = pii_weak.fit(three)
    before, after = ({r.doc_id: r for r in d.collect()} for d in (three, four))
    assert before.keys() == after.keys()
    for key, r in before.items():
        assert after[key].text == pii_weak.redacted(r.text, pii_weak.spans_of(r.text, model)[1])
        assert after[key].n_chars == len(after[key].text) and not pii_weak.base_spans(after[key].text)
    five = C.best_fit_packing(spark, four, cases.SF)
    assert {r.doc_id for r in five.collect()} == set(after)
    run = LLM_REGISTRY["pipeline"](spark, cases.SF)
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in run.collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in five.collect())


def test_stages_on_odd_rows(spark):
    docs = cases.edge_docs(spark)
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, cases.SF)
        assert out.columns == docs.columns, name
        assert out.count() <= docs.count()
        assert stage(spark, cases.empty_docs(spark), cases.SF).count() == 0, name
    three = C.near_dedup(spark, docs, cases.SF).collect()
    ids = [r.doc_id for r in three if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and {9, 11} <= set(ids) and not {10, 12, 40} & set(ids)
    assert packing_certified.pack(docs, C.vocabulary_path(), 0, 2048).count() >= docs.count()


def test_last_stage_remembers_little(spark):
    docs = spark.read.parquet(f"{cases.SF}/documents.parquet")
    assert C.REMEMBERED <= 1 << 17 < tokenizer.TABLE_WORDS
    small = packing_certified.pieces(docs, C.vocabulary_path(), 0, 2048, words=9).drop("uid")
    assert sorted(small.collect()) == sorted(packing_certified.pieces(docs, C.vocabulary_path(), 0, 2048).drop("uid").collect())


def test_a_worker_drops_earlier_tables(monkeypatch):
    common.word_hash()[b"word"]
    made = []
    monkeypatch.setattr(packing_certified, "map_rows", lambda docs, schema, make: made.append(make))

    class Docs:
        def select(self, *names):
            return self
    packing_certified.pieces(Docs(), C.vocabulary_path(), 0, 2048, words=9)
    made[0]()
    assert not common.word_hash() and tokenizer.word_table(C.vocabulary_path(), 9).limit == 9
