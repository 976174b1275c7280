"""The registered queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cinder.llm import bpe_rank_array, html_tree, langid_centroid, license_scan, minhash_bottomk, packing_certified, packing_windows, periodic_runs, phrase_automata, pii_weak, quality_llr, token_files, topk_mtree
from cinder.llm.common import prepare, read_table
from cinder.llm.tokenizer import vocabulary_path
from cinder.operators.staging import new_folder

Query = Callable[[SparkSession, str], DataFrame]
LLM_REGISTRY: dict[str, Query] = {}
LLM_ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark, sf_dir):
        prepare(spark)
        return fn(spark, sf_dir)
    LLM_REGISTRY[fn.__name__] = run
    return run


@query
def op1_mtree_topk(spark, sf_dir):
    return topk_mtree.top_k(read_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, k=10)


LLM_ORACLE["op1_mtree_topk"] = """
WITH good AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op2_bpe_rank_array(spark, sf_dir):
    return bpe_rank_array.digests(bpe_rank_array.round_trip(read_table(spark, sf_dir, "documents"), vocabulary_path()))


@query
def op6_best_fit_packing(spark, sf_dir):
    return packing_certified.pack(read_table(spark, sf_dir, "documents"), vocabulary_path(), end_id=0, capacity=2048)


@query
def op7_pii_weak(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return pii_weak.find(docs, pii_weak.fit(docs))


@query
def op8_token_files(spark, sf_dir):
    folder = new_folder(spark, "tokens")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), f"{folder}/out", f"{folder}/work", vocabulary_path(), end_id=2)
    return token_files.digests(token_files.read_token_files(spark, f"{folder}/out"))


@query
def op3_minhash_bottomk(spark, sf_dir):
    return minhash_bottomk.near_duplicates(read_table(spark, sf_dir, "documents"))


LLM_ORACLE["op3_minhash_bottomk"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(words) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
edges AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
both_ways AS (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, e.b FROM reach JOIN both_ways e ON e.a = reach.r),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d JOIN least l USING (doc_id) LEFT JOIN n USING (doc_id)
"""


@query
def op4_html_tree(spark, sf_dir):
    return html_tree.extract(read_table(spark, sf_dir, "pages"))


@query
def op5_nearest_centroid(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return langid_centroid.predict(docs, langid_centroid.fit(docs))


@query
def op9_license_scan(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return license_scan.summary(license_scan.scan(docs, license_scan.fit(docs)))


@query
def op10_quality_llr(spark, sf_dir):
    return quality_llr.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op11_periodic_runs(spark, sf_dir):
    return periodic_runs.digests(periodic_runs.run_rows(read_table(spark, sf_dir, "documents"), periodic_runs.planted))


@query
def op12_window_packing(spark, sf_dir):
    return packing_windows.pack(read_table(spark, sf_dir, "documents"), vocabulary_path(), end_id=1, capacity=2048)


@query
def op13_phrase_automata(spark, sf_dir):
    return phrase_automata.collocations(read_table(spark, sf_dir, "documents"))


LLM_ORACLE["op13_phrase_automata"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, size, unnest(list_transform(range(1, CAST(len(w) - size + 2 AS BIGINT)), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size),
f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM cand),
scored AS (
  SELECT c.lang, c.phrase, c.size, c.a, c.k, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * c.a // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
              JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (SELECT lang, a, w, size, unnest(range(2, size)) AS n FROM cand WHERE size > 2),
subs AS (SELECT lang, a, unnest(list_transform(range(1, size - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS phrase FROM inner_),
longer AS (SELECT lang, phrase, max(a) AS longer FROM subs GROUP BY ALL),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, encode(s.phrase)) AS rank
  FROM lowest s LEFT JOIN longer b ON b.lang = s.lang AND b.phrase = s.phrase
  WHERE b.longer IS NULL OR 100 * b.longer < 80 * s.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline  # stands at the repository's top and imports this subpackage

    return corpus_pipeline.run(spark, sf_dir)
