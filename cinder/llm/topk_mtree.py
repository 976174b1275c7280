"""Exact top-k by inner product with M-trees and best-first search.

Vectors become whole numbers, floor(scale * x). Rows with the same whole vector are one
entry that keeps its ``k + 1`` smallest ids (no answer can need more of them), so copies,
however many, cost one. Entries are dealt to cells around pivots, more of them for more entries, within a cell to
shells of like distance from its pivot, and within a shell to pages of bounded size. A page is an M-tree: every node has a routing vector, the covering radius
of its subtree, its distance to its parent's routing vector and its largest norm; leaves
hold vectors with their distance to the leaf's routing vector.

By d(q,x)^2 = |q|^2 + |x|^2 - 2 q.x a distance bounds a score. A subtree at distance at
least m from q, with norms up to M, scores at most (|q|^2 + M^2 - m^2) / 2, and at most
q.c + |q| r by Cauchy-Schwarz. m follows from the covering radius, and before q.c is even
computed from |d(q,parent) - d(parent,c)| - r: a child or a vector that this stored bound
rules out costs no inner product. Nodes are visited best bound first until none can beat
the k-th score. Ties stay in, so smaller ids win. Scores are exact integers.

A query's first threshold is its k-th best score among a bounded sample of vectors, found before anything
is shuffled. It is then sent to one page, that of the shell with the best bound, whose k-th best score tightens the
threshold, and after that only to the pages of the shells that can still beat it: a shell is ruled out by its
least and greatest distance from the pivot before a vector moves. Identical queries are searched once.

Defined results: vectors null, empty, with a null or non-finite component, and null ids
take no part. Rows of the same id and vector count once. An id with several vectors is
searched with each, and its answer is the k best of all (query vector, candidate row) pairs;
rows of its own are left out before anything is counted, so they never take a place or raise
a threshold. Only vectors of the query's
dimension are candidates. Components of 2^31 or more after scaling are taken as +-2^31
(scores stay in 64 bits). Other input columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinder.llm.common import prepare
from cinder.operators.staging import stage

#: Vectors, by hash order, whose scores give a query's first threshold; the first of them are the cells' pivots:
#: one for each PAGE_ROWS entries, CELLS at least and PIVOTS at most.
PIVOTS = 256
CELLS = 32
#: Shells of a cell at most; with PIVOTS it bounds the directory of shells.
SHELLS = 64
PAGE_ROWS = 8192
QUERY_ROWS = 4096
LEAF = 256
FANOUT = 16
#: Relative rounding allowed for in bounds; pruning needs more than that.
SLACK = 1e-9


def whole_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """id, vec (array<bigint>), each pair once."""
    top = F.lit(float(1 << 31))
    x = F.transform(F.col(vec_col), lambda c: F.greatest(F.least(F.floor(c.cast("double") * scale).cast("double"), top), -top).cast("long"))
    good = F.expr(f"`{vec_col}` is not null and size(`{vec_col}`) > 0 and forall(`{vec_col}`, c -> c is not null and not isnan(c) "
                  "and abs(cast(c as double)) < double('infinity'))")
    return df.filter(F.col(id_col).isNotNull() & good).select(F.col(id_col).cast("long").alias("id"), x.alias("vec")).distinct()


class Tree:
    """M-tree over the rows of an integer matrix, loaded in bulk."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self.x = vectors, vectors.astype(np.float64)
        self.norm2 = np.einsum("ij,ij->i", self.x, self.x)
        self.peak = float(np.abs(self.x).max())
        self.route: list[int] = []       # row of the routing vector
        self.radius: list[float] = []
        self.top: list[float] = []       # largest squared norm below
        self.to_parent: list[float] = []
        self.kids: list[np.ndarray | None] = []
        self.rows: list[np.ndarray | None] = []
        self.row_dist: list[np.ndarray | None] = []
        rows = np.arange(len(vectors))
        self._node(rows, self._middle(rows), 0.0)
        work = [0]
        while work:
            node = work.pop()
            groups = self._split(self.rows[node])
            if groups is None:
                continue
            own = self.route[node]
            first = len(self.route)
            for centre, part in groups:
                self._node(part, centre, float(self._distance(own, np.array([centre]))[0]))
            self.kids[node], self.rows[node], self.row_dist[node] = np.arange(first, len(self.route)), None, None
            work.extend(range(first, len(self.route)))
        self.radius_a, self.top_a = np.array(self.radius), np.array(self.top)
        self.to_parent_a, self.route_a = np.array(self.to_parent), np.array(self.route)

    def _distance(self, row: int, others: np.ndarray) -> np.ndarray:
        d = self.norm2[row] + self.norm2[others] - 2 * (self.x[others] @ self.x[row])
        return np.sqrt(np.maximum(d, 0))

    def _middle(self, rows: np.ndarray) -> int:
        """The row nearest to the rows' mean."""
        mean = self.x[rows].mean(0)
        return int(rows[np.argmin(((self.x[rows] - mean) ** 2).sum(1))])

    def _node(self, rows: np.ndarray, centre: int, to_parent: float) -> None:
        d = self._distance(centre, rows)
        self.route.append(centre)
        self.radius.append(float(d.max()))
        self.top.append(float(self.norm2[rows].max()))
        self.to_parent.append(to_parent)
        self.kids.append(None)
        self.rows.append(rows)
        self.row_dist.append(d)

    def _split(self, rows: np.ndarray) -> list[tuple[int, np.ndarray]] | None:
        """Rows by their nearest of up to FANOUT routing rows (evenly spaced ones), each group with its middle row."""
        if len(rows) <= LEAF:
            return None
        fanout = min(FANOUT, -(-2 * len(rows) // LEAF))
        seeds = rows[np.linspace(0, len(rows) - 1, fanout).astype(int)]
        d = self.norm2[seeds][None, :] - 2 * (self.x[rows] @ self.x[seeds].T)
        near = np.argmin(d, 1)
        parts = [rows[near == j] for j in range(fanout)]
        parts = [p for p in parts if len(p)]
        if len(parts) == 1:  # cannot be told apart by distance: halves
            parts = [rows[:len(rows) // 2], rows[len(rows) // 2:]]
        return [(self._middle(p), p) for p in parts]

    def search(self, query: np.ndarray, k: int, least: float, skip: np.ndarray | None = None) -> list[tuple[int, int]]:
        """(score, row) of all rows that no k better ones rule out; only scores of at least ``least`` matter. Rows marked in ``skip`` do not count."""
        q = query.astype(np.float64)
        q2 = float(q @ q)
        norm = q2 ** 0.5
        small = self.peak * float(np.abs(q).max()) * len(q) < 2 ** 52  # then float products of whole numbers are exact
        found: list[int] = []  # min-heap of the k best scores
        out: list[tuple[int, int]] = []

        def margin(bound):
            return bound + SLACK * (np.abs(bound) + q2) + 1e-3

        def by_distance(m, top):
            return margin((q2 + top - np.square(np.maximum(m, 0))) / 2)

        dot = float(self.x[self.route[0]] @ q)
        d = max(q2 + self.norm2[self.route[0]] - 2 * dot, 0) ** 0.5
        heap = [(-float(min(by_distance(d - self.radius[0], self.top[0]), margin(dot + norm * self.radius[0]))), 0, d)]
        while heap:
            bound, node, d = heapq.heappop(heap)
            if -bound < least:
                break
            if self.kids[node] is not None:
                kids = self.kids[node]
                kids = kids[by_distance(np.abs(d - self.to_parent_a[kids]) - self.radius_a[kids], self.top_a[kids]) >= least]
                if not len(kids):
                    continue
                at = self.route_a[kids]
                dots = self.x[at] @ q
                dist = np.sqrt(np.maximum(q2 + self.norm2[at] - 2 * dots, 0))
                bounds = np.minimum(by_distance(dist - self.radius_a[kids], self.top_a[kids]), margin(dots + norm * self.radius_a[kids]))
                for b, kid, e in zip(bounds.tolist(), kids.tolist(), dist.tolist()):
                    if b >= least:
                        heapq.heappush(heap, (-b, kid, e))
                continue
            rows = self.rows[node]
            rows = rows[by_distance(np.abs(d - self.row_dist[node]), self.norm2[rows]) >= least]
            rows = rows if skip is None else rows[~skip[rows]]
            if small:
                scores = self.x[rows] @ q
                good = scores >= least
                scores, rows = scores[good].astype(np.int64).tolist(), rows[good]
            else:
                scores = exact_scores(self.vectors[rows], query)
            for score, row in zip(scores, rows.tolist()):
                if score >= least:
                    out.append((score, row))
                    heapq.heappush(found, score)
                    if len(found) > k:
                        heapq.heappop(found)
                    if len(found) == k:
                        least = max(least, found[0])
        return [(s, r) for s, r in out if s >= least]


def exact_scores(vectors: np.ndarray, query: np.ndarray) -> list[int]:
    """Integer inner products; Python's integers where 64 bits might not do, held to the range of a long."""
    if not len(vectors):
        return []
    if float(np.abs(vectors).max()) * float(np.abs(query).max()) * len(query) < 2 ** 62:
        return (vectors @ query).tolist()
    exact = vectors.astype(object) @ query.astype(object)
    return [max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in exact]


def floor_of(score: int) -> float:
    """The score as a threshold; where a double cannot hold it, a little less."""
    return float(score) if abs(score) < 2 ** 53 else float(score) - 1e-12 * abs(float(score))


def top_k(df: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024,
          pivots: int = PIVOTS, n_cells: int = CELLS, page_rows: int = PAGE_ROWS, n_shells: int = SHELLS) -> DataFrame:
    """query_id, rank, vec_id, score. ``is_query`` maps the id column to a boolean column."""
    spark = df.sparkSession
    prepare(spark)
    rows = stage(whole_vectors(df, id_col, vec_col, scale), "vectors")
    # Entries: each distinct vector with its k + 1 smallest ids. The limit by rank works before the shuffle.
    order = Window.partitionBy("vec").orderBy("id")
    entries = (rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
               .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("h", F.xxhash64("vec")))
    entries = stage(entries, "entries")
    n_cells = min(pivots, max(n_cells, -(-entries.count() // page_rows)))
    chosen = entries.orderBy("h", "vec").limit(pivots).select("vec", "ids").collect()  # at most `pivots` rows of k + 1 ids
    by_dim: dict[int, np.ndarray] = {}
    only: dict[int, list[int | None]] = {}
    for r in chosen:
        by_dim.setdefault(len(r.vec), []).append(r.vec)
        only.setdefault(len(r.vec), []).append(r.ids[0] if len(r.ids) == 1 else None)
    by_dim = {n: np.array(v, np.int64) for n, v in by_dim.items()}
    shared, only_id = spark.sparkContext.broadcast(by_dim), spark.sparkContext.broadcast(only)

    def assign(batches):
        """Cell of each entry: its nearest pivot of its dimension (0 if none), the distance to it, and its squared norm."""
        for pdf in batches:
            cells, dists, tops = np.zeros(len(pdf), np.int32), np.zeros(len(pdf)), np.zeros(len(pdf))
            dims = pdf["vec"].map(len).to_numpy()
            for dim in np.unique(dims):
                centres = shared.value.get(int(dim))
                if centres is not None:
                    at = np.flatnonzero(dims == dim)
                    x, c = np.stack(pdf["vec"].iloc[at].to_list()).astype(float), centres[:n_cells].astype(float)
                    d = (x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * (x @ c.T)
                    cells[at], dists[at], tops[at] = np.argmin(d, 1), np.sqrt(np.maximum(d.min(1), 0)), (x * x).sum(1)
            yield pdf.assign(dim=dims.astype(np.int32), cell=cells, dist=dists, top=tops)[["vec", "ids", "h", "dim", "cell", "dist", "top"]]
    celled = stage(entries.mapInPandas(assign, "vec array<bigint>, ids array<bigint>, h bigint, dim int, cell int, dist double, top double"), "cells")
    # One row a cell: at most `n_cells` for each dimension of a pivot, and one for each dimension without a pivot of its own.
    steps = [j / n_shells for j in range(1, n_shells)] or [0.5]
    sizes = celled.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.percentile_approx("dist", steps, 1000).alias("at")).collect()
    edges = {}
    for r in sizes:
        m = min(n_shells, -(-r.n // page_rows))
        edges.setdefault(r.dim, {})[r.cell] = [r.at[-(-n_shells * j // m) - 1] for j in range(1, m)]
    edges = spark.sparkContext.broadcast(edges)

    def shell_of(dim: pd.Series, cell: pd.Series, dist: pd.Series) -> pd.Series:
        return pd.Series([int(np.searchsorted(edges.value[d][c], x)) for d, c, x in zip(dim, cell, dist)], dtype="int32")
    celled = celled.withColumn("shell", F.pandas_udf(shell_of, "int")("dim", "cell", "dist"))
    # One row a shell: at most `n_shells` for each row above. Shells of more than a page are dealt to pages by hash.
    directory = celled.groupBy("dim", "cell", "shell").agg(F.min("dist").alias("low"), F.max("dist").alias("high"), F.max("top").alias("top"),
                                                           F.count("*").alias("n")).orderBy("dim", "cell", "shell").collect()
    shells = {dim: [r for r in directory if r.dim == dim] for dim in {r.dim for r in directory}}
    shells = spark.sparkContext.broadcast({dim: {c: np.array([r[c] for r in some]) for c in ("cell", "shell", "low", "high", "top")}
                                           for dim, some in shells.items()})
    # A query is a vector. One whose id has no other vector finds its own id in one entry at most, so k + 1 places are
    # enough whoever asks; one whose id has several is searched for that id, without its rows.
    queries = rows.filter(is_query(F.col("id"))).select("vec", "id")
    several = queries.groupBy("id").count().filter("count > 1").select("id", F.lit(True).alias("alone"))
    queries = queries.join(several, "id", "left").select("id", "vec", F.col("alone").isNotNull().alias("alone"))
    queries = stage(queries.withColumn("own", F.when(F.col("alone"), F.col("id")).otherwise(0)).withColumn("q", F.xxhash64("vec", "alone", "own")), "queries")
    searched = queries.select("vec", "alone", "own", "q").distinct()

    def route(only_best: bool):
        def run(batches):
            """Each distinct query once for the shell of the best bound (``first``), or also for every other that can hold one of its k best."""
            for pdf in batches:
                out = {"q": [], "alone": [], "own": [], "least": [], "qvec": [], "dim": [], "cell": [], "shell": [], "first": []}
                for q, vec, alone, own, known in zip(pdf["q"], pdf["vec"], pdf["alone"], pdf["own"], pdf["known"]):
                    query, dim = np.asarray(vec, np.int64), len(vec)
                    centres, here, least = shared.value.get(dim), shells.value.get(dim), float(known)
                    if here is None:
                        continue
                    bounds = np.full(len(here["cell"]), np.inf)
                    if centres is not None:
                        x, scores = query.astype(float), exact_scores(centres, query)
                        scores = sorted((s for s, i in zip(scores, only_id.value[dim]) if not alone or i != own), reverse=True)
                        enough = k if alone else k + 1  # one of the vectors may be the query's own
                        least = max(least, floor_of(scores[enough - 1])) if len(scores) >= enough else least
                        c = centres[:n_cells].astype(float)
                        dots, q2 = c @ x, float(x @ x)
                        c2 = (c * c).sum(1)
                        d = np.sqrt(np.maximum(q2 + c2 - 2 * dots, 0))[here["cell"]]
                        size2 = q2 + here["top"] + c2[here["cell"]]
                        apart = np.maximum(np.maximum(d - here["high"], here["low"] - d), 0)
                        # the rounding of distances grows with the norms, so it is allowed for on both sides
                        apart = np.maximum(apart - SLACK ** 0.5 * np.sqrt(size2), 0)
                        bounds = np.minimum((q2 + here["top"] - apart * apart) / 2, dots[here["cell"]] + q2 ** 0.5 * here["high"])
                        bounds = bounds + SLACK * (np.abs(bounds) + size2) + 1e-3
                    best = int(np.argmax(bounds))
                    for at in [best] if only_best else np.flatnonzero(bounds >= least).tolist():
                        for name, value in zip(out, (q, alone, own, least, vec, dim, here["cell"][at], here["shell"][at], at == best)):
                            out[name].append(value)
                yield pd.DataFrame(out).astype({"q": "int64", "alone": "bool", "own": "int64", "least": "float64", "dim": "int32", "cell": "int32",
                                                "shell": "int32", "first": "bool"})
        return run

    def asked_of(known: DataFrame, only_best: bool) -> DataFrame:
        return stage(known.select("vec", "alone", "own", "q", "known").mapInPandas(
            route(only_best), "q bigint, alone boolean, own bigint, least double, qvec array<bigint>, dim int, cell int, shell int, first boolean"), "routed")

    place = ["dim", "cell", "shell"]

    def search(routed: DataFrame, only_best: bool) -> DataFrame:
        """Pages of entries and blocks of queries by shell; every page meets every block of its shell once. The first page of a
        query's best shell is all that is searched first, and left out afterwards."""
        asked = {tuple(r[c] for c in place): r["count"] for r in routed.groupBy(*place).count().collect()}
        plan = [(*at, -(-r.n // page_rows), -(-asked[at] // QUERY_ROWS)) for r in directory if (at := (r.dim, r.cell, r.shell)) in asked]
        plan = F.broadcast(spark.createDataFrame(plan, "dim int, cell int, shell int, n_pages int, n_blocks int"))
        pages = (celled.join(plan, place).withColumn("page", F.pmod("h", "n_pages").cast("int")).filter("page = 0" if only_best else "true")
                 .select("vec", "ids", *place, "page", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block")))
        last = F.lit(0) if only_best else F.col("n_pages") - 1
        numbers = F.filter(F.sequence(F.lit(0), last), lambda i: F.lit(only_best) | ~F.col("first") | (i > 0))
        blocks = (routed.join(plan, place).withColumn("block", F.pmod(F.hash("q"), "n_blocks"))
                  .select("q", "alone", "own", "least", "qvec", *place, F.explode(numbers).alias("page"), "block"))
        key = [*place, "page", "block"]
        return pages.groupBy(*key).cogroup(blocks.groupBy(*key)).applyInPandas(look, "q bigint, id bigint, score bigint")

    def look(entries_pdf: pd.DataFrame, queries_pdf: pd.DataFrame) -> pd.DataFrame:
        out = {"q": [], "id": [], "score": []}
        if len(entries_pdf) and len(queries_pdf):
            tree, ids = Tree(np.stack(entries_pdf["vec"].to_list()).astype(np.int64)), entries_pdf["ids"].to_list()
            one = np.array([len(i) == 1 for i in ids])
            first = np.array([i[0] for i in ids], np.int64)
            for q, alone, own, least, vec in zip(*(queries_pdf[c] for c in ("q", "alone", "own", "least", "qvec"))):
                skip, places = (one & (first == own), k) if alone else (None, k + 1)
                best = [(-s, int(i)) for s, row in tree.search(np.asarray(vec, np.int64), places, least, skip) for i in ids[row] if not alone or i != own]
                for s, i in heapq.nsmallest(places, best):
                    out["q"].append(q)
                    out["id"].append(i)
                    out["score"].append(-s)
        return pd.DataFrame(out).astype({"q": "int64", "id": "int64", "score": "int64"})
    first_hits = stage(search(asked_of(searched.withColumn("known", F.lit(-float(1 << 63))), True), True), "first-hits")
    # The k-th best score of that page, where it holds as many rows as the query asks for.
    enough = F.when(F.col("alone"), k).otherwise(k + 1)
    tight = first_hits.groupBy("q").agg(F.count("*").alias("found"), F.min("score").alias("worst"))
    worst = F.when(F.abs(F.col("worst").cast("double")) < float(1 << 53), F.col("worst").cast("double"))
    worst = F.coalesce(worst, F.col("worst").cast("double") - F.abs(F.col("worst").cast("double")) * 1e-12)
    known = searched.join(tight, "q", "left").withColumn("known", F.when(F.col("found") >= enough, worst).otherwise(-float(1 << 63)))
    hits = first_hits.unionByName(search(asked_of(known, False), False))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    hits = hits.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1).drop("place")
    hits = hits.groupBy("q").agg(F.collect_list(F.struct("id", "score")).alias("hits"))  # k + 1 at most
    answers = (queries.join(hits, "q")
               .select(F.col("id").alias("query_id"), F.explode(F.filter("hits", lambda x: x["id"] != F.col("id"))).alias("x"))
               .select("query_id", F.col("x.id").alias("vec_id"), F.col("x.score").alias("score")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
