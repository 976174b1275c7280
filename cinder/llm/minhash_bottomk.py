"""Near-duplicates by bottom-k sketches of one hash function, confirmed on full sets.

A document's set is its distinct 5-word shingles as 64-bit hashes; its sketch is the
``SKETCH`` smallest. Documents with equal sets are one class from there on, so copies cost
one. Steps, all on classes:

1. Inverted lists. Sets with Jaccard similarity of 0.75 or more share at least ``OVERLAP``
   retained values (a link at exactly 0.75 misses that with probability 1e-7; sets smaller
   than a sketch are compared in full, without that risk). So of each sketch only the
   values before its last ``OVERLAP - 1``, rarest first, need a list: two sketches with
   enough in common meet in one of them, and a passage that many documents share stays
   out of the lists unless it makes up most of a document.
2. Lists of up to ``SHORT`` classes give all their pairs.
3. A longer list names a leader, its most typical class. Members are compared with the
   leader, not with each other. Let D(A) be the symmetric difference of A and the leader's
   set, and x(A) = 7 |D(A)| - |A|. A and B are linked if and only if
   14 |D(A) & D(B)| >= x(A) + x(B). Members linked to the leader are in one component and
   need no further check among themselves; any other pair must share as many values of the
   D sets as that inequality says, so the same inverted lists, now of D values, find them.
   A pair that meets in the list of a value that many differences hold has only such
   values in common, and then the inequality leaves next to no pair. The leader is moved to
   the group's centre first.
   This is repeated as long as a round leaves at most ``SHRINK`` of the entries of long lists
   that the one before left, however many rounds that takes. Only entries that no leader
   makes fewer are paired in full, by a join.
4. The union of two sketches estimates each pair's similarity; pairs that cannot reach 0.75
   go. Of the rest, first each class's likeliest pair is checked on the full sets, then
   those whose ends are not in one component yet. Pairs within a component change nothing.
5. Components by smallest label with shortcuts.

Defined results: a document without words (null, empty, blank) has no shingles and is
linked with nothing. Repeated rows and rows of one doc_id with several texts are handled
row by row; a component's id is the smallest doc_id in it. A null doc_id is never a
component's id: such a row gets the component of its class, or null (and is kept) if no
row with an id has its set. Other input columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinder.llm.common import WordHash, map_rows, word_hash
from cinder.operators.staging import stage

WORDS = 5
SKETCH = 64
OVERLAP = 30
SHORT = 48
#: Group of the first round, of sketches; later groups are named by their leader.
FIRST = -1
#: How many times the pairs of a short list a list of low values may look at.
LOOSE = 64
SHRINK = 0.9
#: Most bits of the filter that saves computing sets nobody asked for, and its bits for each id asked for. More ids
#: than it has room for are joined with the texts instead.
FILTER_BITS = 1 << 27
BITS_PER_ID = 16
_STEP, _MIX1, _MIX2 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def shingles(text: str | None, known: WordHash) -> np.ndarray:
    """Sorted distinct shingle hashes (63 bits). bytes.lower touches A-Z only, bytes.split cuts at x20 and x09-x0D."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.int64)
    w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    k = min(WORDS, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h = h * _STEP + w[i:len(w) - k + 1 + i]
    h ^= h >> np.uint64(30)
    h *= _MIX1
    h ^= h >> np.uint64(27)
    h *= _MIX2
    h ^= h >> np.uint64(31)
    return np.unique(h >> np.uint64(1)).astype(np.int64)


def digest(values: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    import xxhash

    both = np.frombuffer(xxhash.xxh3_128_digest(values.tobytes()), "<i8")
    return int(both[0]), int(both[1])


def features(docs: DataFrame) -> DataFrame:
    """uid (unique), doc_id, n, h1, h2, sketch."""
    def make():
        known, row = word_hash(), [0]

        def run(keys, texts):
            task = TaskContext.get().partitionId() << 36
            for key, text in zip(keys, texts):
                values = shingles(text, known)
                yield (task + row[0], key, len(values), *digest(values), values[:SKETCH])
                row[0] += 1
        return run
    return map_rows(docs.select("doc_id", "text"), "uid bigint, doc_id bigint, n bigint, h1 bigint, h2 bigint, sketch array<bigint>", make)


def postings(records: DataFrame) -> DataFrame:
    """The values of each record's elems that need a list, with the record's fields.

    records: grp, node, n, out, w (size of elems), ln, x, need, reach, elems. Values are
    taken rarest first; those that only one record of the group has make no list. ``near``
    ones are before the last ``need - 1``, the others (of nodes that are ``out``) before the
    last ``reach - 1``. In the groups of leaders, a value of over SHORT records is ``low``:
    pairs that meet in its list first have low values in common only, ``h`` at most, and a
    near one of those is kept only if that can be enough for any partner.
    ``typical`` counts a record's values that many records share.
    """
    keep = ["grp", "node", "n", "out", "w", "ln", "x", "need", "reach"]
    rows = records.select(*keep, F.explode("elems").alias("v"))
    counts = rows.groupBy("grp", "v").agg(F.count("*").alias("df")).filter("df > 1")
    own = Window.partitionBy("grp", "node")
    rows = (rows.join(counts, ["grp", "v"])
            .withColumn("low", F.when(F.col("grp") == FIRST, 0).otherwise((F.col("df") > SHORT).cast("int")))
            .withColumn("shared", F.count("*").over(own)).withColumn("h", F.sum("low").over(own))
            .withColumn("typical", F.sum((F.col("df") > SHORT).cast("int")).over(own))
            .withColumn("place", F.row_number().over(own.orderBy("df", "v")) + F.col("w") - F.col("shared")))
    return (rows.filter("place <= w - reach + 1")
            .withColumn("near", F.expr("place <= w - need + 1 and (low = 0 or 14 * h >= ln + 1 + x)")).filter("near or out")
            .select("grp", "v", "low", "node", "n", "out", "w", "h", "x", "near", "typical"))


#: Whether a and b of one list are a candidate: their sizes, and the overlap that their differences can have at most
#: (in a low value's list: of low values), allow 0.75.
_POSSIBLE = "4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n) and 14 * if({low} = 1, least(a.h, b.h), least(a.w, b.w)) >= a.x + b.x"
_FIELDS = ["node", "n", "out", "w", "h", "x"]


def short_pairs(lists: DataFrame) -> DataFrame:
    """a, b: candidates of short lists: near members with each other unless both are settled, the others with settled ones.
    Lists with the same members are paired once. Impossible pairs are left out before they become rows."""
    member = F.struct(*_FIELDS)
    lists = (lists.groupBy("grp", "v", "low").agg(F.sort_array(F.collect_list(F.when(F.col("near"), member))).alias("l"),
                                                  F.sort_array(F.collect_list(F.when(~F.col("near"), member))).alias("far"))
             .select("low", "l", "far").distinct())
    first = lists.select("low", "l", "far", F.posexplode("l").alias("i", "a"))
    others = f"filter(concat(slice(l, i + 2, size(l)), if(a.out, slice(l, 1, 0), far)), b -> (a.out or b.out) and {_POSSIBLE.format(low='low')})"
    pairs = first.select(F.col("a.node").alias("p"), F.explode(F.expr(f"transform({others}, b -> b.node)")).alias("q"))
    return pairs.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def long_pairs(posts: DataFrame) -> DataFrame:
    """a, b: candidates of lists of any length, by a join; for what further rounds would not make fewer."""
    a, b = posts.alias("a"), posts.alias("b")
    met = "((a.near and b.near and (a.out or b.out)) or a.out != b.out)"
    on = F.expr(f"a.grp = b.grp and a.v = b.v and a.node < b.node and {met} and {_POSSIBLE.format(low='a.low')}")
    return a.join(b, on).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()


def leaders(posts: DataFrame) -> DataFrame:
    """leader, node: each list's members with its most typical member."""
    chosen = posts.groupBy("grp", "v").agg(F.max(F.struct("typical", (-F.col("node")).alias("m"))).alias("x"))
    chosen = chosen.select("grp", "v", (-F.col("x.m")).alias("leader"))
    return posts.join(chosen, ["grp", "v"]).filter("node != leader").select("leader", "node").distinct()


def wanted_bits(ids: DataFrame, n_bits: int) -> np.ndarray:
    """A bit for each hash of the ids: n_bits / 64 numbers reach the driver."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(n_bits))
    words = (ids.select(bit.alias("b")).groupBy(F.shiftright("b", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("x")).toArrow())
    out = np.zeros(n_bits // 64, np.uint64)
    out[words["w"].to_numpy()] = words["x"].to_numpy().view(np.uint64)
    return out


def full_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, n, set of the asked nodes, computed again from their texts.

    Texts that nobody asked for are left out before their sets are made: by a filter of the asked ids, whose bits
    follow their number, or, where these are more than ``FILTER_BITS`` allow, by a join that moves texts instead of sets.
    """
    asked = stage(classes.join(nodes, "node", "left_semi").select("node", "cid", "h1", "h2"), "asked")
    ids, rows = asked.select(F.col("cid").alias("doc_id")), docs.filter(F.col("doc_id").isNotNull())
    n_bits = 1 << max(6, (BITS_PER_ID * asked.count()).bit_length())
    bits = None
    if n_bits <= FILTER_BITS:
        bits = docs.sparkSession.sparkContext.broadcast(wanted_bits(ids, n_bits).tobytes())
        rows = rows.select(F.pmod(F.xxhash64("doc_id"), F.lit(n_bits)).alias("bit"), "text")
    else:
        rows = rows.join(ids.distinct(), "doc_id", "left_semi").select(F.lit(0).cast("long").alias("bit"), "text")

    def make():
        words, known = np.frombuffer(bits.value, np.uint64) if bits else np.ones(1, np.uint64), word_hash()

        def run(at, texts):
            at = np.asarray(at, np.int64)
            for i in np.flatnonzero(words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).tolist():
                values = shingles(texts[i], known)
                if len(values):
                    yield (*digest(values), values)
        return run
    found = map_rows(rows, "h1 bigint, h2 bigint, values array<bigint>", make)
    found = found.groupBy("h1", "h2").agg(F.first("values").alias("values"))  # equal sets only: any one will do
    return found.join(asked.select("node", "h1", "h2"), ["h1", "h2"]).select("node", F.size("values").cast("long").alias("n"), "values")


def differences(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Records of the next round: each member's difference from its leader, and whether they are linked (not out)."""
    own, lead = sets.select("node", "n", "values"), sets.select(F.col("node").alias("leader"), F.col("n").alias("ln"), F.col("values").alias("lv"))
    both = members.join(own, "node").join(lead, "leader")
    both = both.withColumn("elems", F.expr("concat(array_except(values, lv), array_except(lv, values))"))
    both = both.withColumn("w", F.size("elems").cast("long"))
    both = both.withColumn("x", F.expr("7 * w - n")).withColumn("out", F.expr("x > ln"))
    return both.select(F.col("leader").alias("grp"), "node", "n", "out", "w", "ln", "x", "elems",
                       F.expr("greatest(1, ceil((ln + 1 + x) / 14))").alias("need"),
                       F.expr("greatest(1, if(out, ceil((x - floor(4 * n / 3)) / 14), ceil((ln + 1 + x) / 14)))").alias("reach"))


def recentred(members: DataFrame, records: DataFrame) -> DataFrame:
    """leader, node with each group's most central member as its leader.

    The group's majority set is the leader's set changed by the values that most
    differences hold; the member that differs least from it leads. A leader with an edit of
    its own would put that edit into every difference.
    """
    size = records.groupBy("grp").agg(F.count("*").alias("m"))
    rows = records.select("grp", "node", F.explode("elems").alias("v"))
    counts = rows.groupBy("grp", "v").agg(F.count("*").alias("df")).filter("df > 1").join(size, "grp").filter("2 * df > m").select("grp", "v")
    held = rows.join(counts, ["grp", "v"], "left_semi").groupBy("grp", "node").agg(F.count("*").alias("c"))
    score = records.select("grp", "node", "w").join(held, ["grp", "node"]).select("grp", F.struct((F.col("w") - 2 * F.col("c")).alias("s"), "node").alias("k"))
    better = score.groupBy("grp").agg(F.min("k").alias("k")).filter("k.s < 0").select(F.col("grp").alias("leader"), F.col("k.node").alias("new"))
    moved = members.join(better, "leader", "left").select("leader", F.coalesce("new", "leader").alias("new"), "node")
    every = moved.select("new", "node").union(moved.select("new", F.col("leader").alias("node")))
    return every.toDF("leader", "node").filter("leader != node").distinct()


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """a, b, est of the pairs that the union sketch leaves possible."""
    sk = lambda side: classes.select(F.col("node").alias(side), F.col("sketch").alias(f"s{side}"))
    both = pairs.join(sk("a"), "a").join(sk("b"), "b")
    both = both.withColumn("u", F.expr(f"slice(sort_array(array_union(sa, sb)), 1, {SKETCH})"))
    both = both.withColumn("o", F.expr("size(array_intersect(array_intersect(sa, sb), u))"))
    return both.filter(f"o * {SKETCH} >= {OVERLAP} * size(u)").select("a", "b", (F.col("o") / F.size("u")).alias("est"))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b of the pairs whose full sets are similar enough."""
    side = lambda s: sets.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("values").alias(f"v{s}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").withColumn("i", F.expr("size(array_intersect(va, vb))"))
    return both.filter("100 * i >= 75 * (na + nb - i)").select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node that edges (a, b) reach from it; only nodes with an edge."""
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct().toDF("node", "other"), "edges")
    labels = stage(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("x")), "other")
        near = near.groupBy("node").agg(F.min("x").alias("x")).join(labels, "node")
        near = near.select("node", F.least("x", "label").alias("label"), F.col("label").alias("old"))
        # shortcut: the label's own label is at least as small
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = stage(near.join(up, "label", "left").select("node", F.least("label", "up").alias("label"), "old"), "labels")
        labels = new.select("node", "label")
        if new.filter("label < old").isEmpty():
            return labels


def links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """node, label of all classes that are linked with another one."""
    spark = docs.sparkSession
    need = F.least(F.lit(OVERLAP), F.ceil(F.lit(0.75) * F.size("sketch"))).cast("long")
    zero = F.lit(0).cast("long")
    records = classes.select(F.lit(FIRST).cast("long").alias("grp"), "node", "n", F.lit(True).alias("out"), F.size("sketch").cast("long").alias("w"),
                             zero.alias("ln"), zero.alias("x"), need.alias("need"), need.alias("reach"), F.col("sketch").alias("elems"))
    pairs, edges, before = [], [spark.createDataFrame([], "a bigint, b bigint")], float("inf")
    key = ["grp", "v"]
    while True:
        posts = stage(postings(records), "lists")
        outer, near = F.col("out").cast("int"), F.col("near").cast("int")
        sizes = posts.groupBy(*key).agg(F.sum(near).alias("m"), F.sum(1 - near).alias("far"), F.sum((1 - outer) * near).alias("settled"))
        # a list's pairs at most; those of low values are nearly all ruled out before they are made
        is_long = F.expr(f"m * m + far * settled > if(low = 1, {LOOSE}, 1) * {SHORT * SHORT}")
        posts = posts.join(sizes, key).filter("near or settled > 0").withColumn("long", is_long)
        listed = stage(posts.select(*key, "low", *_FIELDS, "near", "typical", "long"), "lists")
        pairs.append(short_pairs(listed.filter("not long")))
        rest = listed.filter("long")
        left = rest.count()
        if not left:
            break
        if left > SHRINK * before:
            pairs.append(long_pairs(rest))
            break
        before = left
        members = stage(leaders(rest), "members")
        nodes = members.select("node").union(members.select(F.col("leader").alias("node"))).distinct()
        sets = stage(full_sets(docs, classes, nodes), "sets")
        members = stage(recentred(members, stage(differences(members, sets), "differences")), "members")
        seen = stage(differences(members, sets), "differences")
        edges.append(seen.filter("not out").select(F.col("grp").alias("a"), F.col("node").alias("b")))
        records = seen.join(seen.filter("out").select("grp").distinct(), "grp", "left_semi")
    every = pairs[0]
    for more in pairs[1:]:
        every = every.union(more)
    likely = stage(estimated(every.distinct(), classes), "pairs")
    nodes = likely.select(F.col("a").alias("node")).union(likely.select(F.col("b").alias("node"))).distinct()
    sets = stage(full_sets(docs, classes, nodes), "sets")
    best = [likely.groupBy(own).agg(F.max_by(F.col(other), F.struct("est", F.col(other))).alias(other)).select("a", "b")
            for own, other in (("a", "b"), ("b", "a"))]
    known = edges[0]
    for more in edges[1:]:
        known = known.union(more)
    known = stage(known.union(confirmed(best[0].union(best[1]).distinct(), sets)), "links")
    labels = components(known)
    at = lambda side: labels.select(F.col("node").alias(side), F.col("label").alias(f"l{side}"))
    open_pairs = (likely.join(at("a"), "a", "left").join(at("b"), "b", "left")
                  .filter("la is null or lb is null or la != lb").select("a", "b"))
    return components(known.union(confirmed(open_pairs, sets)))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``."""
    docs = docs.select("doc_id", "text")
    seen = stage(features(docs), "features")
    classes = seen.filter("n > 0 and doc_id is not null").groupBy("h1", "h2").agg(
        F.min("uid").alias("node"), F.min("doc_id").alias("cid"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = stage(classes, "classes")
    linked = classes.select("node", "cid").join(links(docs, classes), "node")  # classes with a link
    smallest = linked.groupBy("label").agg(F.min("cid").alias("least"))
    least = linked.join(smallest, "label").select("node", "least")
    named = classes.join(least, "node", "left").select("h1", "h2", F.coalesce("least", "cid").alias("component_id"))
    out = seen.select("doc_id", F.col("n").alias("n_shingles"), "h1", "h2").join(named, ["h1", "h2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
