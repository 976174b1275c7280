"""Periodic runs of words, by block convolution.

A run is a stretch of words with smallest period q and at least ``max(SHORTEST, 2 q)`` words
that no neighbouring word extends keeping period q. Periods are searched at dyadic scales: at
scale B (2, 4, 8, ...) a text is cut into blocks of B words, and a block's occurrences at the
distances 2B-1 to 4B-2 (from 1 at the smallest scale) are the zeros of the sum of squared
differences between the block and the window behind it, computed for all distances at once by
a number-theoretic transform modulo ``PRIME``. A stretch that repeats q words later is at
least 2B-1 words long for every q of the scale, so it holds a whole block: no period is
missed. Zeros are seeds: they are compared word by word (a sum may vanish modulo the prime by
chance) and extended to both sides.

Two exact shortcuts bound the work. The stretch of a run that repeats holds six words that
recur, so a block takes part only if the six-word windows in it (or, for blocks under six
words, one around it) recur within the scale's distances. And a block whose whole window lies
in a known run of a period of at most B has only multiples of that period as distances, which
lead back to that run; it is left out, as are such distances of blocks near a run's end. Texts
of a batch go through each scale together.

Defined results: a null, empty or blank text has no words and no runs, its collapsed text is
empty. A null doc_id keeps its row; repeated rows are each answered. Other input columns are
ignored. An empty table gives no rows. Texts are used whole, however long; what a task holds
besides its batch grows with the longest text, transforms in pieces of ``CELLS`` numbers.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinder.llm.common import map_rows

#: Words a run has at least.
SHORTEST = 12
#: Words of the window that recurs in every run: SHORTEST words with a period of six or less repeat six, longer periods more.
SEED = SHORTEST // 2
#: 15 * 2**27 + 1 with primitive root 31: products of two residues fit 64 bits, transforms reach 2**27 words.
PRIME, ROOT = np.uint64(2013265921), 31
#: Numbers in one transform or comparison.
CELLS = 1 << 21
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def mod(x: np.ndarray) -> np.ndarray:
    return x - x // PRIME * PRIME


@lru_cache(maxsize=64)
def twiddles(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order 2 * half, as a column."""
    p = int(PRIME)
    base = pow(ROOT, (p - 1) // (2 * half), p)
    base = pow(base, p - 2, p) if inverse else base
    out = np.ones(half, np.uint64)
    done = 1
    while done < half:  # out[done:2 done] = out[:done] * base ** done
        out[done:2 * done] = mod(out[:done] * np.uint64(pow(base, done, p)))
        done *= 2
    return out[:, None]


def transform(a: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of every column, in bit-reversed order. The length is a power of two."""
    n, m = a.shape
    half = n // 2
    while half:
        pair = a.reshape(n // (2 * half), 2, half, m)
        u, v = pair[:, 0], pair[:, 1]
        a = np.empty_like(pair)
        total = u + v
        a[:, 0] = np.minimum(total, total - PRIME)  # the smaller one: below zero wraps to a huge number
        a[:, 1] = mod((u + PRIME - v) * twiddles(half, False))
        a = a.reshape(n, m)
        half //= 2
    return a


def inverse_transform(a: np.ndarray) -> np.ndarray:
    """Inverse of ``transform``, from bit-reversed to natural order."""
    n, m = a.shape
    half = 1
    while half < n:
        pair = a.reshape(n // (2 * half), 2, half, m)
        u, v = pair[:, 0], mod(pair[:, 1] * twiddles(half, True))
        a = np.empty_like(pair)
        total, gap = u + v, u + PRIME - v
        a[:, 0], a[:, 1] = np.minimum(total, total - PRIME), np.minimum(gap, gap - PRIME)
        a = a.reshape(n, m)
        half *= 2
    return mod(a * np.uint64(pow(n, int(PRIME) - 2, int(PRIME))))


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sum of squared differences of each column of ``blocks`` and its column of ``windows`` at every distance, modulo PRIME."""
    size, m = blocks.shape
    n = 1 << (len(windows) - 1).bit_length()
    flipped, padded = np.zeros((n, m), np.uint64), np.zeros((n, m), np.uint64)
    flipped[0], flipped[n - size + 1:] = blocks[0], blocks[:0:-1]  # word i at place -i: the product correlates
    padded[:len(windows)] = windows
    products = inverse_transform(mod(transform(flipped) * transform(padded)))[:len(windows) - size + 1]
    squares = np.zeros((len(windows) + 1, m), np.uint64)
    np.cumsum(mod(windows * windows), axis=0, out=squares[1:])
    own = mod(blocks * blocks).sum(0)
    return mod(own + squares[size:] - squares[:-size] + 2 * (PRIME - products))


def next_repeat(ids: np.ndarray, owner: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Distance from each word to the next occurrence of the SEED words from it on, in the same text; a huge number without one.

    Windows are compared by hash; a chance match only makes a distance too small, which costs a comparison later.
    """
    n = len(ids)
    out = np.full(n, n + 1, np.int64)
    if n < SEED:
        return out
    key = np.zeros(n - SEED + 1, np.uint64)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    for k in range(SEED):
        key = key * np.uint64(0xD6E8FEB86659FD93) + mixed[k:n - SEED + 1 + k]
    at = np.flatnonzero(np.arange(n - SEED + 1) + SEED <= ends[owner[:n - SEED + 1]])
    key = key[at] + owner[at].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    out[at[order[same]]] = at[order[same + 1]] - at[order[same]]
    return out


def reach(ids: np.ndarray, at: np.ndarray, distance: np.ndarray, limit: np.ndarray, step: int, width: int) -> np.ndarray:
    """How many words from ``at`` on, in direction ``step`` and at most ``limit``, equal the word ``distance`` behind them."""
    got, active = np.zeros(len(at), np.int64), np.flatnonzero(limit > 0)
    k = np.arange(width)[:, None]
    while len(active):
        on = []
        for part in np.array_split(active, -(-len(active) * width // CELLS)):
            ahead = got[part] + k
            inside = ahead < limit[part]
            place = at[part] + step * np.where(inside, ahead, 0)
            same = inside & (ids[place] == ids[place + distance[part]])
            count = np.where(same.all(0), width, np.argmin(same, axis=0))
            got[part] += count
            on.append(part[count == width])
        active = np.concatenate(on)
    return got


def scale_runs(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, near: np.ndarray, size: int, known: np.ndarray) -> np.ndarray:
    """Rows (start, end, distance) of the stretches of at least two distances that blocks of ``size`` words seed."""
    low, high = (1 if size == 2 else 2 * size - 1), 4 * size - 2
    n = len(ids)
    # Blocks of every text that a window at the least distance still fits behind.
    count = np.maximum(0, (ends - starts - low) // size)
    text = np.repeat(np.arange(len(starts)), count)
    at = starts[text] + size * (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count))
    recurs = np.concatenate([[0], np.cumsum(near <= high)])
    if size >= SEED:
        keep = recurs[at + size - SEED + 1] - recurs[at] == size - SEED + 1
    else:
        keep = recurs[at + 1] > recurs[np.maximum(at + size - SEED, starts[text])]
    inside = known[(known[:, 2] <= size) & (known[:, 1] - known[:, 0] >= 5 * size - 2)]
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, inside[:, 0], 1)
    np.add.at(cover, inside[:, 1] - (5 * size - 2) + 1, -1)
    keep &= np.cumsum(cover)[at] == 0
    at, text = at[keep], text[keep]
    seeds = []
    reach_of = np.arange(low, high + size)[:, None]
    word = np.arange(size)[:, None]
    columns = max(1, CELLS // (4 * size))
    for first in range(0, len(at), columns):
        here, owner = at[first:first + columns], text[first:first + columns]
        windows = ids[np.minimum(here + reach_of, n - 1)].astype(np.uint64)
        far, which = np.nonzero(squared_differences(ids[here + word].astype(np.uint64), windows) == 0)
        far += low
        fits = here[which] + far + size <= ends[owner[which]]
        seeds.append(np.stack([owner[which], here[which], far], 1)[fits])
    seeds = np.concatenate(seeds) if seeds else np.zeros((0, 3), np.int64)
    # Inside a known run, multiples of its period lead back to it.
    seeds = seeds[np.argsort(seeds[:, 1], kind="stable")]
    fresh = np.ones(len(seeds), bool)
    for start, end, period in known[(known[:, 2] <= size) & (known[:, 1] - known[:, 0] >= low + size)].tolist():
        a, b = np.searchsorted(seeds[:, 1], [start, end])
        fresh[a:b] &= (seeds[a:b, 2] % period != 0) | (seeds[a:b, 1] + seeds[a:b, 2] + size > end)
    seeds = seeds[fresh]
    whole = [(ids[part[:, 1] + word] == ids[part[:, 1] + part[:, 2] + word]).all(0)
             for part in np.array_split(seeds, -(-len(seeds) * size // CELLS) or 1)]
    seeds = seeds[np.concatenate(whole)]
    if not len(seeds):
        return np.zeros((0, 3), np.int64)
    # Neighbouring blocks at the same distance belong to one stretch.
    seeds = seeds[np.lexsort((seeds[:, 1], seeds[:, 2], seeds[:, 0]))]
    joined = (seeds[1:, 0] == seeds[:-1, 0]) & (seeds[1:, 2] == seeds[:-1, 2]) & (seeds[1:, 1] == seeds[:-1, 1] + size)
    first = np.flatnonzero(np.concatenate([[True], ~joined]))
    last = np.concatenate([first[1:], [len(seeds)]]) - 1
    owner, distance, left, right = seeds[first, 0], seeds[first, 2], seeds[first, 1], seeds[last, 1] + size
    left = left - reach(ids, left - 1, distance, left - starts[owner], -1, max(size, 8))
    right = right + distance + reach(ids, right, distance, ends[owner] - distance - right, 1, max(size, 8))
    found = np.stack([left, right, distance], 1)
    return found[found[:, 1] - found[:, 0] >= np.maximum(SHORTEST, 2 * found[:, 2])]


def find(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Runs of several texts, their word ids one after another: rows (text, start in it, length, period) by text, start, period."""
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    near = next_repeat(ids, owner, ends)
    some = np.zeros(len(lengths), bool)
    some[owner[near <= len(ids)]] = True
    held = some[owner]
    ids, near = ids[held], near[held]
    texts, size = np.flatnonzero(some), 2
    ends = np.cumsum(lengths[texts])
    starts = ends - lengths[texts]
    known = np.zeros((0, 3), np.int64)
    longest = int(lengths[texts].max()) if len(texts) else 0
    while (1 if size == 2 else 2 * size - 1) + size <= longest:
        found = np.concatenate([known, scale_runs(ids, starts, ends, near, size, known)])
        # The same stretch at several distances: they are multiples of the smallest, which is its period.
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        known = found[np.concatenate([[True], (found[1:, :2] != found[:-1, :2]).any(1)])[:len(found)]]
        size *= 2
    which = np.searchsorted(ends, known[:, 0], "right")
    out = np.stack([texts[which], known[:, 0] - starts[which], known[:, 1] - known[:, 0], known[:, 2]], 1) if len(known) else np.zeros((0, 4), np.int64)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = out = len(self)
        return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that stand in no run after that run's first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()])


def run_rows(docs: DataFrame, rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), collapsed: one row per row of ``docs``.

    ``rewrite(doc_id, words)`` may change a text's words before the search.
    """
    def make():
        def run(keys, texts):
            words = [t.encode().split() if t else [] for t in texts]  # bytes.split cuts at ASCII white space only
            if rewrite:
                words = [rewrite(k, w) for k, w in zip(keys, words)]
            known = _Ids()
            lengths = np.array([len(w) for w in words], np.int64)
            ids = np.fromiter((known[w] for ws in words for w in ws), np.int64, int(lengths.sum()))
            runs: list[list[tuple[int, int, int]]] = [[] for _ in words]
            for text, start, length, period in find(ids, lengths).tolist():
                runs[text].append((start, length, period))
            for key, ws, found in zip(keys, words, runs):
                yield key, len(ws), [dict(zip(("start", "length", "period"), r)) for r in found], collapsed(ws, found).decode()
        return run
    return map_rows(docs.select("doc_id", "text"), f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string", make)


def planted(key: int | None, words: list[bytes]) -> list[bytes]:
    """The query's rule: one document in ten, by crc32 of its id, repeats itself from some word on. A null id never does."""
    import zlib

    n = len(words)
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period), hashes of all runs and of the collapsed text."""
    # greatest length, then smallest start, then smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best_of = found.withColumn("best", best)
    return best_of.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("best.length * 1000 div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
