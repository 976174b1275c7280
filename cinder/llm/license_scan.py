"""Licence scan with a trained paragraph classifier.

Word n-grams of one to three are the sparse features of a multinomial logistic regression over
the licence families and an ``unknown`` class. It is trained on the templates (notices, naming
phrases and bare names, also with words dropped and corpus words mixed in) and, for ``unknown``,
on at most ``SAMPLE`` paragraphs of the corpus (lines, those of over ``LONGEST`` characters in
pieces of that many), by hash order, whole and in windows (the bounds are parameters). A
temperature fitted on a held-out fifth calibrates the probabilities.

The classifier judges every text first, in overlapping windows of 8, 24 and 64 words, whatever
they hold. A window is identified as each family that gets a probability of at least ``PROPOSE``;
where none does, the window is ``unknown``. Identified windows are then compared with the
templates of their families: a stretch is confirmed if it holds ``OVERLAP`` of the word pairs of one, in
at most half as many words again as the template has (a sentence of a licence: in ``WINDOW`` words
at least), and if its own words get that family with a probability of at least ``ACCEPT``.
Where confirmed stretches of two families share word pairs, the one with more pairs stays; overlapping
ones of one family are merged. Every family of a text is reported, each with its own spans; line breaks and
signs between words (comment marks) do not matter. The ids of an SPDX expression are judged one by one.

Only word n-grams of the notices have weights. A span holds the punctuation that touches it.

Defined results: a null or empty text has no paragraphs and no licences. Positions are code
points. Null or repeated doc_ids keep their rows; other input columns are ignored. Texts
are read whole.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinder.llm.common import map_rows

SAMPLE = 4000
LONGEST = 2000
ACCEPT = 0.6
OVERLAP = 0.6
WINDOW = 40
PROPOSE = 0.05
#: (words, step) of the classifier's windows. A stretch of up to words - step + 1 words lies wholly in one of them.
WINDOWS = ((8, 4), (24, 8), (64, 16))
#: Words judged together; bounds what a task holds.
WORDS_AT_ONCE = 1 << 17
UNKNOWN = "unknown"
SPDX = "spdx-license-identifier"
COPIES = 8
_WORD = re.compile(r"[^\W_]+(?:[.+-][^\W_]+)*")

#: Names and opening sentences of public licences.
NAMES = {
    "AGPL": ["GNU Affero General Public License", "GNU AGPL", "AGPL-3.0"],
    "Apache": ["Apache License", "Apache-2.0", "Apache License Version 2.0", "Apache 2.0 License"],
    "BSD": ["BSD License", "BSD-3-Clause", "BSD-2-Clause", "3-clause BSD License", "New BSD License", "Simplified BSD License", "BSD 3-Clause License", "BSD 2-Clause License"],
    "CC-BY": ["CC BY 4.0", "CC BY 3.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution License"],
    "CC-BY-NC": ["CC BY-NC 4.0", "CC BY-NC 2.0", "CC BY-NC 3.0", "Creative Commons Attribution-NonCommercial License", "CC BY-NC-SA 4.0",
                 "Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-SA": ["CC BY-SA 4.0", "CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike License", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0": ["CC0 1.0 Universal", "CC0 Public Domain Dedication", "CC0 1.0"],
    "GPL": ["GNU General Public License", "GNU General Public License version 3", "GNU General Public License version 2", "GPL-3.0", "GPL-2.0", "GNU GPL"],
    "ISC": ["ISC License"],
    "LGPL": ["GNU Lesser General Public License", "GNU LGPL", "LGPL-2.1", "LGPL-3.0"],
    "MIT": ["MIT License", "MIT licence", "Expat License"],
    "MPL": ["Mozilla Public License", "Mozilla Public License Version 2.0", "MPL-2.0"],
    "Unlicense": ["Unlicense"],
}
#: How notices name a licence.
PHRASES = ["Licensed under the {}.", "Licensed under {}.", "Released under the {}.", "This work is licensed under the {}.",
           "This work is licensed under {}, version 3.", "Distributed under the {}.", "Available under the terms of the {}.",
           "This program is free software under the {}.", "SPDX-License-Identifier: {}", "Licensed under the {}, Version 2.0."]
#: SPDX ids, and how they are named besides by themselves (an id without a digit is no name by itself).
IDS = {
    "AGPL": ["AGPL-3.0-only", "AGPL-3.0-or-later"],
    "BSD": ["0BSD"],
    "CC-BY": ["CC-BY-4.0", "CC-BY-3.0", "CC-BY-2.0"],
    "CC-BY-NC": ["CC-BY-NC-4.0", "CC-BY-NC-3.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0"],
    "CC-BY-SA": ["CC-BY-SA-4.0", "CC-BY-SA-3.0"],
    "CC0": ["CC0-1.0"],
    "GPL": ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"],
    "ISC": ["ISC"],
    "LGPL": ["LGPL-2.0", "LGPL-2.0-only", "LGPL-2.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "MIT": ["MIT", "MIT-0"],
    "MPL": ["MPL-1.1"],
}
ID_PHRASES = ["SPDX-License-Identifier: {}", "Licensed under {}.", "Licensed under the {}.", "Released under {}.", "License: {}"]
#: Sentences of the licence texts themselves.
NOTICES = {
    "AGPL": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "Apache": ["you may not use this file except in compliance with the License. You may obtain a copy of the License at",
               "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"],
    "CC0": ["the person who associated a work with this deed has dedicated the work to the public domain by waiving all rights"],
    "GPL": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
            "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "LGPL": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
}


def tokens(text: str) -> list[str]:
    """Words in small letters; cut before lower-casing, which may add signs that are no letters."""
    return _WORD.findall(text.lower()) if text.isascii() else [w.lower() for w in _WORD.findall(text)]


def grams(words: list[str]) -> list[str]:
    return [" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


#: Word pairs of the phrases without a name: by themselves they name no licence.
FRAMES = frozenset(pair for phrase in [*PHRASES, *ID_PHRASES] for part in phrase.split("{}") for pair in zip(tokens(part), tokens(part)[1:]))


def templates() -> list[tuple[str, str]]:
    """(family, text) of every notice."""
    named = [(f, p.format(n)) for f, names in NAMES.items() for n in names for p in PHRASES]
    bare = [(f, n) for f, names in NAMES.items() for n in names if any(map(str.isdigit, n)) or " " in n]
    ids = [(f, p.format(i)) for f, names in IDS.items() for i in names for p in [*ID_PHRASES, *["{}"] * any(map(str.isdigit, i))]]
    return named + bare + ids + [(f, t) for f, texts in NOTICES.items() for t in texts]


def paragraphs(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of each line with a character that is no white space."""
    out, at = [], 0
    for line in (text or "").split("\n"):
        if line and not line.isspace():
            out.append((at, at + len(line)))
        at += len(line) + 1
    return out


def sample_paragraphs(docs: DataFrame, bound: int) -> list[str]:
    """At most ``bound`` corpus paragraphs, long ones in pieces of ``LONGEST`` characters, the smallest hashes first; repeated ones count once.

    Only hashes are shuffled; the second pass fetches the chosen lines.
    """
    lines = docs.select(F.explode(F.regexp_extract_all("text", F.lit(f"([^\\n]{{1,{LONGEST}}})"), F.lit(1))).alias("line"))
    lines = lines.filter(F.length(F.trim("line")) > 0).withColumn("h", F.xxhash64("line"))
    chosen = lines.select("h").distinct().orderBy("h").limit(bound).collect()
    if not chosen:
        return []
    few = docs.sparkSession.createDataFrame([(r.h,) for r in chosen], "h bigint")
    found = lines.join(F.broadcast(few), "h", "left_semi").groupBy("h").agg(F.min("line").alias("line"))
    return [r.line for r in found.orderBy("h").collect()]


class Model:
    def __init__(self):
        self.index: dict[str, int] = {}
        self.classes: list[str] = []
        self.weights = np.zeros((0, 0))
        self.temperature = 1.0
        self.templates: list[tuple[str, frozenset, int, int]] = []  # family, units, units needed, words of a window
        self.anchors: dict[tuple, list[int]] = {}  # unit -> templates that cannot be there without one of their anchors
        self.singles: frozenset = frozenset()
        self.ids: dict[str, str] = {}  # SPDX id -> family
        self.longer: list[tuple[np.ndarray, np.ndarray]] = []  # n-grams of two, three words: sorted keys, positions

    def learn_vocabulary(self, vocabulary: list[str]) -> None:
        """An n-gram's key is the position of all but its last word, times the size, plus the position of its last."""
        self.index = {g: k + 1 for k, g in enumerate(vocabulary)}  # 0: the intercept
        for n in (2, 3):
            some = [(g.rpartition(" "), at) for g, at in self.index.items() if g.count(" ") == n - 1]
            some = sorted((self.index[head] * (len(vocabulary) + 1) + self.index[last], at) for (head, _, last), at in some)
            self.longer.append((np.array([k for k, _ in some], np.int64), np.array([at for _, at in some], np.int64)))

    def windows(self, single: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, end, class) of the windows over a row of word positions (0: an unknown word) that are identified as a family."""
        by_size, out = [single], []
        for keys, at in self.longer:
            head = by_size[-1][:len(single) - len(by_size)]
            asked = head * (len(self.index) + 1) + single[len(by_size):]
            place = np.minimum(np.searchsorted(keys, asked), max(len(keys) - 1, 0))
            good = (head > 0) & (single[len(by_size):] > 0) & (keys[place] == asked) if len(keys) else np.zeros(len(asked), bool)
            by_size.append(np.where(good, at[place] if len(keys) else 0, 0))
        where = np.concatenate([np.flatnonzero(x) for x in by_size])
        feature = np.concatenate([x[x > 0] for x in by_size])
        size = np.concatenate([np.full(int((x > 0).sum()), n + 1) for n, x in enumerate(by_size)])
        order = np.lexsort((where, feature))
        where, feature, size = where[order], feature[order], size[order]
        before = np.full(len(where), -1)  # the same n-gram's place before this one: in a window each counts once
        before[1:] = np.where(feature[1:] == feature[:-1], where[:-1], -1)
        for width, step in WINDOWS:
            count = -(-max(len(single) - width, 0) // step) + 1
            low = -(-np.maximum(before + 1, np.maximum(where + size - width, 0)) // step)
            high = np.minimum(where // step, count - 1)
            use = low <= high
            low, high, used = low[use], high[use] + 1, feature[use]
            z = np.empty((count, len(self.classes)))
            for c in range(len(self.classes)):
                w = self.weights[used, c]
                z[:, c] = self.weights[0, c] + np.cumsum(np.bincount(low, w, count + 1) - np.bincount(high, w, count + 1))[:count]
            p = np.exp((z - z.max(1, keepdims=True)) / self.temperature)
            p = p[:, :-1] / p.sum(1, keepdims=True)  # the last class is "unknown"
            out += [(t * step, t * step + width, c) for t, c in np.argwhere(p >= PROPOSE).tolist()]
        return out

    def identify(self, texts: list[list[str]]) -> list[list[tuple[int, int, str]]]:
        """For each text (as words) the (start, end, family) of its identified windows."""
        out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        gap = max(w for w, _ in WINDOWS)  # unknown words between texts, so that no window holds words of two
        step = max(s for _, s in WINDOWS)
        at = 0
        while at < len(texts):
            starts, row, first = [], [], at
            while at < len(texts) and (not row or len(row) < WORDS_AT_ONCE):
                starts.append(len(row))
                row += [self.index.get(w, 0) for w in texts[at]]
                row += [0] * (gap + -(len(row) + gap) % step)
                at += 1
            found = self.windows(np.array(row, np.int64))
            if found:
                which = np.searchsorted(starts, [s for s, _, _ in found], "right") - 1
                for (start, end, c), t in zip(found, which.tolist()):
                    start, end = start - starts[t], min(end - starts[t], len(texts[first + t]))
                    if start < end:
                        out[first + t].append((start, end, self.classes[c]))
        return out

    def features(self, words: list[str]) -> np.ndarray:
        """Positions of the known n-grams, each once."""
        index = self.index
        return np.unique([index[g] for g in grams(words) if g in index] or [0]).astype(np.int64)

    def predict(self, words: list[str]) -> tuple[str, float]:
        z = self.weights[self.features(words)].sum(0) + self.weights[0]
        z = np.exp((z - z.max()) / self.temperature)
        best = int(np.argmax(z))
        return self.classes[best], float(z[best] / z.sum())

    def learn_templates(self, notices: list[tuple[str, list[str]]], corpus: list[list[str]]) -> None:
        """Units are word pairs; a template of one word that is an id of its own (with a digit) is one unit."""
        common = Counter(p for words in corpus for p in set(zip(words, words[1:])))
        for family, words in notices:
            if len(words) == 2 and words[0] == SPDX:
                self.ids[words[1]] = family
            units = frozenset(zip(words, words[1:])) or frozenset((w,) for w in words if any(c.isdigit() for c in w))
            if units:
                width = len(words) + max(2, len(words) // 2)
                self.templates.append((family, units, -(-round(OVERLAP * 100) * len(units) // 100), max(width, WINDOW) if len(words) > 10 else width))
        shared = Counter(u for _, units, *_ in self.templates for u in units)
        for t, (_, units, needed, _) in enumerate(self.templates):
            # With more units missing than these leave, too few would stand: one of the rarest is always there.
            for u in sorted(units, key=lambda u: (common[u], shared[u], u))[:len(units) - needed + 1]:
                self.anchors.setdefault(u, []).append(t)
        self.singles = frozenset(u[0] for u in shared if len(u) == 1)

    def candidates(self, words: list[str]) -> set[tuple[int, int, str, tuple]]:
        """(first word, last word, family, places of the units) of the stretches that hold enough of a template."""
        out = set()
        pairs = list(zip(words, words[1:]))
        done: dict[int, int] = {}  # template -> last place looked at
        places = [(i, u) for i, u in enumerate(pairs) if u in self.anchors]
        places += [(i, (w,)) for i, w in enumerate(words) if w in self.singles]
        for at, unit in places:
            for t in self.anchors[unit]:
                family, units, needed, width = self.templates[t]
                if len(unit) == 1:
                    out.add((at, at, family, (at,)))
                    continue
                low = max(0, at - width + 2, done.get(t, -1) + 1)
                done[t] = high = min(len(pairs), at + width - 1) - 1
                # Windows before ``low`` were looked at with the template's last anchor; those that reach over it were not.
                near = [(i, pairs[i]) for i in range(max(0, low - width + 2), high + 1) if pairs[i] in units]
                count, k = Counter(), 0
                for j, (i, u) in enumerate(near):
                    count[u] += 1
                    while i - near[k][0] > width - 2:
                        count[near[k][1]] -= 1
                        if not count[near[k][1]]:
                            del count[near[k][1]]
                        k += 1
                    if len(count) >= needed and count[u] == 1 and not FRAMES.issuperset(count):  # nor does one at the end
                        while count[near[k][1]] > 1:  # a repeated unit at the start adds nothing
                            count[near[k][1]] -= 1
                            k += 1
                        out.add((near[k][0], i + 1, family, tuple(x for x, _ in near[k:j + 1])))
        return out

    def matches(self, words: list[str], identified: list[tuple[int, int, str]]) -> set[tuple[int, int, str, tuple]]:
        """Candidates that share a word with an identified window of their family. Templates are looked for around the windows only."""
        by_family: dict[str, list[list[int]]] = {}
        around: list[list[int]] = []
        reach = max((width for *_, width in self.templates), default=0)
        for start, end, family in sorted(identified):
            for spans, a, b in ((by_family.setdefault(family, []), start, end), (around, max(0, start - reach), end + reach)):
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], b)
                else:
                    spans.append([a, b])
        out = set()
        for a, b in around:
            for first, last, family, places in self.candidates(words[a:b]):
                spans = by_family.get(family, ())
                k = bisect_right(spans, [a + last, len(words) + reach]) - 1 if spans else -1
                if k >= 0 and spans[k][1] > a + first:
                    out.add((a + first, a + last, family, tuple(a + i for i in places)))
        return out

    def found(self, words: list[str], identified: list[tuple[int, int, str]]) -> list[tuple[int, int, str, float]]:
        """(first word, last word, family, probability) of every confirmed stretch, merged by family, in order."""
        seen: dict[tuple[int, int], tuple[str, float]] = {}
        good = []
        for first, last, family, places in self.matches(words, identified):
            if (first, last) not in seen:
                seen[first, last] = self.predict(words[first:last + 1])
            best, p = seen[first, last]
            if best == family and p >= ACCEPT:
                good.append((-len(places), -p, first, last, family, places))
        owner: dict[int, str] = {}
        kept = []
        for _, p, first, last, family, places in sorted(good):
            if all(owner.get(i, family) == family for i in places):
                owner.update(dict.fromkeys(places, family))
                kept.append((family, first, last, -p))
        merged: list[list] = []
        for family, first, last, p in sorted(kept):
            if merged and merged[-1][2] == family and first <= merged[-1][1]:
                merged[-1][1], merged[-1][3] = max(merged[-1][1], last), max(merged[-1][3], p)
            else:
                merged.append([first, last, family, p])
        return sorted(map(tuple, merged))


def train(notices: list[tuple[str, str]], background: list[str], seed: int = 7) -> Model:
    rng, model = random.Random(seed), Model()
    model.classes = [*sorted({f for f, _ in notices}), UNKNOWN]
    plain = [(f, tokens(t)) for f, t in notices]
    vocabulary = sorted({g for _, words in plain for g in grams(words)})
    model.learn_vocabulary(vocabulary)
    known_words = {w for _, words in plain for w in words}
    corpus = [w for w in map(tokens, background) if w]
    model.learn_templates(plain, corpus)
    filler = [w for words in corpus for w in words if w not in known_words] or ["x"]
    examples = []
    for family, words in plain:
        examples.append((family, words))
        for _ in range(COPIES):
            kept = [w for w in words if rng.random() > 0.06]
            extra = [rng.choice(filler) for _ in range(rng.randrange(0, 25))]
            cut = rng.randrange(0, len(extra) + 1)
            examples.append((family, extra[:cut] + kept + extra[cut:]))
    # Notices in the sampled paragraphs must not teach "unknown": leave out those that hold most of a template.
    clean = [w for w in corpus if not model.candidates(w)]
    examples += [(UNKNOWN, w) for w in clean]
    for words in clean:
        for width, _ in WINDOWS:
            if len(words) > width:
                at = rng.randrange(len(words) - width + 1)
                examples.append((UNKNOWN, words[at:at + width]))
    shuffled = [words[:] for _, words in plain]
    for words in shuffled:  # the words of a notice without its order say nothing
        rng.shuffle(words)
    examples += [(UNKNOWN, w) for w in shuffled]
    rows = [model.features(w) for _, w in examples]
    y = np.array([model.classes.index(f) for f, _ in examples])
    held = np.array([rng.random() < 0.2 for _ in examples])
    model.weights = _softmax_regression(rows, y, ~held, len(vocabulary) + 1, len(model.classes))
    z = np.stack([model.weights[r].sum(0) + model.weights[0] for r in rows])
    losses = [(float(np.mean(_log_loss(z[held] / t, y[held]))), t) for t in np.geomspace(0.3, 5, 40)] if held.any() else [(0.0, 1.0)]
    model.temperature = min(losses)[1]
    return model


def _log_loss(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return np.log(np.exp(z).sum(1)) - z[np.arange(len(y)), y]


def _softmax_regression(rows: list[np.ndarray], y: np.ndarray, use: np.ndarray, dims: int, classes: int,
                        steps: int = 150, penalty: float = 1e-4) -> np.ndarray:
    """Gradient descent with per-weight steps (AdaGrad) on sparse rows; classes weigh alike."""
    which = np.flatnonzero(use)
    at = np.concatenate([rows[i] for i in which])
    row = np.repeat(np.arange(len(which)), [len(rows[i]) for i in which])
    order = np.argsort(at, kind="stable")
    at_sorted, row_sorted = at[order], row[order]
    starts = np.flatnonzero(np.r_[True, np.diff(at_sorted) > 0])
    bounds = np.r_[0, np.cumsum([len(rows[i]) for i in which])][:-1]
    target = np.eye(classes)[y[which]]
    share = 1 / np.maximum(target.sum(0), 1)
    weight = (target @ share)[:, None] * len(which) / classes
    w, seen = np.zeros((dims, classes)), np.full((dims, classes), 1e-8)
    for _ in range(steps):
        z = np.add.reduceat(w[at], bounds, axis=0) + w[0]
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        gap = (p - target) * weight / len(which)
        grad = penalty * w
        grad[at_sorted[starts]] += np.add.reduceat(gap[row_sorted], starts, axis=0)
        grad[0] += gap.sum(0)
        seen += grad * grad
        w -= 0.3 * grad / np.sqrt(seen)
    return w


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    return train(templates(), sample_paragraphs(docs, sample))


def scan_text(text: str | None, model: Model) -> list[tuple[int, int, str, float]]:
    """(start, end, family, probability) of every notice and every name of a licence, also over line breaks."""
    return scan_texts([text], model)[0]


def scan_texts(texts: list[str | None], model: Model) -> list[list[tuple[int, int, str, float]]]:
    """``scan_text`` of each; the classifier judges the windows of many texts together."""
    split = [tokens(t or "") for t in texts]
    return [_confirm(t, words, windows, model) if windows or SPDX in words else []
            for t, words, windows in zip(texts, split, model.identify(split))]


def _confirm(text: str, words: list[str], identified: list[tuple[int, int, str]], model: Model) -> list[tuple[int, int, str, float]]:
    spans = model.found(words, identified)
    if not spans and SPDX not in words:
        return []
    found = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    for i, word in enumerate(words):
        if word == SPDX:
            spans += _expression(text, found, words, i, model)
    spans = sorted((*_touching(text, found[first][0], found[last][1]), family, p) for first, last, family, p in set(spans))
    inner = _inside(spans)
    return [x for x in spans if x not in inner]


def _inside(spans: list[tuple]) -> set[tuple]:
    """Spans that lie in another one of their family."""
    last, out = {}, set()
    for x in sorted(spans, key=lambda x: (x[0], -x[1], -x[3])):
        if x[1] <= last.get(x[2], -1):
            out.add(x)
        last[x[2]] = max(x[1], last.get(x[2], -1))
    return out


def _expression(text: str, found: list[tuple[int, int]], words: list[str], at: int, model: Model) -> list[tuple[int, int, str, float]]:
    """The ids of an SPDX expression, each judged as if it stood alone: the one after the tag and those after or, and, with."""
    out, i = [], at + 1
    while i < len(words) and "\n" not in text[found[at][1]:found[i][0]]:
        family = model.ids.get(words[i])
        if family:
            best, p = model.predict([SPDX, words[i]])
            if best == family and p >= ACCEPT:
                out.append((at if i == at + 1 else i, i, family, p))
        if i + 1 >= len(words) or words[i + 1] not in ("or", "and", "with"):
            break
        i += 2
    return out


def _touching(text: str, start: int, end: int) -> tuple[int, int]:
    """With the punctuation that touches the span."""
    while end < len(text) and not (text[end].isspace() or text[end].isalnum()):
        end += 1
    while start and not (text[start - 1].isspace() or text[start - 1].isalnum()):
        start -= 1
    return start, end


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_paragraphs, licences: array of (start, end, family, probability)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda keys, texts: [(k, len(paragraphs(t)), x) for k, t, x in zip(keys, texts, scan_texts(texts, shared.value))]
    return map_rows(docs.select("doc_id", "text"), "doc_id bigint, n_paragraphs bigint, "
                    "licences array<struct<start: bigint, end: bigint, family: string, probability: double>>", make)


def summary(scanned: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs, n_licences, families, spans."""
    return scanned.select("doc_id", "n_paragraphs", F.size("licences").cast("long").alias("n_licences"),
                          F.array_join(F.array_sort(F.array_distinct(F.col("licences.family"))), ",").alias("families"),
                          F.expr("array_join(transform(licences, x -> concat(x.family, ':', x.start, ':', x.end)), ',')").alias("spans"))
