"""Personal data by weak supervision.

Loose patterns propose spans of five kinds. Four labelers vote +1, 0 (abstain) or -1 on
each: the strict pattern, a gazetteer (cue words before the span, top-level domains), the
context (what touches the span) and a check of its inner form (checksum, ranges, digits).
Expectation-maximisation over the counts of vote patterns of the whole corpus estimates,
per kind, how reliable each labeler is and how likely each pattern is right. Those
likelihoods train a logistic span classifier on votes and shape; a proposed span is added
where it gives ``ACCEPT`` or more. Spans of the strict base patterns always stay.

Only counts by pattern leave the tasks (a few thousand rows at most, whatever the input).

Defined results: a null or empty text has no spans. Positions are code points, ends
exclusive. Spans are listed by kind (email, ip, card, phone, secret), then start. Null or
repeated doc_ids keep their rows; other input columns are ignored by ``find`` and kept by
``redact``. Texts are read whole; no pattern takes more than linear time on long runs.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinder.llm.common import map_batches, map_rows

KINDS = ("email", "ip", "card", "phone", "secret")
ACCEPT = 0.5
ROUNDS = 60
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# The base patterns. A run of digits is entered at its first digit only; no match can start inside it.
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]").search
_NOT_DIGIT = re.compile("[^0-9]+")
# Loose patterns.
_AT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[(\[{] ?at ?[)\]}] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[(\[{] ?dot ?[)\]}]) ?[A-Za-z0-9-]{1,63}){1,8}", re.I)
_BRACKETED_AT = re.compile(r"[(\[{] ?at ?[)\]}]", re.I).search  # every match of _AT holds one; case is ignored as there
_LOOSE_CARD = re.compile(r"(?<![0-9])[0-9](?:[ ./-]?[0-9]){12,18}(?![0-9])")
_LOOSE_PHONE = re.compile(r"(?<![0-9+(])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
_SECRET = re.compile(r"[=:] {0,3}[\"']?([A-Za-z0-9+/_-]{16,})")
#: Cue words and top-level domains of the gazetteer.
CUES = {
    "email": {"email", "e-mail", "mail", "contact", "write", "mailto"},
    "ip": {"ip", "host", "server", "address", "addr", "from"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "pan"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "cell", "fax"},
    "secret": {"token", "secret", "password", "passwd", "pwd", "key", "apikey", "api_key", "auth", "bearer", "credential"},
}
COUNTER_CUES = {"version", "release", "isbn", "page", "pages", "order", "invoice", "chapter", "section", "sha1", "sha256", "md5", "commit", "checksum", "id"}
DOMAINS = {"com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "eu", "ch", "at", "it", "nl", "us", "ca", "co"}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) << (k & 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the strict patterns: leftmost, not overlapping per kind, failing matches dropped."""
    out, after, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            out.append((0, start, host.end()))
        after = host.end() if host else at + 1
        at = text.find("@", after)
    if _DIGIT(text):
        if "." in text:
            out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(digits := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Further candidates; those that touch a base span of their kind are left out."""
    out = []
    if _BRACKETED_AT(text):
        out += [(0, m.start(), m.end()) for m in _AT.finditer(text)]
    if _DIGIT(text):
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text)] if "." in text else []
        out += [(2, m.start(), m.end()) for m in _LOOSE_CARD.finditer(text)]
        out += [(3, m.start(), m.end()) for m in _LOOSE_PHONE.finditer(text)]
    if "=" in text or ":" in text:
        out += [(4, m.start(1), m.end(1)) for m in _SECRET.finditer(text)]
    if not base or not out:
        return out
    taken = [sorted((s, e) for k, s, e in base if k == kind) for kind in range(len(KINDS))]
    import bisect

    def free(kind, s, e):
        at = bisect.bisect_left(taken[kind], (e, 0)) - 1
        return at < 0 or taken[kind][at][1] <= s
    return [c for c in out if free(*c)]


def _entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def votes(text: str, kind: int, start: int, end: int, strict: bool) -> tuple[int, int, int, int, int]:
    """The four votes and a shape bucket of one candidate."""
    span, name = text[start:end], KINDS[kind]
    before = re.findall(r"[a-z_0-9-]+", text[max(0, start - 40):start].lower())[-3:]
    gaz = 1 if CUES[name].intersection(before) else -1 if COUNTER_CUES.intersection(before) else 0
    if name == "email" and not gaz:
        gaz = 1 if re.split(r"[^a-z0-9]+", span.lower())[-1] in DOMAINS else 0
    left, right = text[start - 1:start], text[end:end + 1]
    joins = lambda c: c.isalnum() or c in "_@/"
    context = -1 if (left and joins(left)) or (right and joins(right)) else 1
    digits = _NOT_DIGIT.sub("", span)
    if name == "email":
        inner = any(c.isalpha() for c in span.split("@")[0])
    elif name == "ip":
        parts = span.split(".")
        inner = all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts) and not all(int(p) < 10 for p in parts)
    elif name == "card":
        inner = luhn(digits) and len(set(digits)) > 2
    elif name == "phone":
        inner = 8 <= len(digits) <= 15 or (len(digits) == 10 and digits[0] not in "01")
    else:
        inner = _entropy(span) >= 3 and any(c.isdigit() for c in span) and any(c.isalpha() for c in span)
    return 1 if strict else 0, gaz, context, 1 if inner else -1, min(7, len(digits) // 4)


def patterns(docs: DataFrame) -> list[tuple[tuple[int, ...], int]]:
    """((kind, four votes, shape), number of candidates) over the whole corpus."""
    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py() or ""
                base = base_spans(text)
                for strict, spans in ((True, base), (False, loose_spans(text, base))):
                    for kind, start, end in spans:
                        seen[kind, *votes(text, kind, start, end, strict)] += 1
        rows = sorted(seen)
        yield pa.RecordBatch.from_arrays([pa.array([list(r) for r in rows], pa.list_(pa.int32())),
                                          pa.array([seen[r] for r in rows], pa.int64())], names=["pattern", "n"])
    found = map_batches(docs.select("text"), run, "pattern array<int>, n bigint").groupBy("pattern").agg(F.sum("n").alias("n"))
    return sorted((tuple(r.pattern), r.n) for r in found.collect())


def posterior(ballots: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns (rows of -1, 0, 1) seen n times: chance that each is right; P(vote | class) per labeler."""
    right = np.clip(0.5 + 0.2 * ballots.sum(1), 0.05, 0.95)
    table = np.zeros((2, ballots.shape[1], 3))
    for _ in range(ROUNDS):
        for c, w in enumerate(((1 - right) * n, right * n)):
            for v in (-1, 0, 1):  # a labeler is believed to be right four times as often as wrong until counts say more
                table[c, :, v + 1] = ((ballots == v) * w[:, None]).sum(0) + (4 if v == (1 if c else -1) else 1)
        table /= table.sum(2, keepdims=True)
        prior = ((right * n).sum() + 1) / (n.sum() + 2)
        like = [np.log(p) + np.log(np.take_along_axis(table[c], ballots.T + 1, 1)).sum(0) for c, p in enumerate((1 - prior, prior))]
        right = 1 / (1 + np.exp(np.clip(like[0] - like[1], -60, 60)))
    return right, table


def design(rows: np.ndarray) -> np.ndarray:
    """Intercept, each labeler's + and -, and the shape bucket, one column each."""
    ballots, shape = rows[:, 1:5], rows[:, 5]
    return np.hstack([np.ones((len(rows), 1)), ballots > 0, ballots < 0, shape[:, None] == np.arange(8)[None, :]]).astype(float)


def fit(docs: DataFrame) -> dict[tuple[int, ...], float]:
    """Classifier's probability by (kind, votes, shape)."""
    found, out = patterns(docs), {}
    for kind in range(len(KINDS)):
        own = [(p, n) for p, n in found if p[0] == kind]
        if not own:
            continue
        rows, n = np.array([p for p, _ in own]), np.array([c for _, c in own], float)
        target, _ = posterior(rows[:, 1:5], n)
        x, n = design(rows), np.minimum(n, 1e6 * n / n.sum())  # one scale at every size, so the penalty weighs alike
        w = np.zeros(x.shape[1])
        for _ in range(30):  # Newton steps of ridge logistic regression
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (n * (p - target)) + w
            w -= np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(w)), grad)
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        out.update({tuple(map(int, r)): float(q) for r, q in zip(rows, p)})
    return out


def spans_of(text: str | None, model: dict) -> tuple[list, list]:
    """Base spans and all spans, each by kind, then start."""
    if not text:
        return [], []
    base = base_spans(text)
    more = [c for c in loose_spans(text, base) if model.get((c[0], *votes(text, *c, False)), 0) >= ACCEPT]
    return sorted(base), sorted(base + more)


def written(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_secret (no base kind) and n_spans (of
    every kind, added ones too): one row per row of ``docs``."""
    def make():
        def run(keys, texts):
            for key, text in zip(keys, texts):
                base, every = spans_of(text, model)
                count = Counter(k for k, _, _ in base)
                yield key, count[0], count[1], count[2], count[3], hashlib.sha256(written(base).encode()).hexdigest(), written(every), sum(k == 4 for k, _, _ in every), len(every)
        return run
    return map_rows(docs.select("doc_id", "text"), "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                    "base_sha256 string, spans string, n_secret bigint, n_spans bigint", make)


def redacted(text: str, spans: list) -> str:
    """Each span (overlapping ones together) replaced by its kind in angle brackets."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with personal data replaced in text, and n_chars (where there is one) the new text's code points."""
    def run(batches):
        for batch in batches:
            at, n_at = batch.schema.get_field_index("text"), batch.schema.get_field_index("n_chars")
            texts = [t.as_py() for t in batch.column(at)]
            found = [spans_of(t, model)[1] for t in texts]
            new = [redacted(t, f) if f else t for t, f in zip(texts, found)]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            if n_at >= 0:
                old = batch.column(n_at).to_pylist()
                counts = [len(t) if f else n for t, f, n in zip(new, found, old)]
                batch = batch.set_column(n_at, batch.schema.field(n_at), pa.array(counts, batch.schema.field(n_at).type))
            yield batch
    return map_batches(docs, run, docs.schema)
