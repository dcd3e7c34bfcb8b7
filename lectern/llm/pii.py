"""Personal data with a skip-chain conditional random field.

Plain rules find e-mail addresses, IP addresses, card numbers and phone numbers. The field
labels the tokens near anything that could be personal: neighbouring tokens share
chain potentials, and distant tokens that are the same or differ only in punctuation
share skip potentials (each linked to its previous occurrence in the document), so
evidence at one mention reaches the others. Loopy sum-product message passing over
all documents of a chunk gives each token's label distribution; confident labels on
tokens that no rule covers become further spans (secrets such as access tokens, and
repeats of found values in other forms). Rule spans always stay.

The potentials are trained piecewise on at most ``train_rows`` documents with digits or
``@``: token weights by softmax regression, pair potentials from label co-occurrence. The
labels come from the rules and, for secrets, from cue words. Documents are only
mapped; tokens far from any candidate are outside the field, so its size follows the
candidates, and memory is bounded by a chunk or one longer text.

Defined cases: null or empty text has no spans; repeated rows are judged alike; offsets
are code points, the end excluded; an empty table trains nothing and gives no
rows; extra columns are ignored by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality import per_segment
from .words import byte_set, chunks, text_buffer

KINDS = ("email", "ip", "card", "phone")
LABELS = ("", *KINDS, "secret")
TRAIN_ROWS = 1000
TRAIN_CHARS = 20_000
SURE = 0.9
REACH = 2
ROUNDS = 8

#: What follows a local part, and the other kinds' patterns. Starts inside a
#: digit run can never match where the run's start did not, hence the look-behind.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

TOKEN = re.compile(r"""[^\s"'`,;:=<>()\[\]{}|*%$&#!?]+""")
CUE = re.compile(r"(?i)(?:token|secret|passw(?:or)?d|api[ _-]?key|bearer)\W{1,4}\Z")
CANDIDATE = byte_set((0x30, 0x39), (0x40, 0x40))
N_FEATURES = 22


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the rules' spans, by start, then kind."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        d = _only_digits(m.group()) if m.end() - m.start() <= 37 else ""
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def tokens_near(text: str) -> list[tuple[int, int, str, bool]]:
    """(start, end, token, follows its neighbour) of the tokens within ``REACH`` of a
    candidate: a token with a digit or ``@``, or one after a cue word."""
    all_tokens = []
    for m in TOKEN.finditer(text):
        s = m.group()
        lead = len(s) - len(s.lstrip("."))
        core = s.strip(".")
        if core:
            all_tokens.append((m.start() + lead, m.start() + lead + len(core), core))
    hot = [i for i, (s, _, t) in enumerate(all_tokens)
           if any("0" <= c <= "9" or c == "@" for c in t) or (len(t) >= 8 and CUE.search(text, max(0, s - 24), s))]
    near = sorted({j for i in hot for j in range(max(0, i - REACH), min(len(all_tokens), i + REACH + 1))})
    return [(*all_tokens[j], k > 0 and near[k - 1] == j - 1) for k, j in enumerate(near)]


def features(text: str, token: tuple[int, int, str, bool], before: str) -> list[float]:
    s, _, t, _ = token
    d = _only_digits(t)
    n, letters = len(d), sum(c.isalpha() for c in t)
    parts = t.split(".")
    hexa = all(c in "0123456789abcdefABCDEF" for c in t)
    left = text[s - 1] if s else ""
    return [1, "@" in t, n == 0, 1 <= n <= 3, 4 <= n <= 8, 9 <= n <= 11, 12 <= n <= 19, n >= 20, n == len(t),
            len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts),
            "@" in t and "." in t.split("@")[-1], hexa and len(t) >= 16 and 0 < n < len(t), letters > 0 and n > 0 and len(t) >= 12,
            12 <= n <= 19 and n + t.count("-") == len(t) and luhn(d), bool(CUE.search(text, max(0, s - 24), s)),
            left in "\"'`" and left != "", t[0] == "+", before[:1] == "+", letters == len(t), t[:1].isupper(),
            len(t) >= 16, left == "("]


def known_labels(text: str, tokens: list, spans: list) -> list[int]:
    """Training labels: the covering rule span's kind, or secret for a long value after a
    cue word; similar tokens of the document share a label."""
    out = []
    for s, e, t, _ in tokens:
        label = next((k + 1 for a, k, b in spans if a < e and s < b), 0)
        if not label and len(t) >= 16 and any("0" <= c <= "9" for c in t) and CUE.search(text, max(0, s - 24), s):
            label = LABELS.index("secret")
        out.append(label)
    shared = {}
    for (_, _, t, _), label in zip(tokens, out):
        key = key_of(t)
        if label and key is not None and len(key) >= 8:
            shared.setdefault(key, label)
    return [label or shared.get(key_of(t), 0) for (_, _, t, _), label in zip(tokens, out)]


def key_of(token: str) -> str | None:
    """What makes distant tokens similar: letters and digits, if there is a digit or ``@``."""
    k = "".join(c for c in token.lower() if c.isalnum())
    return k if len(k) >= 4 and any("0" <= c <= "9" or c == "@" for c in token) else None


class Field:
    def __init__(self, weights: np.ndarray | None = None, chain: np.ndarray | None = None, skip: np.ndarray | None = None):
        n = len(LABELS)
        self.weights = np.zeros((n, N_FEATURES)) if weights is None else weights
        self.chain = np.zeros((n, n)) if chain is None else chain
        self.skip = 2 * np.eye(n) if skip is None else skip

    def fit(self, x: np.ndarray, y: np.ndarray, chained: np.ndarray, skips: np.ndarray, rounds: int = 300) -> Field:
        """Piecewise training. ``chained``, ``skips``: pairs of token indices."""
        n = len(LABELS)
        hot = np.eye(n)[y]
        w, m, v = np.zeros((n, N_FEATURES)), np.zeros((n, N_FEATURES)), np.zeros((n, N_FEATURES))
        for step in range(1, rounds + 1):
            p = x @ w.T
            p = np.exp(p - p.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g = (hot - p).T @ x / max(len(x), 1) - 1e-4 * w
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            w = w + 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)

        def affinity(pairs: np.ndarray, strength: float) -> np.ndarray:
            count = np.full((n, n), 0.5)
            np.add.at(count, (y[pairs[:, 0]], y[pairs[:, 1]]), 1)
            expected = count.sum(1, keepdims=True) * count.sum(0, keepdims=True) / count.sum()
            return strength * np.clip(np.log(count / expected), -3, 3)

        both = np.concatenate([skips, skips[:, ::-1]])
        skip = affinity(both, 1.0) + np.eye(n)
        return Field(w, affinity(chained, 0.3), skip)

    def marginals(self, x: np.ndarray, chained: np.ndarray, skips: np.ndarray) -> np.ndarray:
        """Label distribution of each token by loopy message passing."""
        own = x @ self.weights.T
        own -= own.max(1, keepdims=True)
        u = np.concatenate([chained[:, 0], skips[:, 0]])
        v = np.concatenate([chained[:, 1], skips[:, 1]])
        pot = np.concatenate([np.broadcast_to(self.chain, (len(chained), *self.chain.shape)),
                              np.broadcast_to(self.skip, (len(skips), *self.skip.shape))])
        down, up = np.zeros((len(u), len(LABELS))), np.zeros((len(u), len(LABELS)))
        belief = own
        for _ in range(ROUNDS if len(u) else 0):
            to_v = np.logaddexp.reduce((belief[u] - up)[:, :, None] + pot, axis=1)
            to_u = np.logaddexp.reduce((belief[v] - down)[:, None, :] + pot, axis=2)
            down = 0.5 * down + 0.5 * (to_v - to_v.max(1, keepdims=True))
            up = 0.5 * up + 0.5 * (to_u - to_u.max(1, keepdims=True))
            belief = own.copy()
            np.add.at(belief, v, down)
            np.add.at(belief, u, up)
        p = np.exp(belief - belief.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


class Graph:
    """Tokens of several documents as one graph."""

    def __init__(self):
        self.tokens, self.x, self.y, self.chained, self.skips, self.doc = [], [], [], [], [], []

    def add(self, d: int, text: str, spans: list, with_labels: bool = False) -> None:
        tokens, last, before = tokens_near(text), {}, ""
        for i, t in enumerate(tokens):
            at = len(self.tokens)
            self.x.append(features(text, t, before if t[3] else ""))
            before = t[2]
            if t[3]:
                self.chained.append((at - 1, at))
            key = key_of(t[2])
            if key is not None:
                if key in last:
                    self.skips.append((last[key], at))
                last[key] = at
            self.tokens.append(t)
            self.doc.append(d)
        if with_labels:
            self.y.extend(known_labels(text, tokens, spans))

    def arrays(self):
        pairs = lambda p: np.array(p, np.int64).reshape(-1, 2)
        return np.array(self.x, float).reshape(-1, N_FEATURES), pairs(self.chained), pairs(self.skips)


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS, train_chars: int = TRAIN_CHARS) -> Field | None:
    """The field fitted on the ``train_rows`` documents of smallest hashed id that hold a
    digit or ``@`` and at most ``train_chars`` characters, one row per id (the text of
    smallest hash); None without any."""
    fit = docs.where(F.length("text") <= train_chars).where(F.col("text").rlike("[0-9@]")).where("doc_id is not null")
    some = fit.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    rows = (fit.select("doc_id", "text").join(F.broadcast(some), "doc_id").groupBy("doc_id")
            .agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")).orderBy("doc_id").collect())
    g = Graph()
    for r in rows:
        g.add(0, r["text"], rule_spans(r["text"]), with_labels=True)
    if not g.tokens:
        return None
    x, chained, skips = g.arrays()
    return Field().fit(x, np.array(g.y), chained, skips)


def spans_of(b: pa.RecordBatch, text_col: str, field: Field | None, sure: float) -> dict[int, tuple[list, list]]:
    """Rule spans and further spans, (start, kind, end), of the documents that have any
    candidate."""
    data, off = text_buffer(b.column(text_col))
    text = b.column(text_col)
    some = np.flatnonzero(per_segment(CANDIDATE[data], off) | per_segment(data == 0x3D, off)).tolist()
    out, g, texts = {}, Graph(), {}
    for d in some:
        texts[d] = t = text[d].as_py()
        out[d] = (rule_spans(t), [])
        g.add(d, t, out[d][0])
    if field is not None and g.tokens:
        p = field.marginals(*g.arrays())
        best = p.argmax(1)
        for i in np.flatnonzero((best > 0) & (p.max(1) >= sure)).tolist():
            s, e, t, _ = g.tokens[i]
            rules, more = out[g.doc[i]]
            if any("0" <= c <= "9" or c == "@" for c in t) and not any(a < e and s < z for a, _, z in rules):
                more.append((s, int(best[i]) - 1, e))
    return out


def _joined(spans: list) -> str:
    return ",".join(f"{LABELS[k + 1]}:{s}:{e}" for s, k, e in sorted(spans))


EMPTY = hashlib.sha256(b"").hexdigest()


def find(docs: DataFrame, field: Field | None, sure: float = SURE) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in chunks(batch, "text"):
                n = b.num_rows
                counts = np.zeros((len(KINDS), n), np.int64)
                digest, spans = [EMPTY] * n, [""] * n
                for d, (rules, more) in spans_of(b, "text", field, sure).items():
                    for _, k, _ in rules:
                        counts[k, d] += 1
                    digest[d] = hashlib.sha256(_joined(rules).encode()).hexdigest()
                    spans[d] = _joined(rules + more)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), *(pa.array(c) for c in counts), pa.array(digest, pa.string()), pa.array(spans, pa.string())],
                    names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, " + "".join(f"n_{k} bigint, " for k in KINDS) + "base_sha256 string, spans string")


def redact(docs: DataFrame, field: Field | None, sure: float = SURE) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; overlapping spans
    are replaced together, under the first one's kind."""
    cols = docs.columns
    schema = T.StructType(docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in chunks(batch, "text"):
                text = b.column("text")
                new = {}
                for d, (rules, more) in spans_of(b, "text", field, sure).items():
                    if rules or more:
                        t, parts, at = text[d].as_py(), [], 0
                        for s, k, e in sorted(rules + more):
                            if s >= at:
                                parts += [t[at:s], f"<{LABELS[k + 1].upper()}>"]
                            at = max(at, e)
                        new[d] = "".join([*parts, t[at:]])
                if new:
                    text = pa.array([new.get(i, t) for i, t in enumerate(text.to_pylist())], text.type)
                yield pa.RecordBatch.from_arrays([text if c == "text" else b.column(c) for c in cols], names=cols)

    return docs.mapInArrow(run, schema)
