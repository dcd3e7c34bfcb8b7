"""Quality rules: line sequence labelling with a linear-chain conditional random field.

Every line of a text is a node; the field labels it content or boilerplate from the
line's own features (length, shares of letters, capitals, digits, symbols, repeats,
sentence ends, place in the text) and from its neighbours' labels. Viterbi decoding
gives the best labelling of the whole text, and a text is kept when content lines
hold at least ``share`` of its words. Plain counts come first: a text with too few
words, or with too many words in repeated 5-word windows, fails without the field.

The field is trained here on at most ``train_rows`` labelled documents of at most
``train_lines`` lines: a documented bound. Labels are of documents, so line labels are
latent: a document's label only bounds the expected share of its lines that carry it
(see ``Field.fit``). Everything else covers whole texts. Documents are only mapped; decoding advances all documents
of a chunk line by line, so memory is bounded by the chunk (or one longer text).

Defined cases: null and empty text have no words and fail; repeated rows are judged
alike; without labelled rows of both classes the field keeps everything that passes
the counts; extra columns are ignored by ``judge`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .staging import give_back
from .words import SPACED, Words, byte_set, chunks, grams, hashes, mix, words_of

MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
SHARE = 0.5
TRAIN_ROWS = 3000
TRAIN_LINES = 200
ROUNDS = 150
EXPECTED = 0.8

SYMBOLS = byte_set(*[(ord(c), ord(c)) for c in "#*$%&|<>"])
CAPITAL = byte_set((0x41, 0x5A))
LETTER = byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
DIGIT = byte_set((0x30, 0x39))
MARKS = byte_set(*[(ord(c), ord(c)) for c in "!?|{}[]()=_;:/\\\""])
LEAD = ~byte_set((0x80, 0xBF))
N_FEATURES = 14
WITH_WORDS = 2             # the feature that is 0 for a line without words


def per_segment(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``mask`` in each of the adjoining segments ``offsets[i]:offsets[i + 1]``."""
    out = np.zeros(len(offsets) - 1, np.int64)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        out[full] = np.add.reduceat(mask, offsets[full], dtype=np.int64)
    return out


def repeated(key: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more."""
    s = np.sort(key)
    twice = s[1:][s[1:] == s[:-1]]
    out = np.zeros(len(key), bool)
    if len(twice):
        seen = np.zeros(1 << 16, bool)
        seen[(twice & np.uint64(0xFFFF)).astype(np.int64)] = True
        near = np.flatnonzero(seen[(key & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(twice, key[near]), len(twice) - 1)
        out[near[twice[at] == key[near]]] = True
    return out


def in_document(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A hash of (document, hash), so equal hashes of different documents differ."""
    return mix(h + (doc.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA24BAED4963EE407))


@dataclass
class Lines:
    """Lines of a chunk: first line of each document, features, words, repeats."""

    first: np.ndarray
    features: np.ndarray
    words: np.ndarray
    again: np.ndarray


def lines_of(w: Words) -> Lines:
    data, n = w.data, len(w.offsets) - 1
    cut = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate([w.offsets[:-1], cut + 1]), kind="stable")
    doc_of_cut = np.searchsorted(w.offsets, cut, side="right") - 1
    per_doc = 1 + np.bincount(doc_of_cut, minlength=n)
    first = np.concatenate(([0], np.cumsum(per_doc)))
    doc = np.repeat(np.arange(n), per_doc)
    # line i of document d starts at starts[i]; the last one of d ends with the text
    edges = np.concatenate([starts, [len(data)]])
    last = np.zeros(len(starts), bool)
    last[first[1:] - 1] = True
    ends = np.where(last, w.offsets[doc + 1], edges[1:] - 1)
    size = per_segment(LEAD[data], edges)
    spaced = per_segment(SPACED[data], edges)
    words = np.diff(np.searchsorted(w.starts, edges))
    key = in_document(hashes(data, starts, ends), doc)
    _, where, back = np.unique(key, return_index=True, return_inverse=True)
    again = (where[back] != np.arange(len(key))) & (spaced > 0)
    letters, total = per_segment(LETTER[data], edges), np.maximum(spaced, 1)
    place = np.arange(len(starts)) - first[doc]
    end_byte = data[np.maximum(ends - 1, 0)] if len(data) else np.zeros(len(starts), np.uint8)
    f = np.empty((len(starts), N_FEATURES), np.float32)
    for j, v in enumerate((
            1, np.log1p(size) / 5, np.minimum(words, 3) / 3, letters / total,
            per_segment(CAPITAL[data], edges) / np.maximum(letters, 1),
            per_segment(DIGIT[data], edges) / total, per_segment(SYMBOLS[data], edges) / total,
            per_segment(MARKS[data], edges) / total, again, spaced == 0,
            ((end_byte == 0x2E) & (ends > starts)), np.minimum(total / np.maximum(words, 1), 20) / 20,
            place == 0, per_segment(data == 0x7C, edges) > 0)):
        f[:, j] = v
    f[:, 6] = np.minimum(f[:, 6] * 10, 1)
    f[:, 7] = np.minimum(f[:, 7] * 10, 1)
    return Lines(first, f, words, again)


class Field:
    """Linear-chain field with labels 0 (boilerplate) and 1 (content)."""

    def __init__(self, emit: np.ndarray | None = None, move: np.ndarray | None = None):
        self.emit = np.zeros((2, N_FEATURES)) if emit is None else emit
        self.move = np.zeros((2, 2)) if move is None else move

    @staticmethod
    def steps(first: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Documents from the longest, and how many of them have a line at each step."""
        size = np.diff(first)
        order = np.argsort(-size, kind="stable")
        left = -size[order]
        return order, [int(np.searchsorted(left, -t, side="left")) for t in range(int(size.max(initial=0)))]

    def viterbi(self, first: np.ndarray, features: np.ndarray) -> np.ndarray:
        """The best label of each line."""
        score = features @ self.emit.T.astype(np.float32)
        order, active = self.steps(first)
        start = first[:-1][order]
        came = np.zeros((len(features), 2), np.int8)
        best, finish = np.zeros((len(order), 2)), np.zeros(len(order), np.int8)
        for t, a in enumerate(active):
            at = start[:a] + t
            if t:
                from0, from1 = best[:a, :1] + self.move[0], best[:a, 1:] + self.move[1]
                came[at] = from1 > from0
                best[:a] = np.maximum(from0, from1) + score[at]
            else:
                best[:a] = score[at]
        finish[:] = best[:, 1] > best[:, 0]
        label, now = np.zeros(len(features), np.int8), finish
        size = np.diff(first)[order]
        for t in range(len(active) - 1, -1, -1):
            a = active[t]
            at = start[:a] + t
            ongoing = size[:a] - 1 > t
            now[:a] = np.where(ongoing, came[np.minimum(at + 1, len(came) - 1), now[:a]], now[:a])
            label[at] = now[:a]
        return label

    @staticmethod
    def expect(start: np.ndarray, active: list[int], score: np.ndarray, move: np.ndarray,
               weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward passes: each line's label distribution, and the weighted
        expected number of moves between labels."""
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        for t, a in enumerate(active):
            at = start[:a] + t
            ahead[at] = score[at] if not t else score[at] + np.logaddexp(
                ahead[at - 1, :1] + move[0], ahead[at - 1, 1:] + move[1])
        pair = np.zeros((2, 2))
        for t in range(len(active) - 1, 0, -1):
            at = start[:active[t]] + t
            nxt = score[at] + behind[at]
            behind[at - 1] = np.logaddexp(nxt[:, :1] + move[:, 0], nxt[:, 1:] + move[:, 1])
            both = ahead[at - 1][:, :, None] + move + nxt[:, None, :]
            both = np.exp(both - np.logaddexp.reduce(both.reshape(-1, 4), axis=1)[:, None, None])
            pair += np.einsum("nij,n->ij", both, weight[at])
        mass = ahead + behind
        return np.exp(mass - np.logaddexp(mass[:, :1], mass[:, 1:])), pair

    def fit(self, first: np.ndarray, features: np.ndarray, quality: np.ndarray, rounds: int = ROUNDS,
            rate: float = 0.1, decay: float = 1e-3, expected: float = EXPECTED) -> Field:
        """Training with latent line labels. A document's quality only says that at least
        the share ``expected`` of its lines with words has its label: of all distributions
        over labellings that hold this, the one nearest to the field's (forward and backward
        passes with a bonus per document, found by dual ascent along the rounds) is what
        Adam draws the field to. Each document has the same weight."""
        order, active = self.steps(first)
        start, n = first[:-1][order], len(first) - 1
        size = np.diff(first)
        doc = np.repeat(np.arange(n), size)
        weight = np.repeat(1 / np.maximum(size, 1), size)
        x = features.astype(float)
        full = x[:, WITH_WORDS] > 0
        own = np.asarray(quality)[doc]
        hot = np.stack([own == 0, own == 1], 1) * full[:, None].astype(float)
        lines = np.bincount(doc, full, minlength=n)
        bonus = np.zeros(n)
        theta = np.concatenate([self.emit.ravel(), self.move.ravel()])
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        cells = 2 * N_FEATURES
        for step in range(1, rounds + 1):
            emit, move = theta[:cells].reshape(2, -1), theta[cells:].reshape(2, 2)
            score = x @ emit.T
            mass, pair = self.expect(start, active, score, move, weight)
            held, pair_held = self.expect(start, active, score + hot * bonus[doc][:, None], move, weight)
            share = np.bincount(doc, (held * hot).sum(1), minlength=n) / np.maximum(lines, 1)
            bonus = np.where(lines > 0, np.maximum(bonus + expected - share, 0), 0)
            slope = np.concatenate([(((held - mass) * weight[:, None]).T @ x).ravel(), (pair_held - pair).ravel()]) / n
            slope -= decay * theta
            m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
            theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return Field(theta[:cells].reshape(2, -1), theta[cells:].reshape(2, 2))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, train_lines: int = TRAIN_LINES) -> Field | None:
    """The field fitted on the ``train_rows`` labelled documents of smallest hashed id
    that have at most ``train_lines`` lines, one row per id (the text of smallest hash);
    None without rows of both classes."""
    some = (labels.select("doc_id", "quality").where("quality in (0, 1) and doc_id is not null")
            .groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    texts = (docs.select("doc_id", "text").where(F.length(F.regexp_replace("text", "[^\n]", "")) < train_lines)
             .join(F.broadcast(some), "doc_id").groupBy("doc_id", "quality")
             .agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in chunks(batch, "text"):
                x = lines_of(words_of(b.column("text"), SPACED))
                yield pa.RecordBatch.from_arrays(
                    [b.column("quality"), pa.array(np.diff(x.first), pa.int64()),
                     pa.array([x.features[a:z].tobytes() for a, z in zip(x.first, x.first[1:])], pa.binary())],
                    names=["quality", "n", "features"])

    rows = texts.mapInArrow(give_back(run), "quality int, n bigint, features binary").collect()
    # in an order of their own, so the fit does not depend on how rows were dealt
    rows = sorted((r["quality"], r["n"], bytes(r["features"])) for r in rows)
    if len({q for q, _, _ in rows}) < 2:
        return None
    x = np.concatenate([np.frombuffer(f, np.float32).reshape(-1, N_FEATURES) for _, _, f in rows])
    return Field().fit(np.concatenate(([0], np.cumsum([n for _, n, _ in rows]))), x, np.array([q for q, _, _ in rows]))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(b: pa.RecordBatch, text_col: str, field: Field | None, share: float) -> dict[str, np.ndarray]:
    """The counts, ``base_failed``, ``content_words`` and ``kept`` of a chunk's documents."""
    w = words_of(b.column(text_col), SPACED)
    n_words, offsets = w.counts, w.offsets
    g, at = grams(hashes(w.data, w.starts, w.ends), w.first, WINDOW)
    doc = w.doc
    twice = at[repeated(in_document(g, doc[at]))]
    cover = np.zeros(len(doc) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    in_repeat = np.cumsum(cover[:-1]) > 0
    lines = lines_of(w)
    out = {
        "n_words": n_words,
        "word_chars": per_segment(SPACED[w.data] & LEAD[w.data], offsets),
        "n_symbols": per_segment(SYMBOLS[w.data], offsets),
        "n_dup_lines": per_segment(lines.again, lines.first),
        "n_repeat_words": per_segment(in_repeat, w.first),
    }
    out["base_failed"] = (n_words < MIN_WORDS) | (100 * out["n_repeat_words"] > REPEAT_PERCENT * n_words)
    content = n_words if field is None else per_segment(
        np.where(field.viterbi(lines.first, lines.features) == 1, lines.words, 0), lines.first)
    out["content_words"] = content
    out["kept"] = ~out["base_failed"] & (content >= share * n_words)
    return out


def judge(docs: DataFrame, field: Field | None, share: float = SHARE) -> DataFrame:
    """Counts and verdict of each document, one row per input row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in chunks(batch, "text"):
                m = measure(b, "text", field, share)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(v) for v in m.values())],
                                                 names=["doc_id", *m])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        give_back(run), f"doc_id {id_type}, " + "".join(f"{c} bigint, " for c in MEASURES)
        + "base_failed boolean, content_words bigint, kept boolean")


def keep_good(docs: DataFrame, field: Field | None, share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    schema = T.StructType(docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in chunks(batch, "text"):
                yield b.filter(pa.array(measure(b, "text", field, share)["kept"]))

    return docs.mapInArrow(give_back(run), schema)
