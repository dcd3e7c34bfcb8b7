"""LM scoring with a gated recurrent language model.

Corpus counts come first: every training document's tokens (lower-cased words and one
end token) are counted per task and summed by Spark. The words that make up at least ``SHARE``
of the tokens (and occur ``LEAST`` times) form the network's vocabulary, so it grows with the
corpus's variety and has at most 1 / ``SHARE`` words. It is cut by rank into about
sqrt(size) classes of equal sums of root counts; all other words are one more class, whose words share the add-one
unigram of the rest. The output is factored: a softmax over classes, then one over the
words of the target's class.

Training is truncated backpropagation in numpy: each task deals its documents to lanes,
advances all lanes in windows of ``window`` steps, carries the hidden state from window to
window and resets it at document starts (in training also every ``PART`` tokens of a
long document). Every training document is used once: rounds
take disjoint parts of them, and after a round the tasks' changes of the weights are averaged,
weighted by tokens, in pieces of bounded size by a tree of bounded groups. A step
updates the embeddings of its own input words alone. Scoring carries the state through the whole
document, so the score is the complete text's log10 probability.

Scale: tasks hold one Arrow batch; counts are shuffled by token hash after map-side sums.
Scoring looks counts up in a broadcast of at most ``head_rows`` frequent tokens; beyond
that, the scoring pass also writes the tokens without a count, which are joined by shuffle as
(row, token) sums and added, with the same result. Words are identified by 64-bit hashes. The weights, hence ``score``, depend
on how documents fall into tasks; all other columns do not.

Defined cases: null or empty text is the end token alone; a null id counts as empty
text in the held-out rule; repeated rows are scored alike and all train; without
training rows every count is 0 and the network is untrained; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import stage
from .words import LOWER, SPACED, chunks, hashes, words_of

FOLDS, HELD = 7, 2
HIDDEN = 12
SHARE, LEAST = 5e-6, 2
BUCKETS = 64               # a power of two
WINDOW = 16
LANES = 512
LANE_TOKENS = 4096
ROUNDS = 2
RATE = 0.01
HEAD_ROWS = 2_000_000
PART = 2048
FAN_IN = 64
PIECE = 1 << 16
CHUNK = 32 << 20
BLOCK = 500_000
ROWS = 512
AT_ONCE = 1 << 18
CACHED = 1 << 14
REACH = 80.0
END = np.uint64(0x5D1E2F3C4B5A6978)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD


def tokens_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a chunk, each document closed by ``END``, and document bounds."""
    w = words_of(col, SPACED)
    n = len(w.first) - 1
    first = w.first + np.arange(n + 1)
    out = np.full(int(first[-1]), END)
    out[np.arange(len(w.starts)) + w.doc] = hashes(w.data, w.starts, w.ends, LOWER)
    return out, first


def count_tokens(docs: DataFrame) -> DataFrame:
    """(token, c): how often each token occurs in ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def merged():
            u, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return u, np.bincount(inverse, np.concatenate([p[1] for p in parts])).astype(np.int64)

        def rows(u, c):
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(c)], names=["token", "c"])

        for batch in batches:
            for b in chunks(batch, "text", CHUNK // 4):
                parts.append(np.unique(tokens_of(b.column("text"))[0], return_counts=True))
                if sum(len(p[0]) for p in parts) > 1_000_000:
                    parts = [merged()]
                    if len(parts[0][0]) > 500_000:
                        yield rows(*parts.pop())
        if parts:
            yield rows(*merged())

    return docs.select("text").mapInArrow(run, "token bigint, c bigint").groupBy("token").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """The network's words: sorted hashes and each one's rank."""

    hashes: np.ndarray
    ranks: np.ndarray

    @property
    def size(self) -> int:
        return len(self.hashes)

    def slots(self) -> tuple[np.ndarray, np.ndarray]:
        """By the hash's low bits: the place of a word (-1: none), and whether several words
        share them. Made once per task."""
        if "_slots" not in self.__dict__:
            low = (self.hashes & np.uint64(self.low)).astype(np.int64)
            place, crowded = np.full(self.low + 1, -1, np.int32), np.zeros(self.low + 1, bool)
            place[low] = np.arange(self.size)
            crowded[low[place[low] != np.arange(self.size)]] = True
            self._slots = place, crowded
        return self._slots

    @property
    def low(self) -> int:
        return (1 << max(16, self.size.bit_length() + 4)) - 1

    def __getstate__(self):
        return {"hashes": self.hashes, "ranks": self.ranks}

    def ids(self, tokens: np.ndarray) -> np.ndarray:
        """Rank of known words; ``size`` plus a hash bucket for others."""
        out = (tokens & np.uint64(BUCKETS - 1)).astype(np.int32) + np.int32(self.size)
        if self.size:
            place, crowded = self.slots()
            for i in range(0, len(tokens), BLOCK):
                t, o = tokens[i:i + BLOCK], out[i:i + BLOCK]
                low = (t & np.uint64(self.low)).astype(np.int64)
                at = place[low]
                ok = self.hashes[at] == t      # an empty place points at the last word, which is elsewhere
                np.copyto(o, self.ranks[at], where=ok, casting="same_kind")
                rest = np.flatnonzero(~ok & crowded[low])
                at = np.minimum(np.searchsorted(self.hashes, t[rest]), self.size - 1)
                ok = self.hashes[at] == t[rest]
                o[rest[ok]] = self.ranks[at[ok]]
        return out


def class_edges(counts: np.ndarray) -> np.ndarray:
    """First rank of each class, and the end. About sqrt(size) classes of equal sums of root
    counts: frequent words sit in small classes, which keeps the mean class of a token small."""
    if not len(counts):
        return np.zeros(1, np.int64)
    root = np.sqrt(counts + 1.0)
    middle = np.cumsum(root) - root / 2
    cls = (middle / root.sum() * np.ceil(np.sqrt(len(counts)))).astype(np.int64)
    return np.append(np.flatnonzero(np.diff(cls, prepend=-1)), len(counts))


class Gru:
    """Weights and the passes over them. Ids below ``size`` are words by rank, ids above are the
    last class. The last column of ``to_class`` and ``to_word`` is the bias."""

    NAMES = ("embed", "turn", "to_class", "to_word")

    def __init__(self, size: int, hidden: int = HIDDEN, seed: int = 7, edges: np.ndarray | None = None):
        rng = np.random.default_rng(seed)
        self.size, self.hidden = size, hidden
        self.edges = class_edges(np.zeros(size)) if edges is None else edges
        self.classes = len(self.edges) - 1
        self.class_of = np.append(np.repeat(np.arange(self.classes), np.diff(self.edges)), self.classes).astype(np.int16)
        self.start = size + BUCKETS
        self.rows = np.arange(ROWS)
        self.ones = np.ones(max(self.classes + 1, np.diff(self.edges).max(initial=0)), np.float32)
        init = lambda *s: (rng.standard_normal(s) * 0.1).astype(np.float32)
        self.embed, self.turn = init(self.start + 1, 3 * hidden), init(hidden, 3 * hidden)
        self.to_class, self.to_word = init(self.classes + 1, hidden + 1), init(size, hidden + 1)
        self.to_class[:, -1] = self.to_word[:, -1] = 0

    def arrays(self) -> list[np.ndarray]:
        return [getattr(self, n) for n in self.NAMES]

    def start_from(self, counts: np.ndarray, rest: int) -> Gru:
        """Biases that give the words' and classes' own frequencies. ``counts`` by rank."""
        mass = np.append(np.add.reduceat(counts + 1.0, self.edges[:-1]) if self.size else [], rest + 1.0)
        self.to_class[:, -1] = np.log(mass / mass.max())
        self.to_word[:, -1] = np.log((counts + 1.0) / mass[self.class_of[:-1]])
        return self

    def pack(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()]).astype(np.float64)

    def unpack(self, flat: np.ndarray) -> Gru:
        at = 0
        for n, a in zip(self.NAMES, self.arrays()):
            setattr(self, n, flat[at:at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return self

    def softmax(self, s: np.ndarray, weights: np.ndarray, own: np.ndarray, weight: np.ndarray | None, shift: bool):
        """Log probability of column ``own`` in each row; with ``weight``, instead a matrix and a
        factor of its rows whose product is the weighted gradient of the negative ones by the
        logits. ``shift``: logits may overflow as they are."""
        e = s @ np.ascontiguousarray(weights.T)       # a product with a transposed view is several times slower
        if shift:
            e -= e.max(1, keepdims=True)
        rows, ones = self.rows[:len(own)], self.ones[:len(weights)]
        if weight is None:
            logp = e[rows, own]
            np.exp(e, out=e)
            return logp - np.log(e @ ones)
        np.exp(e, out=e)
        total = e @ ones
        e[rows, own] -= total
        return e, weight / total

    def forward(self, before: np.ndarray, fresh: np.ndarray, h: np.ndarray):
        """Hidden states of a window (steps, lanes), with what the backward pass needs. Inside,
        lanes are the last axis, so that every operation runs over long contiguous rows."""
        k, steps = self.hidden, len(before)
        drive = np.ascontiguousarray(self.embed[before].transpose(0, 2, 1))
        keep = (~fresh).astype(np.float32)
        turn, h = np.ascontiguousarray(self.turn.T), np.ascontiguousarray(h.T)
        states = np.empty((steps, k, before.shape[1]), np.float32)
        saved = []
        for t in range(steps):
            old = h * keep[t]
            turned = turn @ old
            gates = drive[t, :2 * k]
            gates += turned[:2 * k]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            z, r = gates[:k], gates[k:]
            new = drive[t, 2 * k:]
            new += r * turned[2 * k:]
            np.tanh(new, out=new)
            h = new + z * (old - new)
            states[t] = h
            saved.append((old, turned[2 * k:], z, r, new))
        return states.transpose(0, 2, 1), h.T, saved, keep

    def output(self, states: np.ndarray, ids: np.ndarray, grads: list | None = None, weight: np.ndarray | None = None):
        """Natural log probability of each id (the last class without its word part); with
        ``grads``, adds the output gradients there and returns those of the states instead."""
        k, ids = self.hidden, ids.ravel()
        cls = self.class_of[np.minimum(ids, self.size)]
        order = np.argsort(cls, kind="stable")         # one product per class
        cls, ids = cls[order], ids[order]
        s = np.ones((len(ids), k + 1), states.dtype)
        s[:, :k] = states.reshape(-1, k)[order]
        # states are within 1, so logits of small weights cannot overflow
        reach = lambda w: max(w.max(initial=0), -w.min(initial=0))
        shift = any(reach(w[:, :k]) * k + reach(w[:, k]) > REACH for w in (self.to_class, self.to_word))
        bounds, edges = np.searchsorted(cls, np.arange(self.classes + 1)).tolist(), self.edges.tolist()
        # (rows, their columns, the weights and where their gradients go): all rows by class, then each class by word
        parts = [(slice(at, at + ROWS), cls[at:at + ROWS], self.to_class, 2, slice(None)) for at in range(0, len(ids), ROWS)]
        for c in range(self.classes):
            a, b = edges[c], edges[c + 1]
            if b - a > 1:
                for at in range(bounds[c], bounds[c + 1], ROWS):
                    i = slice(at, min(at + ROWS, bounds[c + 1]))
                    parts.append((i, ids[i] - a, self.to_word[a:b], 3, slice(a, b)))
        if grads is None:
            logp = np.zeros(len(ids))
            for i, own, weights, _, _ in parts:
                logp[i] += self.softmax(s[i], weights, own, None, shift)
            out = np.empty_like(logp)
            out[order] = logp
            return out, None
        weight, back = weight[order], np.zeros((len(ids), k), states.dtype)
        for i, own, weights, which, where in parts:
            g, factor = self.softmax(s[i], weights, own, weight[i], shift)
            factor = factor[:, None]
            back[i] += (g @ weights[:, :k]) * factor
            grads[which][where] += g.T @ (s[i] * factor)
        flow = np.empty_like(back)
        flow[order] = back
        return None, flow.reshape(states.shape)

    def backward(self, before: np.ndarray, saved: list, keep: np.ndarray, back: np.ndarray, grads: list) -> np.ndarray:
        """Adds the gradients of a window to ``grads``; the distinct inputs."""
        k = self.hidden
        back = np.ascontiguousarray(back.transpose(0, 2, 1))
        flow = np.zeros_like(back[0])
        drive = np.empty((len(before), 3 * k, before.shape[1]), np.float32)
        for t in range(len(before) - 1, -1, -1):
            old, turned, z, r, new = saved[t]
            d = back[t] + flow
            d_new = d * (1 - z) * (1 - new * new)
            drive[t, :k] = d * (old - new) * z * (1 - z)
            drive[t, k:2 * k] = d_new * turned * r * (1 - r)
            drive[t, 2 * k:] = d_new
            through = drive[t].copy()
            through[2 * k:] *= r
            grads[1] += (through @ old.T).T
            flow = (d * z + self.turn @ through) * keep[t]
        ids, flat = before.ravel(), drive.transpose(0, 2, 1).reshape(-1, 3 * k)
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        at = np.flatnonzero(np.diff(ids, prepend=-1))
        grads[0][ids[at]] += np.add.reduceat(flat[order], at, axis=0)
        return ids[at]


def lanes_of(first: np.ndarray, most: int = LANES) -> np.ndarray:
    """(steps, lanes) matrix of token positions: documents dealt to lanes, the longest
    first to the lane with least; -1 where a lane has ended."""
    size = np.diff(first)
    total, longest = int(size.sum()), int(size.max(initial=1))
    n = int(max(1, min(most, 2 * total // longest, len(size))))
    load = [(0, i) for i in range(n)]
    placed = []
    for d in np.argsort(-size, kind="stable").tolist():
        used, lane = heapq.heappop(load)
        placed.append((d, lane, used))
        heapq.heappush(load, (used + int(size[d]), lane))
    out = np.full((n, max(u for u, _ in load)), -1, np.int32)
    for d, lane, used in placed:
        out[lane, used:used + size[d]] = np.arange(first[d], first[d + 1])
    return np.ascontiguousarray(out.T)


def score_chunk(gru: Gru, ids: np.ndarray, first: np.ndarray, window: int = 64) -> np.ndarray:
    """Natural log probability of each token of a chunk, states carried through."""
    out = np.zeros(len(ids), np.float32)
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[first[:-1]] = gru.start
    fresh = np.zeros(len(ids), bool)
    fresh[first[:-1]] = True
    lanes = lanes_of(first)
    live, h = np.arange(lanes.shape[1]), np.zeros((lanes.shape[1], gru.hidden), np.float32)
    held: list[tuple[np.ndarray, np.ndarray]] = []      # states of windows that await their output

    def flush():
        at = np.concatenate([p for p, _ in held])
        out[at] = gru.output(np.concatenate([x for _, x in held]), ids[at])[0]
        held.clear()

    for at in range(0, len(lanes), window):
        p = lanes[at:at + window][:, live]
        on = p[0] >= 0
        if not on.all():
            p, live, h = p[:, on], live[on], h[on]
        q = np.maximum(p, 0)
        states, h, _, _ = gru.forward(before[q], fresh[q], h)
        real = p >= 0
        held.append((p[real], states[real]))
        if sum(len(p) for p, _ in held) >= AT_ONCE:
            flush()
    if held:
        flush()
    return out


class Trainer:
    """Adam on one task's chunks."""

    def __init__(self, gru: Gru, rate: float = RATE, window: int = WINDOW):
        self.gru, self.rate, self.window, self.steps, self.tokens = gru, rate, window, 0, 0
        self.m = [np.zeros_like(a) for a in gru.arrays()]
        self.v = [np.zeros_like(a) for a in gru.arrays()]
        self.grads = [np.zeros_like(a) for a in gru.arrays()]

    def chunk(self, ids: np.ndarray, first: np.ndarray) -> None:
        g = self.gru
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[first[:-1]] = g.start
        # parts of at most PART tokens: the state is truncated there as well, so that one
        # long document does not leave the other lanes idle
        size = np.diff(first)
        starts = np.repeat(first[:-1], -(-size // PART))
        rank = np.arange(len(starts)) - np.searchsorted(starts, starts)
        first = np.append(starts + rank * PART, first[-1])
        fresh = np.zeros(len(ids), bool)
        fresh[first[:-1]] = True
        lanes = lanes_of(first, min(LANES, max(8, len(ids) // LANE_TOKENS)))      # a small chunk still gives many steps
        live, h = np.arange(lanes.shape[1]), np.zeros((lanes.shape[1], g.hidden), np.float32)
        for at in range(0, len(lanes), self.window):
            p = lanes[at:at + self.window][:, live]
            on = p[0] >= 0
            if not on.all():
                p, live, h = p[:, on], live[on], h[on]
            q = np.maximum(p, 0)
            inputs, grads = before[q], self.grads
            states, h, saved, keep = g.forward(inputs, fresh[q], h)
            weight = (p.ravel() >= 0).astype(np.float32)
            n = float(weight.sum())
            _, back = g.output(states, ids[q], grads, weight / max(n, 1.0))
            self._step(g.backward(inputs, saved, keep, back, grads), min(1.0, n / 256))
            self.tokens += int(n)

    def _step(self, inputs: np.ndarray, scale: float) -> None:
        """One update from ``self.grads``, which are then zero; of the embeddings, of ``inputs`` alone."""
        self.steps += 1
        a, b = 1 - 0.9**self.steps, 1 - 0.99**self.steps
        whole = list(zip(self.gru.arrays(), self.grads, self.m, self.v))
        parts = [tuple(x[inputs] for x in whole[0]), *whole[1:]]
        size = np.sqrt(sum(float(np.vdot(x, x)) for _, x, _, _ in parts))
        clip = min(1.0, 1.0 / (size + 1e-9))
        rate = self.rate * scale * np.sqrt(b) / a
        for part in parts:
            flat = [x.reshape(-1) for x in part]
            for at in range(0, len(flat[0]), CACHED):
                w, x, m, v = (y[at:at + CACHED] for y in flat)
                m *= 0.9
                v *= 0.99
                x *= 0.1 * clip
                m += x
                x *= x              # 0.01 * the squared gradient
                v += x
                np.sqrt(v, out=x)
                x += 1e-6
                np.divide(m, x, out=x)
                x *= rate
                w -= x
                x[:] = 0
        for x, y in zip(whole[0], parts[0]):
            x[inputs] = y


def _average(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    n = rows["tokens"].to_numpy(float)
    mean = sum(np.frombuffer(x, np.float32) * (t / max(n.sum(), 1)) for x, t in zip(rows["change"], n))
    return pd.DataFrame([[*key, int(n.sum()), mean.astype(np.float32).tobytes()]], columns=["piece", "task", "tokens", "change"])


def train(docs: DataFrame, vocabulary: Vocabulary, gru: Gru, rounds: int = ROUNDS) -> Gru:
    """The network after all rounds; round ``r`` takes the documents of part ``r``."""
    hidden = gru.hidden
    sc = docs.sparkSession.sparkContext
    part = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(rounds))
    for r in range(rounds):
        shared = sc.broadcast((vocabulary, gru.edges, gru.pack()))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            vocabulary, edges, flat = shared.value
            trainer = Trainer(Gru(vocabulary.size, hidden, edges=edges).unpack(flat))
            for batch in batches:
                for b in chunks(batch, "text", CHUNK):
                    tokens, first = tokens_of(b.column("text"))
                    trainer.chunk(vocabulary.ids(tokens), first)
            if trainer.tokens:
                change = (trainer.gru.pack() - flat).astype(np.float32)
                pieces = [change[at:at + PIECE].tobytes() for at in range(0, len(change), PIECE)]
                same = lambda x: pa.array([x] * len(pieces), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(pieces)), pa.int64()), same(TaskContext.get().partitionId()), same(trainer.tokens),
                     pa.array(pieces, pa.binary())], names=["piece", "task", "tokens", "change"])

        got = stage(docs.where(part == r).select("text").mapInArrow(
            run, "piece bigint, task bigint, tokens bigint, change binary"))
        tasks = (got.agg(F.max("task")).first()[0] or 0) + 1
        while True:
            tasks = -(-tasks // FAN_IN)
            got = got.groupBy("piece", (F.col("task") / FAN_IN).cast("bigint").alias("task")).applyInPandas(
                _average, "piece bigint, task bigint, tokens bigint, change binary")
            if tasks == 1:
                break
        mean = sorted(got.select("piece", "change").collect())
        if mean:
            gru.unpack(gru.pack() + np.concatenate([np.frombuffer(m["change"], np.float32) for m in mean]))
    return gru


def score(docs: DataFrame, head_rows: int = HEAD_ROWS, rounds: int = ROUNDS, hidden: int = HIDDEN) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = docs.select("doc_id", "text")
    learn = docs.where(~held_out())
    counts = stage(count_tokens(learn))
    totals = counts.agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("n")).first()
    v, n = int(totals["v"]), int(totals["n"] or 0)
    top = counts.where(F.col("c") >= max(LEAST, int(np.ceil(SHARE * n)))).orderBy(F.desc("c"), "token").toArrow()
    ranked, top = (top.column(c).to_numpy() for c in ("token", "c"))
    ranked = ranked.view(np.uint64)
    order = np.argsort(ranked)
    vocabulary = Vocabulary(ranked[order], order)
    n_rest, v_rest = n - int(top.sum()), v - len(top)
    gru = Gru(vocabulary.size, hidden, edges=class_edges(top)).start_from(top.astype(float), n_rest)
    gru = train(learn, vocabulary, gru, rounds)

    least = 0
    if v > head_rows:      # the counts above a quantile make up the head; the rest is joined
        least = int(counts.approxQuantile("c", [1 - head_rows / v], head_rows / (4 * v))[0])
        while counts.where(F.col("c") > least).count() > head_rows:
            least *= 2
    head = counts.where(F.col("c") > least).toArrow()
    tokens = head.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    shared = docs.sparkSession.sparkContext.broadcast(
        (vocabulary, top, gru.edges, gru.pack(), tokens[order], head.column("c").to_numpy()[order]))
    del head, tokens, order
    ten = np.log(10.0)

    def plus_one(tokens, ids, top, head, c):
        """Count of each token plus one; of those neither in the network nor in the head, 0
        where the join counts, else 1."""
        out = np.full(len(tokens), 0.0 if least else 1.0)
        word = ids < len(top)
        out[word] = top[ids[word]] + 1.0
        rest = np.flatnonzero(~word)
        if len(head):
            at = np.minimum(np.searchsorted(head, tokens[rest]), len(head) - 1)
            ok = head[at] == tokens[rest]
            out[rest[ok]] = c[at[ok]] + 1.0
        return out

    def total(x, first, kind=np.float64):
        return np.add.reduceat(x, first[:-1], dtype=kind) if len(first) > 1 else np.zeros(0, kind)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    with_row = docs.withColumn("held_out", held_out()).withColumn("row", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, top, edges, flat, head, c = shared.value
        gru = Gru(vocabulary.size, hidden, edges=edges).unpack(flat)
        for batch in batches:
            for b in chunks(batch, "text", CHUNK):
                tokens, first = tokens_of(b.column("text"))
                ids = vocabulary.ids(tokens)
                count = np.empty(len(tokens), np.float64)       # plus one; 0 where the join counts
                for at in range(0, len(tokens), BLOCK):
                    count[at:at + BLOCK] = plus_one(tokens[at:at + BLOCK], ids[at:at + BLOCK], top, head, c)
                gone = np.flatnonzero(count == 0)
                at = np.searchsorted(gone, first).astype(np.int32)
                # token and whether it is outside the network's words; empty unless counts are joined
                joined = [pa.ListArray.from_arrays(at, x) for x in (
                    pa.array(tokens[gone].view(np.int64)), pa.array(ids[gone] >= vocabulary.size))]
                del tokens, gone
                sums = [total(count > 1, first, np.int64)]
                counted = count > 0
                logs = np.log10(count, out=count, where=counted)
                logs -= np.log10(n + v + 1.0) * counted
                sums.append(total(logs, first))
                # the unigram of the last class differs from the corpus's by its total alone
                logs += (np.log10(n + v + 1.0) - np.log10(n_rest + v_rest + 1.0)) * counted
                logs *= ids >= vocabulary.size
                outside = total(logs, first)
                del count, logs, counted
                sums.append(total(score_chunk(gru, ids, first), first) / ten + outside)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("row"), b.column("held_out"), pa.array(np.diff(first), pa.int64()),
                     *(pa.array(s) for s in sums), *joined],
                    names=["doc_id", "row", "held_out", "n_tokens", "n_known", "base_score", "score", "token", "outside"])

    out = with_row.mapInArrow(run, f"doc_id {id_type}, row bigint, held_out boolean, n_tokens bigint, n_known bigint, "
                                   "base_score double, score double, token array<bigint>, outside array<boolean>")
    if least:
        out = stage(out)
        rare = (out.select("row", F.explode(F.arrays_zip("token", "outside")).alias("x")).select("row", "x.*")
                .groupBy("row", "token", "outside").agg(F.count(F.lit(1)).alias("times"))
                .join(counts.where(F.col("c") <= least), "token", "left").withColumn("c", F.coalesce("c", F.lit(0))))
        log = lambda total: F.col("times") * F.log10((F.col("c") + 1.0) / F.lit(float(total)))
        rare = rare.groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("k"),
                                       F.sum(log(n + v + 1)).alias("b"),
                                       F.sum(F.when(F.col("outside"), log(n_rest + v_rest + 1)).otherwise(0.0)).alias("s"))
        plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
        out = out.join(rare, "row", "left").select("doc_id", "held_out", "n_tokens", plus("n_known", "k"),
                                                   plus("base_score", "b"), plus("score", "s"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"),
                      "base_score", "score")
