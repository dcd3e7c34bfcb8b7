"""Language model: exact counts, exact gradients, and a gain on held-out text."""
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from .data import edge_rows, make_docs
from lectern.llm import gru_lm


def tokens(t):
    return [x for x in re.split("[\x20\t-\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if x] + ["\0end"]


def held(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2


def test_base_columns(spark, docs):
    rows, c = edge_rows(), Counter()
    for d, t in rows:
        if not held(d):
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    want = Counter()
    for d, t in rows:
        w = tokens(t)
        want[str(d), held(d), len(w), sum(c[x] > 0 for x in w), n, f"{sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w):.6f}"] += 1
    scores = []
    for head in (1_000_000, 5):        # 5: nearly all counts come by the join
        got = gru_lm.score(docs, head_rows=head).collect()
        assert Counter((str(r["doc_id"]), *tuple(r)[1:5], f"{r['base_score']:.6f}") for r in got) == want
        scores.append(sorted(r["score"] for r in got))
        assert all(r["score"] < 0 for r in got)
    assert np.allclose(scores[0], scores[1])


def test_gradient():
    """Backpropagation equals finite differences within a window."""
    g = gru_lm.Gru(20, hidden=3)
    for name in g.NAMES:
        setattr(g, name, getattr(g, name).astype(np.float64) * 3)
    r = np.random.default_rng(0)
    ids, before = r.integers(0, 20 + gru_lm.BUCKETS, (5, 4)), r.integers(0, g.start + 1, (5, 4))
    fresh = r.random((5, 4)) < 0.3
    start = r.standard_normal((4, 3))

    def loss():
        states, _, _, _ = g.forward(before, fresh, start)
        return -g.output(states.astype(np.float64), ids)[0].sum()
    grads = [np.zeros_like(a) for a in g.arrays()]
    states, _, saved, keep = g.forward(before, fresh, start)
    _, back = g.output(states.astype(np.float64), ids, grads, np.ones(20))
    g.backward(before, saved, keep, back, grads)
    for a, d in zip(g.arrays(), grads):
        for _ in range(12):
            i = tuple(r.integers(0, s) for s in a.shape)
            if a[i] < -1e8:
                continue
            a[i] += 1e-2
            up = loss()
            a[i] -= 2e-2
            down = loss()
            a[i] += 1e-2
            assert abs((up - down) / 2e-2 - d[i]) < 2e-2 + 0.02 * abs(d[i])


def test_state_runs_through_whole_documents():
    """Lanes and windows change nothing: each document scored alone, step by step."""
    r = np.random.default_rng(1)
    g = gru_lm.Gru(40)
    size = np.array([1, 7, 130, 33, 1, 64])
    first = np.concatenate(([0], np.cumsum(size)))
    ids = r.integers(0, 40 + gru_lm.BUCKETS, first[-1])
    got = gru_lm.score_chunk(g, ids, first, window=16)
    for a, b in zip(first, first[1:]):
        h = np.zeros((1, g.hidden), np.float32)
        for i in range(a, b):
            before = np.array([[g.start if i == a else ids[i - 1]]])
            states, h, _, _ = g.forward(before, np.array([[i == a]]), h)
            assert abs(g.output(states, ids[i:i + 1])[0][0] - got[i]) < 1e-4


def test_probabilities_sum_to_one():
    g = gru_lm.Gru(35)
    states = np.random.default_rng(2).standard_normal((1, 1, g.hidden)).astype(np.float32)
    p = [math.exp(g.output(states, np.array([i]))[0][0]) for i in range(36)]    # 35 words and the last class
    assert abs(sum(p) - 1) < 1e-5


def test_learns_order(spark):
    """Words in a fixed order: held-out text scores far better than by frequency."""
    r = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    rows = []
    for d in range(400):
        at = r.randrange(12)
        rows.append((d, " ".join(words[(at + i) % 12] for i in range(r.randint(40, 120)))))
    out = [x for x in gru_lm.score(make_docs(spark, rows).coalesce(1), rounds=1).collect() if x["held_out"]]
    n = sum(x["n_tokens"] for x in out)
    assert sum(x["score"] for x in out) / n > sum(x["base_score"] for x in out) / n + 0.3


def test_network_words_follow_the_corpus(spark, monkeypatch):
    """The network's vocabulary covers most tokens of 1,500 words, in about sqrt(size) classes."""
    r = random.Random(6)
    rows = [(d, " ".join(f"w{r.randrange(1500)}" for _ in range(120))) for d in range(150)]
    seen = []
    monkeypatch.setattr(gru_lm, "train", lambda docs, vocabulary, gru, rounds: seen.append((vocabulary, gru)) or gru)
    gru_lm.score(make_docs(spark, rows))
    (vocabulary, gru), = seen
    ids = [i for d, t in rows if not held(d) for i in vocabulary.ids(gru_lm.tokens_of(pa.array([t]))[0])]
    assert sum(i < vocabulary.size for i in ids) > 0.9 * len(ids)
    assert abs(gru.classes - math.sqrt(vocabulary.size)) <= 1


@pytest.mark.parametrize("same", [1, 1 << 20])
def test_ids_equal_a_search(same):
    """Words whose hashes share low bits (all of them with ``same`` above the table's size) are told apart."""
    r = np.random.default_rng(8)
    every = np.unique(r.integers(0, 1 << 40, 4000).astype(np.uint64) * np.uint64(same))
    words = np.sort(r.choice(every, 1500, replace=False))
    v = gru_lm.Vocabulary(words, r.permutation(1500))
    rank = dict(zip(words.tolist(), v.ranks.tolist()))
    want = [rank.get(t, 1500 + t % gru_lm.BUCKETS) for t in every.tolist()]
    assert v.ids(every).tolist() == want


def test_empty(no_docs):
    assert gru_lm.score(no_docs).count() == 0
