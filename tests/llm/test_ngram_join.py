"""Near duplicates against all pairs."""
import random
import re

import numpy as np
import pytest

from .data import rows_of, edge_rows, make_docs
from lectern.llm import ngram_join as nj


def sets_of(rows, k):
    out = []
    for _, t in rows:
        w = [x for x in re.split("[\x20\t-\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if x]
        out.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    return out


def brute(rows, k, percent):
    s, n = sets_of(rows, k), len(rows)
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(n):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j]):
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return sorted([(d, len(s[i]), low.get(root(i))) for i, (d, _) in enumerate(rows)], key=str)


def near_copies(seed, n_words, n_copies, edits):
    """Copies of one text with 0 to ``edits`` changed words, and texts that share a passage."""
    r = random.Random(seed)
    word = lambda: "w" + str(r.randint(0, 3000))
    base = [word() for _ in range(n_words)]
    rows = []
    for i in range(n_copies):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(n_words)] = word()
        if r.random() < 0.2:
            w = w[:r.randint(int(0.8 * n_words), n_words)]
        rows.append((i, " ".join(w)))
    passage = " ".join(word() for _ in range(50))
    rows += [(1000 + i, passage + " " + " ".join(word() for _ in range(r.randint(3, 60)))) for i in range(40)]
    return rows + [(2000 + i, " ".join(word() for _ in range(r.randint(0, 40)))) for i in range(40)]


def test_edge_cases(docs):
    assert rows_of(nj.near_duplicates(docs, sketch_bits=16)) == brute(edge_rows(), 4, 85)


@pytest.mark.parametrize("bits,block,k,percent", [(16, 20_000, 4, 85), (16, 7, 5, 80)])
def test_near_copies(spark, bits, block, k, percent):
    rows = near_copies(5, 120, 90, 9)
    got = nj.near_duplicates(make_docs(spark, rows).repartition(5), k=k, percent=percent, sketch_bits=bits, block=block)
    assert rows_of(got) == brute(rows, k, percent)


def test_null_ids_link(spark):
    """Rows without an id link like others, also where only such a row joins two documents."""
    w = [f"w{i}" for i in range(100)]
    text = lambda a: " ".join(["x"] * a + w[a:])
    rows = [(1, text(0)), (None, text(6)), (2, text(12)), (None, "n " + text(40)), (None, text(40)), (7, text(70)), (None, text(70))]
    want = brute(rows, 4, 85)
    assert [r[2] for r in want if r[0] == 2] == [1] and brute([r for r in rows if r[0]], 4, 85)[1][2] == 2
    assert rows_of(nj.near_duplicates(make_docs(spark, rows).repartition(3), sketch_bits=16)) == want


def test_prefix_condition():
    """Linked sets share enough prefix shingles at the smaller of their match numbers."""
    r = np.random.default_rng(0)
    for _ in range(300):
        a = np.unique(r.integers(0, 60, 40))
        b = np.unique(np.concatenate([r.permutation(a)[r.integers(0, 4):], r.integers(0, 60, r.integers(0, 3))]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 85 * (len(a) + len(b) - both):
            continue
        o = nj.overlap(len(a), len(b), 85)
        for l in range(1, min(8, o) + 1):
            assert len(np.intersect1d(a[:len(a) - o + l], b[:len(b) - o + l])) >= l


def test_match_numbers_follow_cost():
    assert nj.choose_matches(np.zeros(30), 10, 8) == 1
    assert nj.choose_matches(np.full(30, 50.0), 10, 8) > 1


def test_empty_table(no_docs):
    assert nj.near_duplicates(no_docs, sketch_bits=16).count() == 0
