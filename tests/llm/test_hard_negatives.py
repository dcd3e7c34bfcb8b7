"""Hard negatives against all products, and the packed products against Python integers."""

import math
import random

import numpy as np
import pytest

from lectern.llm import hard_negatives


@pytest.mark.parametrize("most,kind", [(3, np.int64), (257, np.int64), (1 << 18, np.int64), (1 << 40, object), (10 ** 30, object)])
def test_products(most, kind):
    r = random.Random(most)
    make = lambda n: np.array([[r.randint(-most, most) for _ in range(17)] for _ in range(n)], dtype=kind)
    a, b = make(5), make(131)
    assert hard_negatives.products(a, b).tolist() == [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]


def brute(rows):
    ok = [(k, v, (label + 1) % 10 if v is not None and v % 7 == 0 else label, [math.floor(256 * x) for x in e])
          for k, (v, e, label) in enumerate(rows)
          if label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for k, anchor, label, vector in ok:
        if anchor is None or anchor % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(vector, r[3])), r[1] is None, r[1] or 0, r[0], r[2]) for r in ok if r[0] != k)
        for p in [s for s in scored if s[4] == label][:5]:
            fits = [s for s in scored if s[4] != label and 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0]][:10]
            out += [(anchor, None if p[1] else p[2], i, None if n[1] else n[2], -p[0], -n[0]) for i, n in enumerate(fits, 1)]
    return sorted(out, key=str)


def cases():
    r = random.Random(2)
    vector = lambda: [r.choice([-1.0, 0.0, 0.25, 0.5, 1.0]) for _ in range(4)]
    return [[], [(0, [1.0], 1)],
            [(r.choice([None, *range(0, 1000)]), r.choice([None, [], [math.nan, 1.0], [math.inf], [None, 1.0], vector(), vector(), vector()[:3]]),
              r.choice([None, 0, 1, 2])) for _ in range(700)] + [(100, [0.5, 0.5, 0.5, 1.0], 1)] * 50]


@pytest.mark.parametrize("rows", cases())
def test_mine(spark, rows):
    df = spark.createDataFrame([(*r, "q", 1) for r in rows], "vec_id bigint, embedding array<float>, label int, row string, vector int").repartition(3)
    got = hard_negatives.mine(df, round_rows=40, block_rows=50).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
