"""Order MinHash against a plain version with the same hash of words, k-mers and tuples."""

import hashlib
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from lectern.llm import order_minhash
from lectern.llm.order_minhash import K, L, M



def s64(x):
    return x - (1 << 64) if x >> 63 else x



def hb(b, seed=42):
    return xxhash.xxh64(b, seed=seed & ((1 << 64) - 1)).intdigest()



def chained(*longs):
    h = 42
    for x in longs:
        h = hb(struct.pack("<q", x), h)
    return s64(h)



def numbered(x, i):
    return s64(hb(struct.pack("<i", i), hb(struct.pack("<q", x))))


BLANKLESS = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")


def signature(text):
    words = [x for x in re.split(r"[ \t\n\x0b\f\r]+", BLANKLESS.sub(r" \1 ", text or "")) if x]
    hashes, seen, elements, out = [s64(hb(x.encode())) for x in words], {}, [], []
    if not words:
        return []
    for i in range(max(len(hashes) - K + 1, 1)):
        h = chained(*hashes[i:i + K]) >> 24
        seen[h] = seen.get(h, -1) + 1
        elements.append((h if not seen[h] else numbered(h, seen[h]) >> 24, i))
    for v in range(-(M // 2), M // 2):
        order = sorted(elements, key=lambda e: ((e[0] - (v << 34)) % (1 << 40), e[1]))
        chosen = sorted((order[t % len(order)] for t in range(L)), key=lambda e: (e[1], e[0] % (1 << 40)))
        out.append("%08x" % ((chained(*[e[0] % (1 << 40) for e in chosen]) >> 32) & 0xFFFFFFFF))
    return out


def like(a, b):
    return 1.0 if not a and not b else sum(x == y for x, y in zip(a, b)) / M if a and b else 0.0


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for i, (d, t) in enumerate(rows):
        t, after = t or "", rows[(i + 1) % len(rows)][1] or ""
        q = len(t) // 4
        edited = t[:len(t) - q] + after[:q]
        a, b, c = signature(t), signature(edited), signature(after)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b), like(a, b), like(a, c)))
    return sorted(out, key=str)


def cases():
    r = random.Random(3)
    text = lambda n: " ".join(r.choice("a b c dd é 漢字 x\ny 😀".split(" ")) for _ in range(n))
    return [[], [(1, "a b c d e f g h")],
            [(None, None), (1, ""), (2, " \n"), (3, "one"), (4, "x y"), (5, "漢字漢字漢"), (6, "z " * 20_000)]
            + [(i, text(r.randint(1, 300))) for i in range(10, 60)] + [(200, "p q r s t u v w x y z" * 5)] * 30]


@pytest.mark.parametrize("rows", cases())
def test_compare(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "h") for r in rows], "doc_id bigint, text string, sig int, h1 string").repartition(3)
    assert sorted((tuple(r) for r in order_minhash.compare(docs).collect()), key=str) == brute(rows)


def test_order_counts(spark):
    """The same k-mers in another order are less alike than an unchanged order."""
    r = random.Random(5)
    parts = [" ".join(f"w{r.randint(0, 10 ** 6)}" for _ in range(40)) for _ in range(10)]
    df = spark.createDataFrame([(" ".join(parts), " ".join(reversed(parts)), " ".join(parts[:9]))], "a string, b string, c string")
    s = {c: order_minhash.signature(F.col(c)) for c in "abc"}
    turned, cut = df.select(order_minhash.likeness(s["a"], s["b"]), order_minhash.likeness(s["a"], s["c"])).first()
    assert turned < 0.3 < 0.6 < cut
