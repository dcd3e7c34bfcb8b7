"""Ranked resolution against the scores of all pairs."""
import random
import re

import pytest
from pyspark.sql import functions as F

from lectern.operators.resolve import resolve_ranked


def plain(works, items, limit, percent):
    words = lambda s: set(re.findall(r"[^\W_]+", (s or "").lower()))
    terms = lambda a, t: {("a", w) for w in words(a)} | {("t", w) for w in words(t)}
    held = {i: terms(a, t) for i, a, t, m, lang in items if m == "texts" and lang == "English"}
    held = {i: t for i, t in held.items() if t}
    df = {}
    for t in held.values():
        for w in t:
            df[w] = df.get(w, 0) + 1
    out = set()
    for a, t in set(works):
        impact = {w: (1 if w[0] == "a" else 2) * (len(held) // df[w]).bit_length() for w in terms(a, t) if w in df}
        hits = [(-sum(impact.get(w, 0) for w in h), int(i)) for i, h in held.items() if h & impact.keys()]
        hits = [x for x in hits if -x[0] * 100 >= sum(impact.values()) * percent]
        out |= {(a, t, r, str(i), -s) for r, (s, i) in enumerate(sorted(hits)[:limit], 1)}
    return out


@pytest.mark.parametrize("limit,percent", [(5, 50), (2, 10), (1, 100), (3, 0)])
def test_equals_all_pairs(spark, limit, percent):
    r = random.Random(3)
    name = lambda n: " ".join(r.choice(["The", "the", "Sea", "war", "Émile", "x1", "king", "queen", "of", "rare%d" % r.randint(0, 30)]) for _ in range(n))
    items = [(str(i), name(2), name(4), r.choice(["texts", "texts", "audio"]), r.choice(["English", "English", "French"])) for i in range(150)]
    items += [(str(200 + i), "Hot Author", "the hot title", "texts", "English") for i in range(80)]
    items += [("400", None, "sea", "texts", "English"), ("401", "", "--", "texts", "English"), ("402", "king", None, "texts", "English")]
    works = [(name(1), name(3)) for _ in range(60)] + [("hot author", "TITLE, the hot"), (None, "sea"), ("king", None), (None, None), ("", "!"), ("zz", "zz")]
    works += works[:5]
    w = spark.createDataFrame(works, "author string, title string").repartition(3)
    c = spark.createDataFrame(items, "identifier string, author string, title string, mediatype string, language string").repartition(3)
    got = resolve_ranked(w, c, [F.col("identifier").cast("int")], limit=limit, percent=percent)
    # works without an author or title are found again by their own values
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain(works, items, limit, percent)))


def test_empty(spark):
    w = spark.createDataFrame([("a", "b")], "author string, title string")
    c = spark.createDataFrame([], "identifier string, author string, title string, mediatype string, language string")
    order = [F.col("identifier")]
    assert resolve_ranked(w, c, order).count() == 0
    assert resolve_ranked(w.limit(0), c, order).count() == 0
