"""Byte-pair training against the plain sequential algorithm, and round trips."""

import random
from collections import Counter

import pytest

from lectern.operators.bpe import BLANK, detokenize_bpe, encoder, fit_bpe, safe_round, tokenize_bpe


def sequential(words, merges):
    table = {w: [BLANK, *w] for w in words if w}
    counts, out = Counter(w for w in words if w), []
    for rank in range(1, merges + 1):
        pairs = Counter()
        for w, parts in table.items():
            for p in zip(parts, parts[1:]):
                pairs[p] += counts[w]
        best = min((p for p in pairs.items() if p[1] >= 2), key=lambda p: (-p[1], p[0][0].encode(), p[0][1].encode()), default=None)
        if not best:
            break
        out.append((rank, *best[0], best[1]))
        for w, parts in table.items():
            joined, i = [], 0
            while i < len(parts):
                two = tuple(parts[i:i + 2]) == best[0]
                joined.append("".join(parts[i:i + 2]) if two else parts[i])
                i += 2 if two else 1
            table[w] = joined
    return out, table


def corpus():
    r = random.Random(9)
    stems = ["lo", "low", "new", "wid", "aaa", "naïve", "漢字", "😀x", "ab" * 6]
    return [r.choice(stems) + r.choice(["", "er", "est", "aa", "b"]) for _ in range(400)] + [None, "", "q"]


@pytest.mark.parametrize("candidates", [3, 128])
def test_many_merges_equal_sequential_training(spark, candidates):
    words = corpus()
    model = fit_bpe(spark.createDataFrame([(w,) for w in words], "tok string"), 40, candidates=candidates)
    want, table = sequential(words, 40)
    assert [tuple(r) for r in model.merges.orderBy("rank").collect()] == want
    tokens = {r["id"]: r["token"] for r in model.vocab.collect()}
    encode = encoder(model)
    assert all([tokens[i] for i in encode(w)] == parts for w, parts in table.items())


def test_round_trip(spark):
    r = random.Random(1)
    words = [w for w in corpus() if w]
    texts = [(i, " ".join(r.choice(words) for _ in range(r.randint(0, 30)))) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    model = fit_bpe(spark.createDataFrame([(w,) for w in words], "tok string"), 15)
    back = detokenize_bpe(tokenize_bpe(docs, model, ["doc_id"]), model, ["doc_id"])
    assert sorted(tuple(r) for r in back.collect()) == texts


def test_no_words(spark):
    model = fit_bpe(spark.createDataFrame([], "tok string"), 5)
    assert model.merges.count() == 0 and model.vocab.count() == 2


def test_round_stops_where_order_could_change():
    top = [("a", "b", 9), ("c", "d", 8), ("b", "e", 7), ("f", "g", 6)]
    # (ab, e) may occur 7 times: (c, d) is safe, (b, e) is not
    assert safe_round(top, set(), 10, True) == top[:2]
    assert safe_round(top, set(), 1, True) == top[:1]
    assert safe_round(top, {"ab"}, 10, True) == top[:1]
