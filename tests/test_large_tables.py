"""Vocabularies beyond the broadcast bounds: same rows as within them, and no row per token."""

import random

import pytest

from conftest import docs_df
from lectern.operators import bpe
from lectern.operators import tokenize as tk
from lectern.operators.tokenize import detokenize, fit_vocab, token_rows, tokenize


def texts():
    r = random.Random(5)
    words = ["the", "of", "and"] + [f"w{i}" for i in range(60)]
    return [" ".join(r.choice(words[:3 if r.random() < 0.6 else 63]) for _ in range(r.randint(0, 30))) for _ in range(60)] + ["", "rare1 the rare2"]


def test_only_rare_tokens_are_shuffled(spark):
    """The frequent head is looked up in place: no exploded token table is joined or grouped."""
    d = docs_df(spark, texts()).unionByName(spark.createDataFrame([(3, "the twin w7"), (None, "of w1"), (77, None)], "doc_id bigint, text string"))
    v = fit_vocab(token_rows(d.where("doc_id < 40"), ["doc_id"]))
    rows = lambda t: sorted(map(str, t.select("doc_id", "input_ids", "attention_mask", "special_tokens_mask").collect()))
    small, large = tokenize(d, v, ["doc_id"], add_eos=True), tokenize(d, v, ["doc_id"], add_eos=True, broadcast_max_rows=20)
    assert rows(small) == rows(large)
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan, "every token became a row"


@pytest.mark.parametrize("skip", [True, False])
def test_detokenize_in_place(spark, skip):
    d = docs_df(spark, texts())
    v = fit_vocab(token_rows(d.where("doc_id < 40"), ["doc_id"]))
    t = tokenize(d, v, ["doc_id"], add_eos=True)
    t = t.unionByName(t.where("doc_id = 5")).select("doc_id", "input_ids")
    t = t.unionByName(spark.createDataFrame([(900, None), (901, [2, None, -7])], t.schema))
    rows = lambda x: sorted(map(tuple, x.collect()))
    small, large = (detokenize(t, v, ["doc_id"], skip_special=skip, broadcast_max_rows=n) for n in (2_000_000, 20))
    assert rows(small) == rows(large)
    got = dict(rows(large))
    the = v.where("id = 2").first()["token"]
    assert got[900] == "" and got[901] == f"{the} <unk>" + ("" if skip else " <unk>")
    twice = [w for w in texts()[5].split() for _ in (0, 1)]
    seen = {r["token"] for r in v.collect()}
    assert got[5] == " ".join([w if w in seen else "<unk>" for w in twice] + ([] if skip else ["<|endoftext|>"] * 2))


def test_caller_codes_in_place(spark, monkeypatch):
    """L2 beyond the bound: the same codes, and no row per token; repeated and null keys as before."""
    fn = lambda t: [len(t), ord(t[-1])][: 0 if t == "of" else 2]
    d = docs_df(spark, texts())
    codes = lambda t: [x for w in t.split() for x in fn(w)]
    want = sorted((i, codes(t)) for i, t in enumerate(texts()))
    real = tk.head_and_tail
    for bound in (2_000_000, 20):
        monkeypatch.setattr(tk, "head_and_tail", lambda *a, n=bound, **k: real(*a, **(k | {"max_rows": n})))
        out = tk.tokenize_with(d, fn, ["doc_id"])
        assert sorted((r.doc_id, r.input_ids) for r in out.collect()) == want
        assert "explode" not in out._jdf.queryExecution().optimizedPlan().toString()
        odd = d.unionByName(spark.createDataFrame([(900, "a bb"), (900, "the"), (None, "the")], d.schema))
        got = sorted((r.doc_id, r.input_ids) for r in tk.tokenize_with(odd, fn, ["doc_id"]).where("doc_id >= 900 or doc_id is null").fillna(-1).collect())
        assert got == [(-1, []), *[(900, codes("a the bb"))] * 2]


def test_a_round_costs_its_own_merges(spark, monkeypatch):
    """No round replays the merges of the rounds before it."""
    calls, real = [], bpe.merged
    monkeypatch.setattr(bpe, "merged", lambda s, merges: calls.append(len(merges)) or real(s, merges))
    model = bpe.fit_bpe(spark.createDataFrame([(w,) for t in texts() for w in t.split()], "tok string"), 8)
    assert model.merges.count() == 8 and sum(calls) < 8 and all(calls)
