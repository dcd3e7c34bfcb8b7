"""Models beyond the broadcast bounds: same rows as within them, and no work that grows with
the table per step."""

import pytest
from pyspark.sql import functions as F

from lectern.operators import generate as gen
from lectern.operators import joins, lm
from test_large_tables import texts


def model_of(spark):
    return lm.fit_bigram(spark.createDataFrame([(t.split(),) for t in texts()], "toks array<string>"), "toks")


def test_samples_in_rounds(spark):
    """A candidate table over the bound: rows walk over the head and fetch what they wait for;
    the samples are those of one pass."""
    prompts = spark.createDataFrame([(i, p) for i, p in enumerate(["the", "w5 of", "unseen", "rare1", "rare2", "", "w9 w10"])], "prompt_id bigint, prompt string")
    m = model_of(spark)
    run = lambda n: sorted(gen.generate(m, prompts, max_new_tokens=None, max_length=14, num_return_sequences=2, k=6, t=0.9,
                                        p=0.9, walk_bytes=n).collect())
    whole = run(gen.WALK_BYTES)
    assert any(len(r.generated_text.split()) == 14 for r in whole)
    assert run(4000) == whole          # head and fetches
    assert run(300) == whole           # fetches over the bound: steps by join
    assert run(0) == whole


def test_lookup_cut_by_count(spark):
    """No row of either table is copied: the frequent keys are broadcast, the rest joined once."""
    big = spark.createDataFrame([(k, i) for i, k in enumerate("aaaaabbbcde")] + [(None, 99), ("zz", 98)], "k string, i int")
    small = big.where("k < 'z'").groupBy("k").agg(F.count(F.lit(1)).alias("c"))
    for how in ("left", "inner"):
        want = sorted(map(str, big.join(small, "k", how).collect()))
        cut = joins.lookup(big, small, ["k"], how, broadcast_max_rows=4, count_col="c")
        assert sorted(map(str, cut.collect())) == want
        assert "_salt" not in cut._jdf.queryExecution().optimizedPlan().toString()


def test_losses_beyond_the_bounds(spark, monkeypatch):
    held = spark.createDataFrame([(t.split(),) for t in texts()[:9]] + [(["new", "the", "new"],)], "toks array<string>")
    m = model_of(spark)
    grid = lambda: [(r.model_id, r.lam, pytest.approx(r.eval_loss)) for r in lm.grid_losses(m, held, "toks", [0.2, 0.7]).orderBy("model_id").collect()]
    want = grid()
    single = [lm.eval_loss(m, held, "toks", x).first()["eval_loss"] for x in (0.2, 0.7)]
    assert [w[2] for w in want] == single
    assert lm.grid_losses(m, held.where("false"), "toks", [0.2]).count() == 0
    for module in (joins, lm):
        monkeypatch.setattr(module, "BROADCAST_MAX_ROWS", 8)
    monkeypatch.setattr(lm, "lookup", lambda *a, **k: joins.lookup(*a, **(k | {"broadcast_max_rows": 8})))
    assert grid() == want
