"""Count model (J1-J3), perplexity and report (B12, B13, A10), sampling and
generation (F3, F4, J4-J7, A9)."""

import math

import pytest
from pyspark.sql import functions as F

from lectern.operators import generate as gen
from lectern.operators import lm
from lectern.sources.sinks import metrics_report


@pytest.fixture(scope="module")
def model(spark):
    train = spark.createDataFrame([(0, "a b a c a b".split()), (1, "b a b".split())], "doc_id long, toks array<string>")
    return lm.fit_bigram(train, "toks"), train


def test_counts(model):
    m, _ = model
    big = {(r.prev, r.tok): r.c for r in m.bigram.collect()}
    assert big == {("a", "b"): 3, ("b", "a"): 2, ("a", "c"): 1, ("c", "a"): 1}
    assert (m.n_tokens, m.vocab_size) == (9, 3)


def test_probabilities_sum_to_one(spark, model):
    m, _ = model
    # every vocabulary token plus one unseen token after each context
    toks = ["a", "b", "c", "zz"]
    held = spark.createDataFrame([(i, [p, t]) for i, (p, t) in enumerate((p, t) for p in ["a", "b", "c", "q"] for t in toks)],
                                 "doc_id long, toks array<string>")
    s = lm.scored_pairs(m, held, "toks").withColumn("p", lm.prob(m, 0.5))
    tot = {r.prev: r.s for r in s.groupBy("prev").agg(F.sum("p").alias("s")).collect()}
    for prev, total in tot.items():
        assert abs(total - 1.0) < 1e-12, (prev, total)


def test_loss_and_perplexity(spark, model):
    m, train = model
    r = lm.eval_loss(m, train, "toks", 0.5).first()
    pairs = 7
    assert r.n_tokens == pairs and r.eval_loss > 0
    losses = lm.grid_losses(m, train, "toks", [0.1, 0.5, 0.9])
    best = lm.best_model(losses).first()
    assert best.model_id == 3                       # training data: trust the bigrams most
    kept = {r.model_id: r.reason for r in lm.retained_models(losses, 2).collect()}
    assert kept == {3: "best", 2: "recent"}


def test_report_two_decimals(spark):
    row = spark.createDataFrame([(0.5, 0.8)], "eval_loss double, other_metric double")
    lines = [r.line for r in metrics_report(row, "eval_loss", {"eval_loss": "%s", "other_metric": "%s"})
             .orderBy("line_no").collect()]
    assert lines == ["Evaluation Results:", "eval_loss: 0.5", "other_metric: 0.8", "Perplexity: 1.65"]
    assert f"{math.exp(0.5):.2f}" == "1.65"


def test_warpers(spark):
    probs = spark.createDataFrame([("x", "a", 0.5), ("x", "b", 0.3), ("x", "c", 0.15), ("x", "d", 0.05)],
                                  "prev string, tok string, p double")
    k = gen.top_k(probs, 3)
    assert sorted(r.tok for r in k.collect()) == ["a", "b", "c"]
    t = {r.tok: r.p for r in gen.temperature(k, 1.0).collect()}
    assert abs(t["a"] - 0.5 / 0.95) < 1e-12
    p = {r.tok for r in gen.top_p(gen.temperature(k, 1.0), 0.6).collect()}
    assert p == {"a", "b"}                          # mass above "b" is 0.526 < 0.6
    cold = {r.tok: r.p for r in gen.temperature(k, 0.1).collect()}
    assert cold["a"] > 0.99


def test_generation(spark, model):
    m, _ = model
    prompts = spark.createDataFrame([(1, "c"), (2, "unseen word")], "prompt_id long, prompt string")
    greedy = {r.prompt_id: r.generated_text for r in gen.generate(m, prompts, max_new_tokens=4, k=1).collect()}
    assert greedy[1] == "c a b a b"
    assert greedy[2] == "unseen word a b a b"       # back-off to the most frequent token
    out = gen.generate(m, prompts, max_new_tokens=12, num_return_sequences=3, k=50, t=0.7, p=0.9,
                       checkpoint_every=5)
    rows = out.collect()
    assert len(rows) == 6 and all(len(r.generated_text.split()) == len(r.prompt.split()) + 12 for r in rows)
    again = {(r.prompt_id, r.seq_no): r.generated_text
             for r in gen.generate(m, prompts.repartition(3), max_new_tokens=12, num_return_sequences=3,
                                   k=50, t=0.7, p=0.9).collect()}
    assert again == {(r.prompt_id, r.seq_no): r.generated_text for r in rows}
    salted = {(r.prompt_id, r.seq_no): r.generated_text
              for r in gen.generate(m, prompts, max_new_tokens=12, num_return_sequences=3, k=50,
                                    t=0.7, p=0.9, broadcast_max_rows=0).collect()}
    assert salted == again                          # shuffled, salted lookup path
    capped = gen.generate(m, prompts, max_new_tokens=None, max_length=3, k=1).collect()
    assert {r.prompt_id: len(r.generated_text.split()) for r in capped} == {1: 3, 2: 3}
    blocks = {r.prompt_id: r.block for r in gen.render_samples(out).collect()}
    assert blocks[1].startswith("Prompt: c\nGenerated Text 1:\n") and "Generated Text 3:" in blocks[1]
    assert blocks[1].count("Prompt: ") == 1
    single = {r.prompt_id: r.block for r in gen.render_samples(out, per_prompt_header=False).collect()}
    assert single[1].count("Prompt: c\nGenerated Text ") == 3 and single[1].endswith("\n\n")


def test_saved_model_scores_alike(spark, model, tmp_path):
    m, train = model
    back = lm.load_model(spark, lm.save_model(m, str(tmp_path / "m")))
    assert back.totals == m.totals
    loss = lambda x: lm.eval_loss(x, train, "toks", 0.3).first()
    assert loss(back) == loss(m)


def test_tables_are_counted_when_asked(spark):
    m = lm.fit_bigram(spark.createDataFrame([(["a", "b", "a"],)], "toks array<string>"), "toks")
    assert m.bigram.count() == 2
    assert "bigram" in m.__dict__ and not {"context", "unigram", "totals"} & set(m.__dict__)


@pytest.mark.parametrize("k", [3, 1500])
def test_top_k_of_a_hot_context(spark, k):
    """Above the group-limit threshold a context of 6,000 successors is ranked by slices."""
    probs = spark.range(6000).select(F.lit("").alias("prev"), F.concat(F.lit("t"), "id").alias("tok"),
                                     (F.col("id") % 700 / 1e7).alias("p")).union(
        spark.createDataFrame([("x", "a", 0.5)], "prev string, tok string, p double"))
    got = gen.top_k(probs.repartition(4), k)
    want = sorted(((i % 700 / 1e7, f"t{i}") for i in range(6000)), key=lambda r: (-r[0], r[1]))[:k]
    rows = sorted((r.rank, r.tok) for r in got.where("prev = ''").collect())
    assert rows == [(i + 1, t) for i, (_, t) in enumerate(want)]
    assert got.where("prev = 'x'").count() == 1
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("_part" in plan) == (k > 1000) and ("WindowGroupLimit" in plan) == (k <= 1000)


def test_candidate_size_counts_bytes(spark):
    """Long junk tokens weigh what they are."""
    rows = spark.createDataFrame([([(1, "x" * 1600, 1.0)],), ([(1, "y", 1.0)],)],
                                 "cands array<struct<rank:int,tok:string,cdf:double>>")
    assert [r[0] for r in rows.select(gen.candidate_cells("cands")).collect()] == [103, 4]


def test_em_weight_falls_to_the_best_weight(spark):
    """The loss never rises, ends at or below the grid's best, and one pair table serves all rounds."""
    import random
    r = random.Random(8)
    words = ["a", "b", "c", "d", "e"]
    rows = [(i, [r.choice(words[:1 + i % 5]) for _ in range(r.randint(0, 12))] + (["new"] if i % 9 == 0 else [])) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id bigint, toks array<string>")
    model = lm.fit_bigram(df.where("doc_id < 60"), "toks")
    held = df.where("doc_id >= 60")
    steps = lm.em_weight(model, held, "toks", rounds=150).orderBy("round").collect()
    assert len(steps) == 151 and all(b.eval_loss <= a.eval_loss + 1e-12 for a, b in zip(steps, steps[1:]))
    grid = lm.grid_losses(model, held, "toks", [i / 10 for i in range(1, 10)]).collect()
    assert steps[-1].eval_loss <= min(g.eval_loss for g in grid) + 1e-6
    assert lm.em_weight(model, held.where("false"), "toks").count() == 0
