"""Registered model queries: fit, evaluate, select, sample, generate, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import generate as gen
from ..operators import lm
from ..operators.split import split_exact
from ..operators.tokenize import pretokens
from ..session import cut_lineage
from ..sources.sinks import metrics_report
from . import oracle as o
from .inputs import table
from .q_corpus import SEED, cleaned_documents
from .registry import register

LAM = 0.5
GRID = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
TOP_K, TEMP, TOP_P = 50, 0.7, 0.9       # the shipped generation config
MAX_LENGTH = 100          # prompt and new tokens together, as the shipped config has it


def doc_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned documents with their whitespace tokens and a 10 % exact split,
    written once to the checkpoint folder: the fit and the evaluation both read
    it. The split's own passes re-derive the (cheap, narrow) cleaning rather than
    writing the token table twice; measured faster than materialising both."""
    d = cleaned_documents(spark, sf).select("doc_id", pretokens("text").alias("toks"))
    return cut_lineage(split_exact(d, ["doc_id"], 0.1, SEED))


def fitted(spark: SparkSession, sf: str) -> tuple[lm.BigramModel, DataFrame]:
    s = doc_tokens(spark, sf)
    model = lm.fit_bigram(s.where(F.col("split") == "train"), "toks")
    return model, s.where(F.col("split") == "validation")


def prompts(spark: SparkSession, sf: str) -> DataFrame:
    """Prompt table: every benchmark item, cleaned, blanks dropped."""
    b = table(spark, sf, "benchmark")
    return b.select(F.col("item_id").alias("prompt_id"), tx.clean_text("text").alias("prompt")) \
        .where(F.col("prompt") != "")


# --------------------------------------------------------------------------- SQL

MODEL_SQL = o.corpus_ctes() + f""",
dr AS (SELECT doc_id, row_number() OVER (ORDER BY {o.md5key(SEED, 'doc_id')}, doc_id) - 1 AS r,
              count(*) OVER () AS n, {o.ws_tokens('text')} AS l FROM cdocs),
ds AS (SELECT doc_id, l, {o.split_label()} AS split FROM dr),
prs AS (SELECT split, l[i] AS prev, l[i + 1] AS tok
        FROM (SELECT split, l, unnest(range(1, len(l))) AS i FROM ds)),
bigram AS (SELECT prev, tok, count(*) AS c FROM prs WHERE split = 'train' GROUP BY ALL),
ctx AS (SELECT prev, sum(c) AS c_prev FROM bigram GROUP BY prev),
uni AS (SELECT tok, count(*) AS c_tok FROM (SELECT unnest(l) AS tok FROM ds WHERE split = 'train')
        GROUP BY tok),
nv AS (SELECT sum(c_tok) AS big_n, count(*) AS big_v FROM uni),
vp AS (SELECT prev, tok, count(*) AS n FROM prs WHERE split = 'validation' GROUP BY ALL),
sc AS (SELECT vp.n, b.c, x.c_prev, u.c_tok FROM vp LEFT JOIN bigram b USING (prev, tok)
       LEFT JOIN ctx x USING (prev) LEFT JOIN uni u USING (tok))"""


def p_sql(lam: str) -> str:
    uni = "((coalesce(c_tok, 0) + 1) / CAST((SELECT big_n + big_v + 1 FROM nv) AS DOUBLE))"
    return (f"(CASE WHEN c_prev IS NULL THEN {uni} ELSE "
            f"{lam} * (coalesce(c, 0) / CAST(c_prev AS DOUBLE)) + (1 - {lam}) * {uni} END)")


LOSS_SQL = MODEL_SQL + f""",
loss AS (SELECT CAST(sum(n) AS BIGINT) AS n_tokens,
                sum(n * -ln({p_sql('CAST(0.5 AS DOUBLE)')})) / sum(n) AS eval_loss FROM sc)"""

GRID_SQL = MODEL_SQL + """,
grid AS (SELECT * FROM (VALUES """ + ", ".join(f"({i + 1}, CAST({x!r} AS DOUBLE))"
                                                for i, x in enumerate(GRID)) + f""") AS g(model_id, lam)),
losses AS (SELECT model_id, lam, sum(n * -ln({p_sql('lam')})) / sum(n) AS eval_loss
           FROM sc, grid GROUP BY model_id, lam)"""

INV_T = repr(1.0 / TEMP)
CANDS_SQL = MODEL_SQL + f""",
probs AS (SELECT b.prev, b.tok, b.c / CAST(x.c_prev AS DOUBLE) AS p FROM bigram b JOIN ctx x USING (prev)
          UNION ALL SELECT '' AS prev, tok, c_tok / CAST((SELECT big_n FROM nv) AS DOUBLE) FROM uni),
topk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY prev ORDER BY p DESC, tok) AS rank
                        FROM probs) WHERE rank <= {TOP_K}),
temp AS (SELECT prev, tok, rank, pow(p, CAST({INV_T} AS DOUBLE)) / sum(pow(p, CAST({INV_T} AS DOUBLE)))
                OVER (PARTITION BY prev) AS p FROM topk),
nuc0 AS (SELECT *, coalesce(sum(p) OVER (PARTITION BY prev ORDER BY rank
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM temp),
nuc AS (SELECT prev, tok, rank, p / sum(p) OVER (PARTITION BY prev) AS p FROM nuc0
        WHERE before < {TOP_P}),
cdfs AS (SELECT *, sum(p) OVER (PARTITION BY prev ORDER BY rank
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cdf FROM nuc)"""

PROMPTS_SQL = f"""
pr AS (SELECT item_id AS prompt_id, {o.clean('text')} AS prompt FROM benchmark),
prompts AS (SELECT prompt_id, prompt, {o.ws_tokens('prompt')} AS pl FROM pr WHERE prompt <> '')"""

GREEDY_SQL = "WITH RECURSIVE " + MODEL_SQL + ", " + PROMPTS_SQL + f""",
best AS (SELECT prev, tok FROM (SELECT prev, tok, row_number() OVER (PARTITION BY prev
           ORDER BY c / CAST(c_prev AS DOUBLE) DESC, tok) AS rn FROM bigram JOIN ctx USING (prev))
         WHERE rn = 1),
bo AS (SELECT tok FROM uni ORDER BY c_tok DESC, tok LIMIT 1),
g(prompt_id, seq_no, step, lim, last, new) AS (
  SELECT prompt_id, 1, 0, greatest({MAX_LENGTH} - len(pl), 0), coalesce(pl[-1], ''), []::VARCHAR[] FROM prompts
  UNION ALL
  SELECT g.prompt_id, g.seq_no, g.step + 1, g.lim, coalesce(b.tok, (SELECT tok FROM bo)),
         list_append(g.new, coalesce(b.tok, (SELECT tok FROM bo)))
  FROM g LEFT JOIN best b ON b.prev = g.last WHERE g.step < g.lim),
samples AS (SELECT g.prompt_id, g.seq_no, p.prompt,
                   CASE WHEN len(g.new) > 0 THEN p.prompt || ' ' || array_to_string(g.new, ' ')
                        ELSE p.prompt END AS generated_text
            FROM g JOIN prompts p USING (prompt_id) WHERE g.step = g.lim)"""


# ------------------------------------------------------------------ fit and evaluate

@register("bigram_counts", "WITH " + MODEL_SQL + " SELECT prev, tok, CAST(c AS BIGINT) AS c FROM bigram")
def q_bigram_counts(spark, sf):
    m, _ = fitted(spark, sf)
    return m.bigram.select("prev", "tok", F.col("c").cast("long").alias("c"))


@register("eval_loss", "WITH " + LOSS_SQL + " SELECT n_tokens, round(eval_loss, 6) AS eval_loss FROM loss")
def q_eval_loss(spark, sf):
    m, val = fitted(spark, sf)
    r = lm.eval_loss(m, val, "toks", LAM)
    return r.select("n_tokens", F.round("eval_loss", 6).alias("eval_loss"))


@register("perplexity", "WITH " + LOSS_SQL + """
SELECT 'eval_loss' AS metric, round(eval_loss, 6) AS value FROM loss
UNION ALL SELECT 'perplexity', round(exp(eval_loss), 2) FROM loss""")
def q_perplexity(spark, sf):
    m, val = fitted(spark, sf)
    r = lm.eval_loss(m, val, "toks", LAM)
    return r.select(F.explode(F.array(
        F.struct(F.lit("eval_loss").alias("metric"), F.round("eval_loss", 6).alias("value")),
        F.struct(F.lit("perplexity").alias("metric"),
                 F.round(lm.perplexity("eval_loss"), 2).alias("value")))).alias("m")).select("m.*")


@register("best_model", "WITH " + GRID_SQL + """
SELECT model_id, lam, round(eval_loss, 6) AS eval_loss FROM losses
ORDER BY eval_loss, model_id LIMIT 1""")
def q_best_model(spark, sf):
    m, val = fitted(spark, sf)
    b = lm.best_model(lm.grid_losses(m, val, "toks", GRID))
    return b.select(F.col("model_id").cast("int").alias("model_id"), "lam",
                    F.round("eval_loss", 6).alias("eval_loss"))


EM_ROUNDS = 20
_EM_STEPS = "".join(f""",
e{i} AS MATERIALIZED (SELECT coalesce(sum(n * lam * seen / (lam * seen + (1 - lam) * uni)) / sum(n), any_value(lam)) AS lam
  FROM terms, e{i - 1} WHERE seen IS NOT NULL)""" for i in range(1, EM_ROUNDS + 1))
_EM_ROWS = " UNION ALL ".join(f"SELECT {i} AS round, lam FROM e{i}" for i in range(EM_ROUNDS + 1))
EM_SQL = MODEL_SQL + f""",
terms AS MATERIALIZED (SELECT n, CASE WHEN c_prev IS NOT NULL THEN coalesce(c, 0) / CAST(c_prev AS DOUBLE) END AS seen,
  (coalesce(c_tok, 0) + 1) / CAST((SELECT big_n + big_v + 1 FROM nv) AS DOUBLE) AS uni FROM sc),
e0 AS (SELECT CAST(0.5 AS DOUBLE) AS lam){_EM_STEPS},
em AS ({_EM_ROWS})"""


@register("em_weight", "WITH " + EM_SQL + """
SELECT CAST(round AS INTEGER) AS round, round(any_value(lam), 6) AS lam,
       round(sum(n * -ln(CASE WHEN seen IS NULL THEN uni ELSE lam * seen + (1 - lam) * uni END)) / sum(n), 6) AS eval_loss
FROM em, terms GROUP BY round""")
def q_em_weight(spark, sf):
    """The interpolation weight by expectation maximisation, round by round."""
    m, val = fitted(spark, sf)
    r = lm.em_weight(m, val, "toks", LAM, EM_ROUNDS)
    return r.select("round", F.round("lam", 6).alias("lam"), F.round("eval_loss", 6).alias("eval_loss"))


@register("retained_models", "WITH " + GRID_SQL + """,
r AS (SELECT *, row_number() OVER (ORDER BY model_id DESC) AS nw,
             row_number() OVER (ORDER BY eval_loss, model_id) AS bt FROM losses)
SELECT model_id, lam, round(eval_loss, 6) AS eval_loss,
       CASE WHEN bt = 1 THEN 'best' ELSE 'recent' END AS reason FROM r WHERE nw <= 2 OR bt = 1""")
def q_retained_models(spark, sf):
    m, val = fitted(spark, sf)
    r = lm.retained_models(lm.grid_losses(m, val, "toks", GRID), 2)
    return r.select(F.col("model_id").cast("int").alias("model_id"), "lam",
                    F.round("eval_loss", 6).alias("eval_loss"), "reason")


@register("eval_report", "WITH " + LOSS_SQL + """
SELECT * FROM (VALUES (1, 'Evaluation Results:')) AS t(line_no, line)
UNION ALL SELECT 2, 'eval_loss: ' || printf('%.6f', eval_loss) FROM loss
UNION ALL SELECT 3, 'eval_tokens: ' || CAST(n_tokens AS VARCHAR) FROM loss
UNION ALL SELECT 4, 'Perplexity: ' || printf('%.2f', exp(eval_loss)) FROM loss""")
def q_eval_report(spark, sf):
    m, val = fitted(spark, sf)
    r = lm.eval_loss(m, val, "toks", LAM)
    return metrics_report(r, "eval_loss", {"eval_loss": "%.6f", "eval_tokens": "%d"},
                          {"eval_tokens": "n_tokens"})


# ------------------------------------------------------------------ sampling

@register("top_k", "WITH " + CANDS_SQL + " SELECT prev, tok, CAST(rank AS INTEGER) AS rank FROM topk")
def q_top_k(spark, sf):
    m, _ = fitted(spark, sf)
    return gen.top_k(gen.next_token_probs(m), TOP_K).select("prev", "tok", "rank")


@register("temperature", "WITH " + CANDS_SQL + """
SELECT prev, tok, CAST(rank AS INTEGER) AS rank, round(p, 6) AS p FROM temp""")
def q_temperature(spark, sf):
    m, _ = fitted(spark, sf)
    c = gen.temperature(gen.top_k(gen.next_token_probs(m), TOP_K), TEMP)
    return c.select("prev", "tok", "rank", F.round("p", 6).alias("p"))


@register("top_p", "WITH " + CANDS_SQL + """
SELECT prev, tok, CAST(rank AS INTEGER) AS rank, round(p, 6) AS p FROM nuc""")
def q_top_p(spark, sf):
    m, _ = fitted(spark, sf)
    c = gen.top_p(gen.temperature(gen.top_k(gen.next_token_probs(m), TOP_K), TEMP), TOP_P)
    return c.select("prev", "tok", "rank", F.round("p", 6).alias("p"))


@register("sample_next", "WITH " + CANDS_SQL + ", " + PROMPTS_SQL + f""",
arr AS (SELECT prev, list(struct_pack(rank := rank, tok := tok, cdf := cdf) ORDER BY rank) AS cands
        FROM cdfs GROUP BY prev),
st AS (SELECT prompt_id, seq_no, coalesce(pl[-1], '') AS last FROM prompts, range(1, 3) s(seq_no)),
j AS (SELECT st.*, coalesce(a.cands, (SELECT cands FROM arr WHERE prev = '')) AS cands,
             {o.uniform01(SEED, 'prompt_id', 'seq_no', '0')} AS u
      FROM st LEFT JOIN arr a ON a.prev = st.last AND st.last <> '')
SELECT prompt_id, CAST(seq_no AS INTEGER) AS seq_no,
       coalesce(list_filter(cands, lambda c: c.cdf > u)[1], cands[-1]).tok AS tok FROM j""")
def q_sample_next(spark, sf):
    """One draw per (prompt, sequence) from each prompt's last token: two sequences."""
    m, _ = fitted(spark, sf)
    out = gen.generate(m, prompts(spark, sf), max_new_tokens=1, num_return_sequences=2,
                       k=TOP_K, t=TEMP, p=TOP_P, seed=SEED)
    return out.select("prompt_id", F.col("seq_no").cast("int").alias("seq_no"),
                      F.try_element_at(F.split("generated_text", " "), F.lit(-1)).alias("tok"))


# ------------------------------------------------------------------ generation

@register("generate_greedy", GREEDY_SQL + """
SELECT prompt_id, CAST(seq_no AS INTEGER) AS seq_no, prompt, generated_text FROM samples""")
def q_generate_greedy(spark, sf):
    m, _ = fitted(spark, sf)
    out = gen.generate(m, prompts(spark, sf), max_new_tokens=None, max_length=MAX_LENGTH, k=1, seed=SEED)
    return out.select("prompt_id", F.col("seq_no").cast("int").alias("seq_no"), "prompt",
                      "generated_text")


SAMPLED_SQL = "WITH RECURSIVE " + CANDS_SQL + ", " + PROMPTS_SQL + f""",
arr AS (SELECT prev, list(struct_pack(rank := rank, tok := tok, cdf := cdf) ORDER BY rank) AS cands
        FROM cdfs GROUP BY prev),
g(prompt_id, seq_no, step, lim, last, new) AS (
  SELECT prompt_id, seq_no, 0, greatest({MAX_LENGTH} - len(pl), 0), coalesce(pl[-1], ''), []::VARCHAR[]
  FROM prompts, range(1, 3) s(seq_no)
  UNION ALL
  SELECT prompt_id, seq_no, step + 1, lim, nx, list_append(new, nx) FROM (
    SELECT x.*, coalesce(list_filter(x.c, lambda e: e.cdf > x.u)[1], x.c[-1]).tok AS nx FROM (
      SELECT g.prompt_id, g.seq_no, g.step, g.lim, g.new,
             coalesce(a.cands, (SELECT cands FROM arr WHERE prev = '')) AS c,
             {o.uniform01(SEED, 'g.prompt_id', 'g.seq_no', 'g.step')} AS u
      FROM g LEFT JOIN arr a ON a.prev = g.last AND g.last <> '' WHERE g.step < g.lim) x))
SELECT g.prompt_id, CAST(g.seq_no AS INTEGER) AS seq_no, p.prompt,
       CASE WHEN len(g.new) > 0 THEN p.prompt || ' ' || array_to_string(g.new, ' ') ELSE p.prompt END
         AS generated_text
FROM g JOIN prompts p USING (prompt_id) WHERE g.step = g.lim"""


@register("generate_sampled", SAMPLED_SQL)
def q_generate_sampled(spark, sf):
    """Sampled generation with the shipped settings, two sequences per prompt."""
    m, _ = fitted(spark, sf)
    out = gen.generate(m, prompts(spark, sf), max_new_tokens=None, max_length=MAX_LENGTH, num_return_sequences=2,
                       k=TOP_K, t=TEMP, p=TOP_P, seed=SEED)
    return out.select("prompt_id", F.col("seq_no").cast("int").alias("seq_no"), "prompt",
                      "generated_text")


@register("render_samples", GREEDY_SQL + """
SELECT prompt_id, 'Prompt: ' || prompt || chr(10) || 'Generated Text ' || CAST(seq_no AS VARCHAR)
       || ':' || chr(10) || generated_text || chr(10) || chr(10) AS block FROM samples""")
def q_render_samples(spark, sf):
    m, _ = fitted(spark, sf)
    out = gen.generate(m, prompts(spark, sf), max_new_tokens=None, max_length=MAX_LENGTH, k=1, seed=SEED)
    return gen.render_samples(out, "prompt_id", per_prompt_header=True)
