"""Count-based language model as MapReduce-style aggregation (J1-J3, E4, E5, E8,
F5, F6, D6, B12).

The reference fine-tunes and evaluates a neural model; the data side of those
verbs over a bigram model with interpolation is plain grouping and joining.
Losses are comparable only within this engine.

    p(tok | prev) = lam * c(prev, tok) / c(prev) + (1 - lam) * (c(tok) + 1) / (N + V + 1)

and, when ``prev`` was never seen as a context, only the second term, so that
probabilities sum to one over the vocabulary plus one unknown class.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import BROADCAST_MAX_CELLS, BROADCAST_MAX_ROWS, lookup, string_cells, table_size


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def next_token_pairs(df: DataFrame, tokens_col: str) -> DataFrame:
    """``prev, tok`` for every adjacent pair inside each row's token array.

    Built narrowly from the row's own array (no window over documents, so a
    huge document is not one window partition); the first token has no
    predecessor and is not a target.
    """
    t = F.col(tokens_col)
    n = F.size(t)
    pairs = F.when(n >= 2, F.arrays_zip(F.slice(t, 1, n - 1).alias("prev"),
                                        F.slice(t, 2, n - 1).alias("tok")))
    return df.select(F.inline(pairs))


def pair_counts(df: DataFrame, tokens_col: str) -> DataFrame:
    """``prev, tok, c``. Partial aggregation runs map-side, so a hot pair is
    summed before the shuffle."""
    return next_token_pairs(df, tokens_col).groupBy("prev", "tok").agg(
        F.count(F.lit(1)).alias("c"))


class BigramModel:
    """The three count tables and two scalars of a bigram model.

    A table is computed when it is first asked for and written to the shared
    checkpoint folder then (the fitted model), so a caller that needs only bigram
    counts never counts contexts; sizes for the lookups are measured the same way.
    """

    def __init__(self, pairs: DataFrame | None = None, tokens: DataFrame | None = None, *,
                 bigram: DataFrame | None = None, context: DataFrame | None = None,
                 unigram: DataFrame | None = None, totals: tuple[int, int] | None = None):
        """From training ``pairs`` (prev, tok) and ``tokens`` (tok), or from finished tables."""
        self._pairs, self._tokens = pairs, tokens
        for name, value in (("bigram", bigram), ("context", context), ("unigram", unigram), ("totals", totals)):
            if value is not None:
                self.__dict__[name] = value

    @cached_property
    def bigram(self) -> DataFrame:
        """``prev, tok, c``."""
        return cut_lineage(self._pairs.groupBy("prev", "tok").agg(F.count(F.lit(1)).alias("c")))

    @cached_property
    def context(self) -> DataFrame:
        """``prev, c_prev``."""
        return cut_lineage(self.bigram.groupBy("prev").agg(F.sum("c").alias("c_prev")))

    @cached_property
    def unigram(self) -> DataFrame:
        """``tok, c_tok``."""
        return cut_lineage(self._tokens.groupBy("tok").agg(F.count(F.lit(1)).alias("c_tok")))

    @cached_property
    def totals(self) -> tuple[int, int]:
        """N and V."""
        row = self.unigram.agg(F.sum("c_tok").alias("n"), F.count(F.lit(1)).alias("v")).first()
        return int(row["n"] or 0), int(row["v"] or 0)

    @property
    def n_tokens(self) -> int:
        return self.totals[0]

    @property
    def vocab_size(self) -> int:
        return self.totals[1]

    @cached_property
    def context_size(self) -> tuple[int, int]:
        return table_size(self.context, string_cells("prev"))

    @cached_property
    def unigram_size(self) -> tuple[int, int]:
        return table_size(self.unigram, string_cells("tok"))


def fit_bigram(train: DataFrame, tokens_col: str) -> BigramModel:
    """The model of the training rows; its tables are counted when first used."""
    return BigramModel(next_token_pairs(train, tokens_col), train.select(F.explode(tokens_col).alias("tok")))


def save_model(model: BigramModel, path: str) -> str:
    """The model as tables below ``path``: bigram, context, unigram, totals."""
    root = path.rstrip("/")
    for name in ("bigram", "context", "unigram"):
        getattr(model, name).write.mode("overwrite").parquet(f"{root}/{name}")
    n, v = model.totals
    model.unigram.sparkSession.range(1).select(F.lit(n).cast("long").alias("n_tokens"), F.lit(v).cast("long").alias(
        "vocab_size")).write.mode("overwrite").parquet(f"{root}/totals")
    return path


def load_model(spark: SparkSession, path: str) -> BigramModel:
    """A model written by ``save_model``."""
    root = path.rstrip("/")
    t = spark.read.parquet(f"{root}/totals").first()
    return BigramModel(**{name: spark.read.parquet(f"{root}/{name}") for name in ("bigram", "context", "unigram")},
                       totals=(t["n_tokens"], t["vocab_size"]))


def scored_pairs(model: BigramModel, held_out: DataFrame, tokens_col: str) -> DataFrame:
    """Validation pairs, pre-aggregated to ``prev, tok, n`` before the three
    lookups (a frequent ``prev`` is then one row per distinct successor, not one
    per occurrence), with their counts under the model."""
    val = pair_counts(held_out, tokens_col).withColumnRenamed("c", "n")
    # (prev, tok) is unique on both sides: a plain shuffled join has no hot key.
    # The context and unigram lookups have hot keys on the validation side: large tables
    # are cut by count, and the pairs are written once, as each part reads them.
    j = val.join(model.bigram, ["prev", "tok"], "left")
    if any(size > bound for t in (model.context_size, model.unigram_size)
           for size, bound in zip(t, (BROADCAST_MAX_ROWS, BROADCAST_MAX_CELLS))):
        j = cut_lineage(j)
    j = lookup(j, model.context, ["prev"], "left", small_size=model.context_size, count_col="c_prev")
    return lookup(j, model.unigram, ["tok"], "left", small_size=model.unigram_size, count_col="c_tok")


def prob(model: BigramModel, lam) -> Column:
    uni = (F.coalesce("c_tok", F.lit(0)) + 1) / F.lit(float(model.n_tokens + model.vocab_size + 1))
    big = F.coalesce("c", F.lit(0)) / F.col("c_prev")
    lam = _c(lam) if not isinstance(lam, (int, float)) else F.lit(float(lam))
    return F.when(F.col("c_prev").isNull(), uni).otherwise(lam * big + (1 - lam) * uni)


def eval_loss(model: BigramModel, held_out: DataFrame, tokens_col: str, lam: float = 0.5) -> DataFrame:
    """One row ``n_tokens, eval_loss`` (mean negative log-likelihood)."""
    s = scored_pairs(model, held_out, tokens_col)
    return s.agg(F.sum("n").cast("long").alias("n_tokens"),
                 (F.sum(F.col("n") * -F.log(prob(model, lam))) / F.sum("n")).alias("eval_loss"))


def grid_losses(model: BigramModel, held_out: DataFrame, tokens_col: str,
                lams: Sequence[float]) -> DataFrame:
    """Every lambda of the grid scored in one pass over the validation pairs.
    ``model_id`` is the 1-based grid position (later = newer checkpoint)."""
    s = scored_pairs(model, held_out, tokens_col)
    sums = s.agg(F.sum("n").alias("_n"), *[F.sum(F.col("n") * -F.log(prob(model, x))).alias(f"_s{i}")
                                           for i, x in enumerate(lams)]).where("_n IS NOT NULL")
    grid = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("model_id"), F.lit(float(x)).alias("lam"),
                                        (F.col(f"_s{i}") / F.col("_n")).alias("eval_loss")) for i, x in enumerate(lams)]))
    return sums.select(grid.alias("_g")).select("_g.*")


def em_weight(model: BigramModel, held_out: DataFrame, tokens_col: str, start: float = 0.5, rounds: int = 30,
              tolerance: float | None = None) -> DataFrame:
    """J3 as an iterative fit: ``round, lam, eval_loss`` of expectation maximisation for the weight.

    A round's sufficient statistic is the expected share of held-out pairs that the bigram
    term explains; pairs whose context was never seen do not depend on the weight. The terms
    are written once, with one row per distinct pair, and a round is one aggregate over them. The loss
    never rises, and its only optimum is the best weight. Stops early once the weight moves
    by less than ``tolerance``. No held-out pairs give no rows.
    """
    seen = F.when(F.col("c_prev").isNotNull(), F.coalesce("c", F.lit(0)) / F.col("c_prev"))
    uni = (F.coalesce("c_tok", F.lit(0)) + 1) / F.lit(float(model.n_tokens + model.vocab_size + 1))
    terms = cut_lineage(scored_pairs(model, held_out, tokens_col).select("n", seen.alias("seen"), uni.alias("uni")))
    steps, lam = [], float(start)
    for i in range(rounds + 1):
        mixed = lam * F.col("seen") + (1 - lam) * F.col("uni")
        r = terms.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("seen").isNotNull(), F.col("n"))).alias("known"),
                      F.sum(F.col("n") * lam * F.col("seen") / mixed).alias("share"),
                      F.sum(F.col("n") * -F.log(F.coalesce(mixed, F.col("uni")))).alias("loss")).first()
        if not r["n"]:
            break
        steps.append((i, lam, r["loss"] / r["n"]))
        after = r["share"] / r["known"] if r["known"] else lam
        if tolerance is not None and abs(after - lam) < tolerance:
            break
        lam = after
    return held_out.sparkSession.createDataFrame(steps, "round int, lam double, eval_loss double")


def best_model(losses: DataFrame) -> DataFrame:
    """E5: the lowest ``eval_loss`` (ties: lower model_id), via ``min_by``."""
    return losses.agg(F.min_by(F.struct("model_id", "lam", "eval_loss"),
                               F.struct("eval_loss", "model_id")).alias("b")).select("b.*")


def retained_models(losses: DataFrame, keep_last: int = 2) -> DataFrame:
    """the newest ``keep_last`` checkpoints plus the best one."""
    w_new = Window.orderBy(F.col("model_id").desc())   # one row per checkpoint: small
    w_best = Window.orderBy("eval_loss", "model_id")
    r = losses.select("*", F.row_number().over(w_new).alias("_new"),
                      F.row_number().over(w_best).alias("_best"))
    return r.where((F.col("_new") <= keep_last) | (F.col("_best") == 1)).select(
        "model_id", "lam", "eval_loss",
        F.when(F.col("_best") == 1, F.lit("best")).otherwise(F.lit("recent")).alias("reason"))


def perplexity(loss_col) -> Column:
    """``exp(eval_loss)``."""
    return F.exp(_c(loss_col))
