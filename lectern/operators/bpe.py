"""Byte-pair vocabulary trained as Spark jobs (I1, I2: a subword tokenizer without a pretrained one).

Words are counted once; training then works on distinct words. A word is a blank mark and
its characters, each symbol between two delimiters, so applying a merge is a string
replacement from left to right. Pair counts are a table that every round changes only by
the words in which a merged pair occurs: their old pairs are subtracted, their new ones added.

A round takes several merges where that provably equals taking them one by one. In order of
count, a pair joins the round if it shares no neighbouring symbol with the pairs already
taken (its own count cannot change) and its count exceeds that of any pair those merges can
create: a new pair ``(x, ab)`` is at most as frequent as ``(x, a)``, and ``(ab, y)`` as ``(b, y)``.
So the merges are those of the plain sequential algorithm, ties by symbol.

The driver holds the merge list (its length is the parameter) and ``candidates`` pairs a round.
Encoding runs once per distinct word, through the caller hook of ``tokenize_with``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .tokenize import EOS_ID, EOS_TOKEN, FIRST_WORD_ID, UNK_ID, UNK_TOKEN, detokenize, tokenize_with

# ---------------------------------------------------------------------------
# Two non-characters around each symbol, and the mark of a preceding blank.
OPEN, CLOSE = "﷐", "﷑"
BLANK = "▁"
# ---------------------------------------------------------------------------


@dataclass
class BytePairs:
    """``merges``: rank, left, right, count. ``vocab``: token, id, count (the merge's; 0 for a character)."""
    merges: DataFrame
    vocab: DataFrame


def spelled(word: Column) -> Column:
    """A word as delimited symbols; the delimiters themselves cannot be part of it."""
    plain = F.translate(word, OPEN + CLOSE, "��")
    return F.concat(F.lit(OPEN + BLANK + CLOSE), F.regexp_replace(plain, "(?s)(.)", f"{OPEN}$1{CLOSE}"))


def merged(spelling: Column, merges: Sequence[tuple[str, str]]) -> Column:
    for left, right in merges:
        spelling = F.replace(spelling, F.lit(f"{OPEN}{left}{CLOSE}{OPEN}{right}{CLOSE}"), F.lit(f"{OPEN}{left}{right}{CLOSE}"))
    return spelling


def symbols(spelling: str) -> Column:
    return F.split(F.expr(f"substring({spelling}, 2, length({spelling}) - 2)"), CLOSE + OPEN)


def adjacent(syms: str, weight: Column) -> Column:
    """(left, right, n) of each pair of neighbouring symbols."""
    n = F.greatest(F.size(syms) - 1, F.lit(0))
    zipped = F.arrays_zip(F.slice(syms, F.lit(1), n).alias("left"), F.slice(syms, F.lit(2), n).alias("right"))
    return F.transform(zipped, lambda p: F.struct(p["left"].alias("left"), p["right"].alias("right"), weight.alias("n")))


def safe_round(top: Sequence[tuple[str, str, int]], known: set[str], most: int, complete: bool) -> list[tuple[str, str, int]]:
    """The leading pairs that sequential training would take next. ``top`` is in order; ``complete`` says
    that it holds all pairs, otherwise a pair outside may be as frequent as the last one."""
    outside = 0 if complete else top[-1][2]
    taken, new_most = [], 0
    for left, right, n in top[:most]:
        if taken and (n <= new_most or any(left == b or right == a for a, b, _ in taken)):
            break
        taken.append((left, right, n))
        if left + right in known:      # its new pairs may add to existing ones
            break
        beside = max((m for a, b, m in top if b == left or a == right), default=0)
        new_most = max(new_most, min(n, max(beside, outside)))
    return taken


def fit_bpe(words: DataFrame, merges: int, word_col: str = "tok", min_count: int = 2, candidates: int = 128) -> BytePairs:
    """Train on a table of words (one row per occurrence). Stops early when no pair
    occurs ``min_count`` times. Null and empty words are ignored."""
    spark = words.sparkSession
    counted = words.where(F.col(word_col) != "").groupBy(F.col(word_col).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    table = cut_lineage(counted.select("n", spelled(F.col("w")).alias("s")))
    base = table.select(F.explode(symbols("s")).alias("token")).distinct()
    pairs = cut_lineage(table.withColumn("a", symbols("s")).select(F.inline(adjacent("a", F.col("n"))))
                        .groupBy("left", "right").agg(F.sum("n").alias("n")))
    done: list[tuple[str, str, int]] = []
    while len(done) < merges:
        top = [tuple(r) for r in pairs.where(F.col("n") >= min_count).orderBy(F.col("n").desc(), "left", "right").limit(candidates).collect()]
        if not top:
            break
        now = safe_round(top, {a + b for a, b, _ in done}, merges - len(done), len(top) < candidates)
        done += now
        if len(done) >= merges:
            break
        # every round writes the words anew, with the old spelling of those it changed, so that a
        # round costs its own merges and not those of all rounds before it
        after = merged(F.col("s"), [(a, b) for a, b, _ in now])
        table = cut_lineage(table.select("n", after.alias("s"), F.when(after != F.col("s"), F.col("s")).alias("was")))
        changed = table.where(F.col("was").isNotNull())
        both = changed.withColumn("a0", symbols("was")).withColumn("a1", symbols("s")).select(
            F.inline(F.concat(adjacent("a0", -F.col("n")), adjacent("a1", F.col("n")))))
        pairs = cut_lineage(pairs.unionByName(both).groupBy("left", "right").agg(F.sum("n").alias("n")).where("n > 0"))
    listed = spark.createDataFrame([(i, *m) for i, m in enumerate(done, 1)], "rank int, left string, right string, count bigint")
    return BytePairs(listed, _vocab(base, listed))


def _vocab(base: DataFrame, merges: DataFrame) -> DataFrame:
    """Reserved tokens, then characters, then merges by rank; a token spelled twice keeps its first place.
    The characters are at most Unicode's, so one window over the table is bounded."""
    spark = base.sparkSession
    tokens = base.select("token", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("count")).unionByName(
        merges.select(F.concat("left", "right").alias("token"), "rank", "count"))
    first = tokens.groupBy("token").agg(F.min("rank").alias("rank"), F.min_by("count", "rank").alias("count"))
    place = F.row_number().over(Window.orderBy("rank", "token")) + FIRST_WORD_ID - 1
    reserved = spark.createDataFrame([(UNK_TOKEN, UNK_ID, 0), (EOS_TOKEN, EOS_ID, 0)], "token string, id int, count bigint")
    return reserved.unionByName(cut_lineage(first.select("token", place.cast("int").alias("id"), "count")))


def encoder(model: BytePairs) -> Callable[[str], list[int]]:
    """word -> ids: the merges of lowest rank first, as in training. An unseen character is unknown."""
    ranks = {(r["left"], r["right"]): r["rank"] for r in model.merges.collect()}
    # characters and merges: bounded by Unicode and the number of merges
    ids = {r["token"]: r["id"] for r in model.vocab.select("token", "id").collect() if r["id"] >= FIRST_WORD_ID}

    def encode(word: str) -> list[int]:
        parts = [BLANK, *(c if c not in (OPEN, CLOSE) else "�" for c in word)]
        while len(parts) > 1:
            best = min(zip(parts, parts[1:]), key=lambda p: ranks.get(p, len(ranks) + 1))
            if best not in ranks:
                break
            joined, i = [], 0
            while i < len(parts):
                two = i + 1 < len(parts) and (parts[i], parts[i + 1]) == best
                joined.append(parts[i] + parts[i + 1] if two else parts[i])
                i += 2 if two else 1
            parts = joined
        return [ids.get(p, UNK_ID) for p in parts]
    return encode


def tokenize_bpe(df: DataFrame, model: BytePairs, keys: Sequence[str], text_col: str = "text") -> DataFrame:
    """``keys..., input_ids, attention_mask, special_tokens_mask`` of cleaned texts."""
    return tokenize_with(df, encoder(model), keys, text_col)


def detokenize_bpe(df: DataFrame, model: BytePairs, keys: Sequence[str], ids_col: str = "input_ids") -> DataFrame:
    """``keys..., text``: tokens joined, blank marks as blanks. Exact for cleaned texts of known characters
    that hold neither the mark nor a delimiter."""
    shown = detokenize(df, model.vocab, keys, ids_col)
    text = F.replace(F.replace("text", F.lit(" "), F.lit("")), F.lit(BLANK), F.lit(" "))
    return shown.select(*keys, F.ltrim(text).alias("text"))
