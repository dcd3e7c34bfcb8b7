"""Vocabulary and tokenization.

The reference calls a pretrained byte-pair tokenizer; here tokenization is a
table operation: pre-tokens come from Spark string functions, ids from a
vocabulary fitted on the corpus and attached by a join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import WS_CHARS
from ..session import cut_lineage
from .elements import find_all, find_in_head, find_in_tail, numbered, repeated, same_keys
from .joins import head_and_tail, lookup, string_cells, table_size
from .prefix import dense_ordinal

# ---------------------------------------------------------------------------
# Reserved ids and their token strings.
UNK_TOKEN = "<unk>"
EOS_TOKEN = "<|endoftext|>"
UNK_ID = 0
EOS_ID = 1
FIRST_WORD_ID = 2
MAX_ID = 2**31 - 1
# Pre-token pattern of the "words" scheme: letter runs, digit runs, and any
# other single character that is not whitespace.
WORDS_PATTERN = r"\p{L}+|\p{N}+|[^\p{L}\p{N}" + WS_CHARS + "]"
# ---------------------------------------------------------------------------

TOKEN_COLS = ("input_ids", "attention_mask", "special_tokens_mask")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pretokens(text, scheme: str = "whitespace") -> Column:
    """Pre-token array of a text column.

    ``whitespace`` expects cleaned text (single spaces) and splits on ' ';
    ``words`` extracts letter runs, digit runs and punctuation marks.
    """
    t = _c(text)
    if scheme == "whitespace":
        return F.filter(F.split(t, " "), lambda x: x != "")
    if scheme == "words":
        return F.regexp_extract_all(t, F.lit(WORDS_PATTERN), 0)
    raise ValueError(f"unknown pre-token scheme {scheme!r}")


def token_rows(df: DataFrame, keys: Sequence[str], text_col: str = "text",
               scheme: str = "whitespace") -> DataFrame:
    """One row per token occurrence: ``keys..., pos, tok`` (pos is 0-based)."""
    return df.select(*keys, F.posexplode(pretokens(text_col, scheme)).alias("pos", "tok"))


def fit_vocab(tokens: DataFrame, tok_col: str = "tok", min_count: int = 1,
              slices: int | None = None) -> DataFrame:
    """``token, id, count``. Ids follow ``(count desc, token)`` from 2; id 0 is
    the unknown token and id 1 the end-of-text token (count 0).

    Counting is a partial + final hash aggregate, so a token that is a third of
    the corpus is summed map-side before the shuffle. Ids need a global order:
    ``dense_ordinal`` range-partitions instead of sorting in one task.
    """
    counts = (tokens.groupBy(F.col(tok_col).alias("token"))
              .agg(F.count(F.lit(1)).alias("count"))
              .where((F.col("count") >= min_count) & ~F.col("token").isin(UNK_TOKEN, EOS_TOKEN)))
    ranked = dense_ordinal(counts, [F.col("count").desc(), F.col("token").asc()], out="_o",
                           slices=slices)
    # ids are 32-bit, as the token arrays are: a larger vocabulary stops with an error
    # instead of wrapping round
    wide = F.col("_o") + FIRST_WORD_ID
    bounded = F.when(wide <= MAX_ID, wide.cast("int")).otherwise(F.raise_error(F.lit(
        f"more than {MAX_ID} vocabulary entries; raise min_count")).cast("int"))
    words = ranked.select("token", bounded.alias("id"), F.col("count").cast("long").alias("count"))
    spark = tokens.sparkSession
    specials = spark.createDataFrame(
        [(UNK_TOKEN, UNK_ID, 0), (EOS_TOKEN, EOS_ID, 0)],
        "token string, id int, count long")
    return words.unionByName(specials)


def special_tokens(vocab: DataFrame, pad_token: str | None = None) -> DataFrame:
    """``name, token, id`` for unk, eos and pad; pad defaults to eos."""
    names = vocab.where(F.col("id").isin(UNK_ID, EOS_ID)).select(
        F.when(F.col("id") == UNK_ID, "unk").otherwise("eos").alias("name"), "token", "id")
    pad_lit = F.lit(pad_token).cast("string")
    pad = vocab.where(F.col("token") == F.coalesce(pad_lit, F.lit(EOS_TOKEN))).select(
        F.lit("pad").alias("name"), "token", "id")
    return names.unionByName(pad)


def lookup_ids(rows: DataFrame, vocab: DataFrame, keys: Sequence[str],
               broadcast_max_rows: int = 2_000_000) -> DataFrame:
    """Attach ``id`` to each token row (unknown -> 0).

    Up to ``broadcast_max_rows`` vocabulary entries (and as many cells as
    ``joins.lookup`` allows) are broadcast, so token rows never leave their partition.
    A larger vocabulary is cut by count: its frequent head is broadcast, and only the
    rows the head does not know, whose tokens are rare by construction, are shuffled
    to the tail. However hot a token is, its rows stay where they are.
    """
    v = vocab.select(F.col("token").alias("tok"), "id", "count")
    done = lambda j: j.select(*keys, "pos", "tok", F.coalesce("id", F.lit(UNK_ID)).alias("id"))
    head, tail = head_and_tail(v, table_size(v, string_cells("tok")), max_rows=broadcast_max_rows)
    if tail is None:
        return done(rows.join(F.broadcast(head.drop("count")), "tok", "left"))
    seen = rows.join(F.broadcast(head.select("tok", F.col("id").alias("_head"))), "tok", "left")
    known = seen.where(F.col("_head").isNotNull() | F.col("tok").isNull()).withColumnRenamed("_head", "id")
    rest = seen.where(F.col("_head").isNull() & F.col("tok").isNotNull()).drop("_head").join(
        tail.select("tok", "id"), "tok", "left")
    return done(known).unionByName(done(rest))


def mask_columns(ids: Column) -> list[Column]:
    """Attention mask of ones and the special-token mask."""
    return [
        ids.alias("input_ids"),
        F.transform(ids, lambda x: F.lit(1)).alias("attention_mask"),
        F.transform(ids, lambda x: (x == EOS_ID).cast("int")).alias("special_tokens_mask"),
    ]


def tokenize(df: DataFrame, vocab: DataFrame, keys: Sequence[str], text_col: str = "text",
             scheme: str = "whitespace", keep: Sequence[str] = (), add_eos: bool = False,
             broadcast_max_rows: int = 2_000_000) -> DataFrame:
    """``keys..., keep..., input_ids, attention_mask, special_tokens_mask``.

    No truncation (I6). Rows without tokens keep empty arrays. Tokens are looked up in the
    rows' own lists (``elements``): a vocabulary within the bound without a shuffle, a larger one by its
    frequent head, and only the rows' rare tokens are shuffled to its tail.
    """
    keys_all = list(dict.fromkeys([*keys, *keep]))
    v = vocab.select(F.col("token").alias("k"), F.col("id").alias("v"), "count")
    head, tail = head_and_tail(v, table_size(v, string_cells("k")), max_rows=broadcast_max_rows)
    found = find_all(df, keys_all, pretokens(text_col, scheme), head, tail, UNK_ID)
    ids = F.concat("_found", F.array(F.lit(EOS_ID))) if add_eos else F.col("_found")
    return found.select(*keys_all, *mask_columns(ids))


def detokenize(df: DataFrame, vocab: DataFrame, keys: Sequence[str], ids_col: str = "input_ids",
               out: str = "text", skip_special: bool = True, keep: Sequence[str] = (),
               broadcast_max_rows: int = 2_000_000) -> DataFrame:
    """Ids back to text: ``keys..., keep..., out``, the ids' tokens joined by single blanks.

    ``skip_special`` leaves out end-of-text tokens; an id outside the vocabulary shows as
    the unknown token. Ids are looked up in the rows' own lists, as ``tokenize`` does with tokens.
    Rows that share their keys become one, their tokens in order of position.
    """
    keys_all = list(dict.fromkeys([*keys, *keep]))
    weight = F.col("count") if "count" in vocab.columns else F.lit(1)
    v = vocab.select(F.col("id").alias("k"), F.coalesce("token", F.lit(UNK_TOKEN)).alias("v"), weight.alias("count"))
    head, tail = head_and_tail(v, table_size(v, string_cells("v")), max_rows=broadcast_max_rows)
    ids = F.transform(ids_col, lambda x: F.when(x != EOS_ID, x)) if skip_special else F.col(ids_col)
    rows = numbered(find_in_head(df, keys_all, ids, head, UNK_TOKEN, rest=tail is not None))
    several = repeated(rows, keys_all)
    words = rows.select(*keys_all, "_found") if tail is None else find_in_tail(rows, keys_all, tail)
    if not skip_special:
        words = words.withColumn("_found", F.transform("_found", lambda t: F.coalesce(t, F.lit(UNK_TOKEN))))
    line = F.array_join("_found", " ").alias(out)
    if several.isEmpty():
        return words.select(*keys_all, line)
    merged = same_keys(words, keys_all, several, "left_semi").select(*keys_all, F.posexplode_outer("_found").alias("pos", "t")) \
        .groupBy(*keys_all).agg(F.sort_array(F.collect_list(F.when(F.col("t").isNotNull(), F.struct("pos", "t")))).alias("_p"))
    return same_keys(words, keys_all, several, "left_anti").select(*keys_all, line).unionByName(
        merged.select(*keys_all, F.array_join(F.transform("_p", lambda x: x["t"]), " ").alias(out)))


def byte_ids(text) -> Column:
    """UTF-8 byte values of a text as ``array<int>`` (empty text -> []).

    The hex form is cut into pairs by one linear regex pass; a lambda that
    re-encoded or re-indexed the text per element would be quadratic.
    """
    pairs = F.regexp_extract_all(F.hex(F.encode(_c(text), "UTF-8")), F.lit("[0-9A-F]{2}"), 0)
    return F.transform(pairs, lambda x: F.conv(x, 16, 10).cast("int"))


def tokenize_bytes(df: DataFrame, keys: Sequence[str], text_col: str = "text",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Byte tokenizer; narrow, no vocabulary, no shuffle."""
    return df.select(*keys, *keep, *mask_columns(byte_ids(text_col)))


def tokenize_with(df: DataFrame, fn: Callable[[str], list[int]], keys: Sequence[str],
                  text_col: str = "text", scheme: str = "whitespace") -> DataFrame:
    """L2: plug a caller's per-token encoder (str -> list of ids).

    The Python function runs in an Arrow-batched pandas UDF on the *distinct*
    pre-tokens only, so its cost grows with the vocabulary rather than with the corpus; its
    output is looked up in the rows' own lists, as ``tokenize`` does with ids. Rows that share
    their keys get the codes of all of them, in order of position; a null key gets none.
    """
    import pandas as pd

    def _encode_batch(s):
        return s.map(lambda t: [int(x) for x in fn(t)])

    _encode_batch.__annotations__ = {"s": pd.Series, "return": pd.Series}
    _encode = F.pandas_udf(_encode_batch, T.ArrayType(T.IntegerType()))

    keys = list(keys)
    # encoded once per distinct token and written out, so the Python function
    # never runs twice for a token
    counted = token_rows(df, keys, text_col, scheme).groupBy("tok").agg(F.count(F.lit(1)).alias("count"))
    codes = cut_lineage(counted.select("tok", _encode("tok").alias("codes"), "count"))
    size = table_size(codes, string_cells("tok") + F.size("codes"))
    head, tail = head_and_tail(codes.select(F.col("tok").alias("k"), F.array_join("codes", " ").alias("v"), "count"), size)
    found = find_all(df, keys, pretokens(text_col, scheme), head, tail)
    ids = F.array_remove(F.split(F.array_join("_found", " "), " "), "").cast("array<int>")
    several = repeated(df, keys, with_null=True)
    if several.isEmpty():
        return found.select(*keys, *mask_columns(ids))
    part = same_keys(df, keys, several, "left_semi")
    joined = lookup(token_rows(part, keys, text_col, scheme), codes.drop("count"), ["tok"], "left", salt_cols=[*keys, "pos"],
                    small_size=size)
    grouped = joined.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("pos", "codes"))).alias("_p"))
    shared = F.flatten(F.transform("_p", lambda x: x["codes"]))
    merged = part.select(*keys).join(grouped, keys, "left").select(
        *keys, *mask_columns(F.coalesce(shared, F.array().cast("array<int>"))))
    return same_keys(found, keys, several, "left_anti").select(*keys, *mask_columns(ids)).unionByName(merged)


def map_batches(df: DataFrame, fn, schema) -> DataFrame:
    """L1: a batched table function (pandas frame in, pandas frame out; the row
    count may change), run per partition through Arrow."""
    def _run(batches):
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(_run, schema=schema)
