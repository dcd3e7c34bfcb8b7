"""Packing token rows into fixed-size blocks.

The reference concatenates the token lists of a batch and cuts the stream into
``block_size`` pieces, dropping the remainder. Concatenation is never
materialised here: each row gets its token offset inside its packing scope, each
row is cut into the pieces that fall into each block, and a block is the
ordered concatenation of at most ``block_size`` tokens. Every group the plan
builds is bounded by ``block_size`` (or by one row's own length).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .prefix import running_offsets
from .tokenize import TOKEN_COLS

BLOCK_COLS = ("input_ids", "attention_mask", "special_tokens_mask", "labels")


def _with_labels(df: DataFrame) -> DataFrame:
    # Labels are a copy of input_ids
    return df.withColumn("labels", F.col("input_ids"))


def pack_document(df: DataFrame, block_size: int, scope_col: str,
                  cols: Sequence[str] = TOKEN_COLS, keep: Sequence[str] = ()) -> DataFrame:
    """Each row is one packing scope (a whole document); narrow, no shuffle.

    Output ``scope_id, block_id, keep..., cols..., labels``.
    """
    n_blocks = F.floor(F.size(cols[0]) / F.lit(block_size)).cast("int")
    # sequence(0, -1) is [0, -1], not empty: guard the zero-block case
    idx = F.when(n_blocks > 0, F.sequence(F.lit(0), n_blocks - 1)).otherwise(
        F.array().cast("array<int>"))
    exploded = df.select(F.col(scope_col).cast("long").alias("scope_id"), *keep, *cols,
                         F.explode(idx).alias("block_id"))
    start = F.col("block_id") * F.lit(block_size) + 1
    return _with_labels(exploded.select(
        "scope_id", F.col("block_id").cast("long").alias("block_id"), *keep,
        *[F.slice(c, start, F.lit(block_size)).alias(c) for c in cols]))


def cut_blocks(df: DataFrame, scope: Sequence[str], offset_col: str, total_col: str,
               block_size: int, cols: Sequence[str] = TOKEN_COLS) -> DataFrame:
    """Cut rows with known scope offsets into blocks; drop each scope's remainder.

    A row covering tokens ``[o, o+n)`` of its scope contributes one piece to each
    block it overlaps; pieces are regrouped by ``(scope, block)`` and joined in
    offset order. Output ``scope..., block_id, cols..., labels``.
    """
    scope = list(scope)
    bs = F.lit(block_size)
    o = F.col(offset_col)
    n = F.size(cols[0])
    usable = F.floor(F.col(total_col) / bs) * bs          # E3: len // bs * bs
    end = F.least(o + n, usable)
    blocks = F.when(end > o, F.sequence(F.floor(o / bs), F.floor((end - 1) / bs))).otherwise(
        F.array().cast("array<bigint>"))
    pieces = df.select(*scope, o.alias("_o"), end.alias("_end"), *cols,
                       F.explode(blocks).alias("block_id"))
    lo = F.greatest(F.col("block_id") * bs, F.col("_o"))
    hi = F.least((F.col("block_id") + 1) * bs, F.col("_end"))
    sliced = pieces.select(
        *scope, "block_id", lo.alias("_start"),
        *[F.slice(c, (lo - F.col("_o") + 1).cast("int"), (hi - lo).cast("int")).alias(c)
          for c in cols])
    grouped = sliced.groupBy(*scope, "block_id").agg(
        F.sort_array(F.collect_list(F.struct("_start", *cols))).alias("_pc"))
    return _with_labels(grouped.select(
        *scope, F.col("block_id").cast("long").alias("block_id"),
        *[F.flatten(F.transform("_pc", _field(c))).alias(c) for c in cols]))


def _field(name: str):
    return lambda p: p[name]


def token_offsets(df: DataFrame, block_rows: int = 1000, order_col: str = "row_idx",
                  ids_col: str = "input_ids", batch_col: str | None = None) -> DataFrame:
    """token offset of each row inside its batch of ``block_rows`` rows.

    Adds ``batch_id``, ``n_tokens``, ``offset`` and ``batch_tokens``. Windows hold
    at most ``block_rows`` rows. ``batch_col`` names an existing column equal to
    ``floor(order_col / block_rows)``: when the input is already partitioned by
    it (see ``with_batches``), the windows need no further shuffle.
    """
    if batch_col is None:
        df = df.withColumn("batch_id", F.floor(F.col(order_col) / F.lit(block_rows)).cast("long"))
    elif batch_col != "batch_id":
        df = df.withColumnRenamed(batch_col, "batch_id")
    w = Window.partitionBy("batch_id").orderBy(order_col)
    return (df.withColumn("n_tokens", F.size(ids_col).cast("long"))
            .withColumn("offset", F.coalesce(
                F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                .cast("long"))
            .withColumn("batch_tokens", F.sum("n_tokens").over(Window.partitionBy("batch_id"))
                        .cast("long")))


def with_batches(rows: DataFrame, block_rows: int = 1000, order_col: str = "row_idx") -> DataFrame:
    """Add ``batch_id`` and hash-partition rows by it, once: the batch windows and blocks of
    ``token_offsets`` / ``pack_batch`` reuse this partitioning. A write in between would lose it."""
    b = rows.withColumn("batch_id", F.floor(F.col(order_col) / F.lit(block_rows)).cast("long"))
    return b.repartition("batch_id")


def pack_batch(df: DataFrame, block_size: int, batch_rows: int = 1000,
               order_col: str = "row_idx", cols: Sequence[str] = TOKEN_COLS,
               batch_col: str | None = None) -> DataFrame:
    """I8: rows are concatenated inside consecutive batches of ``batch_rows`` rows
    (by ``order_col``), cut across row boundaries, remainder dropped per batch.
    ``scope_id`` is the batch number."""
    off = token_offsets(df, batch_rows, order_col, cols[0], batch_col)
    blocks = cut_blocks(off, ["batch_id"], "offset", "batch_tokens", block_size, cols)
    return blocks.withColumnRenamed("batch_id", "scope_id")


def pack_file(df: DataFrame, block_size: int, scope_col: str, order_col: str = "row_idx",
              cols: Sequence[str] = TOKEN_COLS, slices: int | None = None) -> DataFrame:
    """Each scope (a file) is one token stream however many rows it has.

    Offsets come from the sliced prefix sum, which writes its (usually tokenized,
    expensive) input once, so a file that is a third of the corpus is still cut into
    balanced windows.
    """
    sized = df.withColumn("_n", F.size(cols[0]).cast("long"))
    off = running_offsets(sized, [scope_col], order_col, "_n", out="_off", slices=slices, total_out="_tot")
    blocks = cut_blocks(off, [scope_col], "_off", "_tot", block_size, cols)
    return blocks.withColumn("scope_id", F.col(scope_col).cast("long")).select(
        "scope_id", "block_id", *cols, "labels")


def pack_stats(df: DataFrame, block_size: int, scope_col: str, ids_col: str = "input_ids") -> DataFrame:
    """Per scope ``n_tokens, usable_tokens, n_blocks, dropped_tokens``."""
    n = F.sum(F.size(ids_col)).cast("long")
    g = df.groupBy(F.col(scope_col).alias("scope_id")).agg(n.alias("n_tokens"))
    usable = (F.floor(F.col("n_tokens") / block_size) * block_size).cast("long")
    return g.select("scope_id", "n_tokens", usable.alias("usable_tokens"),
                    F.floor(F.col("n_tokens") / block_size).cast("long").alias("n_blocks"),
                    (F.col("n_tokens") - usable).alias("dropped_tokens"))
