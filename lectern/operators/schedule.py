"""Training order as a table.

The reference hands the blocks to a trainer that shuffles them each epoch and
logs / evaluates / saves every N steps. The data side of that is a plan table:
``epoch, step, batch_id, keys...`` with a seeded hash order per epoch.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import seeded_md5
from ..session import cut_lineage
from .prefix import hash_rank


def batch_plan(df: DataFrame, keys: Sequence[str], epochs: int = 3, batch_size: int = 1,
               seed: int = 42, digits: int = 3) -> DataFrame:
    """One row per (epoch, block). ``batch_id`` is the 0-based batch inside the epoch,
    ``step`` the 1-based global optimisation step (last partial batch kept).

    Epochs are generated by ``explode(sequence)``: no cross join. Every row needs
    its full rank, ranked inside ``16**digits`` uniform hash buckets per epoch
    (use 4 digits past ~10^10 blocks to keep each bucket window small).
    """
    keys = list(keys)
    # ranked in two passes (bucket counts, then ranks): the keys are written once
    ep = cut_lineage(df.select(*keys)).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    ranked = hash_rank(ep.withColumn("_h", seeded_md5(seed, "epoch", *keys)), "_h", keys,
                       out="_r", scope=["epoch"], digits=digits, count_out="_n")
    per_epoch = F.ceil(F.col("_n") / F.lit(batch_size)).cast("long")
    batch = F.floor(F.col("_r") / F.lit(batch_size)).cast("long")
    return ranked.select(
        F.col("epoch").cast("int").alias("epoch"),
        (F.col("epoch") * per_epoch + batch + 1).cast("long").alias("step"),
        batch.alias("batch_id"), *keys)


def block_keys(counts: DataFrame, block_size: int, scope_col: str = "doc_id",
               tokens_col: str = "n_tokens") -> DataFrame:
    """``scope_id, block_id`` of the blocks that ``pack_document`` cuts, from token counts
    alone: a plan needs the keys, not the tokens."""
    n = F.floor(F.col(tokens_col) / F.lit(block_size))
    # sequence(0, -1) counts down: scopes without a whole block go first
    return counts.where(n > 0).select(F.col(scope_col).cast("long").alias("scope_id"), F.explode(
        F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)).alias("block_id"))


def step_events(blocks: DataFrame, epochs: int = 3, batch_size: int = 1, logging_steps: int = 100,
                eval_steps: int = 500, save_steps: int = 500) -> DataFrame:
    """``step, event`` for every step that logs, evaluates or saves. Steps follow from
    the number of blocks (one row per block in ``blocks``): each epoch has
    ``ceil(blocks / batch_size)``."""
    total = blocks.agg((F.ceil(F.count(F.lit(1)) / F.lit(batch_size)) * epochs).cast("long")).first()[0]
    # ranges are dealt over tasks, so no value or task holds all steps
    due = [blocks.sparkSession.range(n, total + 1, n).select(F.col("id").alias("step"), F.lit(name).alias("event"))
           for name, n in (("log", logging_steps), ("evaluate", eval_steps), ("save", save_steps))]
    return reduce(DataFrame.unionByName, due)
