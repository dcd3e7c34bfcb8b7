"""Written intermediate tables, sized joins and connected components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir

BROADCAST_ROWS = 2_000_000


def new_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Written intermediate tables: cut lineage, keep column pruning, survive lost executors.
stage = cut_lineage


def sized_join(big: DataFrame, small: DataFrame, on, how: str, rows: int | None = None,
               most: int = BROADCAST_ROWS) -> DataFrame:
    """A join whose narrow right side is broadcast if it has at most ``most`` rows
    (counted unless given); otherwise shuffled, where Spark splits skewed partitions."""
    if rows is None:
        rows = small.count()
    return big.join(F.broadcast(small) if rows <= most else small, on, how)


def give_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow``; at its end the freed memory goes back to the system. Spark
    keeps the worker process for later tasks, and what it still held would add to theirs and
    to the executor's own."""
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc alone has it
            if trim:
                trim(0)
    return wrapped


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the undirected ``edges`` (a, b): root is the
    smallest node reachable. Alternating large-star and small-star steps, which need
    about log(nodes) rounds; each round's edges are written to shared storage."""
    e = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        state = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if tuple(state) == before or not state["n"]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = tuple(state)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = stage(small)
