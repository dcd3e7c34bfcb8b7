"""Ordered positions without funnelling a table through one task.

Three helpers, all plain DataFrame plans:

* ``running_offsets`` - exclusive prefix sum of a size column within a scope. The rows are
  range-partitioned by (scope, order) into balanced slices and written once; sums
  per (slice, scope) get a prefix over that small table, then a window runs inside
  each slice's part of a scope. Slices hold about rows / ``slices`` rows whatever the
  keys are (dense, sparse, hashed, negative), and a scope that holds a third of all
  rows spans a third of the slices.
* ``hash_rank`` - 0-based global rank in ``(hash, keys)`` order where the hash is
  uniform (md5). Buckets are the hash's first hex digits, so they are balanced
  by construction and their table has ``16**digits`` rows per scope.
* ``dense_ordinal`` - 0-based rank in an arbitrary order (e.g. count desc,
  token). Range partitioning splits the order into balanced slices; the slices
  are written to the checkpoint folder so partition ids and in-slice positions
  are fixed, then a per-slice offset table (one row per slice) is added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import lookup


def sliced(df: DataFrame, order: Sequence[Column], slices: int | None = None) -> DataFrame:
    """``df`` range-partitioned in ``order`` and written once, with the slice number
    ``_sl`` (ascending in ``order``) and ``_mi``, ascending within a slice."""
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                       .withColumn("_sl", F.spark_partition_id())
                       .withColumn("_mi", F.monotonically_increasing_id()))


def running_offsets(df: DataFrame, scope: Sequence[str], order_col: str, size_col: str,
                    out: str = "offset", slices: int | None = None,
                    total_out: str | None = None) -> DataFrame:
    """Exclusive prefix sum of ``size_col`` within ``scope`` in ``order_col`` order
    (``order_col`` unique within a scope); optionally the scope total.

    The input is read once. The table of (slice, scope) sums has at most
    ``slices`` + number of scopes rows; its windows run per scope, over at most
    ``slices`` rows. It is joined back by size-checked lookup.
    """
    scope = list(scope)
    rows = sliced(df, [F.col(c) for c in (*scope, order_col)], slices).drop("_mi")
    sums = rows.groupBy("_sl", *scope).agg(F.sum(size_col).cast("long").alias("_s"))
    by_scope = Window.partitionBy(*scope) if scope else Window.partitionBy()
    before = F.sum("_s").over(by_scope.orderBy("_sl").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("_sl", *scope, F.coalesce(before, F.lit(0)).cast("long").alias("_o"),
                         F.sum("_s").over(by_scope).cast("long").alias("_t"))
    w = Window.partitionBy("_sl", *scope).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    joined = lookup(rows, cut_lineage(starts), ["_sl", *scope], "inner", salt=1)
    res = joined.withColumn(out, (F.col("_o") + F.coalesce(F.sum(size_col).over(w), F.lit(0))).cast("long"))
    if total_out:
        res = res.withColumn(total_out, F.col("_t"))
    return res.drop("_sl", "_o", "_t")


def hash_rank(df: DataFrame, hash_col: str, keys: Sequence[str], out: str = "rank",
              scope: Sequence[str] = (), digits: int = 3, count_out: str | None = None) -> DataFrame:
    """0-based rank by ``(hash_col, *keys)`` within ``scope``.

    ``count_out`` optionally adds the scope's row count. The bucket table
    (``16**digits`` rows per scope value) is written once and joined by
    size-checked lookup, so neither many digits nor many scopes are broadcast unseen.
    """
    scope = list(scope)
    b = df.withColumn("_hb", F.conv(F.substring(hash_col, 1, digits), 16, 10).cast("int"))
    counts = b.groupBy(*scope, "_hb").agg(F.count(F.lit(1)).alias("_bn"))
    w = (Window.partitionBy(*scope) if scope else Window.partitionBy()).orderBy("_hb")
    offs = counts.select(
        *scope, "_hb",
        F.coalesce(F.sum("_bn").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_bo"),
        *([F.sum("_bn").over(Window.partitionBy(*scope) if scope else Window.partitionBy())
           .alias(count_out)] if count_out else []),
    )
    joined = lookup(b, cut_lineage(offs), [*scope, "_hb"], "inner", salt=1)
    w_in = Window.partitionBy(*scope, "_hb").orderBy(hash_col, *keys)
    return joined.withColumn(out, (F.col("_bo") + F.row_number().over(w_in) - 1).cast("long")) \
        .drop("_hb", "_bo")


def dense_ordinal(df: DataFrame, order: Sequence[Column], out: str = "ordinal",
                  slices: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (which must be a total order)."""
    ranged = sliced(df, order, slices)
    sizes = ranged.groupBy("_sl").agg(F.count(F.lit(1)).alias("_n"))
    offs = sizes.select("_sl", (F.sum("_n").over(Window.orderBy("_sl")) - F.col("_n")).alias("_so"))
    # one row per slice: a proven bound
    res = ranged.join(F.broadcast(offs), "_sl")
    pos_in_slice = F.col("_mi") - F.shiftleft(F.col("_sl").cast("long"), 33)
    return res.withColumn(out, (F.col("_so") + pos_in_slice).cast("long")).drop("_sl", "_mi", "_so")
