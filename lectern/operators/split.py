"""Exact, reproducible train/validation split.

``n_test = ceil(test_size * n)`` rows go to validation: those first in
``(md5(seed:key), key)`` order - never ``randomSplit`` (approximate and
partition-dependent).

Rows are bucketed by the first hex digits of their hash (4,096 uniform
buckets). Bucket sizes come from a partial + final count, and prefix offsets over
the small bucket table decide most rows at once: a bucket that ends before
``n_test`` is all validation, one that starts after it is all train. Only the one
bucket that straddles ``n_test`` (per scope) is ranked, so the full table is
labelled by a broadcast of the bucket table and is never shuffled or sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import seeded_md5
from ..session import cut_lineage
from .joins import lookup


def split_exact(df: DataFrame, keys: Sequence[str], test_size: float = 0.1, seed: int = 42,
                out: str = "split", small_guard: bool = True,
                scope: Sequence[str] = (), materialize: bool = False,
                digits: int = 3) -> DataFrame:
    """Label each row ``train`` or ``validation``.

    With ``scope`` each group (e.g. each book) is split on its own. With
    ``small_guard`` (G3) a table, or scope, of fewer than 2 rows is returned under
    both labels, as the reference's preprocessing does. ``keys`` must identify a
    row (within its scope).

    The input is read up to three times (bucket counts, labels, the straddling
    bucket); with ``materialize`` it is first written to the shared checkpoint
    folder, so an expensive input (tokenized, packed blocks) is computed once.
    """
    keys, scope = list(keys), list(scope)
    if materialize:
        df = cut_lineage(df)
    own = list(dict.fromkeys([*scope, *keys]))
    if scope and set(df.columns) != set(own):
        # many scopes: their buckets may be too many to broadcast, so only keys travel
        # through the joins and the labels meet the wide rows once
        labels = split_exact(df.select(*own), keys, test_size, seed, out, small_guard, scope, digits=digits)
        return df.join(labels, own)
    h = seeded_md5(seed, *keys)
    hashed = df.withColumn("_hb", F.conv(F.substring(h, 1, digits), 16, 10).cast("int"))

    counts = hashed.groupBy(*scope, "_hb").agg(F.count(F.lit(1)).alias("_bn"))
    w_scope = Window.partitionBy(*scope) if scope else Window.partitionBy()
    n = F.sum("_bn").over(w_scope)
    start = F.coalesce(F.sum("_bn").over(w_scope.orderBy("_hb").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    buckets = counts.select(*scope, "_hb", start.alias("_bo"), "_bn", n.alias("_n"))
    n_test = F.ceil(F.lit(float(test_size)) * F.col("_n")).cast("long")
    buckets = buckets.select(
        *scope, "_hb", "_n", "_bn", (n_test - F.col("_bo")).alias("_need"),
        F.when(F.col("_bo") + F.col("_bn") <= n_test, F.lit("validation"))
        .when(F.col("_bo") >= n_test, F.lit("train")).otherwise(F.lit("cross")).alias("_state"))
    # the bucket table is an aggregate (at most 4,096 rows per scope value): written
    # once, it gives the size of the straddling set without another pass
    buckets = cut_lineage(buckets)
    cross_rows = int(buckets.where(F.col("_state") == "cross").agg(F.sum("_bn")).first()[0] or 0)
    buckets = buckets.drop("_bn")

    # 16**digits rows per scope value: the size is checked before any broadcast
    labelled = lookup(hashed, buckets, [*scope, "_hb"], "inner", salt=1)

    # rank only the straddling bucket(s): about n / 4,096 rows per scope
    cross = labelled.where(F.col("_state") == "cross").select(*scope, *keys, "_hb", "_need")
    w_in = Window.partitionBy(*scope, "_hb").orderBy(h, *keys)
    cross = cross.select(*scope, *keys, F.when(F.row_number().over(w_in) <= F.col("_need"),
                                               F.lit("validation")).otherwise(F.lit("train"))
                         .alias("_cl"))
    # unique keys, no hot key: size-checked broadcast, else a plain join
    keyed = lookup(labelled, cross, [*scope, *keys], "left", salt=1,
                   small_size=(cross_rows, cross_rows * (len(scope) + len(keys) + 1)))
    label = F.when(F.col("_state") == "cross", F.col("_cl")).otherwise(F.col("_state"))
    if small_guard:
        labels = F.when(F.col("_n") < 2, F.array(F.lit("train"), F.lit("validation"))).otherwise(
            F.array(label))
        res = keyed.withColumn(out, F.explode(labels))
    else:
        res = keyed.withColumn(out, label)
    return res.drop("_hb", "_n", "_need", "_state", "_cl")
