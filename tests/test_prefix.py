"""Global-order helpers against plain Python sorts, with a hot scope."""

import hashlib
import random

import pytest

from pyspark.sql import functions as F

from lectern.operators.prefix import dense_ordinal, hash_rank, running_offsets, sliced


def test_dense_ordinal_matches_sort(spark):
    rnd = random.Random(11)
    rows = [(f"t{i}", rnd.choice([1, 1, 1, 2, 3, 50])) for i in range(2000)]
    df = spark.createDataFrame(rows, "token string, count long").repartition(7)
    got = {r.token: r.o for r in dense_ordinal(df, [F.col("count").desc(), F.col("token")], "o", slices=5).collect()}
    want = {t: i for i, (t, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    assert got == want


def test_hash_rank_matches_sort(spark):
    keys = list(range(3000))
    df = spark.createDataFrame([(k, hashlib.md5(f"7:{k}".encode()).hexdigest()) for k in keys], "k long, h string")
    got = {r.k: r.r for r in hash_rank(df.repartition(4), "h", ["k"], out="r", count_out="n").collect()}
    order = sorted(keys, key=lambda k: (hashlib.md5(f"7:{k}".encode()).hexdigest(), k))
    assert got == {k: i for i, k in enumerate(order)}


@pytest.mark.parametrize("slices", [1, 7, 97])
def test_running_offsets_hot_scope(spark, slices):
    rnd = random.Random(2)
    rows = [(0 if rnd.random() < 0.7 else rnd.randint(1, 5), i, rnd.randint(0, 9)) for i in range(5000)]
    df = spark.createDataFrame(rows, "s long, o long, n long").repartition(6)
    got = {(r.s, r.o): (r.off, r.tot) for r in
           running_offsets(df, ["s"], "o", "n", out="off", slices=slices, total_out="tot").collect()}
    want, acc, tot = {}, {}, {}
    for s, o, n in rows:
        tot[s] = tot.get(s, 0) + n
    for s, o, n in sorted(rows, key=lambda r: (r[0], r[1])):
        want[(s, o)] = (acc.get(s, 0), tot[s])
        acc[s] = acc.get(s, 0) + n
    assert got == want


def test_running_offsets_global(spark):
    rows = [(i, (i * 7) % 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "o long, n long").repartition(4)
    got = {r.o: (r.off, r.tot) for r in running_offsets(df, [], "o", "n", out="off", slices=11,
                                                          total_out="tot").collect()}
    acc, want = 0, {}
    for o, n in rows:
        want[o] = (acc, sum(r[1] for r in rows))
        acc += n
    assert got == want


def test_running_offsets_any_keys(spark):
    """Hashed and negative keys: slices stay balanced, so no window holds the table."""
    rnd = random.Random(9)
    rows = [(k, rnd.randint(0, 9)) for k in {rnd.getrandbits(64) - 2**63 for _ in range(4000)}]
    df = spark.createDataFrame(rows, "o long, n long").repartition(4)
    res = running_offsets(df, [], "o", "n", out="off", slices=16)
    acc, want = 0, {}
    for o, n in sorted(rows):
        want[o] = acc
        acc += n
    assert {r.o: r.off for r in res.collect()} == want
    parts = sliced(df, [F.col("o")], 16).groupBy("_sl").count().collect()
    assert len(parts) == 16 and max(r["count"] for r in parts) < 3 * len(rows) / 16


def test_unpartitioned_window_reads_slices_only(spark):
    """The one window without a partition runs over the table of slice sums, written
    before the result's plan: none is left in the plan that reads the rows."""
    res = running_offsets(spark.range(5000).withColumn("n", F.lit(1)), [], "id", "n", slices=8)
    plan = res._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 1 and "_sl#" in windows[0]
    assert res.agg(F.max("offset")).first()[0] == 4999
