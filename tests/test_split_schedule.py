"""Split (G2, G3) and schedule (G4, F7): exact sizes, disjoint and complete,
independent of partitioning."""

import math

import pytest
from pyspark.sql import functions as F

from lectern.operators.schedule import batch_plan, block_keys, step_events
from lectern.operators.split import split_exact


@pytest.mark.parametrize("n", [0, 1, 2, 10, 11, 1000])
def test_split_sizes(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    s = split_exact(df, ["k"], 0.1, 42).collect()
    val = {r.k for r in s if r.split == "validation"}
    tr = {r.k for r in s if r.split == "train"}
    if n < 2:
        assert val == tr == set(range(n))        # small-input fallback
    else:
        assert len(val) == math.ceil(0.1 * n)
        assert val.isdisjoint(tr) and val | tr == set(range(n))


def test_split_ignores_partitioning(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = {r.k for r in split_exact(df.repartition(7), ["k"]).where("split = 'validation'").collect()}
    b = {r.k for r in split_exact(df.coalesce(1), ["k"]).where("split = 'validation'").collect()}
    assert a == b


def test_split_per_scope(spark):
    df = spark.createDataFrame([(s, b) for s in range(3) for b in range(s * 5 + 1)], "scope_id long, block_id long")
    rows = split_exact(df, ["scope_id", "block_id"], scope=["scope_id"]).collect()
    per = {}
    for r in rows:
        per.setdefault((r.scope_id, r.split), 0)
        per[(r.scope_id, r.split)] += 1
    assert per[(0, "train")] == per[(0, "validation")] == 1
    assert per[(1, "validation")] == 1 and per[(2, "validation")] == 2


def test_batch_plan(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    plan = batch_plan(df, ["k"], epochs=3, batch_size=4).collect()
    assert len(plan) == 30
    for e in range(3):
        rows = [r for r in plan if r.epoch == e]
        assert sorted(r.k for r in rows) == list(range(10))
        assert sorted({r.step for r in rows}) == [e * 3 + 1, e * 3 + 2, e * 3 + 3]
    orders = [[r.k for r in sorted((r for r in plan if r.epoch == e), key=lambda r: (r.batch_id, r.k))]
              for e in range(3)]
    assert orders[0] != orders[1]                 # reshuffled each epoch
    wide = batch_plan(df, ["k"], epochs=3, batch_size=4, digits=4).collect()
    assert sorted(tuple(r) for r in wide) == sorted(tuple(r) for r in plan)   # same order
    ev = step_events(spark.range(1000), 1, 1, 100, 500, 500)
    got = sorted((r.step, r.event) for r in ev.collect())
    assert got[:2] == [(100, "log"), (200, "log")] and (500, "evaluate") in got and (1000, "save") in got


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_split_matches_brute_force(spark, digits):
    import hashlib
    n = 997
    df = spark.range(n).withColumnRenamed("id", "k").repartition(5)
    val = {r.k for r in split_exact(df, ["k"], 0.1, 42, digits=digits).where("split = 'validation'").collect()}
    order = sorted(range(n), key=lambda k: (hashlib.md5(f"42:{k}".encode()).hexdigest(), k))
    assert val == set(order[:math.ceil(0.1 * n)])


@pytest.mark.parametrize("blocks,epochs,batch", [(0, 3, 8), (1, 1, 1), (37, 3, 8), (250, 2, 7)])
def test_events_follow_the_plan(spark, blocks, epochs, batch):
    """Steps by arithmetic are the steps of the plan itself."""
    df = spark.range(blocks).withColumnRenamed("id", "k")
    steps = {r.step for r in batch_plan(df, ["k"], epochs, batch).select("step").distinct().collect()}
    want = sorted((s, e) for s in steps for e, n in (("log", 2), ("evaluate", 5), ("save", 10)) if s % n == 0)
    assert sorted(tuple(r) for r in step_events(df, epochs, batch, 2, 5, 10).collect()) == want


def test_events_beyond_one_array(spark):
    """More steps than one array can hold, in more than one task."""
    n = 3_000_000_000
    ev = step_events(spark.range(1), n, 1, 1, n // 2, n)
    assert dict(map(tuple, ev.groupBy("event").count().collect())) == {"log": n, "evaluate": 2, "save": 1}
    assert step_events(spark.range(1000), 1, 1, 1, 500, 500).where("event = 'log'").rdd.getNumPartitions() > 1


def test_block_keys_from_counts(spark):
    df = spark.createDataFrame([(1, 0), (2, 9), (3, 10), (4, 35)], "doc_id long, n_tokens int")
    assert sorted(tuple(r) for r in block_keys(df, 10).collect()) == [(3, 0), (4, 0), (4, 1), (4, 2)]


def test_split_carries_only_keys_through_scopes(spark):
    df = spark.createDataFrame([(s, b, [s, b]) for s in range(4) for b in range(s)], "scope_id long, block_id long, ids array<long>")
    rows = split_exact(df, ["scope_id", "block_id"], scope=["scope_id"]).collect()
    assert all(r.ids == [r.scope_id, r.block_id] for r in rows)
    assert sorted((r.scope_id, r.block_id, r.split) for r in rows if r.scope_id == 1) == [(1, 0, "train"), (1, 0, "validation")]
