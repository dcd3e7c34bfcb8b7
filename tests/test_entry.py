"""Driver contract: the flagship runs, every query has a callable, and every
oracle belongs to a query."""

import __spark_entry__ as entry_mod
from lectern.plans.registry import ORACLES, QUERIES


def test_entry_runs(spark):
    rows = entry_mod.entry(spark).collect()
    assert rows and {"split", "lang", "n_blocks", "n_tokens", "sum_ids"} == set(rows[0].asDict())
    assert {r.split for r in rows} == {"train", "validation"}


def test_registry_shape():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(QUERIES) >= 52 and set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(q)
