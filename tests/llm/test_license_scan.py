"""License scans against plain word comparison, and the SQL on edge cases."""
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from .data import edge_rows, make_docs
from lectern.llm import license_scan as ls
from lectern.llm import sql

NOTICE = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"


def license_rows():
    rows = edge_rows() + [
        (700, "Under the MIT license. under THE mit License, cc by-nc 4.0"), (701, "under the mit licence"), (702, NOTICE + " and more"),
        (703, NOTICE.replace("free of charge", "entirely free of any charge")), (704, "Permission is hereby granted"),
        (705, "x " * 5000 + "Licensed under the Apache License, Version 2.0" + " y" * 5000), (705, "cc by nc"), (706, "cc by nc cc by nc by nc"),
        (707, "under the mİt license under the mit liİcense"), (708, "apache license version 2"), (708, "apache license version 2")]
    return rows


def plain(rows):
    out = []
    for d, t in rows:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        hits = [(i, label) for text, label in ls.BASE for p in [text.split()] for i in range(len(w)) if w[i:i + len(p)] == p]
        at = [i for i, _ in hits]
        out.append((d, len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))))
    return sorted(out, key=str)


def test_base_and_sql(spark):
    rows = license_rows()
    got = ls.scan(make_docs(spark, rows).repartition(3)).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == plain(rows)
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    want = con.execute(sql.license_scan(ls.BASE, ls.NOTICES, ls.K, ls.GAP, ls.LEAST_COVER, ls.MOST_STRETCH)).fetchall()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    labels = {r["doc_id"]: (r["labels"], r["score"]) for r in got}
    assert labels[702] == ("mit", 1.0) and labels[703][0] == "mit" and 0.75 <= labels[703][1] < 1 and labels[704][0] == ""


def test_main_path_has_no_python(spark, docs):
    plan = ls.scan(docs.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan.replace("docs", ""))


def test_repeated_rows_stay_bounded(spark):
    """100,000 equal rows without an id: votes are counted before the shuffle, copies come back in blocks."""
    many = spark.range(0, 100_000, 1, 7).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("x under the MIT license").alias("text"))
    got = ls.scan(many)
    per_task = got.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 100_000 and len(per_task) > 1
    assert max(r["count"] for r in per_task) <= 60_000
    assert [tuple(r) for r in got.distinct().collect()] == [(None, 5, 1, 1, 1, "mit", "mit", 1.0)]


@pytest.mark.parametrize("block", [1, 3, 10])
def test_repeat(spark, block):
    rows = spark.createDataFrame([(i, i) for i in range(1, 12)], "k int, copies bigint")
    assert sorted(r["k"] for r in ls.repeat(rows, ["k"], block=block).collect()) == [i for i in range(1, 12) for _ in range(i)]


def test_empty(no_docs):
    assert ls.scan(no_docs).count() == 0
