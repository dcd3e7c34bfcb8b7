"""The Merkle manifest against a plain version in memory."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lectern.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, scope string, rank int"


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tampered(row):
    d, text = row[0], row[4]
    return leaf((*row[:4], text.replace("\n", ""))) if d is not None and text is not None and zlib.crc32(str(d).encode()) % 2 == 0 else leaf(row)


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, i):
    for level in levels[:-1]:
        run, own = level[i - i % 3:i - i % 3 + 3], i % 3
        yield "".join(run[:own]), "".join(run[own + 1:])
        i //= 3


def brute(rows):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    per = {s: sorted((r[0] is not None, r[0] or 0, leaf(r), tampered(r)) for r in rows if r[1] == s) for s in sources}
    trees = {s: tree([x[2] for x in per[s]]) for s in sources}
    top, out = tree([trees[s][-1][0] for s in sources]), []
    for k, s in enumerate(sources):
        for i, (known, d, own, node) in enumerate(per[s]):
            steps = [*path(trees[s], i), *path(top, k)]
            for left, right in steps:
                node = digest(left + node + right)
            out.append((d if known else None, own, trees[s][-1][0], top[-1][0], digest("".join(a + b for a, b in steps)), node, node == top[-1][0]))
    return sorted(out, key=str)


def cases():
    return [[], [(1, None, None, None, None)],
            [(5, "a", "x", 3, "a\nb")] * 800 + [(None, "b", None, 1, "")] * 5 + [(i, "c", "é", i, f"t\n{i}") for i in range(40)]
            + [(7, None, "q", 2, "z\n"), (7, None, "q", 2, "y\n")]]


@pytest.mark.parametrize("rows", cases())
def test_verify(spark, rows):
    docs = spark.createDataFrame([(*r, "q", 1) for r in rows], SCHEMA).repartition(3)
    assert sorted((tuple(r) for r in merkle.verify(docs).collect()), key=str) == brute(rows)


def test_some_requests(spark):
    """A few ranks descend alone; records are stored once however often they occur."""
    docs = spark.createDataFrame([(i % 4, "s", "x", 1, "t", "q", 1) for i in range(3000)], SCHEMA)
    manifest = merkle.build(merkle.leaf_rows(docs).select("doc_id", "source", "leaf"))
    records = manifest.records
    assert records.count() == records.select("digest", "height").distinct().count() < 3000 / merkle.PAGE
    asked = spark.createDataFrame([("=s", 0), ("=s", 2999)], "scope string, at bigint")
    got = merkle.prove(manifest, asked).withColumn("folded", merkle.fold(F.col("digest"), F.col("proof"))).collect()
    assert len(got) == 2 and {r["folded"] for r in got} == {manifest.root}
