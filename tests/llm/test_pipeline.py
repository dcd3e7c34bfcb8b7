"""Connected components, the pipeline's stages, and the registered queries."""
import random
import re

import pytest

import corpus_pipeline
from lectern.llm import queries, staging

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_components(spark, kind):
    r = random.Random(2)
    n = 200
    edges = {"chain": [(i, i + 1) for i in range(n) if i % 50 != 49], "star": [(7, i) for i in range(n)] + [(3, 7)],
             "random": [(r.randrange(n), r.randrange(n)) for _ in range(150)]}[kind]
    parent = list(range(n + 2))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = staging.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert sorted(map(tuple, got)) == sorted((i, root(i)) for i in {x for a, b in edges if a != b for x in (a, b)})


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", q).group(1)) for q in queries.QUERIES) == list(range(1, 11))


def test_stages(spark):
    docs = queries.table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]
    frames = [docs]
    for _, step in corpus_pipeline.STAGES:
        frames.append(staging.stage(step(spark, frames[-1], SF)))
    for f in frames[1:-1]:
        assert f.columns == docs.columns
    ids = [{r[0] for r in f.select("doc_id").collect()} for f in frames]
    assert len(ids[1]) < len(ids[0]) and len(ids[2]) < len(ids[1]) and ids[3] <= ids[2] and ids[4] == ids[3] == ids[5]
    # one of each group of equal texts is left, and no benchmark passage of ten words
    texts = {r["doc_id"]: r["text"] for r in frames[3].collect()}
    assert len({t for t in texts.values()}) == len(texts)
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t.lower())
    windows = set()
    for r in queries.table(spark, SF, "benchmark").collect():
        w = words(r["text"])
        windows |= {tuple(w[i:i + 10]) for i in range(len(w) - 9)}
    for t in texts.values():
        w = words(t)
        assert not any(tuple(w[i:i + 10]) in windows for i in range(len(w) - 9))
    rest = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, rest.collect())) == sorted(map(tuple, frames[5].collect()))


def test_stages_on_edge_cases(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "a b"), (4, "word " * 30_000)] + [(5, " ".join(f"w{i}" for i in range(40)))] * 2
    for name, data, ddl in (("documents", rows, "doc_id bigint, text string"), ("benchmark", [], "item_id bigint, text string"),
                            ("labels", [(5, None), (None, 1)], "doc_id bigint, quality int")):
        spark.createDataFrame(data, ddl).write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, step in corpus_pipeline.STAGES:
        step(spark, docs, str(tmp_path)).collect()
        step(spark, docs.limit(0), str(tmp_path)).collect()
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {5}


def test_near_duplicates_keep_one_row_per_group(spark):
    """Repeated, null and clashing ids: one row of each group stays, and no other text goes."""
    text = lambda n: " ".join(f"{n}{i}" for i in range(60))
    rows = ([(1, text("a"), "x")] * 3 + [(1, text("a"), "y"), (1, text("b"), "x")]     # repeated, and clashing texts
            + [(None, text("c"), "x")] * 2 + [(None, text("d"), "x"), (4, text("d") + " e", "x")]      # null ids
            + [(3, text("f"), "x"), (5, text("f") + " g", "x"), (5, text("h"), "x")]    # 5 clashes; one of its texts links to 3
            + [(8, None, "x"), (8, "", "x")])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    got = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert sorted(((d, t) for d, t, _ in got), key=str) == sorted(
        [(1, text("a")), (1, text("b")), (None, text("c")), (4, text("d") + " e"), (3, text("f")), (5, text("h")),
         (8, None), (8, "")], key=str)
