"""Catalogue planning (A7, C2-C4, D1-D4, E7, F2), sources and sinks (A1-A11),
flows and the streaming path (K)."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from lectern.operators import catalog as cat
from lectern.plans import prepare
from lectern.sources import files, sinks
from lectern.streaming.text_stream import blocks_from_documents, start_block_stream


def fresh_dir():
    return tempfile.mkdtemp(prefix="lectern-test-")


def test_works_json_and_routing(spark):
    js = json.dumps({"Aesop": [{"title": "Fables", "gutenberg_id": 1497},
                               {"title": "Morals", "gutenberg_id": 0}],
                     "Homer": [{"title": "Iliad"}]})
    works = files.parse_works(spark.createDataFrame([(js,)], "value string"))
    rows = sorted((r.author, r.title, r.gutenberg_id) for r in works.collect())
    assert rows == [("Aesop", "Fables", 1497), ("Aesop", "Morals", 0), ("Homer", "Iliad", None)]
    routable = {r.title: r.routable for r in cat.works_routable(works).collect()}
    assert routable == {"Iliad": False, "Morals": False, "Fables": True}
    with pytest.raises(Exception):
        files.parse_works(spark.createDataFrame([("{not json",)], "value string")).collect()


def test_resolve_candidates_and_downloads(spark):
    works = spark.createDataFrame([("Aesop", "Fables"), ("Aesop", "Missing"), ("Homer", "Iliad")],
                                  "author string, title string")
    rows = [("id%d" % i, "Aesop", "Fables", "texts", "English", i) for i in range(8)]
    rows += [("h1", "Homer", "Iliad", "texts", "Greek", 1), ("h2", "Homer", "Iliad", "audio", "English", 2)]
    catalog = spark.createDataFrame(rows, "identifier string, author string, title string, mediatype string, language string, rnk int")
    res = {r.title: r.identifier for r in cat.resolve_works(works, catalog, [F.col("rnk")]).collect()}
    assert res == {"Fables": "id0", "Missing": None, "Iliad": None}
    cands = cat.candidate_items(works, catalog, [F.col("rnk")]).collect()
    assert sorted(r.identifier for r in cands) == ["id0", "id1", "id2", "id3", "id4"]
    assert sorted(r.title for r in cat.unresolved_works(works, catalog).collect()) == ["Iliad", "Missing"]
    fl = spark.createDataFrame([("id0", "a.txt", "Text"), ("id0", "a.pdf", "Text PDF")], "identifier string, name string, format string")
    resolved = cat.resolve_works(works, catalog, [F.col("rnk")])
    planned = cat.planned_downloads(resolved, fl, "root")
    assert [r.path for r in planned.collect()] == ["root/Aesop/id0/a.txt"]
    manifest = spark.createDataFrame([("root/Aesop/id0/a.txt",)], "path string")
    assert cat.new_files_only(planned, manifest).count() == 0
    tally = {r.status: r.n for r in cat.fetch_tally(cat.fetch_status(resolved, fl)).collect()}
    assert tally == {"success": 1, "not_found": 2}
    # every entry of the list counts, however often a work is listed
    listed = works.union(works.where("title = 'Missing'")).union(works.where("title = 'Fables'"))
    resolved = cat.resolve_works(listed, catalog, [F.col("rnk")])
    tally = {r.status: r.n for r in cat.fetch_tally(cat.fetch_status(resolved, fl), listed).collect()}
    assert tally == {"success": 2, "not_found": 3}


def test_status_of_many_unresolved_works(spark):
    """Null identifiers never meet in a join."""
    resolved = spark.range(3000).select(F.lit("a").alias("author"), F.col("id").cast("string").alias("title"),
                                        F.when(F.col("id") < 5, F.concat(F.lit("i"), "id")).alias("identifier"))
    fl = spark.createDataFrame([("i1", "x.txt", "Text")], "identifier string, name string, format string")
    status = cat.fetch_status(resolved, fl)
    assert {r.status: r.n for r in cat.fetch_tally(status).collect()} == {"not_found": 2995, "failed": 4, "success": 1}
    plan = status._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join"):]
    assert "isnotnull(identifier" in join


def test_text_file_scan_and_lines(spark):
    d = fresh_dir()
    with open(os.path.join(d, "a.txt"), "wb") as f:
        f.write(b"line one\r\nline two\rline three\n")
    with open(os.path.join(d, "bad.txt"), "wb") as f:
        f.write(b"ok \xff\xfe bytes\n")
    good = files.read_text_files(spark, os.path.join(d, "a.txt")).first()
    assert good.text == "line one\nline two\nline three\n" and good.valid_utf8
    lines = [r.text for r in files.read_lines(spark, os.path.join(d, "a.txt")).orderBy("line_no").collect()]
    assert lines == ["line one", "line two", "line three"]
    with pytest.raises(Exception):
        files.read_text_files(spark, os.path.join(d, "bad.txt")).collect()
    lax = files.read_text_files(spark, os.path.join(d, "bad.txt"), strict=False).first()
    assert not lax.valid_utf8 and "�" in lax.text
    with pytest.raises(Exception):
        files.read_text_files(spark, os.path.join(d, "missing.txt")).collect()


def test_prompts(spark):
    d = fresh_dir()
    p = os.path.join(d, "prompts.txt")
    with open(p, "w") as f:
        f.write("  Socrates once said \n\n   \nThe cave\n")
    assert [r.prompt for r in files.read_prompts(spark, p).orderBy("prompt_id").collect()] == \
        ["Socrates once said", "The cave"]


def test_prompts_of_two_files(spark):
    """Two files' first lines are two prompts."""
    d = fresh_dir()
    for name, text in (("a.txt", "hello\n\nagain\n"), ("b.txt", "world\n")):
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    got = {r.prompt: r.prompt_id for r in files.read_prompts(spark, d).collect()}
    assert got == {"hello": 0, "again": 2, "world": 3}


def book(n: int, name: str) -> str:
    return (f"front matter\n*** START OF THIS PROJECT GUTENBERG EBOOK {name} ***\n"
            + "\n".join(f"line {i} of  {name}, and more words" for i in range(n)) + "\nEnd of the Project Gutenberg EBook.\nlegal\n")


def test_lines_and_documents_give_one_dataset(spark):
    """Real books, marked: the line flow equals the whole-text flow, ids by path."""
    d = fresh_dir()
    src = os.path.join(d, "books")
    os.makedirs(src)
    for i, name in enumerate("cab"):
        with open(os.path.join(src, f"{name}.txt"), "w") as f:
            f.write(book(60 + 7 * i, name))
    a = prepare.run_create_dataset(spark, src, os.path.join(d, "a"), block_size=16)
    b = prepare.run_create_dataset_from_lines(spark, src, os.path.join(d, "b"), block_size=16)
    rows = lambda p, name: sorted((r.scope_id, r.block_id, tuple(r.input_ids)) for r in
                                  files.load_table(spark, os.path.join(p, name)).collect())
    for name in ("train_dataset", "val_dataset"):
        assert rows(a, name) == rows(b, name) != []
    assert {r[0] for r in rows(a, "train_dataset")} == {0, 1, 2}
    # line blocks hold no boilerplate either; the literal form keeps it
    lines = prepare._numbered(spark, src)
    words = lambda clean: sum(len(r.input_ids) for r in prepare.preprocess(lines, 8, tokenizer="bytes", clean=clean).collect())
    boiler = sum(len(book(0, n)) for n in "abc")
    assert words(True) < words(False) - boiler + 100


def test_flows_round_trip(spark):
    d = fresh_dir()
    src = os.path.join(d, "book.txt")
    with open(src, "w") as f:
        f.write("*** START OF THIS PROJECT GUTENBERG EBOOK X ***\n" + "This is a test sentence. " * 300 +
                "\nEnd of the Project Gutenberg EBook.\n")
    counts = {}
    out = prepare.run_create_dataset(spark, src, os.path.join(d, "ds"), counts=counts, block_size=64)
    tr = files.load_table(spark, os.path.join(out, "train_dataset"))
    va = files.load_table(spark, os.path.join(out, "val_dataset"))
    n = tr.count() + va.count()
    assert counts == {"train_dataset": tr.count(), "val_dataset": va.count()}
    assert n == (1500 // 64) and va.count() == -(-n // 10)
    assert {"input_ids", "attention_mask", "labels"} <= set(tr.columns)
    pc = {}
    pp = prepare.run_preprocess(spark, src, os.path.join(d, "pp"), counts=pc, block_size=32)
    back = spark.read.parquet(pp)
    assert pc["train"] + pc["validation"] == back.count()
    assert back.where("split = 'validation'").count() >= 1
    assert all(len(r.input_ids) == 32 for r in back.collect())


def test_save_splits_prunes(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "validation")], "k int, split string")
    out = sinks.save_splits(df, str(tmp_path / "s"))
    v = spark.read.parquet(out).where("split = 'validation'")
    assert [r.k for r in v.collect()] == [2]
    assert "PartitionFilters: [isnotnull(split" in v._jdf.queryExecution().executedPlan().toString()


def test_streaming_blocks(spark):
    d = fresh_dir()
    src, sink, ck = (os.path.join(d, x) for x in ("src", "sink", "ck"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.write.parquet(src)
    q = start_block_stream(spark, src, sink, ck, block_size=256)
    q.awaitTermination(120)
    streamed = spark.read.parquet(sink)
    batch = blocks_from_documents(docs, 256)
    assert streamed.count() == batch.count() > 0
    a = streamed.select("scope_id", "block_id", F.md5(F.array_join("input_ids", " ")).alias("h"))
    b = batch.select("scope_id", "block_id", F.md5(F.array_join("input_ids", " ")).alias("h"))
    assert a.exceptAll(b).count() == 0


def test_read_lines_split_file(spark):
    d = fresh_dir()
    p = os.path.join(d, "big.txt")
    lines = [f"line {i} " + "x" * (i % 17) for i in range(3000)]
    with open(p, "w", newline="") as f:
        f.write("\r\n".join(lines[:1000]) + "\n" + "\n".join(lines[1000:2000]) + "\r" + "\n".join(lines[2000:]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = files.read_lines(spark, p)
        assert df.rdd.getNumPartitions() > 5
        got = [(r.line_no, r.text) for r in df.orderBy("line_no").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(enumerate(lines))


def test_run_all(spark):
    d = fresh_dir()
    src = os.path.join(d, "book.txt")
    with open(src, "w") as f:
        f.write("*** START OF THIS PROJECT GUTENBERG EBOOK X ***\n" +
                " ".join(f"word{i % 37} and the {i % 11}" for i in range(4000)) +
                "\nEnd of the Project Gutenberg EBook.\n")
    pr = os.path.join(d, "prompts.txt")
    with open(pr, "w") as f:
        f.write("word1 and\n\n the 3\n")
    paths = prepare.run_all(spark, src, os.path.join(d, "out"), block_size=64, prompts_path=pr,
                            max_length=12, num_return_sequences=2)
    report = [r.value for r in spark.read.text(paths["report"]).collect()]
    assert report[0] == "Evaluation Results:" and report[-1].startswith("Perplexity: ")
    samples = spark.read.parquet(os.path.join(paths["samples"], "table")).collect()
    assert len(samples) == 4 and all(len(r.generated_text.split()) == 12 for r in samples)
    assert {r.prompt for r in samples} == {"word1 and", "the 3"}
    vocabulary = {r.token for r in spark.read.parquet(paths["vocab"]).collect()}
    for r in samples:
        assert r.generated_text.startswith(r.prompt + " ") and set(r.generated_text.split()) <= vocabulary
    text = "\n".join(r.value for r in spark.read.text(os.path.join(paths["samples"], "text")).collect())
    assert text.count("Prompt: ") == 2 and text.count("Generated Text 2:") == 2
    assert spark.read.parquet(paths["dataset"]).where("split = 'validation'").count() >= 1
    plan = spark.read.parquet(paths["plan"])
    assert plan.count() == 3 * spark.read.parquet(paths["dataset"]).where("split = 'train'").count()
    # stages alone, from the saved tables
    again = prepare.run_evaluate(spark, paths["model"], paths["dataset"], os.path.join(d, "again"))
    assert [r.value for r in spark.read.text(again).collect()] == report
    single = prepare.run_generate(spark, paths["model"], paths["vocab"], os.path.join(d, "one"), prompt="the 3",
                                  max_length=6, num_return_sequences=2)
    text = "\n".join(r.value for r in spark.read.text(os.path.join(single, "text")).collect())
    assert text.count("Prompt: the 3\nGenerated Text ") == 2


def test_preprocess_raw_bytes(spark):
    lines = ["  a  b ", "", "héllo\tworld", "x" * 40] * 300
    df = spark.createDataFrame(list(enumerate(lines)), "row_idx long, text string")
    out = prepare.preprocess(df, block_size=32, tokenizer="bytes", clean=False).collect()
    want = {}
    for b0 in range(0, len(lines), 1000):
        stream = [x for t in lines[b0:b0 + 1000] for x in t.encode("utf-8")]
        for j in range(0, len(stream) // 32 * 32, 32):
            want[(b0 // 1000, j // 32)] = stream[j:j + 32]
    assert {(r.scope_id, r.block_id): r.input_ids for r in out} == want
    assert sum(r.split == "validation" for r in out) == -(-len(want) // 10)


def test_read_works_layouts(spark):
    d = fresh_dir()
    whole = os.path.join(d, "works.json")
    with open(whole, "w") as f:
        json.dump({"Aesop": [{"title": "Fables", "gutenberg_id": 7}],
                   "Homer": [{"title": "Iliad"}, {"title": "Odyssey", "gutenberg_id": 0}]}, f, indent=2)
    rows = sorted((r.author, r.title, r.gutenberg_id) for r in files.read_works(spark, whole).collect())
    assert rows == [("Aesop", "Fables", 7), ("Homer", "Iliad", None), ("Homer", "Odyssey", 0)]
    lines = os.path.join(d, "works.jsonl")
    with open(lines, "w") as f:
        f.write(json.dumps({"Aesop": [{"title": "Fables", "gutenberg_id": 7}]}) + "\n")
        f.write(json.dumps({"Homer": [{"title": "Iliad"}]}) + "\n")
    rows = sorted((r.author, r.title) for r in files.read_works(spark, lines, json_lines=True).collect())
    assert rows == [("Aesop", "Fables"), ("Homer", "Iliad")]
