"""Property tests (survey §5): packed blocks are a prefix of the scope's tokens,
block count is floor(tokens / block), no truncation, hooks keep rows whole."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import docs_df
from lectern.operators.pack import pack_document
from lectern.operators.tokenize import fit_vocab, map_batches, token_rows, tokenize

words = st.sampled_from(["a", "b", "cc", "d", "é", "the", "x1"])
docs = st.lists(st.lists(words, max_size=60).map(" ".join), min_size=1, max_size=6)
slow = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@slow
@given(texts=docs, bs=st.integers(1, 9))
def test_pack_document_is_prefix(spark, texts, bs):
    d = docs_df(spark, texts)
    t = tokenize(d, fit_vocab(token_rows(d, ["doc_id"])), ["doc_id"])
    full = {r.doc_id: r.input_ids for r in t.collect()}
    blocks = pack_document(t, bs, "doc_id").collect()
    for doc, ids in full.items():
        assert len(ids) == len(texts[doc].split())            # I6: nothing truncated
        mine = [r.input_ids for r in sorted((r for r in blocks if r.scope_id == doc), key=lambda r: r.block_id)]
        assert len(mine) == len(ids) // bs
        assert [x for b in mine for x in b] == ids[: len(ids) // bs * bs]


def test_map_batches_hook(spark):
    d = docs_df(spark, ["a b", "c", "d e f"])

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(i, w) for i, t in zip(pdf.doc_id, pdf.text) for w in t.split()]
        return pd.DataFrame(rows, columns=["doc_id", "word"])

    out = map_batches(d.repartition(2), fn, "doc_id long, word string")
    assert sorted((r.doc_id, r.word) for r in out.collect()) == \
        [(0, "a"), (0, "b"), (1, "c"), (2, "d"), (2, "e"), (2, "f")]


def test_words_scheme(spark):
    d = docs_df(spark, ["Hello, world! 42 times"])
    rows = token_rows(d, ["doc_id"], scheme="words").orderBy("pos").collect()
    assert [r.tok for r in rows] == ["Hello", ",", "world", "!", "42", "times"]


def test_file_stream_equals_whole_document(spark):
    """I10 over a file's lines gives the blocks I7 gives for the file's whole text."""
    from lectern.functions.text import split_lines
    from lectern.plans import prepare
    texts = ["a b c\nd e\n\nf g h i j k\n" * 7, "one\ntwo three\n" * 11, "x"]
    docs = docs_df(spark, texts)
    vocab = fit_vocab(token_rows(docs, ["doc_id"]))
    whole = prepare.create_dataset(docs, block_size=5, vocab=vocab, clean=True)
    lines = docs.select("doc_id", F.posexplode(split_lines("text")).alias("line_no", "text")) \
        .withColumn("row_idx", F.col("doc_id") * 1000 + F.col("line_no"))
    streamed = prepare.create_dataset_from_lines(lines, block_size=5, vocab=vocab)
    a = {(r.scope_id, r.block_id): (r.input_ids, r.split) for r in whole.collect()}
    b = {(r.scope_id, r.block_id): (r.input_ids, r.split) for r in streamed.collect()}
    assert a == b and len(a) > 10
