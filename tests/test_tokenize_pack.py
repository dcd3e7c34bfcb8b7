"""Tokenize (I1-I6) and pack (I7-I10): the reference's block tests plus brute
force over random rows for the batch and file packers."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import docs_df
from lectern.operators.pack import (pack_batch, pack_document, pack_file, pack_stats, token_offsets,
                                   with_batches)
from lectern.operators import tokenize as tokenize_module
from lectern.operators.tokenize import (EOS_ID, UNK_ID, detokenize, fit_vocab, special_tokens, token_rows,
                                        tokenize, tokenize_bytes, tokenize_with)


def tokenized(spark, texts, **kw):
    d = docs_df(spark, texts)
    v = fit_vocab(token_rows(d, ["doc_id"]))
    return tokenize(d, v, ["doc_id"], **kw), v


def test_tokenized_columns_and_masks(spark):
    t, v = tokenized(spark, ["This is a test.", "", "a a b"])
    assert {"input_ids", "attention_mask", "special_tokens_mask"} <= set(t.columns)
    rows = {r.doc_id: r for r in t.collect()}
    assert rows[1].input_ids == []
    assert rows[0].attention_mask == [1] * 4
    assert rows[2].special_tokens_mask == [0, 0, 0]
    ids = {r.token: r.id for r in v.collect()}
    assert ids["a"] == 2                      # most frequent word gets the first word id
    assert rows[2].input_ids == [ids["a"], ids["a"], ids["b"]]


def test_unknown_tokens_and_specials(spark):
    d = docs_df(spark, ["seen words", "unseen"])
    v = fit_vocab(token_rows(d.where("doc_id = 0"), ["doc_id"]))
    t = tokenize(d, v, ["doc_id"]).orderBy("doc_id").collect()
    assert t[1].input_ids == [UNK_ID]
    sp = {r.name: (r.token, r.id) for r in special_tokens(v).collect()}
    assert sp["pad"] == sp["eos"] and sp["eos"][1] == EOS_ID


@pytest.mark.parametrize("bound", [0, 3, 6])
def test_head_and_tail_match_broadcast(spark, bound):
    """One token is over a third of all rows; the vocabulary passes the broadcast bound."""
    texts = ["the the the cat the dog the"] * 20 + ["a b c", "", "zebra the"]
    d = docs_df(spark, texts)
    v = fit_vocab(token_rows(d.where("doc_id < 21"), ["doc_id"]))
    a = tokenize(d, v, ["doc_id"], broadcast_max_rows=bound).orderBy("doc_id").collect()
    b = tokenize(d, v, ["doc_id"]).orderBy("doc_id").collect()
    assert [r.input_ids for r in a] == [r.input_ids for r in b]
    assert a[-1].input_ids[0] == UNK_ID and a[-2].input_ids == []


def test_detokenize(spark):
    texts = ["the cat  sat", "", "the unseen the"]
    d = docs_df(spark, texts)
    v = fit_vocab(token_rows(d.where("doc_id < 2"), ["doc_id"]))
    t = tokenize(d, v, ["doc_id"], add_eos=True)
    for bound in (0, 2_000_000):
        got = {r.doc_id: r.text for r in detokenize(t, v, ["doc_id"], broadcast_max_rows=bound).collect()}
        assert got == {0: "the cat sat", 1: "", 2: "the <unk> the"}
    shown = {r.doc_id: r.text for r in detokenize(t, v, ["doc_id"], skip_special=False).collect()}
    assert shown[1] == "<|endoftext|>" and shown[0].endswith("sat <|endoftext|>")


def test_special_mask_marks_the_end(spark):
    d = docs_df(spark, ["a b", ""])
    rows = tokenize(d, fit_vocab(token_rows(d, ["doc_id"])), ["doc_id"], add_eos=True).orderBy("doc_id").collect()
    assert [r.special_tokens_mask for r in rows] == [[0, 0, 1], [1]] and rows[1].input_ids == [EOS_ID]


def test_vocabulary_stops_before_ids_wrap(spark, monkeypatch):
    monkeypatch.setattr(tokenize_module, "MAX_ID", 3)
    d = docs_df(spark, ["a b"])
    assert fit_vocab(token_rows(d, ["doc_id"])).count() == 4
    with pytest.raises(Exception, match="raise min_count"):
        fit_vocab(token_rows(docs_df(spark, ["a b c"]), ["doc_id"])).collect()


def test_byte_tokenizer(spark):
    texts = ["héllo", "", "a\nb"]
    t = tokenize_bytes(docs_df(spark, texts), ["doc_id"]).orderBy("doc_id").collect()
    assert [r.input_ids for r in t] == [list(x.encode("utf-8")) for x in texts]


def test_callable_tokenizer(spark):
    t = tokenize_with(docs_df(spark, ["ab c", "c"]), lambda s: [ord(ch) for ch in s], ["doc_id"])
    rows = {r.doc_id: r.input_ids for r in t.collect()}
    assert rows == {0: [97, 98, 99], 1: [99]}


def test_pack_document_block_size(spark):
    long_text = " ".join(["This is a test sentence."] * 100)
    t, _ = tokenized(spark, [long_text, "short text", ""])
    b = pack_document(t, 128, "doc_id").collect()
    assert len(b) == 500 // 128
    assert all(len(r.input_ids) == 128 and r.labels == r.input_ids for r in b)
    assert {r.scope_id for r in b} == {0}


def test_pack_document_exact_sentence(spark):
    t, _ = tokenized(spark, ["This is a test sentence for grouping texts into blocks."])
    b = pack_document(t, 10, "doc_id").collect()
    assert len(b) == 1 and len(b[0].input_ids) == 10 and b[0].labels == b[0].input_ids


def brute_batches(rows, bs, batch_rows):
    out = {}
    for r0 in range(0, (max(rows) + 1) if rows else 0, batch_rows):
        toks = [x for i in range(r0, r0 + batch_rows) for x in rows.get(i, [])]
        n = len(toks) // bs * bs
        for j in range(0, n, bs):
            out[(r0 // batch_rows, j // bs)] = toks[j:j + bs]
    return out


@pytest.mark.parametrize("bs", [1, 16, 5000])
def test_pack_batch_brute_force(spark, bs):
    rnd = random.Random(3)
    for n_rows in (999, 1000, 1001, 2500):
        rows = {i: [rnd.randint(2, 50) for _ in range(rnd.choice([0, 0, 1, 3, 7, 40]))]
                for i in range(n_rows)}
        df = spark.createDataFrame([(i, ids) for i, ids in rows.items()], "row_idx bigint, input_ids array<int>")
        df = df.withColumn("attention_mask", F.transform("input_ids", lambda x: F.lit(1))) \
               .withColumn("special_tokens_mask", F.transform("input_ids", lambda x: F.lit(0)))
        got = {(r.scope_id, r.block_id): r.input_ids for r in pack_batch(df, bs, 1000).collect()}
        assert got == brute_batches(rows, bs, 1000)
        pre = with_batches(df, 1000)
        same = {(r.scope_id, r.block_id): r.input_ids
                for r in pack_batch(pre, bs, 1000, batch_col="batch_id").collect()}
        assert same == got


def test_pack_file_brute_force_and_repartition(spark):
    rnd = random.Random(5)
    data = []
    for doc in range(4):
        for line in range(rnd.randint(0, 300)):
            data.append((doc, doc * 1000 + line, [rnd.randint(2, 9) for _ in range(rnd.randint(0, 6))]))
    df = spark.createDataFrame(data, "doc_id bigint, row_idx bigint, input_ids array<int>")
    df = df.withColumn("attention_mask", F.transform("input_ids", lambda x: F.lit(1))) \
           .withColumn("special_tokens_mask", F.transform("input_ids", lambda x: F.lit(0)))
    want = {}
    for doc in range(4):
        toks = [x for d, _, ids in sorted(data, key=lambda r: r[1]) if d == doc for x in ids]
        for j in range(0, len(toks) // 7 * 7, 7):
            want[(doc, j // 7)] = toks[j:j + 7]
    # several slices per file
    got = {(r.scope_id, r.block_id): r.input_ids
           for r in pack_file(df.repartition(5), 7, "doc_id", "row_idx", slices=9).collect()}
    assert got == want


def test_offsets_and_stats(spark):
    df = spark.createDataFrame([(0, [1, 2]), (1, []), (2, [3, 4, 5])], "row_idx bigint, input_ids array<int>")
    o = {r.row_idx: r.offset for r in token_offsets(df, 1000).collect()}
    assert o == {0: 0, 1: 2, 2: 2}
    st = pack_stats(df.withColumn("s", F.lit(1)), 2, "s").first()
    assert (st.n_tokens, st.usable_tokens, st.n_blocks, st.dropped_tokens) == (5, 4, 2, 1)


def test_flow_with_callable_tokenizer_and_pad(spark):
    from lectern.plans import prepare
    docs = docs_df(spark, ["ab cd " * 20, "x"])
    ds = prepare.create_dataset(docs, block_size=8, tokenizer=lambda s: [len(s), ord(s[0])])
    rows = ds.collect()
    assert len(rows) == (20 * 2 * 2) // 8 and all(len(r.input_ids) == 8 for r in rows)
    assert rows[0].input_ids[:4] in ([2, 97, 2, 99], [2, 99, 2, 97])
    v = fit_vocab(token_rows(docs, ["doc_id"]))
    sp = {r.name: r.id for r in special_tokens(v, pad_token="<unk>").collect()}
    assert sp["pad"] == UNK_ID
