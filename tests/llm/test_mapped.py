"""Operators that map documents one by one, against plain Python versions."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from .data import edge_rows, make_docs, rows_of
from pyspark.sql import functions as F

from lectern.llm import decontaminate, packing, pii, quality, token_counts
from lectern.llm.words import ALNUM, LOWER, SPACED, grams, hash_words, hashes, words_of

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return t


# words ------------------------------------------------------------------------------

@pytest.mark.parametrize("kind,pattern,fold", [(SPACED, "[^\x20\x09-\x0d]+", None), (ALNUM, "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", LOWER)])
def test_words_and_hashes(kind, pattern, fold):
    import pyarrow as pa
    texts = [t for _, t in edge_rows()]
    w = words_of(pa.array(texts), kind)
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    want = [re.findall(pattern, (low(t) if fold is not None else t) if t else "") for t in texts]
    assert w.counts.tolist() == [len(x) for x in want]
    flat = [x.encode() for v in want for x in v]
    h = hashes(w.data, w.starts, w.ends, LOWER if fold is not None else np.arange(256, dtype=np.uint8))
    assert (h == hash_words(flat)).all() and len(set(h.tolist())) == len(set(flat))
    g, at = grams(h, w.first, 4)
    assert len(g) == sum(max(0, len(x) - 3) for x in want)
    assert len(set(g.tolist())) == len({tuple(x[i:i + 4]) for x in want for i in range(len(x) - 3)})


# benchmark decontamination ----------------------------------------------------------

def contaminated_rows():
    r = random.Random(2)
    word = lambda: r.choice(["a", "b", "c", "d", "é", "f7"])
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(r.randint(1, 25))) for i in range(30)] + [(40, None), (41, ""), (42, "!!"), (None, text(12)), (43, "Only, ONE"),
                                                                  (44, "only one"), (43, text(11))]
    docs = edge_rows() + [(500 + i, text(30) + ". " + r.choice(items[:30])[1].upper() + "; " + text(r.randint(0, 30))) for i in range(40)]
    return docs + [(900, "only"), (901, "x only one x"), (902, None)], items


@pytest.mark.parametrize("shard_words", [1_000_000, 12])
def test_decontaminate(spark, shard_words):
    rows, items = contaminated_rows()
    table = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.scan(make_docs(spark, rows), table, shard_words=shard_words)
    assert rows_of(decontaminate.digest(found)) == sorted(decontaminate.brute_force(rows, items), key=str)


def test_remove_spans(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"Before it. {passage.upper()}! after it, more words of the text here and there"), (2, passage), (3, "clean text"), (4, None)]
    items = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    out = decontaminate.clean(make_docs(spark, rows), items)
    assert out.columns == make_docs(spark, rows).columns
    assert {(r["n_words"], r["spans"], r["items"]) for r in out.collect()} == {(7, "s", "i")}
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {
        1: "Before it. ! after it, more words of the text here and there", 3: "clean text", 4: None}


def test_decontaminate_empty(spark, docs, no_docs):
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.scan(no_docs, items).count() == 0 and decontaminate.clean(no_docs, items).count() == 0
    assert decontaminate.digest(decontaminate.scan(docs, items)).where("contaminated").count() == 0


# quality ------------------------------------------------------------------------------

def plain_quality(t):
    t = t or ""
    w = re.findall("[^\x20\x09-\x0d]+", t)
    n = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if n[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit), len(w) < 10 or 100 * len(hit) > 20 * len(w))


def test_quality_counts(docs):
    got = [(r[0], *r[1:7], r["kept"]) for r in quality.judge(docs, None).collect()]
    want = [(d, *plain_quality(t), not plain_quality(t)[-1]) for d, t in edge_rows()]
    assert sorted(got, key=str) == sorted(want, key=str)


def labelled(spark):
    r = random.Random(6)
    prose = lambda: "\n".join(" ".join(r.choice(["the", "of", "tion", "heed"]) for _ in range(12)).capitalize() + "." for _ in range(6))
    junk = lambda: "\n".join(" | ".join(r.choice(["Home", "LOGIN", "$$$", "cart"]) for _ in range(9)) for _ in range(6))
    rows = [(i, prose() if i % 2 else junk()) for i in range(120)]
    return rows, make_docs(spark, rows), spark.createDataFrame(
        [(i, i % 2) for i in range(60)] + [(999, 1), (None, 0), (3, None)], "doc_id bigint, quality int")


def test_quality_field_on_held_out(spark):
    rows, docs, labels = labelled(spark)
    field = quality.train(docs, labels)
    verdict = {r["doc_id"]: r["content_words"] >= 0.5 * r["n_words"] for r in quality.judge(docs, field).collect()}
    assert sum(verdict[i] == bool(i % 2) for i in range(60, 120)) >= 57
    kept = quality.keep_good(docs, field)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {
        r["doc_id"] for r in quality.judge(docs, field).collect() if r["kept"]}


def test_quality_mixed_page(spark):
    """A boilerplate block inside good text is labelled as such, and only its words are left out."""
    rows, docs, labels = labelled(spark)
    good, bad = rows[101][1].split("\n"), rows[100][1].split("\n")
    page = good[:3] + bad[:3] + good[3:]
    got = quality.judge(make_docs(spark, [(1, "\n".join(page)), (2, "\n".join(bad + good[:1]))]), quality.train(docs, labels)).collect()
    assert {r["doc_id"]: r["content_words"] for r in got} == {1: sum(len(x.split()) for x in good), 2: len(good[0].split())}


def test_quality_trains_on_one_row_per_id_of_any_type(spark):
    rows, docs, labels = labelled(spark)
    once = quality.train(docs, labels)
    text_ids = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    named = labels.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    often = text_ids.unionByName(text_ids.where("doc_id = 'd5'").withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(20_000)))).drop("again"))
    again = quality.train(often, named)
    assert np.array_equal(once.emit, again.emit) and np.array_equal(once.move, again.move)


def test_viterbi_is_the_best_labelling():
    r = np.random.default_rng(1)
    first = np.array([0, 1, 5, 5, 11])
    x = r.standard_normal((11, quality.N_FEATURES)).astype(np.float32)
    f = quality.Field(r.standard_normal((2, quality.N_FEATURES)), r.standard_normal((2, 2)))
    got, score = f.viterbi(first, x), x @ f.emit.T
    for a, b in zip(first, first[1:]):
        total = lambda y: sum(score[a + i, v] for i, v in enumerate(y)) + sum(f.move[u, v] for u, v in zip(y, y[1:]))
        every = [[(n >> i) & 1 for i in range(b - a)] for n in range(1 << (b - a))]
        assert abs(total(got[a:b].tolist()) - max(map(total, every))) < 1e-4


def test_quality_without_labels(spark, docs, no_docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.train(docs, labels) is None
    assert quality.judge(no_docs, None).count() == 0


# personal data ---------------------------------------------------------------------------

def plain_spans(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_rule_spans():
    r = random.Random(1)
    parts = ["1", "23", "456", "7", "0", ".", " ", "-", "+", "@", "a", "b.c", "(", ")", "%", "é", "4111 1111 1111 1111", "001.2.3.4"]
    for _ in range(20_000):
        s = "".join(r.choice(parts) for _ in range(r.randint(1, 30)))
        assert pii.rule_spans(s) == plain_spans(s), s
    for long in ("1" * 200_000, "a." * 100_000, "1." * 100_000, "+1" + " (" * 100_000, "9 " * 100_000):
        pii.rule_spans(long)


def personal(spark):
    r = random.Random(8)
    fill = lambda n: " ".join(r.choice(["the", "Of", "heed", "tion,", "1990", "x"]) for _ in range(n))
    hexa = lambda: "".join(r.choice("0123456789abcdef") for _ in range(40))
    rows = edge_rows()
    for i in range(80):
        key = hexa()
        rows.append((600 + i, f'{fill(20)} mail é{i}.x@mail.example.com {fill(9)} 10.0.0.{i} {fill(9)} token = "{key}" {fill(30)} {key} {fill(5)}'
                              f' call: +1 (555) 555-{1000 + i} {fill(4)} card: 4111 1111 1111 1111'))
    return rows


def test_pii(spark):
    rows = personal(spark)
    docs = make_docs(spark, rows)
    field = pii.train(docs)
    found = pii.find(docs, field).collect()
    assert len(found) == len(rows)
    texts = dict(rows[-80:])
    for r in found:
        base = plain_spans(texts.get(r["doc_id"], "") if (r["doc_id"] or 0) >= 600 else dict(rows).get(r["doc_id"]) or "")
        own = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(own).encode()).hexdigest()
        assert set(own) <= set(r["spans"].split(",")) or not own
        if (r["doc_id"] or 0) >= 600:
            t = texts[r["doc_id"]]
            key = re.search('"([0-9a-f]{40})"', t).group(1)
            # the second mention has no cue of its own
            for m in re.finditer(key, t):
                assert f"secret:{m.start()}:{m.end()}" in r["spans"].split(",")
    clean = pii.redact(docs, field)
    assert clean.columns == docs.columns
    for r in clean.where("doc_id >= 600").collect():
        assert not re.search("[0-9a-f]{40}|@mail|4111|555-", r["text"]) and "<SECRET>" in r["text"] and "<EMAIL>" in r["text"]


def test_messages_are_exact_on_trees():
    """On a graph without loops message passing gives the exact marginals."""
    r = np.random.default_rng(3)
    n = len(pii.LABELS)
    f = pii.Field(r.standard_normal((n, pii.N_FEATURES)), r.standard_normal((n, n)), r.standard_normal((n, n)))
    f.skip = f.skip + f.skip.T
    x, old = r.standard_normal((4, pii.N_FEATURES)) * 0.3, pii.ROUNDS
    chained, skips = np.array([[0, 1], [2, 3]]), np.array([[1, 3]])
    pii.ROUNDS = 60
    got = f.marginals(x, chained, skips)
    pii.ROUNDS = old
    own, total = x @ f.weights.T, np.zeros((4, n))
    for y in np.ndindex(*(n,) * 4):
        p = np.exp(sum(own[i, v] for i, v in enumerate(y)) + sum(f.chain[y[a], y[b]] for a, b in chained) + f.skip[y[1], y[3]])
        for i, v in enumerate(y):
            total[i, v] += p
    assert np.allclose(got, total / total.sum(1, keepdims=True), atol=1e-4)


def test_pii_empty(no_docs):
    assert pii.train(no_docs) is None and pii.find(no_docs, None).count() == 0


# tokens ------------------------------------------------------------------------------------

def test_ids_equal_the_tokenizer(tokenizer):
    r = random.Random(1)
    alphabet = list("abz 's'tDÉßÑñ  \n\t.,!?12²½_-­İǅ ’“ \u0085\x1c\x01Σσ́日本\U0001F600<|endoftext|>")
    words = packing.WordIds(WORDS)
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 25))) for _ in range(5000)] + [t or "" for _, t in edge_rows()]
    for t, ids in zip(texts, words.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("size,windows,fan_in", [(4096, 8, 16), (64, 2, 2)])
def test_packing(spark, docs, tokenizer, size, windows, fan_in):
    got = packing.pack(docs, WORDS, size, windows, fan_in, with_ids=True).collect()
    want = Counter()
    for d, t in edge_rows():
        want[d, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (2,)] += 1
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] > 0
        sequences[r["sequence_id"]].append(r)
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
    waste = 0
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
        waste += size - at if at & (at - 1) else 0
    assert waste == 0
    # each id in exactly one piece: pieces of a document (copies together) tile it
    for (d, ids), times in want.items():
        cover = Counter()
        for r in pieces[d, len(ids)]:
            part = tuple(np.frombuffer(r["ids"], "<u4").tolist())
            if part == ids[r["start"]:r["start"] + r["length"]]:
                cover.update(range(r["start"], r["start"] + r["length"]))
        assert set(cover) == set(range(len(ids))) and min(cover.values()) >= times
    assert sum(r["length"] for r in got) == sum(len(ids) * n for (_, ids), n in want.items())


def test_packing_ids_beyond_doubles(spark):
    """Ids that a double cannot hold stay exact in a remainder group that also holds a null id."""
    big = [(1 << 62) + 1, (1 << 60) + 1, None]
    docs = spark.createDataFrame([(i, "a few words") for i in big], "doc_id bigint, text string").coalesce(1)
    assert {r["doc_id"] for r in packing.pack(docs, WORDS).collect()} == set(big)


def test_packing_empty(no_docs):
    assert packing.pack(no_docs, WORDS).count() == 0


def test_edit_aware_counts(tokenizer):
    r = random.Random(3)
    words = packing.WordIds.at(WORDS)
    mk = lambda n: "".join(r.choice(["a", "the ", "b", "'s", " ", "\n", "é.", "12", "zz"]) for _ in range(n))
    for _ in range(1500):
        s = mk(r.randint(0, 60))
        leaves = token_counts.cut_leaves(s, 8)
        d = token_counts.Document(s, [len(x) for x in leaves], token_counts.count(words, leaves))
        for _ in range(r.randint(1, 6)):
            a = r.randint(0, len(s) + 2)
            b, new = r.randint(a, a + 12), mk(r.randint(0, 4))
            d.edit(a, b, new)
            s = s[:a] + new + s[b:]
        for i, n in zip(sorted(d.marked), token_counts.count(words, [d.leaves[i] for i in sorted(d.marked)])):
            d.tree.put(1, i, n)
        assert "".join(d.leaves) == s and d.tree.chars == len(s)
        assert d.tree.tokens == len(tokenizer.encode(s, add_special_tokens=False).ids)


def test_edit_tables(spark, docs, tokenizer):
    edits = spark.createDataFrame(
        [(6, 2, 0, 4, "Zed "), (6, 1, 0, 0, "in front "), (2, 1, 5, 9, "new"), (3, 1, 0, 99, None), (4, 1, 3, 1, "s x"),
         (11, 1, 1000, 90_000, ""), (77777, 1, 0, 1, "x"), (13, 1, None, None, "n ")],
        "doc_id bigint, seq int, start bigint, end bigint, text string")
    state = token_counts.with_edits(token_counts.build(docs, WORDS), edits)
    once = token_counts.apply_edits(state, WORDS)
    twice = token_counts.apply_edits(once, WORDS, propose=token_counts.cleaning_edits_of)
    full = lambda t: len(tokenizer.encode(t or "", add_special_tokens=False).ids)
    for r in [*once.collect(), *twice.collect()]:
        assert r["n_tokens"] == full(r["text"]) == sum(r["leaf_tokens"]) and sum(r["leaf_chars"]) == len(r["text"] or "")
    one = {r["doc_id"]: r for r in once.collect()}
    assert one[4]["text"] == "ones x" and one[2]["text"] == "new" and one[3]["text"] == "" and one[6]["text"].startswith("Zed ront ")
    assert one[6]["n_edits"] == 2 and one[5]["n_encoded"] == 0 and one[6]["n_encoded"] > 0


def test_token_counts_empty(no_docs):
    assert token_counts.apply_edits(token_counts.build(no_docs, WORDS), WORDS, propose=token_counts.cleaning_edits_of).count() == 0
