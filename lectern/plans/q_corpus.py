"""Registered corpus queries: scan, clean, tokenize, pack, split, schedule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators.bpe import BLANK, CLOSE, OPEN, BytePairs, fit_bpe, tokenize_bpe
from ..operators.lines import clean_lines
from ..operators.pack import (BLOCK_COLS, pack_batch, pack_document, pack_file, pack_stats, token_offsets,
                              with_batches)
from ..operators.prefix import running_offsets
from ..operators.schedule import batch_plan, block_keys, step_events
from ..operators.split import split_exact
from ..operators.tokenize import (TOKEN_COLS, WORDS_PATTERN, detokenize, fit_vocab, pretokens, special_tokens,
                                  token_rows, tokenize, tokenize_bytes)
from ..session import cut_lineage
from . import oracle as o
from .inputs import WRAPPED_SQL, documents, wrapped_documents
from .registry import register

BLOCK = 128          # block size used by the registered packing queries
SEED = 42
PAD_WORD = "the"     # a frequent word of the corpus


def ids_str(c) -> F.Column:
    return F.array_join(F.col(c) if isinstance(c, str) else c, " ")


def cleaned_documents(spark: SparkSession, sf: str) -> DataFrame:
    d = documents(spark, sf)
    return d.select("doc_id", "lang", "source", tx.clean_text("text").alias("text"))


def corpus_vocab(docs: DataFrame) -> DataFrame:
    return fit_vocab(token_rows(docs, ["doc_id"], "text"))


def tokenized_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = cleaned_documents(spark, sf)
    return tokenize(docs, corpus_vocab(docs), ["doc_id"], "text", keep=["lang"])


def document_blocks(spark: SparkSession, sf: str, block_size: int = BLOCK) -> DataFrame:
    return pack_document(tokenized_documents(spark, sf), block_size, "doc_id", keep=["lang"])


def split_blocks(spark: SparkSession, sf: str, block_size: int = BLOCK) -> DataFrame:
    return split_exact(document_blocks(spark, sf, block_size), ["scope_id", "block_id"],
                       test_size=0.1, seed=SEED, materialize=True)


def document_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A2: ``doc_id, line_no, row_idx, text``; ``row_idx`` numbers lines across the
    corpus in (doc_id, line_no) order via the sliced prefix sum: one scan."""
    d = documents(spark, sf).select("doc_id", tx.split_lines("text").alias("_ls"))
    sized = d.withColumn("_nl", F.size("_ls").cast("long"))
    off = running_offsets(sized, [], "doc_id", "_nl", out="_first")
    return off.select("doc_id", F.posexplode("_ls").alias("line_no", "text"), "_first").select(
        "doc_id", F.col("line_no").cast("int").alias("line_no"),
        (F.col("_first") + F.col("line_no")).cast("long").alias("row_idx"), "text")


def tokenized_lines(spark: SparkSession, sf: str, add_eos: bool = False) -> DataFrame:
    """Tokenized lines, partitioned by 1,000-line batch (``batch_id``) after the ids are
    known: one shuffle, with batch-sized (never hot) keys, that the batch packers reuse."""
    lines = document_lines(spark, sf).withColumn("text", F.trim(tx.normalize_ws("text")))
    lines = cut_lineage(lines)          # numbered once, read by the vocabulary and the tokens
    vocab = fit_vocab(token_rows(lines, ["row_idx"], "text"))
    return with_batches(tokenize(lines, vocab, ["row_idx"], "text", keep=["doc_id"], add_eos=add_eos), 1000, "row_idx")


def block_columns(b: DataFrame, *keys: str) -> DataFrame:
    """All four block columns as text."""
    return b.select(*keys, *[ids_str(c).alias(c) for c in BLOCK_COLS])


def plan_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Block keys from token counts: no vocabulary and no ids."""
    counts = cleaned_documents(spark, sf).select("doc_id", F.size(pretokens("text")).alias("n_tokens"))
    return block_keys(counts, BLOCK)


# --------------------------------------------------------------------------- SQL

CORPUS = o.corpus_ctes()

LINES_SQL = r"""
lraw AS (SELECT doc_id, CASE WHEN text = '' THEN []::VARCHAR[] ELSE
           string_split_regex(regexp_replace(text, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n') END AS ls
         FROM documents),
loff AS (SELECT doc_id, ls, coalesce(sum(len(ls)) OVER (ORDER BY doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM lraw),
lines AS (SELECT doc_id, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS line_no,
                 first, unnest(ls) AS text FROM loff),
lines2 AS (SELECT doc_id, line_no, CAST(first + line_no AS BIGINT) AS row_idx, text FROM lines)"""

LINE_TOKENS_SQL = LINES_SQL + f""",
ltoks AS (SELECT doc_id, row_idx, unnest(l) AS tok, generate_subscripts(l, 1) - 1 AS pos
          FROM (SELECT doc_id, row_idx, {o.ws_tokens("trim(" + o.normalize_ws("text") + ", ' ')")} AS l
                FROM lines2)),
lvc AS (SELECT tok, count(*) AS cnt FROM ltoks WHERE tok NOT IN ('<unk>', '<|endoftext|>') GROUP BY tok),
lvocab AS (SELECT tok, row_number() OVER (ORDER BY cnt DESC, tok) + 1 AS id FROM lvc),
lids AS (SELECT t.doc_id, t.row_idx, t.pos, coalesce(v.id, 0) AS id FROM ltoks t LEFT JOIN lvocab v USING (tok)),
lrows AS (SELECT l.doc_id, l.row_idx, count(i.pos) AS n FROM lines2 l LEFT JOIN lids i USING (row_idx) GROUP BY ALL),
lrows2 AS (SELECT *, row_idx // 1000 AS batch_id,
   coalesce(sum(n) OVER (PARTITION BY row_idx // 1000 ORDER BY row_idx
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off,
   sum(n) OVER (PARTITION BY row_idx // 1000) AS btot FROM lrows)"""

DOC_BLOCKS_SQL = CORPUS + f""",
ntok AS (SELECT doc_id, count(*) AS n FROM tids GROUP BY doc_id),
blocks AS (
  SELECT CAST(doc_id AS BIGINT) AS scope_id, CAST(pos // {BLOCK} AS BIGINT) AS block_id, lang,
         string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS ids,
         CAST(count(*) AS BIGINT) AS n_tok, CAST(sum(id) AS BIGINT) AS sum_ids
  FROM tids JOIN ntok USING (doc_id) WHERE pos < (n // {BLOCK}) * {BLOCK} GROUP BY ALL)"""

SPLIT_SQL = DOC_BLOCKS_SQL + f""",
ranked AS (SELECT *, row_number() OVER (ORDER BY {o.md5key(SEED, 'scope_id', 'block_id')},
                  scope_id, block_id) - 1 AS r, count(*) OVER () AS n FROM blocks),
splitted AS (SELECT *, {o.split_label()} AS split FROM ranked)"""


MASKS_SQL = f"trim(repeat('1 ', {BLOCK})) AS attention_mask, trim(repeat('0 ', {BLOCK})) AS special_tokens_mask"


# ------------------------------------------------------------------ flagship

@register("block_summary", "WITH " + SPLIT_SQL + """
SELECT split, lang, CAST(count(*) AS BIGINT) AS n_blocks, CAST(sum(n_tok) AS BIGINT) AS n_tokens,
       CAST(sum(sum_ids) AS BIGINT) AS sum_ids
FROM splitted GROUP BY split, lang""")
def q_block_summary(spark: SparkSession, sf: str) -> DataFrame:
    """documents -> clean -> tokenize -> vocab -> pack_document(128) -> split_exact,
    then blocks, tokens and an id checksum per (split, lang)."""
    s = split_blocks(spark, sf)
    return s.groupBy("split", "lang").agg(
        F.count(F.lit(1)).alias("n_blocks"),
        F.sum(F.size("input_ids")).cast("long").alias("n_tokens"),
        F.sum(F.aggregate("input_ids", F.lit(0).cast("long"), lambda a, x: a + x)).cast("long")
        .alias("sum_ids"))


# ------------------------------------------------------------------ cleaning

@register("strip_header", f"SELECT doc_id, {o.strip_header('text')} AS text FROM ({WRAPPED_SQL})")
def q_strip_header(spark, sf):
    return wrapped_documents(spark, sf).select("doc_id", tx.strip_header("text").alias("text"))


@register("strip_footer", f"SELECT doc_id, {o.strip_footer('text')} AS text FROM ({WRAPPED_SQL})")
def q_strip_footer(spark, sf):
    return wrapped_documents(spark, sf).select("doc_id", tx.strip_footer("text").alias("text"))


@register("normalize_ws", f"SELECT doc_id, {o.normalize_ws('text')} AS text FROM documents")
def q_normalize_ws(spark, sf):
    return documents(spark, sf).select("doc_id", tx.normalize_ws("text").alias("text"))


@register("clean_text", f"SELECT doc_id, {o.clean('text')} AS text FROM ({WRAPPED_SQL})")
def q_clean_text(spark, sf):
    return wrapped_documents(spark, sf).select("doc_id", tx.clean_text("text").alias("text"))


@register("clean_lines", f"SELECT doc_id, {o.clean('text')} AS text FROM ({WRAPPED_SQL})")
def q_clean_lines(spark, sf):
    """Cleaning by lines, with no text as one value: its lines, joined, are the cleaned text."""
    d = wrapped_documents(spark, sf).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "text"))
    kept = clean_lines(d, "doc_id", "line_no").where("text <> ''")
    joined = kept.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(
        F.struct("line_no", "text"))), lambda x: x["text"]), " ").alias("text"))
    return documents(spark, sf).select("doc_id").join(joined, "doc_id", "left").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))


# ------------------------------------------------------------------ scans (A2)

@register("scan_lines", "WITH " + LINES_SQL + " SELECT doc_id, line_no, row_idx, text FROM lines2")
def q_scan_lines(spark, sf):
    return document_lines(spark, sf)


# ------------------------------------------------------------------ tokenize

@register("vocab", "WITH " + CORPUS + """
SELECT tok AS token, CAST(id AS BIGINT) AS id, CAST(cnt AS BIGINT) AS count FROM vocab
UNION ALL SELECT '<unk>', 0, 0 UNION ALL SELECT '<|endoftext|>', 1, 0""")
def q_vocab(spark, sf):
    v = corpus_vocab(cleaned_documents(spark, sf))
    return v.select("token", F.col("id").cast("long").alias("id"), "count")


@register("tokenize", "WITH " + CORPUS + """,
per AS (SELECT doc_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS ids,
               CAST(count(*) AS BIGINT) AS n FROM tids GROUP BY doc_id)
SELECT d.doc_id, d.lang, coalesce(p.n, 0) AS n_tokens, coalesce(p.ids, '') AS input_ids,
       trim(repeat('1 ', coalesce(p.n, 0))) AS attention_mask, trim(repeat('0 ', coalesce(p.n, 0))) AS special_tokens_mask
FROM cdocs d LEFT JOIN per p USING (doc_id)""")
def q_tokenize(spark, sf):
    t = tokenized_documents(spark, sf)
    return t.select("doc_id", "lang", F.size("input_ids").cast("long").alias("n_tokens"),
                    *[ids_str(c).alias(c) for c in TOKEN_COLS])


@register("tokenize_eos", "WITH " + CORPUS + """,
per AS (SELECT doc_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS ids,
               CAST(count(*) AS BIGINT) AS n FROM tids GROUP BY doc_id)
SELECT d.doc_id, coalesce(p.ids || ' 1', '1') AS input_ids, trim(repeat('1 ', coalesce(p.n, 0) + 1)) AS attention_mask,
       repeat('0 ', coalesce(p.n, 0)) || '1' AS special_tokens_mask
FROM cdocs d LEFT JOIN per p USING (doc_id)""")
def q_tokenize_eos(spark, sf):
    """An end token closes each document and is marked in the special mask."""
    docs = cleaned_documents(spark, sf)
    t = tokenize(docs, corpus_vocab(docs), ["doc_id"], "text", add_eos=True)
    return t.select("doc_id", *[ids_str(c).alias(c) for c in TOKEN_COLS])


@register("detokenize", "WITH " + CORPUS + """,
per AS (SELECT doc_id, string_agg(CASE WHEN id = 0 THEN '<unk>' ELSE tok END, ' ' ORDER BY pos) AS text
        FROM tids GROUP BY doc_id)
SELECT d.doc_id, coalesce(p.text, '') AS text FROM cdocs d LEFT JOIN per p USING (doc_id)""")
def q_detokenize(spark, sf):
    """Ids back to text, end tokens left out."""
    docs = cleaned_documents(spark, sf)
    vocab = cut_lineage(corpus_vocab(docs))
    return detokenize(tokenize(docs, vocab, ["doc_id"], "text", add_eos=True), vocab, ["doc_id"])


WORDS_SQL = "WITH " + o.corpus_ctes(token_expr="regexp_extract_all(text, " + o.q(WORDS_PATTERN) + ")") + """,
per AS (SELECT doc_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS ids,
               CAST(count(*) AS BIGINT) AS n FROM tids GROUP BY doc_id)
SELECT d.doc_id, coalesce(p.n, 0) AS n_tokens, coalesce(p.ids, '') AS input_ids
FROM cdocs d LEFT JOIN per p USING (doc_id)"""


@register("tokenize_words", WORDS_SQL)
def q_tokenize_words(spark, sf):
    """I2 with the word pre-tokenizer: letter runs, digit runs, single marks."""
    docs = cleaned_documents(spark, sf)
    v = fit_vocab(token_rows(docs, ["doc_id"], "text", scheme="words"))
    t = tokenize(docs, v, ["doc_id"], "text", scheme="words")
    return t.select("doc_id", F.size("input_ids").cast("long").alias("n_tokens"),
                    ids_str("input_ids").alias("input_ids"))


BYTES_SQL = """
SELECT doc_id, CAST(len(b) AS BIGINT) AS n_tokens, CAST(coalesce(list_sum(b), 0) AS BIGINT) AS id_sum,
       md5(array_to_string(b, ' ')) AS ids_md5
FROM (SELECT doc_id, list_transform(range(0, CAST(len(h) / 2 AS BIGINT)),
             lambda i: CAST(('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2)) AS INTEGER)) AS b
      FROM (SELECT doc_id, hex(encode(text)) AS h FROM documents))"""


@register("tokenize_bytes", BYTES_SQL)
def q_tokenize_bytes(spark, sf):
    t = tokenize_bytes(documents(spark, sf), ["doc_id"], "text")
    return t.select(
        "doc_id", F.size("input_ids").cast("long").alias("n_tokens"),
        F.aggregate("input_ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("id_sum"),
        F.md5(ids_str("input_ids")).alias("ids_md5"))


@register("special_tokens", "WITH " + CORPUS + f"""
SELECT * FROM (VALUES ('unk', '<unk>', 0), ('eos', '<|endoftext|>', 1)) AS t(name, token, id)
UNION ALL SELECT 'pad', tok, CAST(id AS INTEGER) FROM vocab WHERE tok = '{PAD_WORD}'""")
def q_special_tokens(spark, sf):
    """B11 with a corpus word as the pad token: its id follows from the fitted vocabulary."""
    v = cut_lineage(corpus_vocab(cleaned_documents(spark, sf)))
    return special_tokens(v, PAD_WORD).select("name", "token", F.col("id").cast("int").alias("id"))


# ------------------------------------------------------------------ byte-pair vocabulary

N_MERGES = 24


def _bpe_sql(n: int) -> str:
    """Sequential training, one step per merge: count neighbouring symbols, take the best, replace it."""
    o_, c_ = o.q(OPEN), o.q(CLOSE)
    parts = [CORPUS, f"""
w0 AS MATERIALIZED (SELECT tok AS word, count(*) AS n,
  {o_} || '{BLANK}' || {c_} || regexp_replace(tok, '(?s)(.)', {o_} || '\\1' || {c_}, 'g') AS s FROM toks GROUP BY tok)"""]
    cut = f"string_split(substr(s, 2, length(s) - 2), {c_} || {o_})"
    for k in range(1, n + 1):
        parts.append(f"""
b{k} AS MATERIALIZED (SELECT a[i] AS l, a[i + 1] AS r, sum(n) AS c
  FROM (SELECT n, a, unnest(range(1, len(a))) AS i FROM (SELECT n, {cut} AS a FROM w{k - 1}))
  GROUP BY ALL HAVING sum(n) >= 2 ORDER BY c DESC, l, r LIMIT 1),
w{k} AS MATERIALIZED (SELECT word, n, coalesce(replace(s, (SELECT {o_} || l || {c_} || {o_} || r || {c_} FROM b{k}),
  (SELECT {o_} || l || r || {c_} FROM b{k})), s) AS s FROM w{k - 1})""")
    listed = " UNION ALL ".join(f"SELECT {k} AS rank, l, r, c FROM b{k}" for k in range(1, n + 1))
    parts.append(f"""
bm AS ({listed}),
bv AS (SELECT t, row_number() OVER (ORDER BY min(rank), t) + 1 AS id FROM (
  SELECT unnest({cut}) AS t, 0 AS rank FROM w0 UNION ALL SELECT l || r, rank FROM bm) GROUP BY t)""")
    return ",".join(parts).replace("\\\\1", "\\1")


BPE_SQL = _bpe_sql(N_MERGES)


def corpus_bpe(docs: DataFrame) -> BytePairs:
    return fit_bpe(token_rows(docs, ["doc_id"], "text"), N_MERGES)


@register("bpe_merges", "WITH " + BPE_SQL + """
SELECT CAST(rank AS INTEGER) AS rank, l AS "left", r AS "right", CAST(c AS BIGINT) AS count FROM bm""")
def q_bpe_merges(spark, sf):
    """The first merges of a byte-pair vocabulary over the cleaned corpus."""
    return corpus_bpe(cleaned_documents(spark, sf)).merges


@register("tokenize_bpe", "WITH " + BPE_SQL + f""",
seg AS (SELECT word, string_split(substr(s, 2, length(s) - 2), {o.q(CLOSE)} || {o.q(OPEN)}) AS a FROM w{N_MERGES}),
sid AS (SELECT word, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY i) AS ids, count(*) AS n
        FROM (SELECT word, unnest(a) AS t, generate_subscripts(a, 1) AS i FROM seg) JOIN bv USING (t) GROUP BY word),
per AS (SELECT doc_id, string_agg(ids, ' ' ORDER BY pos) AS ids, sum(n) AS n FROM toks JOIN sid ON tok = word GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(per.n, 0) AS BIGINT) AS n_tokens, coalesce(per.ids, '') AS input_ids
FROM cdocs d LEFT JOIN per USING (doc_id)""")
def q_tokenize_bpe(spark, sf):
    """Documents as subword ids."""
    docs = cleaned_documents(spark, sf)
    t = tokenize_bpe(docs, corpus_bpe(docs), ["doc_id"])
    return t.select("doc_id", F.size("input_ids").cast("long").alias("n_tokens"), ids_str("input_ids").alias("input_ids"))


# ------------------------------------------------------------------ packing

@register("pack_document", "WITH " + DOC_BLOCKS_SQL + """
SELECT scope_id, block_id, lang, ids AS input_ids, """ + MASKS_SQL + """, ids AS labels FROM blocks""")
def q_pack_document(spark, sf):
    return block_columns(document_blocks(spark, sf), "scope_id", "block_id", "lang")


@register("pack_stats", "WITH " + CORPUS + f""",
n AS (SELECT d.doc_id, CAST(count(t.pos) AS BIGINT) AS n FROM cdocs d LEFT JOIN tids t USING (doc_id)
      GROUP BY d.doc_id)
SELECT CAST(doc_id AS BIGINT) AS scope_id, n AS n_tokens, (n // {BLOCK}) * {BLOCK} AS usable_tokens,
       n // {BLOCK} AS n_blocks, n - (n // {BLOCK}) * {BLOCK} AS dropped_tokens FROM n""")
def q_pack_stats(spark, sf):
    """Needs only token counts: no vocabulary, no ids."""
    return pack_stats(cleaned_documents(spark, sf).select("doc_id", pretokens("text").alias("toks")), BLOCK, "doc_id", "toks")


@register("token_offsets", "WITH " + LINE_TOKENS_SQL + """
SELECT doc_id, row_idx, CAST(batch_id AS BIGINT) AS batch_id, CAST(n AS BIGINT) AS n_tokens,
       CAST(off AS BIGINT) AS offset FROM lrows2""")
def q_token_offsets(spark, sf):
    t = token_offsets(tokenized_lines(spark, sf), 1000, "row_idx",
                      batch_col="batch_id")
    return t.select("doc_id", "row_idx", "batch_id", "n_tokens", "offset")


@register("pack_batch", "WITH " + LINE_TOKENS_SQL + f""",
g AS (SELECT r.batch_id, r.btot, i.row_idx, i.pos, i.id, r.off + i.pos AS gpos
      FROM lids i JOIN lrows2 r USING (row_idx))
SELECT CAST(batch_id AS BIGINT) AS scope_id, CAST(gpos // {BLOCK} AS BIGINT) AS block_id,
       string_agg(CAST(id AS VARCHAR), ' ' ORDER BY gpos) AS input_ids, {MASKS_SQL},
       string_agg(CAST(id AS VARCHAR), ' ' ORDER BY gpos) AS labels
FROM g WHERE gpos < (btot // {BLOCK}) * {BLOCK} GROUP BY batch_id, gpos // {BLOCK}""")
def q_pack_batch(spark, sf):
    b = pack_batch(tokenized_lines(spark, sf), BLOCK, 1000, "row_idx",
                   batch_col="batch_id")
    return block_columns(b, "scope_id", "block_id")


@register("pack_batch_eos", "WITH " + LINE_TOKENS_SQL + f""",
elids AS (SELECT row_idx, pos, id FROM lids UNION ALL SELECT row_idx, n, 1 FROM lrows),
erows AS (SELECT row_idx, row_idx // 1000 AS batch_id,
   coalesce(sum(n + 1) OVER (PARTITION BY row_idx // 1000 ORDER BY row_idx
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off,
   sum(n + 1) OVER (PARTITION BY row_idx // 1000) AS btot FROM lrows),
g AS (SELECT r.batch_id, r.btot, i.id, r.off + i.pos AS gpos FROM elids i JOIN erows r USING (row_idx))
SELECT CAST(batch_id AS BIGINT) AS scope_id, CAST(gpos // {BLOCK} AS BIGINT) AS block_id,
       string_agg(CAST(id AS VARCHAR), ' ' ORDER BY gpos) AS input_ids, trim(repeat('1 ', {BLOCK})) AS attention_mask,
       string_agg(CASE WHEN id = 1 THEN '1' ELSE '0' END, ' ' ORDER BY gpos) AS special_tokens_mask,
       string_agg(CAST(id AS VARCHAR), ' ' ORDER BY gpos) AS labels
FROM g WHERE gpos < (btot // {BLOCK}) * {BLOCK} GROUP BY batch_id, gpos // {BLOCK}""")
def q_pack_batch_eos(spark, sf):
    """With an end token per line, the special mask is cut like the ids."""
    b = pack_batch(tokenized_lines(spark, sf, add_eos=True), BLOCK, 1000, "row_idx", batch_col="batch_id")
    return block_columns(b, "scope_id", "block_id")


@register("pack_file", "WITH " + LINE_TOKENS_SQL + f""",
g AS (SELECT i.doc_id, i.id, i.row_idx, i.pos,
             row_number() OVER (PARTITION BY i.doc_id ORDER BY i.row_idx, i.pos) - 1 AS gpos,
             count(*) OVER (PARTITION BY i.doc_id) AS tot FROM lids i)
SELECT CAST(doc_id AS BIGINT) AS scope_id, CAST(gpos // {BLOCK} AS BIGINT) AS block_id,
       string_agg(CAST(id AS VARCHAR), ' ' ORDER BY gpos) AS input_ids, {MASKS_SQL},
       string_agg(CAST(id AS VARCHAR), ' ' ORDER BY gpos) AS labels
FROM g WHERE gpos < (tot // {BLOCK}) * {BLOCK} GROUP BY doc_id, gpos // {BLOCK}""")
def q_pack_file(spark, sf):
    b = pack_file(tokenized_lines(spark, sf), BLOCK, "doc_id", "row_idx")
    return block_columns(b, "scope_id", "block_id")


# ------------------------------------------------------------------ split and schedule

@register("split_exact", "WITH " + SPLIT_SQL + " SELECT scope_id, block_id, split FROM splitted")
def q_split_exact(spark, sf):
    return split_blocks(spark, sf).select("scope_id", "block_id", "split")


@register("split_small", "WITH " + DOC_BLOCKS_SQL + f""",
ranked AS (SELECT *, row_number() OVER (PARTITION BY scope_id ORDER BY
                  {o.md5key(SEED, 'scope_id', 'block_id')}, block_id) - 1 AS r,
                  count(*) OVER (PARTITION BY scope_id) AS n FROM blocks)
SELECT scope_id, block_id, {o.split_label()} AS split FROM ranked""")
def q_split_small(spark, sf):
    """Per-book split (each document's blocks on their own); books with one block
    land in both splits (G3)."""
    b = document_blocks(spark, sf)
    return split_exact(b, ["scope_id", "block_id"], 0.1, SEED, scope=["scope_id"],
                       materialize=True).select(
        "scope_id", "block_id", "split")


PLAN_SQL = DOC_BLOCKS_SQL + f""",
ep AS (SELECT scope_id, block_id, unnest(range(0, 3)) AS epoch FROM blocks),
pr AS (SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY
         {o.md5key(SEED, 'epoch', 'scope_id', 'block_id')}, scope_id, block_id) - 1 AS r,
         count(*) OVER (PARTITION BY epoch) AS n FROM ep),
plan AS (SELECT CAST(epoch AS INTEGER) AS epoch,
                CAST(epoch * ceil(n / 8) + r // 8 + 1 AS BIGINT) AS step,
                CAST(r // 8 AS BIGINT) AS batch_id, scope_id, block_id FROM pr)"""


@register("batch_plan", "WITH " + PLAN_SQL + " SELECT * FROM plan")
def q_batch_plan(spark, sf):
    return batch_plan(plan_keys(spark, sf), ["scope_id", "block_id"], epochs=3, batch_size=8, seed=SEED)


@register("step_events", "WITH " + PLAN_SQL + """,
steps AS (SELECT DISTINCT step FROM plan)
SELECT step, 'log' AS event FROM steps WHERE step % 100 = 0
UNION ALL SELECT step, 'evaluate' FROM steps WHERE step % 500 = 0
UNION ALL SELECT step, 'save' FROM steps WHERE step % 500 = 0""")
def q_step_events(spark, sf):
    return step_events(plan_keys(spark, sf), 3, 8, 100, 500, 500)
