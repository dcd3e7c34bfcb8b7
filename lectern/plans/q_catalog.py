"""Registered catalogue, naming, prompt and count queries.

The driver's tables have no works list or catalogue, so both are derived from
``documents`` (author = source, title = language and a title number taken from
the document id, media type from length, language name from the code) and the
already-landed manifest from ``labels``. Both engines derive them the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import catalog as cat
from ..operators.resolve import resolve_ranked
from ..sources.files import parse_works
from . import oracle as o
from .inputs import documents, table
from .registry import register

ROOT = "downloads"
PROMPT_ROLE = "user"        # whose turns are prompts


def order():
    """Catalogue rank: longer items first, then by document id."""
    return [F.col("n_chars").desc(), F.col("doc_id").asc()]
LANG_NAMES = {"en": "English", "fr": "French", "de": "German", "es": "Spanish"}


def _title(lang: str = "lang", doc_id: str = "doc_id"):
    return F.concat(F.col(lang), F.lit("-"), (F.col(doc_id) % 50).cast("string"))


def works_with_ids(spark: SparkSession, sf: str) -> DataFrame:
    """``author, title, gutenberg_id``: one entry per document; the id is the
    document id for labelled good-quality documents, 0 for labelled poor ones and
    missing otherwise."""
    d = documents(spark, sf).select("doc_id", "source", "lang")
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    j = d.join(lab, "doc_id", "left")
    gid = F.when(F.col("quality") == 1, F.col("doc_id")).when(F.col("quality") == 0, F.lit(0))
    return j.select(F.col("source").alias("author"), _title().alias("title"),
                    gid.cast("long").alias("gutenberg_id"))


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    d = documents(spark, sf).select("doc_id", "source", "lang", "n_chars")
    lang = F.create_map(*[x for k, v in LANG_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return d.select(
        F.concat(F.lit("item"), F.col("doc_id").cast("string")).alias("identifier"),
        F.col("source").alias("author"), _title().alias("title"),
        F.when(F.col("n_chars") >= 500, F.lit("texts")).otherwise(F.lit("audio")).alias("mediatype"),
        F.element_at(lang, F.col("lang")).alias("language"), "n_chars", "doc_id", "lang")


def item_files(spark: SparkSession, sf: str) -> DataFrame:
    """Every item has a scan text and a PDF; items of 3,000 characters or more
    also have a plain-text file."""
    c = catalog(spark, sf)
    i = F.col("identifier")
    files = F.array(
        F.struct(F.concat(i, F.lit("_djvu.txt")).alias("name"), F.lit("DjVuTXT").alias("format")),
        F.when(F.col("n_chars") >= 3000, F.struct(F.concat(i, F.lit(".txt")).alias("name"),
                                                  F.lit("Text").alias("format"))),
        F.struct(F.concat(i, F.lit(".pdf")).alias("name"), F.lit("Text PDF").alias("format")))
    return c.select("identifier", F.explode(F.filter(files, lambda x: x.isNotNull())).alias("f")) \
        .select("identifier", "f.name", "f.format")


def resolved(spark: SparkSession, sf: str) -> DataFrame:
    return cat.resolve_works(works_with_ids(spark, sf), catalog(spark, sf),
                             [(-F.col("n_chars")).alias("k1"), F.col("doc_id").alias("k2")])


def planned(spark: SparkSession, sf: str) -> DataFrame:
    return cat.planned_downloads(resolved(spark, sf), item_files(spark, sf), ROOT)


# --------------------------------------------------------------------------- SQL

def sanitize_sql(e: str) -> str:
    return f"rtrim(regexp_replace({e}, '[^\\p{{L}}\\p{{N}} ._-]', '', 'g'), ' ')"


CAT_SQL = f"""
works AS (SELECT d.source AS author, d.lang || '-' || CAST(d.doc_id % 50 AS VARCHAR) AS title,
                 CAST(CASE WHEN l.quality = 1 THEN d.doc_id WHEN l.quality = 0 THEN 0 END AS BIGINT)
                   AS gutenberg_id
          FROM documents d LEFT JOIN labels l USING (doc_id)),
catalog AS (SELECT 'item' || CAST(doc_id AS VARCHAR) AS identifier, source AS author,
                   lang || '-' || CAST(doc_id % 50 AS VARCHAR) AS title,
                   CASE WHEN n_chars >= 500 THEN 'texts' ELSE 'audio' END AS mediatype,
                   CASE lang {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in LANG_NAMES.items())} END
                     AS language, n_chars, doc_id, lang FROM documents),
searchable AS (SELECT * FROM catalog WHERE mediatype = 'texts' AND language = 'English'),
files AS (SELECT identifier, identifier || '_djvu.txt' AS name, 'DjVuTXT' AS format FROM catalog
          UNION ALL SELECT identifier, identifier || '.txt', 'Text' FROM catalog WHERE n_chars >= 3000
          UNION ALL SELECT identifier, identifier || '.pdf', 'Text PDF' FROM catalog),
wk AS (SELECT DISTINCT author, title FROM works),
best AS (SELECT author, title, arg_min(identifier, (-n_chars, doc_id)) AS identifier
         FROM searchable GROUP BY author, title),
resolved AS (SELECT wk.author, wk.title, best.identifier FROM wk LEFT JOIN best USING (author, title)),
planned AS (SELECT r.author, r.title, r.identifier, f.name,
                   '{ROOT}/' || {sanitize_sql('r.author')} || '/' || r.identifier || '/' || f.name
                   AS path
            FROM resolved r JOIN files f ON f.identifier = r.identifier AND f.format = 'Text')"""


@register("works_flatten", """
SELECT source || suffix AS author, lang || '-' || CAST(doc_id % 50 AS VARCHAR) || title_end AS title,
       CASE WHEN has_id THEN CAST(doc_id AS BIGINT) END AS gutenberg_id
FROM documents, (VALUES ('', '', true), ('', ' "vol. 2"', false), (' jr.', '', true)) t(suffix, title_end, has_id)""")
def q_works_flatten(spark, sf):
    """A works JSON value per row, with two authors and several titles (one with
    quotes and without an id), parsed back to flat rows."""
    d = documents(spark, sf)
    work = lambda title, gid: F.struct(title.alias("title"), gid.alias("gutenberg_id"))
    gid = F.col("doc_id").cast("long")
    js = F.to_json(F.create_map(
        F.col("source"), F.array(work(_title(), gid), work(F.concat(_title(), F.lit(' "vol. 2"')), F.lit(None).cast("long"))),
        F.concat("source", F.lit(" jr.")), F.array(work(_title(), gid))))
    return parse_works(d.select(js.alias("value")), "value")


@register("works_routable", "WITH " + CAT_SQL + """
SELECT author, title, gutenberg_id,
       coalesce(gutenberg_id IS NOT NULL AND gutenberg_id <> 0, false) AS routable FROM works""")
def q_works_routable(spark, sf):
    return cat.works_routable(works_with_ids(spark, sf))


@register("resolve_works", "WITH " + CAT_SQL + " SELECT author, title, identifier FROM resolved")
def q_resolve_works(spark, sf):
    return resolved(spark, sf)


@register("candidate_items", "WITH " + CAT_SQL + """
SELECT wk.author, wk.title, CAST(c.rank AS INTEGER) AS rank, c.identifier FROM wk JOIN
  (SELECT * FROM (SELECT author, title, identifier, row_number() OVER (PARTITION BY author, title
                  ORDER BY n_chars DESC, doc_id) AS rank FROM searchable) WHERE rank <= 5) c
  USING (author, title)""")
def q_candidate_items(spark, sf):
    return cat.candidate_items(works_with_ids(spark, sf), catalog(spark, sf), order(), 5)


_TERMS = " UNION ".join(f"SELECT {{key}}, unnest(regexp_extract_all(lower({c}), '[\\p{{{{L}}}}\\p{{{{N}}}}]+')) AS word, '{c[0]}' AS f, {n} AS k FROM {{src}}"
                       for c, n in (("author", 1), ("title", 2)))


@register("resolve_ranked", "WITH " + CAT_SQL + f""",
loose AS (SELECT DISTINCT author, CAST(gutenberg_id % 50 AS VARCHAR) || ' / ' || title || ', vol. '
                 || CAST(gutenberg_id % 3 AS VARCHAR) AS title FROM works WHERE gutenberg_id IS NOT NULL),
item AS ({_TERMS.format(key='identifier, n_chars, doc_id', src='searchable')}),
want AS ({_TERMS.format(key='author, title', src='loose')}),
df AS (SELECT f, word, count(*) AS df FROM item GROUP BY f, word),
imp AS (SELECT author, title, f, word, k * length(bin((SELECT count(*) FROM searchable) // df)) AS impact
        FROM want JOIN df USING (f, word)),
tot AS (SELECT author, title, sum(impact) AS total FROM imp GROUP BY author, title),
hit AS (SELECT i.author, i.title, identifier, n_chars, doc_id, sum(impact) AS score
        FROM imp i JOIN item USING (f, word) GROUP BY ALL),
placed AS (SELECT author, title, identifier, score,
                  row_number() OVER (PARTITION BY author, title ORDER BY score DESC, n_chars DESC, doc_id) AS rank
           FROM hit JOIN tot USING (author, title) WHERE 100 * score >= 50 * total)
SELECT author, title, CAST(rank AS INTEGER) AS rank, identifier, CAST(score AS BIGINT) AS score FROM placed WHERE rank <= 5""")
def q_resolve_ranked(spark, sf):
    """D1/F2, loose: titles with their words in another order, a number and a volume added."""
    w = works_with_ids(spark, sf).where("gutenberg_id is not null")
    number = lambda m: (F.col("gutenberg_id") % m).cast("string")
    loose = w.withColumn("title", F.concat(number(50), F.lit(" / "), F.col("title"), F.lit(", vol. "), number(3)))
    return resolve_ranked(loose, catalog(spark, sf), [-F.col("n_chars"), F.col("doc_id")])


@register("unresolved_works", "WITH " + CAT_SQL + """
SELECT author, title FROM wk WHERE NOT EXISTS
  (SELECT 1 FROM searchable s WHERE s.author = wk.author AND s.title = wk.title)""")
def q_unresolved_works(spark, sf):
    return cat.unresolved_works(works_with_ids(spark, sf), catalog(spark, sf))


@register("text_files", "WITH " + CAT_SQL + " SELECT identifier, name, format FROM files WHERE format = 'Text'")
def q_text_files(spark, sf):
    return cat.text_files(item_files(spark, sf))


@register("items_with_text", "WITH " + CAT_SQL + """
SELECT DISTINCT identifier FROM resolved r WHERE identifier IS NOT NULL
  AND EXISTS (SELECT 1 FROM files f WHERE f.identifier = r.identifier AND f.format = 'Text')""")
def q_items_with_text(spark, sf):
    items = resolved(spark, sf).where(F.col("identifier").isNotNull()).select("identifier").distinct()
    return cat.items_with_text(items, item_files(spark, sf), True)


@register("items_without_text", "WITH " + CAT_SQL + """
SELECT DISTINCT identifier FROM resolved r WHERE identifier IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM files f WHERE f.identifier = r.identifier AND f.format = 'Text')""")
def q_items_without_text(spark, sf):
    """D3 complement: resolved items that have no plain-text file (download fails)."""
    items = resolved(spark, sf).where(F.col("identifier").isNotNull()).select("identifier").distinct()
    return cat.items_with_text(items, item_files(spark, sf), False)


@register("new_files_only", "WITH " + CAT_SQL + """,
manifest AS (SELECT p.path FROM planned p JOIN catalog c USING (identifier)
             WHERE c.doc_id IN (SELECT doc_id FROM labels))
SELECT author, title, identifier, name, path FROM planned
WHERE path NOT IN (SELECT path FROM manifest)""")
def q_new_files_only(spark, sf):
    """The already-landed manifest is the planned files of labelled documents."""
    p = planned(spark, sf)
    landed = p.join(catalog(spark, sf).select("identifier", "doc_id"), "identifier") \
        .join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi").select("path")
    return cat.new_files_only(p, landed).select("author", "title", "identifier", "name", "path")


@register("fetch_tally", "WITH " + CAT_SQL + """,
st AS (SELECT CASE WHEN r.identifier IS NULL THEN 'not_found'
                   WHEN NOT EXISTS (SELECT 1 FROM files f WHERE f.identifier = r.identifier
                                    AND f.format = 'Text') THEN 'failed'
                   ELSE 'success' END AS status FROM works w JOIN resolved r
                     ON r.author = w.author AND r.title = w.title)
SELECT status, CAST(count(*) AS BIGINT) AS n FROM st GROUP BY status""")
def q_fetch_tally(spark, sf):
    """One outcome per entry of the works list, repeated entries included."""
    status = cat.fetch_status(resolved(spark, sf), item_files(spark, sf))
    return cat.fetch_tally(status, works_with_ids(spark, sf))


@register("sanitize_name", f"SELECT page_id, {sanitize_sql('url')} AS name FROM pages")
def q_sanitize_name(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.sanitize_name("url").alias("name"))


@register("landing_path", "WITH " + CAT_SQL + f"""
SELECT author, title, '{ROOT}/' || {sanitize_sql('author')} || '/' || {sanitize_sql('title')} || '.txt'
       AS path FROM wk""")
def q_landing_path(spark, sf):
    w = works_with_ids(spark, sf).select("author", "title").distinct()
    return w.select("author", "title", tx.landing_path(F.lit(ROOT), "author", "title").alias("path"))


@register("archive_query", "WITH " + CAT_SQL + """
SELECT author, title, 'creator:"' || author || '" AND title:"' || title
       || '" AND mediatype:texts AND language:"English"' AS query FROM wk""")
def q_archive_query(spark, sf):
    w = works_with_ids(spark, sf).select("author", "title").distinct()
    return w.select("author", "title", tx.archive_query("author", "title").alias("query"))


@register("prompt_scan", f"""
SELECT conv_id, turn, CAST(line_no AS INTEGER) AS line_no, prompt FROM (
  SELECT conv_id, turn, generate_subscripts(ls, 1) - 1 AS line_no, {o.strip_ws('unnest(ls)')} AS prompt
  FROM (SELECT conv_id, turn, CASE WHEN text = '' THEN []::VARCHAR[] ELSE
          string_split_regex(regexp_replace(text, '(\\r\\n|\\r|\\n)\\z', ''), '\\r\\n|\\r|\\n') END AS ls
        FROM conversations WHERE role = '{PROMPT_ROLE}'))
WHERE prompt <> ''""")
def q_prompt_scan(spark, sf):
    """User turns of the conversations as prompt files: one prompt per line,
    stripped, blanks dropped."""
    c = table(spark, sf, "conversations").where(F.col("role") == PROMPT_ROLE)
    lines = c.select("conv_id", "turn", F.posexplode(tx.split_lines("text")).alias("line_no", "text"))
    p = lines.select("conv_id", "turn", F.col("line_no").cast("int").alias("line_no"),
                     tx.strip_ws("text").alias("prompt"))
    return p.where(F.col("prompt") != "")


@register("corpus_counts", "WITH " + CAT_SQL + f""",
pr AS (SELECT {o.clean('text')} AS p FROM benchmark)
SELECT 'documents' AS metric, CAST(count(*) AS BIGINT) AS value FROM documents
UNION ALL SELECT 'works', CAST(count(*) AS BIGINT) FROM works
UNION ALL SELECT 'prompts', CAST(count(*) AS BIGINT) FROM pr WHERE p <> ''""")
def q_corpus_counts(spark, sf):
    """Progress counts, all from one scan each (small aggregate rows); every entry
    of the works list counts."""
    docs = documents(spark, sf).agg(F.count(F.lit(1)).alias("value")) \
        .select(F.lit("documents").alias("metric"), "value")
    works = works_with_ids(spark, sf).agg(F.count(F.lit(1)).alias("value")).select(F.lit("works").alias("metric"), "value")
    pr = table(spark, sf, "benchmark").select(tx.clean_text("text").alias("p")).where(F.col("p") != "") \
        .agg(F.count(F.lit(1)).alias("value")).select(F.lit("prompts").alias("metric"), "value")
    return docs.unionByName(works).unionByName(pr)
