"""Sources (A1-A4, A7, A8, A11).

Missing or unreadable input fails the job: Spark's own ``PATH_NOT_FOUND`` or a
decoding error surfaces, never a silent empty frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip_ws, universal_newlines

WORKS_SCHEMA = "map<string, array<struct<title: string, gutenberg_id: bigint>>>"


def read_text_files(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """A1: one row per file ``path, text, valid_utf8`` (whole file, universal newlines).

    ``strict`` decodes as a strict UTF-8 text read does: bad bytes fail the job.
    Otherwise invalid sequences become U+FFFD and ``valid_utf8`` flags the row.
    """
    raw = spark.read.format("binaryFile").load(path)
    as_str = F.col("content").cast("string")
    if strict:
        text = F.decode("content", "UTF-8")
    else:
        text = F.make_valid_utf8(as_str)
    out = raw.select("path", text.alias("text"), F.is_valid_utf8(as_str).alias("valid_utf8"))
    return out.select("path", universal_newlines("text").alias("text"), "valid_utf8")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A2: one row per line, ``path, line_no, text``; lines split on LF, CRLF, CR.

    Large files stay splittable: Spark's text reader cuts them into blocks read
    by many tasks. A line's number is its position inside its block (the block's
    rows arrive in file order within one scan task) plus the line count of the
    file's earlier blocks, ordered by ``_metadata.file_block_start`` - never by
    arrival order. The per-block table has one row per file split.
    """
    raw = spark.read.text(path).select(
        F.col("value").alias("text"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_bs"),
        F.monotonically_increasing_id().alias("_mi"))
    blocks = raw.groupBy("path", "_bs").agg(F.min("_mi").alias("_m0"),
                                            F.count(F.lit(1)).alias("_nl"))
    w = Window.partitionBy("path").orderBy("_bs").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_first", F.coalesce(F.sum("_nl").over(w), F.lit(0)))
    return raw.join(blocks.select("path", "_bs", "_m0", "_first"), ["path", "_bs"]).select(
        "path", (F.col("_first") + F.col("_mi") - F.col("_m0")).cast("long").alias("line_no"), "text")


def in_memory_table(spark: SparkSession, texts: list[str]) -> DataFrame:
    """A3: a small table from driver-side values (tests and tiny inputs only)."""
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)],
                                 "doc_id bigint, text string")


def load_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A4: a stored table, with a declared schema when given."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def parse_works(df: DataFrame, json_col: str = "value") -> DataFrame:
    """Works JSON (``{author: [{title, gutenberg_id}]}``) to ``author, title,
    gutenberg_id`` rows. Malformed JSON fails the job (FAILFAST)."""
    m = F.from_json(F.col(json_col), WORKS_SCHEMA, {"mode": "FAILFAST"})
    authors = df.select(F.explode(m).alias("author", "works"))
    return authors.select("author", F.explode("works").alias("w")).select(
        "author", F.col("w.title").alias("title"), F.col("w.gutenberg_id").alias("gutenberg_id"))


def read_works(spark: SparkSession, path: str, json_lines: bool = False) -> DataFrame:
    """A works file. By default each file is one JSON document (the original
    layout); with ``json_lines`` each line is a document, so a large works list
    is read by many tasks."""
    raw = spark.read.text(path, wholetext=not json_lines)
    return parse_works(raw, "value")


def prompt_table(lines: DataFrame, text_col: str = "text", key: str = "prompt_id",
                 order_col: str = "line_no") -> DataFrame:
    """Strip each line (Python whitespace) and drop blank ones. ``order_col``
    must identify a line: a line number for one file, ``row_idx`` for several."""
    return lines.select(F.col(order_col).cast("long").alias(key),
                        strip_ws(text_col).alias("prompt")).where(F.col("prompt") != "")


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """Prompts, one per line, of a file or a folder; ids number the lines of all files
    in (path, line) order, so two files' prompts never share one."""
    from ..operators.lines import number_lines
    return prompt_table(number_lines(read_lines(spark, path)), order_col="row_idx")
