"""Boilerplate removal and numbering for line tables (B1-B5 without whole-file values).

A file too long to be one value is a table of lines. Where its header ends and its
footer begins are two positions (line, column) per file, found by aggregating the few
lines that hold a marker; applying them is one size-checked lookup of a row per
file. The result equals cleaning the whole text: the same tokens in the same order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import FOOTER_MARKER, HEADER_MARKER, normalize_ws
from ..session import cut_lineage
from .joins import lookup, string_cells, table_size
from .prefix import dense_ordinal, running_offsets

STARS = "***"


def _last(text: Column, what: str) -> Column:
    """0-based column of the last occurrence of ``what``, overlapping ones included; -1 if none."""
    back = F.instr(F.reverse(text), what[::-1])
    return F.when(back > 0, F.length(text) - back - len(what) + 1).otherwise(-1)


def _first_from(text: Column, what: str, start: Column) -> Column:
    """0-based column of the first occurrence at or after ``start``; -1 if none."""
    at = F.instr(F.substr(text, start + 1), what)
    return F.when(at > 0, at - 1 + start).otherwise(-1)


def content_bounds(lines: DataFrame, key: str = "path", order: str = "line_no") -> DataFrame:
    """Per file with a marker: ``_l0, _c0`` (where the text after the header begins) and
    ``_l1, _c1`` (where the footer begins; null: the end), as line and 0-based column.

    The header reaches to the first ``***`` after the last start marker that has one
    after it; the footer starts at the first end marker after that.
    """
    t = F.col("text")
    at = lines.select(key, F.col(order).alias("_l"), "text")
    marked = at.where(F.contains(t, F.lit(HEADER_MARKER)) | F.contains(t, F.lit(FOOTER_MARKER)))
    stars = at.where(F.contains(t, F.lit(STARS)))
    place = lambda column: F.struct(F.col("_l").alias("l"), column.cast("int").alias("c"))

    # the last place where a header can close, then the last start marker before it
    last_star = stars.groupBy(key).agg(F.max(place(_last(t, STARS))).alias("_star"))
    starts = marked.where(F.contains(t, F.lit(HEADER_MARKER))).join(last_star, key)
    same = F.col("_l") == F.col("_star.l")
    before = F.when(same, F.substring(t, F.lit(1), F.col("_star.c"))).otherwise(t)
    begin = _last(before, HEADER_MARKER)
    opened = (starts.where((F.col("_l") <= F.col("_star.l")) & (begin >= 0)).groupBy(key)
              .agg(F.max(place(begin + len(HEADER_MARKER))).alias("_open")))
    closing = stars.join(opened, key).where(F.col("_l") >= F.col("_open.l"))
    close = _first_from(t, STARS, F.when(F.col("_l") == F.col("_open.l"), F.col("_open.c")).otherwise(F.lit(0)))
    closed = (closing.withColumn("_close", close).where(F.col("_close") >= 0).groupBy(key)
              .agg(F.min(place(F.col("_close") + len(STARS))).alias("_cut")))

    footers = marked.where(F.contains(t, F.lit(FOOTER_MARKER))).join(closed, key, "left").where(
        F.col("_cut").isNull() | (F.col("_l") >= F.col("_cut.l")))
    foot = _first_from(t, FOOTER_MARKER, F.when(F.col("_l") == F.col("_cut.l"), F.col("_cut.c")).otherwise(F.lit(0)))
    footed = (footers.withColumn("_foot", foot).where(F.col("_foot") >= 0).groupBy(key)
              .agg(F.min(place(F.col("_foot"))).alias("_end")))
    return closed.join(footed, key, "full").select(
        key, F.col("_cut.l").alias("_l0"), F.col("_cut.c").alias("_c0"), F.col("_end.l").alias("_l1"), F.col("_end.c").alias("_c1"))


def clean_lines(lines: DataFrame, key: str = "path", order: str = "line_no") -> DataFrame:
    """B5 on lines: ``lines`` without header and footer, each line whitespace-normalised.

    Lines that lie wholly in the header or footer go; a line cut by either keeps its
    rest. Line numbers stay. Columns other than ``text`` are kept.
    """
    t = F.col("text")
    bounds = cut_lineage(content_bounds(lines, key, order))       # a row per marked file: measured, then joined
    size = table_size(bounds, string_cells(F.col(key).cast("string")) + 4)
    j = lookup(lines, bounds, [key], "left", salt_cols=[key, order], small_size=size)
    first, last = F.col(order) == F.col("_l0"), F.col(order) == F.col("_l1")
    inside = (F.col("_l0").isNull() | (F.col(order) >= F.col("_l0"))) & (F.col("_l1").isNull() | (F.col(order) <= F.col("_l1")))
    start = F.when(first, F.col("_c0")).otherwise(F.lit(0))
    end = F.when(last, F.col("_c1")).otherwise(F.length(t))
    rest = F.when(first | last, F.substring(t, start + 1, end - start)).otherwise(t)
    return j.where(inside).withColumn("text", F.trim(normalize_ws(rest))).drop("_l0", "_c0", "_l1", "_c1")


def number_files(paths: DataFrame, out: str = "doc_id") -> DataFrame:
    """``path`` and a dense id in path order: an identity that cannot collide."""
    return dense_ordinal(paths.select("path").distinct(), [F.col("path")], out=out)


def number_lines(lines: DataFrame, out: str = "row_idx") -> DataFrame:
    """``lines`` (path, line_no, text) numbered across files in (path, line_no) order,
    with the file's dense ``doc_id``. Only per-file counts are ordered."""
    files = lines.groupBy("path").agg(F.count(F.lit(1)).alias("_nl"))
    files = dense_ordinal(files, [F.col("path")], out="doc_id")
    first = cut_lineage(running_offsets(files, [], "doc_id", "_nl", out="_first").select("path", "doc_id", "_first"))
    size = table_size(first, string_cells("path") + 2)
    j = lookup(lines, first, ["path"], "inner", salt_cols=["path", "line_no"], small_size=size)
    return j.withColumn(out, (F.col("_first") + F.col("line_no")).cast("long")).drop("_first")
