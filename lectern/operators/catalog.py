"""Acquisition planning as joins.

The reference looks each work up in a remote catalogue one at a time, takes the
first of at most five hits, lists the item's files, keeps plain-text ones and
downloads what is not already on disk. Here the catalogue is a table and each
step is a relational operator over all works at once. Remote ranking and fuzzy
matching are not reproduced: matching is exact on (author, title) and the
order is an explicit rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import sanitize_name

# ---------------------------------------------------------------------------
# Fixed values of the catalogue search: media type, language, hit limit, and the
# file format treated as plain text.
MEDIA_TYPE = "texts"
LANGUAGE = "English"
MAX_RESULTS = 5
TEXT_FORMAT = "Text"
# ---------------------------------------------------------------------------

WORK_KEYS = ("author", "title")


def searchable(catalog: DataFrame) -> DataFrame:
    """C4: the media type and language predicate of the search."""
    return catalog.where((F.col("mediatype") == MEDIA_TYPE) & (F.col("language") == LANGUAGE))


def candidate_items(works: DataFrame, catalog: DataFrame, order: Sequence[Column],
                    limit: int = MAX_RESULTS) -> DataFrame:
    """F2/G1: up to ``limit`` catalogue hits per work, ``rank`` 1..limit.

    ``row_number() <= limit`` is planned as a group limit: a partial limit runs
    before the shuffle, so a (author, title) group that is a third of the
    catalogue ships at most ``limit`` rows per map task.
    """
    w = Window.partitionBy(*WORK_KEYS).orderBy(*order)
    hits = searchable(catalog).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)
    return works.select(*WORK_KEYS).distinct().join(hits, list(WORK_KEYS), "inner") \
        .select(*WORK_KEYS, "rank", "identifier")


def resolve_works(works: DataFrame, catalog: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``author, title, identifier`` (null when nothing matches), first hit by
    ``order``. The catalogue is reduced to one row per work with ``min_by`` (a
    partial + final aggregate, safe for hot groups) before the left join."""
    best = searchable(catalog).groupBy(*WORK_KEYS).agg(
        F.min_by("identifier", F.struct(*order)).alias("identifier"))
    return works.select(*WORK_KEYS).distinct().join(best, list(WORK_KEYS), "left")


def unresolved_works(works: DataFrame, catalog: DataFrame) -> DataFrame:
    """Works with no catalogue hit (the not-found report).

    The catalogue side is reduced to distinct keys first (a partial aggregate),
    so a work with a huge number of catalogue rows ships one row per map task.
    """
    return works.select(*WORK_KEYS).distinct().join(
        searchable(catalog).select(*WORK_KEYS).distinct(), list(WORK_KEYS), "left_anti")


def text_files(files: DataFrame) -> DataFrame:
    """Files whose format is plain text."""
    return files.where(F.col("format") == TEXT_FORMAT)


def items_with_text(items: DataFrame, files: DataFrame, with_text: bool = True) -> DataFrame:
    """D3: items that have (or, with ``with_text=False``, lack) a plain-text file.
    File identifiers are made distinct before the semi/anti join."""
    return items.join(text_files(files).select("identifier").distinct(), "identifier",
                      "left_semi" if with_text else "left_anti")


def planned_downloads(resolved: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """``author, title, identifier, name, path`` for every text file of every
    resolved work; files land in ``root/author/identifier/name``."""
    r = resolved.where(F.col("identifier").isNotNull())
    t = text_files(files).select("identifier", "name")
    path = F.concat_ws("/", F.lit(root), sanitize_name("author"), F.col("identifier"), F.col("name"))
    return r.join(t, "identifier").select(*WORK_KEYS, "identifier", "name", path.alias("path"))


def new_files_only(planned: DataFrame, manifest: DataFrame) -> DataFrame:
    """Skip files already landed (``ignore_existing``): anti join on path."""
    return planned.join(manifest.select("path").distinct(), "path", "left_anti")


def works_routable(works: DataFrame, id_col: str = "gutenberg_id") -> DataFrame:
    """Works with a usable id; a falsy id (null or 0) is skipped and reported."""
    ok = F.col(id_col).isNotNull() & (F.col(id_col) != 0)
    return works.withColumn("routable", F.coalesce(ok, F.lit(False)))


def fetch_status(resolved: DataFrame, files: DataFrame) -> DataFrame:
    """Per work: ``not_found`` (no hit), ``failed`` (no text file) or ``success``.

    Unresolved works are labelled first and never join: their null identifiers
    would all meet in one partition."""
    has_text = text_files(files).select("identifier").distinct().withColumn("_t", F.lit(True))
    found = resolved.where(F.col("identifier").isNotNull()).join(has_text, "identifier", "left")
    found = found.select(*WORK_KEYS, "identifier", F.when(F.col("_t").isNull(), F.lit("failed")).otherwise(
        F.lit("success")).alias("status"))
    return found.unionByName(resolved.where(F.col("identifier").isNull()).select(
        *WORK_KEYS, "identifier", F.lit("not_found").alias("status")))


def fetch_tally(status: DataFrame, works: DataFrame | None = None) -> DataFrame:
    """``status, n``. With ``works`` (the list itself) every entry counts, repeated
    ones as often as they are listed; without it every distinct work counts once.
    Entries are counted per work before the join, so a work listed very often is one row."""
    if works is None:
        return status.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    listed = works.groupBy(*WORK_KEYS).agg(F.count(F.lit(1)).alias("n"))
    return listed.join(status.select(*WORK_KEYS, "status"), list(WORK_KEYS)).groupBy("status").agg(F.sum("n").alias("n"))
