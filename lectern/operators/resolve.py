"""Ranked, loose resolution of works against a catalogue.

A remote catalogue search ranks items by the words they share with the query and takes
the first five. Here that is a join over an inverted index: every searchable item is a set
of field terms (``a:`` author words, ``t:`` title words), every term has an integer impact
(its field's weight times the bit length of items / items holding it), an item's score is the
sum of the impacts of the work's terms it holds, and a hit needs at least ``percent`` of the
work's total impact. Words that no item holds tell nothing and count nowhere.

Pruning is exact. A work's terms are ordered by falling impact. The postings of the first
term give candidates whose ``limit``-th best score is a threshold; an item that holds only
terms whose impacts sum to less than the threshold cannot enter, so the work reads
postings only up to the place where the rest's sum falls below it. Hot words come last and
are read only when they can still decide.

Items with equal term sets are one signature, of which only the ``limit`` first items by
``order`` can be hits: a group that holds a third of the catalogue is one posting per term
and at most ``limit`` rows (a partial group limit runs before the shuffle). Works with equal
term sets are matched once.

Defined cases: null or word-free author and title have no terms; a work without terms has
no hits; works listed repeatedly count once; ties follow ``order``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .catalog import MAX_RESULTS, WORK_KEYS, searchable
from .joins import lookup

PERCENT = 50
WEIGHTS = {"author": 1, "title": 2}


def field_terms(weights: dict[str, int]) -> Column:
    """Sorted distinct ``f:word`` terms of the fields, lower-cased runs of letters and digits."""
    def of(field: str) -> Column:
        words = F.regexp_extract_all(F.lower(F.coalesce(F.col(field), F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
        return F.transform(words, lambda w: F.concat(F.lit(field[0] + ":"), w))

    return F.array_sort(F.array_distinct(F.concat(*[of(c) for c in weights])))


def _signed(df: DataFrame, weights: dict[str, int]) -> DataFrame:
    return df.withColumn("terms", field_terms(weights)).withColumn("sig", F.array_join("terms", " "))


def item_index(catalog: DataFrame, order: Sequence[Column], weights: dict[str, int], limit: int) -> tuple[DataFrame, DataFrame]:
    """``(sig, terms, n)`` of every distinct term set of the searchable items, and the first
    ``limit`` items of each: ``(sig, identifier, _order)``."""
    items = _signed(searchable(catalog), weights).where("sig <> ''").withColumn("_order", F.struct(*order))
    sigs = items.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).withColumn("terms", F.split("sig", " "))
    first = items.withColumn("_at", F.row_number().over(Window.partitionBy("sig").orderBy("_order", "identifier")))
    return cut_lineage(sigs), cut_lineage(first.where(F.col("_at") <= limit).select("sig", "identifier", "_order"))


def weighted_terms(works: DataFrame, sigs: DataFrame, weights: dict[str, int]) -> DataFrame:
    """``(work, term, impact, at, rest, total)``: the terms of each distinct work by falling
    impact; ``rest`` sums the impacts from this term on."""
    items = int(sigs.agg(F.sum("n")).first()[0] or 0)
    held = sigs.select(F.explode("terms").alias("term"), "n").groupBy("term").agg(F.sum("n").alias("df"))
    wanted = works.select(F.col("sig").alias("work"), F.explode("terms").alias("term"))
    share = F.expr(f"{items}L div df")
    weight = F.coalesce(*[F.when(F.col("term").startswith(c[0] + ":"), F.lit(w)) for c, w in weights.items()])
    # a term that a third of the works hold is one key of many rows: checked, else salted
    found = lookup(wanted, cut_lineage(held), ["term"], "inner").withColumn(
        "impact", (weight * F.length(F.bin(share))).cast("bigint"))
    by = Window.partitionBy("work").orderBy(F.desc("impact"), "term")
    after = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return found.select("work", "term", "impact", F.row_number().over(by).alias("at"), F.sum("impact").over(after).alias("rest"),
                        F.sum("impact").over(Window.partitionBy("work")).alias("total"))


def resolve_ranked(works: DataFrame, catalog: DataFrame, order: Sequence[Column], limit: int = MAX_RESULTS,
                   percent: int = PERCENT, weights: dict[str, int] | None = None) -> DataFrame:
    """``author, title, rank, identifier, score``: up to ``limit`` hits per distinct work, by
    falling score, then ``order`` (ascending values that tell items apart)."""
    weights = weights or WEIGHTS
    listed = cut_lineage(_signed(works.select(*WORK_KEYS).distinct(), weights).where("sig <> ''"))
    sigs, items = item_index(catalog, order, weights, limit)
    terms = cut_lineage(weighted_terms(listed.select("sig", "terms").distinct(), sigs, weights))
    query = terms.groupBy("work").agg(F.collect_list(F.struct("term", "impact")).alias("wanted"), F.max("total").alias("total"))
    postings = sigs.select(F.explode("terms").alias("term"), "sig")

    def scored(chosen: DataFrame) -> DataFrame:
        """(work, sig, score) of the signatures that hold a chosen term and enough impact."""
        pairs = chosen.select("work", "term").join(postings, "term").select("work", "sig").distinct()
        held = F.filter("wanted", lambda t: F.array_contains(F.col("terms"), t["term"]))
        score = F.aggregate(held, F.lit(0).cast("bigint"), lambda s, t: s + t["impact"])
        return (pairs.join(query, "work").join(sigs.select("sig", "terms"), "sig").withColumn("score", score)
                .where(F.col("score") * 100 >= F.col("total") * percent).select("work", "sig", "score"))

    def best(hits: DataFrame) -> DataFrame:
        top = Window.partitionBy("work").orderBy(F.desc("score"), "_order", "identifier")
        return hits.join(items, "sig").withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= limit)

    early = cut_lineage(scored(terms.where("at = 1")))
    least = best(early).groupBy("work").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low")).where(
        F.col("n") >= limit).select("work", "low")
    floor = F.greatest(F.coalesce(F.col("low") * 100, F.lit(0)), F.col("total") * percent)
    later = terms.where("at > 1").join(least, "work", "left").where(F.col("rest") * 100 >= floor)
    hits = best(early.unionByName(scored(later)).distinct())
    return listed.select(*WORK_KEYS, F.col("sig").alias("work")).join(hits, "work").select(
        *WORK_KEYS, "rank", "identifier", "score")
