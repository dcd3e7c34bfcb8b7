"""Merkle manifest of a dataset: content-addressed records and proofs by descent.

Every row is a leaf digest. Leaves of one source, in ``doc_id`` order, form a tree of
fan-out three; the sources' roots, in source order, form the tree above. The store
holds digest-to-children records, keyed by what they contain: a record covers up to
``HEIGHT`` levels of a subtree (at most ``FAN ** HEIGHT`` digests, about 16 KB), so equal
subtrees are stored once and a descent takes one join for ``HEIGHT`` levels.

A request is a leaf's rank. Requests descend from the root by the digits of the rank:
each step joins the digests reached to their records, picks the child named by the next
digits and collects the children not selected. Requests that share a prefix travel as one
row until they part. The segments collected from the root downwards are reversed to give
the proof, which reads from the leaf up.

On Spark: equal rows collapse before anything is ordered; ranks come from sliced prefix
sums, so a source with a third of all rows spans many tasks; records are grouped by
(source, page), never more than ``FAN ** HEIGHT`` members. Each level is written to shared
storage. Everything is a DataFrame expression; no digest reaches the driver but the root.

Defined cases: a null field is encoded ``-`` and an empty one ``0:``; rows with a null source are a
source of their own, ordered first; a null ``doc_id`` comes first in its source; rows that
share a ``doc_id`` are ordered by digest; equal rows are separate leaves with separate
ranks; an empty table has no leaves and no root; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup, table_size
from ..operators.prefix import running_offsets
from .staging import stage

FAN = 3
HEIGHT = 5
PAGE = FAN ** HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Ranks of a run of equal leaves are laid out in chunks of this many, then in pages.
CHUNK = 1 << 20
STEP = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    shown = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown))


def leaf_digest(values) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def source_key(source: Column) -> Column:
    """A source as a text that is never null: null first, then bytewise."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source.cast("string")))


def levels_of(n: Column) -> Column:
    """Levels above ``n`` nodes: how many powers of ``FAN`` are below ``n``."""
    powers = [FAN ** k for k in range(40) if FAN ** k < 1 << 62]
    return F.size(F.filter(F.array(*[F.lit(p) for p in powers]), lambda p: p < n))


def parents(nodes: Column) -> Column:
    """Digests of every ``FAN`` consecutive nodes; the last run may be shorter."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(nodes, i * FAN + 1, FAN), ""), 256))


def with_levels(pages: DataFrame) -> DataFrame:
    """Adds ``l0``..``l5``: the page's members and the levels above them."""
    out = pages.withColumn("l0", F.col("members"))
    for k in range(1, HEIGHT + 1):
        out = out.withColumn(f"l{k}", parents(F.col(f"l{k - 1}")))
    return out


def top_of(height: Column) -> Column:
    """The page's digest: the single node ``height`` levels above its members."""
    return F.coalesce(*[F.when(height == k, F.get(f"l{k}", F.lit(0))) for k in range(HEIGHT + 1)])


def segment(digits: Column, height: Column) -> Column:
    """Unselected children on the way down to member ``digits``, root side first."""
    def step(k):
        at = F.floor(digits / FAN ** k).cast("int")
        own = at % FAN
        run = F.slice(f"l{k}", at - own + 1, FAN)
        return F.struct(F.array_join(F.slice(run, F.lit(1), own), "").alias("left"),
                        F.array_join(F.slice(run, own + 2, F.lit(FAN)), "").alias("right"))
    return F.slice(F.array(*[step(k) for k in reversed(range(HEIGHT))]), HEIGHT - height + 1, height)


@dataclass
class Manifest:
    """``leaves``: scope, rank, copies and the leaves' columns, one row per run of equal leaves.
    ``records``: digest, height, members. ``subroots``: scope, levels, at, of, subroot.
    ``root``: the root digest, None for an empty table."""
    leaves: DataFrame
    records: DataFrame
    subroots: DataFrame
    root: str | None


def _pages(nodes: DataFrame, below: int) -> DataFrame:
    """Groups (scope, levels, at, run, digest) nodes by page; ``below`` levels are done."""
    grouped = nodes.groupBy("scope", "levels", F.floor(F.col("at") / PAGE).alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("at", "run", "digest"))).alias("runs"))
    members = F.flatten(F.transform("runs", lambda r: F.array_repeat(r["digest"], r["run"].cast("int"))))
    height = F.least(F.lit(HEIGHT), F.col("levels") - below)
    paged = with_levels(grouped.withColumn("members", members).withColumn("height", height))
    return stage(paged.select("scope", "levels", F.col("page").alias("at"), "height", "members",
                              top_of(F.col("height")).alias("digest")))


def _trees(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of the trees over (scope, levels, at, run, digest), and (scope, levels, root)."""
    most = leaves.agg(F.max("levels").alias("m")).first()["m"] or 0
    nodes, records, roots = leaves, [], []
    for below in range(0, max(most, 1), HEIGHT):
        pages = _pages(nodes, below)
        records.append(pages.select("digest", "height", "members"))
        roots.append(pages.where(F.col("levels") <= below + HEIGHT).select("scope", "levels", F.col("digest").alias("root")))
        nodes = pages.where(F.col("levels") > below + HEIGHT).select("scope", "levels", "at", F.lit(1).alias("run"), "digest")
    union = lambda parts: parts[0] if len(parts) == 1 else parts[0].unionByName(union(parts[1:]))
    return union(records), union(roots)


def laid_out(leaves: DataFrame) -> DataFrame:
    """Runs of equal leaves cut at page borders: adds ``at`` (first rank) and ``run``."""
    last = F.col("rank") + F.col("copies") - 1
    ranged = leaves.withColumn("_c", F.explode(F.sequence(F.floor(F.col("rank") / CHUNK / PAGE), F.floor(last / CHUNK / PAGE))))
    low, high = F.col("_c") * CHUNK, (F.col("_c") + 1) * CHUNK - 1
    first_page = F.greatest(F.floor(F.col("rank") / PAGE), low)
    cut = ranged.withColumn("_p", F.explode(F.sequence(first_page, F.least(F.floor(last / PAGE), high))))
    at = F.greatest(F.col("rank"), F.col("_p") * PAGE)
    end = F.least(last, (F.col("_p") + 1) * PAGE - 1)
    return cut.withColumn("at", at).withColumn("run", end - at + 1).drop("_c", "_p")


def build(rows: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> Manifest:
    """The manifest of ``rows``: source, doc_id, leaf and further ``keep`` columns, one row per leaf."""
    keep = tuple(dict.fromkeys(("doc_id", *keep)))
    order = F.struct("doc_id", "leaf", *[k for k in keep if k != "doc_id"])
    runs = (rows.select(source_key(F.col("source")).alias("scope"), order.alias("leaf"))
            .groupBy("scope", "leaf").agg(F.count(F.lit(1)).alias("copies")))
    ranked = running_offsets(runs, ["scope"], "leaf", "copies", out="rank", total_out="n")
    leaves = stage(ranked.select("scope", "rank", "copies", levels_of(F.col("n")).alias("levels"), "leaf.*"))
    at_pages = laid_out(leaves).select("scope", "levels", "at", "run", F.col("leaf").alias("digest"))
    low, subroots = _trees(at_pages)
    tops = running_offsets(subroots.select(F.lit("").alias("all"), "scope", "levels", F.col("root").alias("subroot"), F.lit(1).alias("one")),
                           ["all"], "scope", "one", out="at", total_out="of")
    tops = stage(tops.select("scope", "levels", "at", levels_of(F.col("of")).alias("of"), "subroot"))
    high, roots = _trees(tops.select(F.lit("").alias("scope"), F.col("of").alias("levels"), "at", F.lit(1).alias("run"),
                                     F.col("subroot").alias("digest")))
    records = stage(low.unionByName(high).groupBy("digest", "height").agg(F.first("members").alias("members")))
    root = roots.first()
    return Manifest(leaves, records, tops, root["root"] if root else None)


def _step(state: DataFrame, requests: DataFrame, records: DataFrame, size, below: int) -> DataFrame:
    """One record downwards: ``state`` (scope, page, levels, digest, path, ...) meets its records, and
    each request (scope, page, digits, ...) picks its member: ``digest``, longer ``path``."""
    height = F.least(F.lit(HEIGHT), F.col("levels") - below)
    found = lookup(state.withColumn("height", height), records, ["digest", "height"], "inner", salt=1, small_size=size)
    opened = stage(with_levels(found).drop("members", "digest"))
    cells = F.size("l0") * 8 + F.size("path") * 16
    met = lookup(requests, opened, ["scope", "page"], "inner", salt=1, small_size=table_size(opened, cells))
    digits = F.col("digits")
    return (met.withColumn("path", F.concat("path", segment(digits, F.col("height"))))
            .withColumn("digest", F.get("l0", digits)).drop("height", *[f"l{k}" for k in range(HEIGHT + 1)]))


def descend(roots: DataFrame, requests: DataFrame, records: DataFrame, most: int) -> DataFrame:
    """Requests (scope, at, ...) below ``roots`` (scope, levels, digest, path, ...), whose trees have at
    most ``most`` levels: each request with its ``digest`` and ``path``, root side first."""
    size = table_size(records, F.size("members") * 5)
    state = None
    for t in reversed(range(max(1, -(-most // HEIGHT)))):
        # trees whose top record is at this depth enter here
        enter = (F.col("levels") > t * HEIGHT) & (F.col("levels") <= (t + 1) * HEIGHT) if t else F.col("levels") <= HEIGHT
        fresh = roots.where(enter).withColumn("page", F.lit(0).cast("long"))
        state = fresh if state is None else state.unionByName(fresh)
        node = F.floor(F.col("at") / PAGE ** t)
        asked = requests if t == 0 else requests.select("scope", node.alias("at")).distinct()
        asked = asked.withColumn("page", F.floor(F.col("at") / PAGE)).withColumn(
            "digits", F.pmod(F.col("at"), F.lit(PAGE)).cast("int"))
        got = _step(state, asked, records, size, t * HEIGHT).drop("page", "digits")
        if t == 0:
            return got
        state = got.withColumnRenamed("at", "page")


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """Requests (scope, at, ...) with ``digest`` (the leaf reached), ``subroot``, ``root`` and ``proof``:
    the (left, right) siblings of every level, from the leaf up."""
    tops, none = manifest.subroots, F.array().cast(STEP)
    most = tops.agg(F.max("of").alias("of"), F.max("levels").alias("levels")).first()
    sources = tops.select(F.lit("").alias("scope"), "at", F.col("scope").alias("source"), F.col("levels").alias("below"))
    above = tops.limit(1).select(F.lit("").alias("scope"), F.col("of").alias("levels"), F.lit(manifest.root).alias("digest"),
                                 none.alias("path"))
    reached = descend(above, sources, manifest.records, most["of"] or 0)
    roots = stage(reached.select(F.col("source").alias("scope"), F.col("below").alias("levels"), "digest", "path",
                                 F.col("digest").alias("subroot")))
    found = descend(roots, requests, manifest.records, most["levels"] or 0)
    return (found.withColumn("proof", F.reverse("path")).withColumn("root", F.lit(manifest.root).cast("string"))
            .drop("path", "levels"))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and its siblings give."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def leaf_rows(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf, and the leaf of the row as tampered with (line feeds deleted where
    2 divides the id's checksum)."""
    c = {f: F.col(f) for f in FIELDS}
    cut = F.when(F.crc32(F.encode(c["doc_id"].cast("string"), "UTF-8")) % 2 == 0, F.replace(c["text"], F.lit("\n"), F.lit(""))).otherwise(c["text"])
    return docs.select("doc_id", "source", leaf_digest(c.values()).alias("leaf"),
                       leaf_digest((c | {"text": cut}).values()).alias("tampered"))


def verify(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: every leaf of the
    untampered table, its proof by descent, and the root folded from the tampered leaf."""
    manifest = build(leaf_rows(docs), keep=("doc_id", "tampered"))
    # a run of equal leaves asks once per rank
    asked = laid_out(manifest.leaves).withColumn("at", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("run") - 1)))
    proved = prove(manifest, asked.select("scope", "at", "doc_id", "tampered"))
    folded = proved.withColumn("folded_root", fold(F.col("tampered"), F.col("proof")))
    return folded.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
