"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is its set of distinct word shingles. All sets share one order of
shingles, rarest first. Two sets of ``n`` and ``m`` shingles that link share at least
``o = ceil(t / (1 + t) * (n + m))`` of them, so for any ``l`` up to that, the first
``n - o + l`` and ``m - o + l`` shingles share at least ``l``. Pairs meet through one shared
shingle of their prefixes for ``l = 1``. Each document then lengthens its prefix to its own
``l``: a longer prefix costs more to compare but asks for more shared shingles before a
pair is verified on whole sets, so ``l`` minimises both costs, estimated from the
frequencies in the prefix. A pair is judged at the smaller ``l`` of the two.

Steps:

1. One pass gives each document's set size and set signature, and each task's counts
   of shingle hashes in ``2^sketch_bits`` buckets. The summed counts (bounded size) give
   the order (bucket count, then hash); any fixed order is correct, rare-first is fast.
2. One pass writes the prefix shingles of each distinct signature; equal sets never
   meet as pairs. Shingles of one signature alone are dropped.
3. Within each prefix shingle the set where it ranks first is a pivot. Pivot pairs
   are checked on their longer prefixes, then verified on whole sets, and links give
   first components.
4. Pairs that meet in a shingle but lie in different components are checked and verified
   alike, and final components follow. Pairs that are connected already cannot
   change a component, so no pair is lost for the result.

Scale: shuffles carry prefix hashes (about (1 - t) of the shingles), never texts; whole
sets travel only for pairs to verify. Shingle groups above ``block`` rows are split
into pairs of blocks over many tasks. Sets are compared by 64-bit shingle hashes and
identified by 64-bit signatures.

Defined cases: null, empty or wordless texts have no shingles and link with
nothing; fewer than ``k`` words are one shingle; equal sets link; repeated rows are in
one component; a null ``doc_id`` never names a component with other ids, but links like any
other; extra columns are ignored. Rows are told apart by a 64-bit hash of their values beside
``doc_id``, which need not be unique or given.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import components, give_back, sized_join, stage
from .words import LOWER, SPACED, chunks, grams, hashes, mix, words_of

K = 4
PERCENT = 85
SKETCH_BITS = 22
SLAB = 1 << 16
MOST_MATCHES = 8
VERIFY_COST = 8.0
BLOCK = 20_000
FAN_IN = 64


def shingle_sets(col: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = words_of(col, SPACED)
    h = hashes(w.data, w.starts, w.ends, LOWER)
    g, at = grams(h, w.first, k)
    cut = np.searchsorted(at, w.first)
    out = [np.unique(g[a:b]) for a, b in zip(cut, cut[1:])]
    counts = w.counts
    for n in range(1, k):
        short = np.flatnonzero(counts == n)
        if len(short):
            gn, at_n = grams(h, w.first, n)
            for d, i in zip(short.tolist(), np.searchsorted(at_n, w.first[short]).tolist()):
                out[d] = gn[i:i + 1]
    return out


def signature(s: np.ndarray) -> int:
    """64-bit signature of a non-empty set."""
    with np.errstate(over="ignore"):
        x = mix(np.array([np.bitwise_xor.reduce(s), mix(s).sum(dtype=np.uint64), len(s)], np.uint64))
        return int(mix(x[:1] + x[1:2] * np.uint64(3) + x[2:] * np.uint64(5)).view(np.int64)[0])


def overlap(n, m, percent: int):
    """Least intersection of two linked sets of these sizes."""
    return -(-percent * (n + m) // (100 + percent))


def survey(docs: DataFrame, k: int, bits: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, key, n, sig) of each document, and the shingle counts by bucket."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    slabs = max(1, (1 << bits) // SLAB)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, waiting, held, id_arrow = np.zeros(1 << bits, np.uint32), [], 0, None

        def settle():
            nonlocal waiting, held
            if waiting:
                bucket, times = np.unique(np.concatenate(waiting), return_counts=True)
                counts[bucket] += times.astype(np.uint32)
            waiting, held = [], 0

        def rows(ids, key, n, sig, slab, data):
            return pa.RecordBatch.from_arrays(
                [ids, key, pa.array(n, pa.int64()), pa.array(sig, pa.int64()), pa.array(slab, pa.int64()),
                 pa.array([TaskContext.get().partitionId()] * len(n), pa.int64()), pa.array(data, pa.binary())],
                names=["doc_id", "key", "n", "sig", "slab", "task", "counts"])

        for batch in batches:
            id_arrow = batch.schema.field("doc_id").type
            for b in chunks(batch, "text"):
                sets = shingle_sets(b.column("text"), k)
                for s in sets:
                    waiting.append((s & np.uint64((1 << bits) - 1)).astype(np.uint32))
                    held += len(s)
                if held > 1_000_000:
                    settle()
                none = [None] * len(sets)
                yield rows(b.column("doc_id"), b.column("key"), [len(s) for s in sets],
                           [signature(s) if len(s) else None for s in sets], none, none)
        settle()
        if id_arrow is not None:
            for i, part in enumerate(np.split(counts, slabs)):
                yield rows(pa.nulls(1, id_arrow), pa.nulls(1, pa.int64()), [None], [None], [i], [zlib.compress(part, 1)])

    done = stage(docs.select("doc_id", "key", "text").mapInArrow(
        give_back(run), f"doc_id {id_type}, key bigint, n bigint, sig bigint, slab bigint, task bigint, counts binary"))
    part = done.where("slab is not null").select("slab", "task", "counts")
    tasks = (part.agg(F.max("task")).first()[0] or 0) + 1
    while True:
        tasks = -(-tasks // FAN_IN)
        part = part.groupBy("slab", (F.col("task") / FAN_IN).cast("bigint").alias("task")).applyInPandas(
            _sum_slabs, "slab bigint, task bigint, counts binary")
        if tasks == 1:
            break
    total = np.zeros(1 << bits, np.uint32)
    for r in part.collect():
        c = np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
        total[r["slab"] * len(c):(r["slab"] + 1) * len(c)] = c
    return done.where("slab is null").select("doc_id", "key", "n", "sig"), total


def _sum_slabs(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(c), np.uint32).astype(np.int64) for c in rows["counts"])
    data = zlib.compress(np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes(), 1)
    return pd.DataFrame([[*key, data]], columns=["slab", "task", "counts"])


def choose_matches(weight: np.ndarray, base: int, most: int) -> int:
    """The number of shared prefix shingles to ask for: postings read, plus the pairs
    met often enough, each at the price of a verification."""
    sums = np.cumsum(weight[:base + most - 1])
    l = np.arange(1, len(sums) - base + 2)
    posting = sums[base - 1:]
    return int(np.argmin(posting * (1 + VERIFY_COST / l)) + 1)


class Order:
    """The common order of shingles, by the summed bucket counts."""

    def __init__(self, counts: np.ndarray, percent: int):
        self.counts, self.percent, self.mask = counts, percent, np.uint64(len(counts) - 1)
        noise = float(np.median(counts))
        self.floor = noise + 3 * noise ** 0.5 + 1      # what a bucket holds without a frequent shingle

    def first(self, s: np.ndarray, more: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The prefix of set ``s`` for one shared shingle, and ``more`` of the next, with
        the counts of their buckets."""
        n = len(s)
        take = min(n, n - -(-self.percent * n // 100) + 1 + more)
        df = self.counts[(s & self.mask).astype(np.int64)]
        near = np.flatnonzero(df <= np.partition(df, take - 1)[take - 1]) if take < n else np.arange(n)
        order = near[np.argsort(df[near], kind="stable")][:take]       # ties: smallest hash, as s is sorted
        return s[order], df[order]

    def adaptive(self, s: np.ndarray) -> tuple[np.ndarray, int]:
        """The lengthened prefix of ``s`` and the number of shared shingles it asks for."""
        most = min(MOST_MATCHES, max(1, len(s) // 4))
        prefix, df = self.first(s, most - 1)
        base = len(prefix) - most + 1
        l = choose_matches(np.maximum(df - self.floor, 0.0), base, most)
        return prefix[:base + l - 1], l


def prefixes(docs: DataFrame, order, k: int) -> DataFrame:
    """(token, sig, n, place): the prefix shingles of each signature (copies in
    different tasks may repeat)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for b in chunks(batch, "text"):
                out = []
                for s in shingle_sets(b.column("text"), k):
                    if len(s) and (sig := signature(s)) not in seen:
                        seen.add(sig)
                        out.append((order.value.first(s)[0].view(np.int64), sig, len(s)))
                if out:
                    size = [len(o[0]) for o in out]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([o[0] for o in out])),
                         *(pa.array(np.repeat(np.array([o[j] for o in out], np.int64), size)) for j in (1, 2)),
                         pa.array(np.concatenate([np.arange(z) for z in size]))],
                        names=["token", "sig", "n", "place"])

    return docs.select("text").mapInArrow(give_back(run), "token bigint, sig bigint, n bigint, place bigint")


def _may_meet(a: str, b: str, percent: int):
    """Size and place conditions of a pair; ``a`` and ``b`` prefix the columns."""
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    o = F.ceil(percent * (n + m) / F.lit(100 + percent))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (F.col(f"{a}place") <= n - o) & (F.col(f"{b}place") <= m - o)


def linked_pairs(docs: DataFrame, classes: DataFrame, pairs: DataFrame, order, k: int, percent: int) -> DataFrame:
    """Of the pairs (a, b) of signatures, those whose whole sets link; sets are only
    compared if the longer prefixes share enough. ``classes`` (sig, key) names the
    row whose text stands for a signature."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    wanted = stage(sized_join(classes.select("sig", "key"), ids, "sig", "left_semi"))

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()        # (key, sig): equal rows have one key, and their sets are built once in a task
        for batch in batches:
            new = []
            for pair in zip(batch.column("key").to_pylist(), batch.column("sig").to_pylist()):
                new.append(pair not in seen)
                seen.add(pair)
            for b in chunks(batch.filter(pa.array(new, pa.bool_())), "text"):
                sets = shingle_sets(b.column("text"), k)
                prefix = [order.value.adaptive(s) if len(s) else (s, 0) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [b.column("sig"), pa.array([signature(s) if len(s) else None for s in sets], pa.int64()),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array([l for _, l in prefix], pa.int64()),
                     pa.array([p.tobytes() for p, _ in prefix], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["sig", "own", "n", "l", "prefix", "set"])

    # several rows may have one key: the signature tells which is meant
    sets = stage(sized_join(docs.select("key", "text"), wanted, "key", "inner").select("key", "sig", "text")
                 .mapInArrow(give_back(load), "sig bigint, own bigint, n bigint, l bigint, prefix binary, set binary")
                 .where("sig = own").drop("own").dropDuplicates(["sig"]))

    def both(pairs: DataFrame, cols: list[str]) -> DataFrame:
        for side, tag in (("a", "x_"), ("b", "y_")):
            pairs = pairs.join(sets.select(F.col("sig").alias(side), *(F.col(c).alias(tag + c) for c in cols)), side)
        return pairs

    def shared(x: pa.Scalar, y: pa.Scalar, xs=slice(None), ys=slice(None)) -> int:
        return len(np.intersect1d(np.frombuffer(x.as_buffer(), np.uint64)[xs], np.frombuffer(y.as_buffer(), np.uint64)[ys],
                                  assume_unique=True))

    def enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for n, m, l, r, x, y in zip(*(b.column(c).to_pylist() for c in ("x_n", "y_n", "x_l", "y_l")), b.column("x_prefix"), b.column("y_prefix")):
                o, l = overlap(n, m, percent), min(l, r)
                keep.append(shared(x, y, slice(n - o + l), slice(m - o + l)) >= l)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for n, m, x, y in zip(b.column("x_n").to_pylist(), b.column("y_n").to_pylist(), b.column("x_set"), b.column("y_set")):
                c = shared(x, y)
                keep.append(100 * c >= percent * (n + m - c))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    checked = stage(both(pairs, ["n", "l", "prefix"]).mapInArrow(give_back(enough), "a bigint, b bigint"))
    return both(checked, ["n", "set"]).mapInArrow(give_back(compare), "a bigint, b bigint")


def cross_pairs(postings: DataFrame, percent: int, block: int) -> DataFrame:
    """Pairs of signatures in different components that meet in a prefix shingle.
    ``postings``: token, size, sig, n, place, root."""
    mixed = postings.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where(
        "low <> high").select("token")
    rows = sized_join(postings, mixed, "token", "left_semi")
    parts = F.ceil(F.col("size") / F.lit(block)).cast("int")
    rows = (rows.withColumn("part", F.pmod(F.xxhash64("sig"), parts).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
            .withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))
            .drop("other", "size"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def flush(t):
            cells = t.to_pandas()
            edge = np.flatnonzero((cells[["token", "low", "high"]].diff().fillna(1) != 0).any(axis=1).to_numpy())
            cols = {c: cells[c].to_numpy() for c in cells}
            a_out, b_out = [], []
            for x, y in zip(edge, [*edge[1:], len(cells)]):
                if y - x > 1:
                    _block_pairs({c: v[x:y] for c, v in cols.items()}, percent, a_out, b_out)
            if a_out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in (a_out, b_out)], names=["a", "b"])

        # a group may continue in the next batch: keep its last group back
        for b in batches:
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            keys = [t.column(c).to_numpy() for c in ("token", "low", "high")]
            same = np.logical_and.reduce([k == k[-1] for k in keys])
            differs = np.flatnonzero(~same)
            cut = int(differs[-1]) + 1 if len(differs) else 0
            if cut:
                yield from flush(t.slice(0, cut))
            held = t.slice(cut)
        if held is not None and held.num_rows:
            yield from flush(held)

    return rows.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high").mapInArrow(
        give_back(run), "a bigint, b bigint").distinct()


def _block_pairs(g: dict[str, np.ndarray], percent: int, a_out: list, b_out: list) -> None:
    """Pairs of one block pair of one shingle group that pass the size and place conditions."""
    roots, inverse, counts = np.unique(g["root"], return_inverse=True, return_counts=True)
    if len(roots) < 2:
        return
    main = inverse == int(np.argmax(counts))
    lone = np.flatnonzero(~main)
    rank = np.full(len(main), -1)
    rank[lone] = np.arange(len(lone))
    split = g["low"][0] != g["high"][0]
    for i in lone:
        ok = (g["root"] != g["root"][i]) & (rank < rank[i])   # members of the main component, or earlier lone ones
        if split:
            ok &= g["part"] != g["part"][i]
        n, m = g["n"][i], g["n"]
        o = overlap(n, m, percent)
        ok &= (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (g["place"][i] <= n - o) & (g["place"] <= m - o)
        j = np.flatnonzero(ok)
        if len(j):
            mine = np.full(len(j), g["sig"][i])
            a_out.append(np.minimum(mine, g["sig"][j]))
            b_out.append(np.maximum(mine, g["sig"][j]))


def linked_rows(docs: DataFrame, keyed: list[str], k: int = K, percent: int = PERCENT, sketch_bits: int = SKETCH_BITS,
                block: int = BLOCK) -> DataFrame:
    """doc_id, key, n, sig, component_id, kept of each row of ``docs``. ``key`` is the hash of
    the columns ``keyed``, so rows equal in them have one key. ``kept`` marks the component's row
    with the smallest (doc_id, key), null ids last, and all its equals; it and ``component_id``
    are null for rows without shingles."""
    docs = docs.select("doc_id", "text", F.xxhash64(*keyed).alias("key"))
    sizes, counts = survey(docs, k, sketch_bits)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("least")
    classes = stage(sizes.where("sig is not null").groupBy("sig").agg(least).select("sig", "least.doc_id", "least.key"))
    order = docs.sparkSession.sparkContext.broadcast(Order(counts, percent))
    rows = stage(prefixes(docs, order, k))
    groups = stage(rows.groupBy("token").agg(F.min(F.struct("place", "n", "sig")).alias("pivot"), F.min("sig").alias("low"),
                                             F.max("sig").alias("high"), F.count(F.lit(1)).alias("size"))
                   .where("low <> high").select("token", "size", "pivot"))
    # the broadcast, if any, holds shingle hashes alone; pivots then join the few rows left
    met = stage(sized_join(rows, groups.select("token"), "token", "left_semi").dropDuplicates(["token", "sig"]))
    postings = stage(met.join(groups, "token"))
    stars = stage(postings.select("*", *(F.col(f"pivot.{c}").alias(f"p_{c}") for c in ("place", "n", "sig")))
                  .where((F.col("sig") != F.col("p_sig")) & _may_meet("", "p_", percent))
                  .select(F.least("sig", "p_sig").alias("a"), F.greatest("sig", "p_sig").alias("b")).distinct())
    links = stage(linked_pairs(docs, classes, stars, order, k, percent))
    first = stage(components(links))
    more = sized_join(postings.drop("pivot"), first.withColumnRenamed("node", "sig"), "sig", "left").withColumn(
        "root", F.coalesce("root", "sig"))
    cross = stage(cross_pairs(stage(more), percent, block))
    links = links.unionByName(linked_pairs(docs, classes, cross, order, k, percent))
    final = stage(components(links))
    # components of several signatures take the smallest row of any; others their own class's
    named = sized_join(classes, final.withColumnRenamed("node", "sig"), "sig", "left").withColumn(
        "root", F.coalesce("root", "sig"))
    named = stage(named)
    of_root = named.groupBy("root").agg(least).select(
        "root", F.col("least.doc_id").alias("component_id"), F.col("least.key").alias("first"))
    by_sig = stage(named.join(of_root, "root").select("sig", "component_id", "first"))
    return sized_join(sizes, by_sig, "sig", "left").select(
        "doc_id", "key", "n", "sig", "component_id",
        F.when(F.col("sig").isNotNull(), F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("key") == F.col("first")))
        .alias("kept"))


def near_duplicates(docs: DataFrame, k: int = K, percent: int = PERCENT, sketch_bits: int = SKETCH_BITS,
                    block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of ``docs``."""
    return linked_rows(docs, ["doc_id", "text"], k, percent, sketch_bits, block).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
