"""Hard negatives from embeddings by Kronecker-packed products.

Vectors are integers: every component is ``floor(scale * x)``. Exact inner products of one
anchor with many candidates come from packed arithmetic: component ``d`` of several
candidates, biased to be non-negative, lies in separated fields of one wide integer

    W[d] = sum_j (c[j][d] + bias) << (width * j)

so one multiplication of ``W[d]`` by the anchor's (biased) component advances all their
scores, and the sum over ``d`` holds each candidate's sum in its own field. A field is as
wide as the largest possible sum, so no field runs into the next. Unpacking takes the bias
terms away again and gives the exact scores.

The wide integer is the 53-bit integer part of a double where at least two fields fit (all partial
sums stay below 2**53, so the products of whole blocks are exact matrix products), and a
Python integer of any length otherwise, so large components stay exact too.

On Spark: rows are written once with a row number. Anchors are taken in rounds of at most
``round_rows`` anchors and ``ROUND_CELLS`` components (the bound of what is broadcast); each
round's anchors meet all rows in blocks, and every task keeps per anchor only the best of
its own rows, merged by one ranked window. The first pass finds the positives, the second
the negatives inside each positive's score window. Nothing per row reaches the driver but
the round's anchors.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no part;
a shorter vector counts as padded with zeros; equal rows are rows of their own, told apart by
their row number, so "other rows" means all but the anchor's own row; a null ``vec_id`` is no anchor
and comes last among ties; an empty table gives no rows; extra columns are ignored. A score beyond
64 bits is ranked exactly within a task and held at the nearest 64-bit value from there on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import stage

ANCHOR_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH, WHOLE = 30, 90, 100
SCALE = 256
#: Anchors of one round (broadcast) and their components, and the block of scores one task holds at a time.
ROUND_ROWS, ROUND_CELLS, BLOCK_ROWS, ANCHOR_BLOCK = 20_000, 4_000_000, 8_192, 512
DOUBLE_BITS = 53
TOP = (1 << 63) - 1


def field_width(anchors: np.ndarray, rows: np.ndarray) -> tuple[int, int, int]:
    """(width, anchor bias, candidate bias): a field of ``width`` bits holds any biased sum."""
    a = max((abs(int(v)) for v in (anchors.min(initial=0), anchors.max(initial=0))), default=0)
    c = max((abs(int(v)) for v in (rows.min(initial=0), rows.max(initial=0))), default=0)
    return max(1, (anchors.shape[1] * 2 * a * 2 * c).bit_length()), a, c


def pack(rows: np.ndarray, width: int, bias: int, fields: int) -> np.ndarray:
    """(dimensions, groups): component ``d`` of ``fields`` consecutive rows in one integer."""
    n, d = rows.shape
    groups = -(-n // fields)
    wide = np.zeros((groups * fields, d), dtype=object if width * fields > DOUBLE_BITS else np.int64)
    wide[:n] = rows
    wide[:n] += bias
    wide = wide.reshape(groups, fields, d)
    packed = wide[:, 0, :].copy()
    for j in range(1, fields):
        packed += wide[:, j, :] << (width * j)
    return packed.T


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products, (anchors, rows), by packed multiplication."""
    n, d = rows.shape
    if not n or not d or not len(anchors):
        return np.zeros((len(anchors), n), dtype=np.int64)
    width, a_bias, c_bias = field_width(anchors, rows)
    fields = DOUBLE_BITS // width
    narrow = fields >= 2
    if not narrow:
        fields = 64
    packed = pack(rows, width, c_bias, fields)
    biased = anchors + a_bias
    if narrow:
        sums = (biased.astype(np.float64) @ packed.astype(np.float64)).astype(np.int64)
    else:
        sums = biased.astype(object) @ packed.astype(object)
    mask = (1 << width) - 1
    out = np.empty((len(anchors), packed.shape[1], fields), dtype=sums.dtype)
    for j in range(fields):
        out[:, :, j] = (sums >> (width * j)) & mask
    scores = out.reshape(len(anchors), -1)[:, :n]
    # (a + x)(c + y) summed, less what the biases x and y added
    return scores - c_bias * anchors.sum(axis=1)[:, None] - a_bias * rows.sum(axis=1)[None, :] - d * a_bias * c_bias


def matrix(vectors: pa.Array, scale: int) -> np.ndarray:
    """Integer components; as 64-bit numbers while every value is small, else Python integers."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0))
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        cells = np.floor(scale * flat)
    whole = np.zeros((len(lengths), width))
    whole[np.arange(width)[None, :] < lengths[:, None]] = cells
    if np.abs(whole).max(initial=0) < 1 << 20:
        return whole.astype(np.int64)
    # scale * x may exceed a double: multiplied as an integer ratio instead
    exact = np.zeros(whole.shape, dtype=object)
    place = np.arange(width)[None, :] < lengths[:, None]
    values = np.empty(len(flat), dtype=object)
    for k, x in enumerate(flat.tolist()):
        top, bottom = x.as_integer_ratio()
        values[k] = scale * top // bottom if not np.isfinite(cells[k]) else int(cells[k])
    exact[place] = values
    return exact


def even(anchors: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both padded with zeros to one width and of one number type."""
    d = max(anchors.shape[1], rows.shape[1])
    if object in (anchors.dtype, rows.dtype):
        anchors, rows = anchors.astype(object), rows.astype(object)
    grow = lambda m: m if m.shape[1] == d else np.hstack([m, np.zeros((len(m), d - m.shape[1]), dtype=m.dtype)])
    return grow(anchors), grow(rows)


def clamp(score) -> int:
    return max(-TOP - 1, min(TOP, int(score)))


class Anchors:
    """One round's anchors, by label, with the score windows of their positives in the second pass."""

    def __init__(self, table: pa.Table, scale: int):
        table = table.combine_chunks()
        self.row = table["row"].to_numpy()
        self.label = table["label"].to_numpy()
        vectors = table["vector"].combine_chunks() if isinstance(table["vector"], pa.ChunkedArray) else table["vector"]
        self.ints = matrix(vectors, scale)
        #: per anchor: (positive's row, positive's score), empty in the first pass
        self.windows = [[(p["row"], p["score"]) for p in ps or []] for ps in table["positives"].to_pylist()]


def order_of(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` of ``at`` by score, higher first, then id, then row number."""
    if scores.dtype == object:
        return np.array(sorted(at, key=lambda j: (-scores[j], ids[j], rows[j]))[:k], dtype=np.int64)
    if len(at) > 8 * k:
        # all that tie with the k-th stay in
        at = at[scores[at] >= np.partition(scores[at], len(at) - k)[len(at) - k]]
    return at[np.lexsort((rows[at], ids[at], -scores[at]))[:k]]


def best(anchors: Anchors, batches: Iterator[pa.RecordBatch], scale: int, k: int, block_rows: int) -> Iterator[pa.RecordBatch]:
    """Per anchor (first pass) or anchor and positive (second), the first ``k`` fitting rows of the task."""
    kept: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
    for batch in batches:
        for lo in range(0, batch.num_rows, block_rows):
            part = batch.slice(lo, block_rows)
            rows, label = part.column("row").to_numpy(), part.column("label").to_numpy()
            no_id = part.column("vec_id").is_null().to_numpy(zero_copy_only=False)
            ids = np.where(no_id, TOP, part.column("vec_id").fill_null(0).to_numpy(zero_copy_only=False))
            vectors = part.column("vector")
            ints = matrix(vectors, scale)
            for from_ in range(0, len(anchors.row), ANCHOR_BLOCK):
                some = slice(from_, from_ + ANCHOR_BLOCK)
                a, c = even(anchors.ints[some], ints)
                for at, scores in enumerate(products(a, c), from_):
                    same = label == anchors.label[at]
                    if not anchors.windows[at]:
                        wanted = [(-1, np.flatnonzero(same & (rows != anchors.row[at])))]
                    else:
                        other = np.flatnonzero(~same)
                        hundred = WHOLE * scores
                        wanted = [(p, other[((LOW * s <= hundred) & (hundred <= HIGH * s))[other]]) for p, s in anchors.windows[at]]
                    for p, fits in wanted:
                        if len(fits):
                            new = [(-scores[j], ids[j], rows[j], no_id[j]) for j in order_of(scores, ids, rows, fits, k)]
                            have = kept.get((at, p))
                            kept[at, p] = sorted(have + new)[:k] if have else new
    out = [(int(anchors.row[at]), p, clamp(-s), None if null else int(i), int(r)) for (at, p), found in kept.items() for s, i, r, null in found]
    if out:
        names = ("anchor", "positive", "score", "vec_id", "row")
        yield pa.RecordBatch.from_arrays([pa.array(col, pa.int64()) for col in zip(*out, strict=True)], names=names)


def ready(vectors: DataFrame, scale: int) -> DataFrame:
    """Rows that take part: row, vec_id, label (as relabelled) and vector (doubles), written once."""
    # null and non-finite components, NaN too, fail the comparison
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label").cast("long") + 1) % LABELS).otherwise(F.col("label")).cast("long")
    return stage(vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
                 .select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"),
                         F.col("embedding").cast("array<double>").alias("vector"))
                 .withColumn("row", F.monotonically_increasing_id()))


def _pass(rows: DataFrame, anchors: DataFrame, by: list[str], k: int, scale: int, block_rows: int) -> DataFrame:
    """The best ``k`` rows by ``by`` for one round's anchors, each with its ``rank``, written."""
    some = rows.sparkSession.sparkContext.broadcast(anchors.select("row", "label", "vector", "positives").toArrow())

    def run(batches):
        return best(Anchors(some.value, scale), batches, scale, k, block_rows)

    found = rows.select("row", "vec_id", "label", "vector").mapInArrow(
        run, "anchor long, positive long, score long, vec_id long, row long")
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    out = stage(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
    some.unpersist()
    return out


def mine(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE,
         round_rows: int = ROUND_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    rows = ready(vectors, scale)
    chosen = rows.where(F.col("vec_id") % ANCHOR_EVERY == 0)
    # anchors are numbered by their row numbers: partition's start plus place in it
    part = F.shiftright("row", 33)
    sizes = chosen.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.withColumn("start", F.sum("n").over(Window.orderBy("part")) - F.col("n"))
    numbered = chosen.withColumn("part", part).join(starts, "part").withColumn(
        "number", F.col("start") + F.row_number().over(Window.partitionBy("part").orderBy("row")) - 1)
    anchors = stage(numbered.select("number", "row", "vec_id", "label", "vector"))
    size = anchors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    step = max(1, min(round_rows, ROUND_CELLS // max(size["width"] or 0, 1)))
    none = F.lit(None).cast("array<struct<row:long,score:long>>")
    result = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for lo in range(0, size["n"], step):
        some = anchors.where(F.col("number").between(lo, lo + step - 1))
        near = _pass(rows, some.withColumn("positives", none), ["anchor"], positives, scale, block_rows)
        windows = near.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct("row", "score")).alias("positives"))
        far = _pass(rows, some.join(windows, "row"), ["anchor", "positive"], negatives, scale, block_rows)
        pairs = near.select("anchor", F.col("row").alias("positive"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        named = some.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
        found = far.join(pairs, ["anchor", "positive"]).join(named, "anchor")
        result = result.unionByName(found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                                                 "positive_score", F.col("score").alias("negative_score")))
    return result
