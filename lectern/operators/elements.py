"""Looking up the elements of list columns (D5, I2, L2) without exploding the lists.

The lookup table's frequent head, within the broadcast bounds, goes to every worker once, and a
batch's elements are looked up together as one Arrow column where the rows lie. A larger
table leaves elements that the head does not know: those alone, rare by construction, are
shuffled to the tail, and what is found is put back at their places. So the traffic is the rows
once, as looked-up values, plus the rare elements.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

GATHER = 1 << 20     # elements of small batches looked up together


def find_in_head(df: DataFrame, keys: Sequence[str], items: Column, head: DataFrame, default=None,
                 rest: bool = False) -> DataFrame:
    """``keys..., _found``: each element's value in ``head`` (``k, v``, its size checked by the
    caller), ``default`` for an element outside it, null for a null one; a null list is empty. With
    ``rest`` also ``_at, _rare``: places and values of the elements outside ``head``."""
    keys = list(keys)
    listed = df.select(*keys, items.alias("_items"))
    shared = df.sparkSession.sparkContext.broadcast(head.select("k", "v").toArrow())
    names = [*keys, "_found", *(["_at", "_rare"] if rest else [])]
    key_list, value = listed.schema["_items"], head.schema["v"].dataType
    gather = GATHER

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        table = shared.value
        whole = lambda c: pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type)
        known, values = whole(table["k"]), whole(table["v"])

        def looked_up(b):
            lists = b.column("_items")
            flat = lists.flatten().cast(known.type)
            at = pc.index_in(flat, value_set=known, skip_nulls=True)
            missed = pc.and_(pc.is_null(at), pc.is_valid(flat))
            found = pc.take(values, at)
            if default is not None:
                found = pc.if_else(missed, pa.scalar(default, values.type), found)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            first = np.concatenate([[0], ends]).astype(np.int32)
            out = [*[b.column(k) for k in keys], pa.ListArray.from_arrays(pa.array(first), found)]
            if rest:
                gone = np.flatnonzero(missed.to_numpy(zero_copy_only=False))
                bounds = pa.array(np.searchsorted(gone, first).astype(np.int32))
                place = gone - first[np.searchsorted(first, gone, "right") - 1]
                out += [pa.ListArray.from_arrays(bounds, pa.array(place.astype(np.int32))),
                        pa.ListArray.from_arrays(bounds, flat.take(pa.array(gone)))]
            return pa.RecordBatch.from_arrays(out, names=names)

        held, n = [], 0
        for b in batches:
            held.append(b)
            n += len(b.column("_items").flatten())
            if n >= gather:
                yield from map(looked_up, pa.Table.from_batches(held).combine_chunks().to_batches())
                held, n = [], 0
        if held:
            yield from map(looked_up, pa.Table.from_batches(held).combine_chunks().to_batches())

    kind = [*[listed.schema[k] for k in keys], T.StructField("_found", T.ArrayType(value))]
    if rest:
        kind += [T.StructField("_at", T.ArrayType(T.IntegerType())), T.StructField("_rare", key_list.dataType)]
    return listed.mapInArrow(run, T.StructType(kind))


def find_in_tail(rows: DataFrame, keys: Sequence[str], tail: DataFrame) -> DataFrame:
    """``keys..., _found`` with the elements of ``_rare`` looked up in ``tail`` (``k, v``). ``rows`` is
    the written result of ``find_in_head`` with a row number ``_row``."""
    keys = list(keys)
    rare = rows.select("_row", F.inline(F.arrays_zip(F.col("_at").alias("p"), F.col("_rare").alias("k"))))
    fixes = rare.join(tail.select("k", "v"), "k").groupBy("_row").agg(F.collect_list(F.struct("p", "v")).alias("_f"))
    both = rows.select("_row", *keys, "_found").join(fixes, "_row", "left").select(
        *keys, "_found", F.transform("_f", lambda f: f["p"]).alias("_p"), F.transform("_f", lambda f: f["v"]).alias("_v"))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in batches:
            lists, place = b.column("_found"), b.column("_p")
            size = lambda x: pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.cumsum(size(lists))]).astype(np.int32)
            at = np.repeat(first[:-1], size(place)) + place.flatten().to_numpy(zero_copy_only=False)
            flat, order = lists.flatten(), np.argsort(at)
            if len(at):
                mask = np.zeros(len(flat), bool)
                mask[at] = True
                flat = pc.replace_with_mask(flat, pa.array(mask), b.column("_v").flatten().take(pa.array(order)))
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keys], pa.ListArray.from_arrays(pa.array(first), flat)],
                                             names=[*keys, "_found"])

    return both.mapInArrow(run, T.StructType([*[both.schema[k] for k in keys], both.schema["_found"]]))


def find_all(df: DataFrame, keys: Sequence[str], items: Column, head: DataFrame, tail: DataFrame | None,
             default=None) -> DataFrame:
    """``keys..., _found`` from both parts of a table ``k, v``."""
    if tail is None:
        return find_in_head(df, keys, items, head, default)
    return find_in_tail(numbered(find_in_head(df, keys, items, head, default, rest=True)), keys, tail)


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` written once with a row number, which repeated keys do not give."""
    return cut_lineage(rows.withColumn("_row", F.monotonically_increasing_id()))


def repeated(df: DataFrame, keys: Sequence[str], with_null: bool = False) -> DataFrame:
    """The key values that several rows have; also, ``with_null``, those with a null part."""
    null = F.lit(False)
    for k in keys if with_null else ():
        null = null | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > 1) | null).select(*keys)


def same_keys(df: DataFrame, keys: Sequence[str], these: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on ``keys``; null equals null."""
    other = these.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    on = None
    for i, k in enumerate(keys):
        c = df[k].eqNullSafe(other[f"_k{i}"])
        on = c if on is None else on & c
    return df.join(other, on, how)
