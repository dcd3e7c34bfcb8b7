"""Joining a large table to a keyed lookup table (one row per key).

Used for token -> id, context -> count, token -> count and last token ->
candidates. The lookup side's size is checked first; up to
``broadcast_max_rows`` rows and ``broadcast_max_cells`` values it is broadcast
(the large side never shuffles).
Beyond that the join is shuffled, and because one key of the large side may
hold a third of its rows, the large side is salted over ``salt`` sub-keys and
the lookup side (one row per key) is replicated ``salt`` times, so a hot key is
spread over ``salt`` tasks. AQE's skew-join split stays on as a second guard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_CELLS = 8_000_000
SALT = 8


def table_size(small: DataFrame, cells: Column | None = None) -> tuple[int, int]:
    """``(rows, cells)`` of a lookup table in one small aggregate. ``cells`` is a
    per-row value count for wide rows (e.g. ``size(array_col) + 1``); by default
    a row counts as one cell."""
    c = cells if cells is not None else F.lit(1)
    r = small.agg(F.count(F.lit(1)).alias("n"), F.sum(c).alias("c")).first()
    return int(r["n"] or 0), int(r["c"] or 0)


def string_cells(col: str | Column) -> Column:
    """Cell measure of a string key: one cell per started 16 bytes, plus one."""
    return F.ceil(F.octet_length(col) / F.lit(16)) + 1


def head_and_tail(small: DataFrame, size: tuple[int, int], count_col: str = "count",
                  max_rows: int = BROADCAST_MAX_ROWS, max_cells: int = BROADCAST_MAX_CELLS) -> tuple[DataFrame, DataFrame | None]:
    """A lookup table cut by how often its keys occur: a head within the broadcast bounds and
    the tail (``None`` when all fits), whose keys are rare by construction."""
    n, cells = size
    if n <= max_rows and cells <= max_cells:
        return small, None
    # as many entries as fit, by the share of rows and of cells; a margin covers the
    # approximate quantile, and ties at the cut stay in the tail
    share = 0.8 * min(1.0, max_rows / max(n, 1), max_cells / max(cells, 1))
    times = F.coalesce(F.col(count_col), F.lit(0))
    cut = small.select(times.alias("_n")).approxQuantile("_n", [1 - share], 0.1 * share) if share else []
    if not cut:
        return small.where(F.lit(False)), small
    return small.where(times > cut[0]), small.where(times <= cut[0])


def lookup(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left",
           salt: int = SALT, broadcast_max_rows: int = BROADCAST_MAX_ROWS,
           small_rows: int | None = None, salt_cols: Sequence[str] | None = None,
           small_size: tuple[int, int] | None = None,
           broadcast_max_cells: int = BROADCAST_MAX_CELLS, count_col: str | None = None) -> DataFrame:
    """``big`` joined to ``small`` on ``on``; ``small`` must be unique on ``on``.

    The broadcast needs both the row count and the cell count (values, for wide
    rows holding arrays) under their bounds. ``small_size`` / ``small_rows`` skip
    the measuring aggregate when the caller already knows them; ``salt_cols``
    picks the large-side columns the salt is hashed from (default: all of them).
    ``count_col`` names a column of ``small`` that tells how frequent its keys are: a larger table is then
    cut by it, its head is broadcast, and only the rows the head does not know, whose keys are rare,
    are shuffled to the tail; nothing is replicated. ``big`` is read twice, so give a written table.
    """
    on = list(on)
    if small_size is not None:
        n, cells = small_size
    elif small_rows is not None:
        n, cells = small_rows, small_rows
    else:
        n, cells = table_size(small)
    if n <= broadcast_max_rows and cells <= broadcast_max_cells:
        return big.join(F.broadcast(small), on, how)
    if count_col:
        # a quarter of the bounds holds most rows' keys already, and several heads may be in use at once
        head, tail = head_and_tail(small, (n, cells), count_col, broadcast_max_rows // 4, broadcast_max_cells // 4)
        known = big.join(F.broadcast(head), on, "inner")
        rest = big.join(F.broadcast(head.select(*on)), on, "left_anti").join(tail, on, how)
        return known.unionByName(rest)
    if salt <= 1:
        return big.join(small, on, how)
    cols = list(salt_cols) if salt_cols else big.columns
    b = big.withColumn("_salt", F.pmod(F.xxhash64(*cols), F.lit(salt)).cast("int"))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return b.join(s, on + ["_salt"], how).drop("_salt")
