"""Deterministic keys and draws (J8): every random choice is a hash of
``seed:key`` so results do not depend on partitioning, retries or ``rand()``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seeded_md5(seed: int, *cols) -> Column:
    """Lower-case hex md5 of ``seed:c1:c2:...`` (values in their string form)."""
    parts = [F.lit(str(seed))] + [_c(c).cast("string") for c in cols]
    return F.md5(F.concat_ws(":", *parts))


def hex_bucket(hash_col, digits: int = 3) -> Column:
    """First ``digits`` hex digits of a hash as an int: 16**digits uniform buckets,
    ordered the same way as the hash itself."""
    return F.conv(F.substring(_c(hash_col), 1, digits), 16, 10).cast("int")


def uniform01(seed: int, *cols) -> Column:
    """A draw in [0, 1) from the first 32 bits of ``md5(seed:key)``."""
    h = seeded_md5(seed, *cols)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
