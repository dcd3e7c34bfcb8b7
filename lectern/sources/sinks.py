"""Sinks (A5, A6, A9, A10): Parquet tables, split-partitioned datasets, text reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import two_decimals

# ---------------------------------------------------------------------------
# The evaluation report's header and perplexity label.
REPORT_HEADER = "Evaluation Results:"
PERPLEXITY_LABEL = "Perplexity: "
# ---------------------------------------------------------------------------


def save_table(df: DataFrame, out_dir: str, name: str, counts: dict | None = None) -> str:
    """A5: ``out_dir/name`` as Parquet, replacing an earlier run. With ``counts``
    (a dict) the written row count is added under ``name``, observed during the
    write itself (E1: no second pass)."""
    path = f"{out_dir.rstrip('/')}/{name}"
    obs = Observation(f"rows_{name}") if counts is not None else None
    out = df.observe(obs, F.count(F.lit(1)).alias("rows")) if obs else df
    out.write.mode("overwrite").parquet(path)
    if obs:
        counts[name] = obs.get["rows"]
    return path


def save_splits(df: DataFrame, out_dir: str, split_col: str = "split",
                counts: dict | None = None) -> str:
    """One dataset, partitioned by split, so reading ``train`` prunes the rest.
    With ``counts`` the rows per split are observed during the write (E1)."""
    obs = Observation("rows_by_split") if counts is not None else None
    out = df
    if obs:
        out = df.observe(obs, F.sum(F.when(F.col(split_col) == "train", 1).otherwise(0)).alias("train"),
                         F.sum(F.when(F.col(split_col) == "validation", 1).otherwise(0)).alias("validation"))
    out.write.mode("overwrite").partitionBy(split_col).parquet(out_dir)
    if obs:
        counts.update({k: int(v or 0) for k, v in obs.get.items()})
    return out_dir


def metrics_report(row: DataFrame, loss_col: str = "eval_loss",
                   formats: Mapping[str, str] | None = None,
                   sources: Mapping[str, str] | None = None) -> DataFrame:
    """A10: ``line_no, line`` of the evaluation report: a header, one
    ``key: value`` line per metric, then ``Perplexity: %.2f`` (B13)."""
    formats = dict(formats or {loss_col: "%.6f"})
    sources = dict(sources or {})
    lines = [F.struct(F.lit(1).alias("line_no"), F.lit(REPORT_HEADER).alias("line"))]
    for i, (key, fmt) in enumerate(formats.items()):
        col = F.col(sources.get(key, key))
        lines.append(F.struct(F.lit(i + 2).alias("line_no"),
                              F.concat(F.lit(f"{key}: "), F.format_string(fmt, col)).alias("line")))
    lines.append(F.struct(F.lit(len(formats) + 2).alias("line_no"),
                          F.concat(F.lit(PERPLEXITY_LABEL), two_decimals(F.exp(loss_col))).alias("line")))
    return row.select(F.explode(F.array(*lines)).alias("l")).select("l.*")


def write_text(df: DataFrame, path: str, col: str, order_by: str | None = None) -> str:
    """Write one text column as plain text files (one value per line block)."""
    out = df.select(col)
    if order_by is not None:
        out = df.sortWithinPartitions(order_by).select(col)
    out.write.mode("overwrite").text(path)
    return path
