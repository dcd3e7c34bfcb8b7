"""Inputs the registered queries derive from the driver's tables.

Each helper reads parquet (so column pruning and filters reach the scan) and
returns the tables the operators expect. The SQL fragments next to them build
the same inputs in DuckDB for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import FOOTER_MARKER, HEADER_MARKER


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


# Raw "books": English and French documents get a boilerplate header before and a
# footer after their text, the other languages stay bare. Both engines build it
# from the same expression.
def wrapped_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir)
    wrap = F.col("lang").isin("en", "fr")
    text = F.when(wrap, F.concat(
        F.lit("The Project Gutenberg EBook of "), F.col("source"), F.lit("\n\n*** "),
        F.lit(HEADER_MARKER), F.lit(" "), F.upper(F.col("lang")), F.lit(" ***\n\n"),
        F.col("text"),
        F.lit("\n\n" + FOOTER_MARKER + " EBook of "), F.col("source"), F.lit("\n*** END ***\n"),
    )).otherwise(F.col("text"))
    return d.select("doc_id", "lang", "source", text.alias("text"))


WRAPPED_SQL = f"""
SELECT doc_id, lang, source,
       CASE WHEN lang IN ('en', 'fr') THEN
         'The Project Gutenberg EBook of ' || source || chr(10) || chr(10) || '*** '
         || '{HEADER_MARKER}' || ' ' || upper(lang) || ' ***' || chr(10) || chr(10)
         || text || chr(10) || chr(10) || '{FOOTER_MARKER}' || ' EBook of ' || source
         || chr(10) || '*** END ***' || chr(10)
       ELSE text END AS text
FROM documents
"""
