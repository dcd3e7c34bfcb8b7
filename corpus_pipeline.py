"""The training-data pipeline: documents to packed sequences in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next one's
documents. All but the last return the columns of ``documents``; ``n_chars`` follows
the text where a stage changes it. Models are fitted on the stage's own input
(the quality field on the labelled rows among it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import decontaminate, ngram_join, packing, pii, quality
from lectern.llm.queries import table, tokenizer_path
from lectern.llm.staging import sized_join, stage


PACKING_CACHE = 250_000


def _recount(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    n = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", n)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: rejected documents go."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2 on five-word shingles at a similarity of 0.8: of each group of linked
    documents one row stays, that with the smallest doc_id (null ids last, ties by a hash of
    the row). Rows are told apart by doc_id and hash, so ids may repeat, clash or be null; of
    rows equal in every column one stays. Texts without shingles link with nothing and all stay."""
    found = ngram_join.linked_rows(docs, docs.columns, k=5, percent=80)
    marks = stage(found.where("kept is not null").groupBy("doc_id", "key")
                  .agg(F.min("kept").alias("kept"), F.count(F.lit(1)).alias("times")).where("not kept or times > 1")
                  .select(F.col("doc_id").alias("_id"), F.col("key").alias("_mark"), "kept"))
    keyed = docs.withColumn("_key", F.xxhash64(*docs.columns))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_mark"))
    once = sized_join(keyed, marks, same, "left_anti")
    again = sized_join(keyed, marks.where("kept").drop("kept"), same, "left_semi").dropDuplicates(["doc_id", "_key"])
    return once.unionByName(again).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: benchmark passages are cut out; documents that are mostly such go."""
    return _recount(decontaminate.clean(docs, table(spark, sf_dir, "benchmark")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: personal data is replaced by its kind."""
    return _recount(pii.redact(docs, pii.train(docs)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: pieces of documents in sequences of at most 4096 tokens."""
    # workers keep their caches while other stages run, so this one is small
    return packing.pack(docs, tokenizer_path(), cache=PACKING_CACHE)


STAGES = [("quality", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("packing", packed)]

#: A linear-chain field, message passing and byte-pair ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
