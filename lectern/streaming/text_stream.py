"""Streaming use of the stateless stages (K).

Cleaning, the byte tokenizer and per-document packing are row-local, so the same
functions run on a ``readStream`` frame: new documents landing in a folder are
cleaned, tokenized and cut into blocks incrementally, with the stream's
checkpoint location giving exactly-once output to a file sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import clean_text
from ..operators.pack import pack_document
from ..operators.tokenize import tokenize_bytes

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def blocks_from_documents(docs: DataFrame, block_size: int = 1024) -> DataFrame:
    """Clean -> byte tokens -> blocks per document. Works on batch or stream frames."""
    cleaned = docs.select("doc_id", clean_text("text").alias("text"))
    return pack_document(tokenize_bytes(cleaned, ["doc_id"], "text"), block_size, "doc_id")


def start_block_stream(spark: SparkSession, source_dir: str, sink_dir: str,
                       checkpoint_location: str, block_size: int = 1024,
                       schema: str = DOC_SCHEMA, available_now: bool = True) -> StreamingQuery:
    """Watch ``source_dir`` for Parquet documents; append their blocks to ``sink_dir``."""
    docs = spark.readStream.schema(schema).parquet(source_dir)
    blocks = blocks_from_documents(docs, block_size).withColumn(
        "n_tokens", F.size("input_ids"))
    w = (blocks.writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_location).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
