"""Registered queries of the subpackage, ``(spark, sf_dir) -> DataFrame``, and
their DuckDB SQL where SQL can express the operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, gru_lm, hard_negatives, license_scan, merkle, ngram_join, order_minhash, packing, pii, quality, sql, staging, token_counts, url_filter, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


@query("op1_url_filter", sql.URL_FILTER)
def op1_url_filter(spark, sf_dir):
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


@query("op5_decontaminate", sql.DECONTAMINATE)
def op5_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"), keep_text=False)
    return decontaminate.digest(found)


@query("op6_quality")
def op6_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op10_packing")
def op10_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op2_ngram_join")
def op2_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_warc", sql.WARC)
def op4_warc(spark, sf_dir):
    path = staging.new_path(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.listing(spark, path)


@query("op7_license_scan", sql.license_scan(license_scan.BASE, license_scan.NOTICES, license_scan.K, license_scan.GAP,
                                            license_scan.LEAST_COVER, license_scan.MOST_STRETCH))
def op7_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query("op8_gru_lm")
def op8_gru_lm(spark, sf_dir):
    return gru_lm.score(table(spark, sf_dir, "documents"))


@query("op9_pii")
def op9_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


@query("op3_token_counts")
def op3_token_counts(spark, sf_dir):
    path = tokenizer_path()
    state = token_counts.build(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    edited = token_counts.apply_edits(state, path, keep_text=False, propose=token_counts.cleaning_edits_of)
    return edited.select("doc_id", "n_edits", "n_tokens_before", "n_tokens", "n_encoded")


@query("op12_merkle", sql.MERKLE)
def op12_merkle(spark, sf_dir):
    return merkle.verify(table(spark, sf_dir, "documents"))


@query("op13_hard_negatives", sql.HARD_NEGATIVES)
def op13_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


@query("op11_order_minhash")
def op11_order_minhash(spark, sf_dir):
    return order_minhash.compare(table(spark, sf_dir, "documents"))
