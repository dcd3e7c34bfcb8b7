"""Content-addressed WARC archive.

An archive is two tables. ``headers`` keeps the exact header block of every WARC record
(one per page) with the strong digest of its payload; ``payloads`` keeps each distinct
payload once, under its SHA-256. Of the records with equal payloads of at least
``least`` bytes, the one with the smallest page id is a ``response`` and the others are
``revisit`` records that refer to it. Reading joins the headers to the payloads,
recomputes every stored payload's digest, compares lengths and digests with the headers',
stops on a mismatch, and gives back the original records byte for byte. ``export_warc`` writes them as plain WARC files with
Spark's text writer, ``import_warc`` reads such files by their content lengths.

Scale: digests, lengths and ids shuffle; payload bytes are written from their own
scan (rows to leave out come as a sized join on id and digest). ``records`` shuffles each
stored payload once, to its response. A payload shared by a third of all pages is stored
once, and its revisits are joined to its length and digest alone.

Defined cases: a null payload is empty; a null url gives an empty target; a null page
id is never a group's smallest unless all are null; rows repeated with one page
id are all responses if that id is the smallest, and share one stored payload; line
ends in a url are percent-encoded; extra columns are ignored; empty tables work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import sized_join, stage

DATE = "2024-01-01T00:00:00Z"
LEAST_BYTES = 0
SMALL_ROWS = 500_000
CRLF = "\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(hex_digest: Column) -> Column:
    """Base32 of a hexadecimal SHA-1: each 5 hexadecimal digits are 4 letters."""
    letters = []
    for at in range(1, 41, 5):
        value = F.conv(F.substring(hex_digest, at, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(BASE32), F.shiftright(value, shift).bitwiseAND(31) + 1, 1))
    return F.concat(*letters)


def _line(name: str, value) -> Column:
    return F.concat(F.lit(name + ": "), value, F.lit(CRLF))


def header(date: str) -> Column:
    """The header block of a record, ending with its empty line."""
    response = F.col("record_type") == "response"
    uri = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    return F.concat(
        F.lit("WARC/1.1" + CRLF), _line("WARC-Type", F.col("record_type")), _line("WARC-Record-ID", page("page_id")),
        _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", uri),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("sha1")))),
        F.when(~response, F.concat(_line("WARC-Refers-To", page("refers_to")), _line("WARC-Profile", F.lit(REVISIT)))).otherwise(""),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(response, F.col("payload_bytes")).otherwise(0).cast("string")), F.lit(CRLF))


def write_archive(pages: DataFrame, path: str, least: int = LEAST_BYTES, date: str = DATE,
                  id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Write ``headers`` and ``payloads`` below ``path``."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn(
        "digest", F.unhex(F.sha2("payload", 256)))
    known = stage(src.select("page_id", "url", "digest", F.sha1("payload").alias("sha1"),
                             F.octet_length("payload").cast("bigint").alias("payload_bytes")))
    groups = (known.where(F.col("payload_bytes") >= least).groupBy("digest")
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    groups = stage(groups)
    marked = sized_join(known, groups, "digest", "left", most=SMALL_ROWS)
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    marked = (marked.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
              .withColumn("refers_to", F.when(revisit, F.col("first_id"))))
    marked.select("page_id", header(date).alias("header"), "digest").write.parquet(f"{path}/headers")
    left_out = stage(marked.where(revisit).select(F.col("page_id").alias("out_id"), F.col("digest").alias("out_digest")).distinct())
    again = stage(marked.where(~revisit).groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"))
    is_out = F.col("page_id").eqNullSafe(F.col("out_id")) & (F.col("digest") == F.col("out_digest"))
    first = sized_join(src, left_out, is_out, "left_anti", most=SMALL_ROWS).select("digest", "payload")
    repeats = again.count()
    alone = sized_join(first, again, "digest", "left_anti", rows=repeats, most=SMALL_ROWS) if repeats else first
    alone.write.parquet(f"{path}/payloads")
    if repeats:
        # several responses share a payload: each task keeps one row per digest before the shuffle
        shared = sized_join(first, again, "digest", "left_semi", rows=repeats, most=SMALL_ROWS)
        shared.groupBy("digest").agg(F.any_value("payload").alias("payload")).write.mode("append").parquet(f"{path}/payloads")


def headers(spark: SparkSession, path: str) -> DataFrame:
    """page_id, header, digest, and the fields read back from each header block."""
    field = lambda name, pattern: F.regexp_extract("header", f"\r\n{name}: {pattern}\r\n", 1)
    refers = field("WARC-Refers-To", "<urn:page:([^>]*)>")
    kept = spark.read.parquet(f"{path}/headers")
    return kept.select("page_id", "header", "digest", field("WARC-Type", "([a-z]+)").alias("record_type"),
                       F.when(refers != "", refers).cast(kept.schema["page_id"].dataType).alias("refers_to"),
                       field("WARC-Payload-Digest", "sha1:([A-Z2-7]{32})").alias("payload_digest"),
                       field("Content-Length", "([0-9]+)").cast("bigint").alias("length"))


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """digest, payload of the store; a payload that is not what its digest says fails."""
    good = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    return spark.read.parquet(f"{path}/payloads").select(
        "digest", F.when(good, F.col("payload")).otherwise(F.raise_error(F.lit("payload does not match its digest"))).alias("payload"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """page_id, record_type, refers_to, header, digest, block (the record's own bytes: empty
    for a revisit), payload_digest and length of every record, rebuilt from the headers and the
    payloads. Only responses read their payload, which is mostly one record per payload; a
    header whose length or digest is not that of its block fails."""
    heads = headers(spark, path)
    own = heads.where("record_type = 'response'").join(payloads(spark, path), "digest", "left").withColumnRenamed("payload", "block")
    fits = F.col("block").isNotNull() & (F.octet_length("block") == F.col("length")) & (
        base32_sha1(F.sha1("block")) == F.col("payload_digest"))
    empty = heads.where("record_type = 'revisit'").withColumn("block", F.lit(b"")).withColumn(
        "block", F.when(F.col("length") == 0, F.col("block")).otherwise(F.raise_error(F.lit("a revisit has no block"))))
    checked = F.when(fits, F.col("block")).otherwise(F.raise_error(F.lit("a header does not match its payload")))
    cols = ["page_id", "record_type", "refers_to", "header", "digest", "block", "payload_digest", "length"]
    return own.withColumn("block", checked).select(*cols).unionByName(empty.select(*cols))


def listing(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record. Lengths
    and digests are those of the blocks rebuilt by ``records``; a revisit has those of
    the response it refers to, whose digest its own header must name."""
    read = stage(records(spark, path).select(
        "page_id", "record_type", "refers_to", "digest", F.octet_length("block").cast("bigint").alias("payload_bytes"),
        F.col("payload_digest").alias("named"), F.when(F.col("record_type") == "response", base32_sha1(F.sha1("block"))).alias("payload_digest")))
    own = read.where("record_type = 'response'")
    full = stage(own.groupBy("digest").agg(F.min("payload_bytes").alias("payload_bytes"), F.min("payload_digest").alias("payload_digest")))
    same = F.when(F.col("named") == F.col("payload_digest"), F.col("payload_digest")).otherwise(
        F.raise_error(F.lit("a revisit does not name its response's digest")))
    revisits = sized_join(read.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest"), full, "digest", "left",
                          most=SMALL_ROWS).withColumn("payload_digest", same)
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return own.select(*cols).unionByName(revisits.select(*cols))


def export_warc(spark: SparkSession, path: str, to: str, per_file: int = 10_000) -> None:
    """The records of an archive as WARC files of at most ``per_file`` records."""
    line = F.concat(F.col("header").cast("binary"), F.col("block")).cast("string")
    (records(spark, path).select(line.alias("value")).write.option("lineSep", CRLF + CRLF)
     .option("maxRecordsPerFile", per_file).text(to))


def import_warc(spark: SparkSession, path: str) -> DataFrame:
    """header and block of every record of the WARC files below ``path``; a block whose
    payload digest does not hold fails."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content").to_pylist():
                heads, blocks, at = [], [], 0
                while at < len(data):
                    end = data.index(b"\r\n\r\n", at) + 4
                    head = data[at:end]
                    size = int(head.split(b"\r\nContent-Length: ")[1].split(b"\r\n")[0])
                    block = data[end:end + size]
                    if b"\r\nWARC-Type: response\r\n" in head:
                        import base64
                        digest = base64.b32encode(hashlib.sha1(block).digest())
                        if b"sha1:" + digest not in head:
                            raise ValueError("a block does not match its digest")
                    heads.append(head)
                    blocks.append(block)
                    at = end + size + 4
                yield pa.RecordBatch.from_arrays([pa.array(heads, pa.binary()), pa.array(blocks, pa.binary())],
                                                 names=["header", "block"])

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "header binary, block binary")
