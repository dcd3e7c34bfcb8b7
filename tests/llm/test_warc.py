"""The archive against plain digests, and exact round trips."""
import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from lectern.llm import staging, warc


def page_rows():
    rows = [(5, "http://a/", "<p>same</p>"), (3, "http://b/\r\nX: y", "<p>same</p>"), (9, None, "<p>same</p>"), (1, "http://c/", None),
            (2, "http://d/", ""), (4, "u", "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nx"), (None, "http://n/", "<p>same</p>"),
            (None, "http://n/", "alone"), (7, "http://r/", "twice"), (7, "http://r/", "twice"), (8, "big", "z" * 300_000), (6, "h", "\x00  ")]
    return [(i, u, h, "x") for i, u, h in rows]


def pages_df(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string").repartition(3)


def plain(rows, least):
    out = []
    for i, _, h, _ in rows:
        b = (h or "").encode()
        ids = [j for j, _, g, _ in rows if (g or "").encode() == b and j is not None]
        first = min(ids) if ids and len(b) >= least else None
        revisit = first is not None and i != first
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least,small", [(0, 500_000), (6, 0)])
def test_listing(spark, least, small, monkeypatch):
    monkeypatch.setattr(warc, "SMALL_ROWS", small)
    path = staging.new_path(spark, "test-archive")
    warc.write_archive(pages_df(spark, page_rows()), path, least=least)
    assert sorted((tuple(r) for r in warc.listing(spark, path).collect()), key=str) == plain(page_rows(), least)
    stored = [bytes(r["payload"]) for r in spark.read.parquet(f"{path}/payloads").collect()]
    assert sorted(stored) == sorted({(h or "").encode() for _, _, h, _ in page_rows()})


def test_files_round_trip(spark):
    path = staging.new_path(spark, "test-archive")
    warc.write_archive(pages_df(spark, page_rows()), path)
    kept = warc.records(spark, path).collect()
    block = {r["page_id"]: bytes(r["block"]) for r in kept if r["record_type"] == "response"}
    full = sorted((r["page_id"], block[r["page_id"] if r["refers_to"] is None else r["refers_to"]]) for r in kept if r["page_id"] is not None)
    assert full == sorted((i, (h or "").encode()) for i, _, h, _ in page_rows() if i is not None)
    warc.export_warc(spark, path, path + "/files", per_file=2)
    back = warc.import_warc(spark, path + "/files").collect()
    text = lambda rows: sorted((bytes(r["header"]) if not isinstance(r["header"], str) else r["header"].encode(), bytes(r["block"])) for r in rows)
    assert text(back) == text(kept)


def test_damaged_payload_fails(spark):
    path = staging.new_path(spark, "test-archive")
    spark.sql("select unhex(sha2('a', 256)) digest, cast('b' as binary) payload").write.parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="does not match"):
        warc.payloads(spark, path).collect()


def test_repeated_rows_store_one_payload(spark):
    path = staging.new_path(spark, "test-archive")
    rows = spark.range(0, 100_000, 1, 7).selectExpr("7L as page_id", "'u' as url", "'<p>again</p>' as html").unionByName(
        spark.range(50).selectExpr("cast(null as bigint) as page_id", "'u' as url", "'no id' as html"))
    warc.write_archive(rows, path)
    assert spark.read.parquet(f"{path}/payloads").count() == 2
    got = warc.listing(spark, path).groupBy("page_id", "record_type", "payload_bytes").count().collect()
    assert sorted(map(tuple, got), key=str) == [(7, "response", 12, 100_000), (None, "response", 5, 50)]


@pytest.mark.parametrize("change", ["replace(header, 'Content-Length: 12', 'Content-Length: 13')", "replace(header, 'sha1:', 'sha1:A')",
                                    "regexp_replace(header, 'sha1:[A-Z2-7]{4}', 'sha1:AAAA')"])
@pytest.mark.parametrize("which", [0, 1])
def test_damaged_header_fails(spark, change, which):
    path = staging.new_path(spark, "test-archive")
    warc.write_archive(spark.createDataFrame([(1, "u", "<p>same</p>!"), (2, "v", "<p>same</p>!")], "page_id bigint, url string, html string"), path)
    if which and "13" in change:
        change = "replace(header, 'Content-Length: 0', 'Content-Length: 13')"
    bad = staging.stage(spark.read.parquet(f"{path}/headers").withColumn("header", F.expr(f"if(page_id = {which + 1}, {change}, header)")))
    bad.write.mode("overwrite").parquet(f"{path}/headers")
    with pytest.raises(Exception, match="does not|has no block"):
        warc.listing(spark, path).collect()


def test_empty(spark):
    path = staging.new_path(spark, "test-archive")
    warc.write_archive(pages_df(spark, []), path)
    assert warc.listing(spark, path).count() == 0
