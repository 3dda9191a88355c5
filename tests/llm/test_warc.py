import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from mortar.llm import scratch, warc

PAGES = [
    (3, "http://a/3", "same"), (1, "http://a/1", "same"), (2, "http://a/2\n", None), (4, None, ""), (5, "u", "é" * 90_000),
    (6, "u", "body\r\n\r\nWARC/1.1\r\n\r\n"), (7, "u", "é" * 90_000), (8, "u", "x"), (8, "u", "x"), (None, "u", "same"), (None, "u", "alone"),
    (18, "u", "x of two"), (18, "u", "yy of two"), (19, "u", "x of two"), (20, "u", "yy of two"),
]


def pages(spark):
    rows = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    return rows.repartition(3)


def sha(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(least=0):
    first = {}
    for i, _, html in sorted((p for p in PAGES if p[0] is not None), key=lambda p: p[0]):
        first.setdefault(html or "", i)
    out = []
    for i, _, html in PAGES:
        size = len((html or "").encode())
        of = first.get(html or "", i)
        revisit = of != i and size >= least
        out.append((i, size, sha(html), "revisit" if revisit else "response", of if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    got = warc.round_trip(pages(spark), least)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == expected(least)


def test_real_pages(spark):
    real = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"]) for r in warc.round_trip(real).collect()}
    assert got == {r["page_id"]: (len(r["html"].encode()), sha(r["html"])) for r in real.collect()}


def test_chunks_carry_running_digests(spark):
    folder = scratch.fresh_path(spark, "warc")
    manifest = warc.write(pages(spark), folder, chunk=1000, archive=2000)
    assert manifest.count() > 1
    rows = warc.read(spark, folder, manifest, chunk=700).filter("page_id = 5").orderBy("chunk_no").collect()
    whole, running = b"", hashlib.sha1()
    for n, r in enumerate(rows):
        running.update(r["chunk"])
        assert (r["chunk_no"], r["offset"], r["size"]) == (n, len(whole), len(r["chunk"]))
        assert r["payload_digest"] == base64.b32encode(running.digest()).decode()
        assert r["last"] == (n == len(rows) - 1)
        whole += bytes(r["chunk"])
    assert whole.decode() == "é" * 90_000
    assert max(r["size"] for r in rows) == 700


def test_archives_are_plain_warc_and_damage_is_found(spark):
    folder = scratch.fresh_path(spark, "warc")
    manifest = warc.write(pages(spark).coalesce(1), folder)
    system, base = scratch.file_system(folder)
    with system.open_input_stream(f"{base}/{manifest.first()['file']}", compression=None) as f:
        packed = f.read()
    text = gzip.decompress(packed)
    assert text.count(b"WARC-Record-ID: ") == len(PAGES)
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: ")
    assert len(list(warc.chunk_rows(io.BytesIO(packed), "x", 64, True))) > len(PAGES)
    with pytest.raises(Exception):
        list(warc.chunk_rows(io.BytesIO(packed[: len(packed) // 2]), "x", 64, True))
    with pytest.raises(ValueError):
        list(warc.chunk_rows(io.BytesIO(gzip.compress(text.replace(b"same", b"sane"))), "x", 64, True))


def foreign(kind, record, body, *fields, http=b"HTTP/1.1 200 OK\r\n\r\n", content="application/http; msgtype=response"):
    block = http + body
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {record}", *fields, f"Content-Type: {content}", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def test_archive_of_others(spark):
    digest = f"WARC-Payload-Digest: sha1:{sha('hello')}"
    one = "<urn:uuid:0c1b2e3f-0000-4000-8000-000000000001>"
    parts = [
        foreign("warcinfo", "<urn:uuid:info>", b"software: x\r\n", http=b"", content="application/warc-fields"),
        foreign("request", "<urn:uuid:req>", b"", http=b"GET / HTTP/1.1\r\n\r\n", content="application/http; msgtype=request"),
        foreign("response", one, b"hello", digest, "WARC-Target-URI: http://a/"),
        foreign("revisit", "<urn:uuid:two>", b"", digest, f"WARC-Refers-To: {one}"),
        foreign("revisit", "<urn:uuid:lost>", b"", digest),
        foreign("response", "<urn:uuid:md5>", b"other", "WARC-Payload-Digest: md5:00"),
        foreign("response", "<urn:uuid:cut>", b"5\r\nhello\r\n0\r\n\r\n", digest, http=b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"),
    ]
    folder = scratch.fresh_path(spark, "warc")
    system, base = scratch.file_system(folder)
    system.create_dir(base)
    with system.open_output_stream(f"{base}/others.warc.gz", compression=None) as f:
        f.write(b"".join(parts))
    chunks = warc.read(spark, folder, spark.createDataFrame([("others.warc.gz",)], "file string"))
    got = {(r["record_type"], r["page_id"], r["payload_bytes"], r["target"]) for r in warc.records(chunks).collect()}
    assert got == {
        ("warcinfo", None, 13, None), ("request", None, 0, None), ("response", None, 5, "http://a/"), ("revisit", None, 5, None),
        ("revisit", None, 0, None), ("response", None, 5, None), ("response", None, 15, None),
    }
    wrong = foreign("revisit", "<urn:uuid:bad>", b"", f"WARC-Payload-Digest: sha1:{sha('else')}", f"WARC-Refers-To: {one}")
    with system.open_output_stream(f"{base}/wrong.warc.gz", compression=None) as f:
        f.write(parts[2] + wrong)
    chunks = warc.read(spark, folder, spark.createDataFrame([("wrong.warc.gz",)], "file string"))
    with pytest.raises(Exception, match="not that of the record"):
        warc.records(chunks).collect()


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
