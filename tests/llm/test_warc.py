import gzip
import hashlib
import random

import duckdb
import pytest

from docweave.llm import warc
from docweave.llm.queries import ORACLES, QUERIES
from docweave.llm.warc import page_number, read_warc, write_warc

SCHEMA = "page_id long, url string, html string, path string, digest int"


def result(records):
    out = records.select(page_number("record_id").alias("p"), "payload_bytes", "payload_digest", "record_type", page_number("refers_to").alias("r"))
    return sorted((tuple(r) for r in out.collect()), key=str)


def brute(pages):
    data = [(p, (h or "").encode()) for p, _, h in pages]
    out = []
    for p, payload in data:
        like = [q for q, other in data if other == payload and q is not None]
        keeper = max(like, default=None)
        revisit = len(payload) >= 1000 and keeper is not None and p != keeper
        out.append((p, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(2)
    big = ["é" * 500, "x" * 1000, "".join(rng.choices("abcdef <>&\r\n", k=200_000))]
    out = [(i, f"http://h/{i}?a b%20\r\né", rng.choice([*big, "short", "y" * 999, f"page {i} " * rng.randint(1, 400)])) for i in range(200)]
    out += [(900, None, None), (901, "", ""), (None, "u", big[0]), (None, "u", "no id " * 300), (7, "u", big[1]), (7, "u", big[1]), (-3, "u", "WARC/1.1\r\n\r\n" * 200)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("range_bytes", [97, 4096, 4 << 20])
def test_records_come_back_whole_from_any_ranges(spark, pages, range_bytes, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3_000)
    archives = write_warc(frame(spark, pages))
    assert archives.count() > 3
    few = archives if range_bytes > 97 else archives.orderBy("bytes").limit(2)
    records = read_warc(spark, few, range_bytes)
    if range_bytes > 97:
        assert result(records) == brute(pages)
        want = {(p, "".join(u.split("\r\n")) if u else u) for p, u, _ in pages}
        got = {(r.p, "".join(r.target_uri.split("\r\n")) if r.target_uri else r.target_uri) for r in records.select(page_number("record_id").alias("p"), "target_uri").collect()}
        assert got == want
    else:
        assert records.count() == few.selectExpr("sum(records)").first()[0]


def test_archives_are_plain_gzip(spark, pages):
    path = write_warc(frame(spark, pages).coalesce(1)).first().path.removeprefix("file:")
    with gzip.open(path) as file:
        text = file.read()
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") >= len(pages)


def test_archives_in_payloads_and_rubbish_between_members(tmp_path):
    inner = warc._member(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 1\r\n\r\nx\r\n\r\n")
    rng = random.Random(1)
    payload = rng.randbytes(70_000) + inner + rng.randbytes(70_000) + inner
    outer = [warc._member(warc._record(k, "u", payload, hashlib.sha1(payload).hexdigest(), None, "d")) for k in range(3)]
    assert all(inner not in x for x in outer)
    data = b"rubbish\x1f\x8b\x08" + outer[0] + b"\x1f\x8b\x08\x00" + outer[1] + outer[2] + outer[0][:5000]
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data)
    for step in (1000, 50_000, 1 << 20):
        found = []
        for start in range(0, len(data), step):
            with open(path, "rb") as file:
                found += warc._records(file, "a", start, min(start + step, len(data)), len(data))
        assert [f[0] for f in found] == [f"<urn:x-page:{k}>" for k in range(3)]
        assert all(f[6] == payload for f in found)


def test_very_long_urls(spark):
    rng = random.Random(3)
    mixed = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789%", k=200_000))
    urls = ["http://h/" + "a" * 70_000, "http://h/" + "é" * 12_000, "http://h/" + mixed, "http://h/" + "a" * 65_000, "short"]
    pages = [(i, url, f"page {i} " * 300) for i, url in enumerate(urls)]
    pages += [(10 + i, url, "the same " * 300) for i, url in enumerate(urls)]
    archives = write_warc(frame(spark, pages))
    for range_bytes in (5_000, 4 << 20):
        records = read_warc(spark, archives, range_bytes)
        assert result(records) == brute(pages)
        got = {(r.p, r.target_uri) for r in records.select(page_number("record_id").alias("p"), "target_uri").collect()}
        assert got == {(p, url) for p, url, _ in pages}


def test_archives_in_payloads_whose_header_is_very_long(tmp_path):
    rng = random.Random(4)
    url = "u" * 90_000 + "".join(rng.choices("abcdefghijklmnop", k=100_000))
    inner = warc._member(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: " + url.encode() + b"\r\nContent-Length: 1\r\n\r\nx\r\n\r\n")
    payload = rng.randbytes(70_000) + inner + rng.randbytes(70_000)
    data = warc._member(warc._record(1, "u", payload, hashlib.sha1(payload).hexdigest(), None, "d"))
    assert inner not in data
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data)
    found = []
    for start in range(0, len(data), 1000):
        with open(path, "rb") as file:
            found += warc._records(file, "a", start, min(start + 1000, len(data)), len(data))
    assert [(f[0], f[6]) for f in found] == [("<urn:x-page:1>", payload)]


def test_no_pages(spark):
    archives = write_warc(frame(spark, []))
    assert archives.count() == 0
    assert read_warc(spark, archives).count() == 0


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    got = sorted((tuple(r) for r in QUERIES["op8_warc"](spark, folder).collect()), key=str)
    assert got == sorted(con.sql(ORACLES["op8_warc"]).fetchall(), key=str)
