"""WARC: exact round trip through monolithic and normalised archives."""

import base64
import gzip
import hashlib
import io
import random
import zlib

import pytest
from tierwise.llm import warc
from tierwise.session import scratch_path


def test_records_cut_anywhere_and_members():
    rng = random.Random(0)
    bodies = [b"", b"\r\n\r\n", b"WARC/1.0\r\n\r\ncontent-length: 5", bytes(rng.randrange(256) for _ in range(70000))]
    recs = [warc.record(i, "http://x/\r\n?a: b", b, warc._digest(b), None, False) for i, b in enumerate(bodies)]
    data = b"".join(recs)
    for step in (1, 7, 1000, 10**6):
        chunks = (data[i:i + step] for i in range(0, len(data), step))
        assert list(warc.records_of(chunks)) == recs
    assert [warc.parse(r)[1] for r in recs] == bodies
    members = b"".join(gzip.compress(r) for r in recs)
    for zipped in (gzip.compress(data), members):
        assert b"".join(warc.inflated(io.BytesIO(zipped))) == data
    with pytest.raises(ValueError):
        list(warc.records_of([data[:-1]]))


def rows():
    big = "<p>" + "z" * 300000 + "</p>"
    return [(1, "http://a", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (9, "http://c", "<p>é</p>"), (3, None, None), (4, "u", ""),
            (5, "u", big), (6, "u", "\r\n\r\nWARC/1.0"), (7, "x", big + "!"), (7, "x", big + "!"), (8, "line\nbreak", "y"),
            (None, "u", big), (None, "u", "alone"), (None, "u", "two"), (None, "u", "two")]


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(spark, min_bytes):
    pages = spark.createDataFrame(rows(), "page_id long, url string, html string").selectExpr(
        "*", "1 AS digest", "2 AS last", "3 AS payload").repartition(3)
    got = warc.round_trip(pages, min_bytes, payloads=True).collect()
    want = []
    for i, _, html in rows():
        b = (html or "").encode()
        same = [j for j, _, h in rows() if (h or "").encode() == b and j is not None]
        to = max(same) if len(b) >= min_bytes and same and max(same) != i else None
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if to is not None else "response",
                     to, b"" if to is not None else b))
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_null_ids_agree_with_sql(spark):
    import duckdb
    from tierwise.llm import sql

    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows())
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({sql.WARC})").fetchall()
    pages = spark.createDataFrame(rows(), "page_id long, url string, html string")
    assert sorted(map(tuple, warc.round_trip(pages).select(cols).collect()), key=str) == sorted(want, key=str)


def test_an_archive_is_a_task(spark):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 50) for i in range(60)], "page_id long, url string, html string").coalesce(1)
    mono = warc.write_archives(pages, scratch_path(spark, "warc-tasks"), roll_bytes=4000)
    assert mono.count() > 3 and warc._dealt(mono).rdd.getNumPartitions() == mono.count()


def test_archives_roll_and_index_points_at_members(spark, tmp_dir):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 50) for i in range(40)], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    mono = warc.write_archives(pages.coalesce(1), folder, roll_bytes=4000)
    assert mono.count() > 3
    for path in [r.path for r in mono.collect()]:
        raw = open(path, "rb").read()
        d = zlib.decompressobj(31)
        d.decompress(raw)
        assert d.eof and not d.unused_data                   # one gzip stream for the whole archive
    for r in warc.normalise(mono, folder).collect():
        data, at = open(r.path, "rb").read(), 0
        for line in open(r["index"]):
            offset, length, kind = line.split()
            assert int(offset) == at and kind == "response"
            assert gzip.decompress(data[at:at + int(length)]).startswith(b"WARC/1.0")
            at += int(length)
        assert at == len(data)


def test_empty_table(spark):
    pages = spark.createDataFrame(rows(), "page_id long, url string, html string").limit(0)
    assert warc.round_trip(pages).count() == 0
