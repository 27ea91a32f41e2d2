import gzip
import hashlib
import io
import re

import pytest

from sheafline.llm.warc import captures, read_archives, records, write_archives
from sheafline.session import scratch_path

SCHEMA = "page_id long, url string, html string, record_type string, digest int"


def roundtrip(spark, rows, **options):
    path = scratch_path(spark, "warc")
    write_archives(spark.createDataFrame(rows, SCHEMA).repartition(3), path)
    return path, captures(read_archives(spark, path, **options)).collect()


def test_round_trip(spark):
    big, crlf = "é" * 600, "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 3
    rows = [(1, "http://a/", big, "x", 1), (2, "http://b/", big, "x", 1), (3, "http://c/", crlf, None, None),
            (4, "u", None, None, None), (5, None, "", None, None), (6, "x\r\nEvil: 1", "short", None, None),
            (7, "y", "short", None, None), (None, "z", big, None, None), (8, "w", "v" * 3_000_000, "", 0)]
    _, got = roundtrip(spark, rows)
    payloads = {r[0]: (r[2] or "").encode() for r in rows}
    assert {r.metadata.page_id for r in got} == set(payloads) and len(got) == len(rows)
    for r in got:
        payload = payloads[r.metadata.page_id]
        if r.record_type == "response":
            assert (bytes(r.payload), r.payload_bytes) == (payload, len(payload))
            assert r.payload_sha1 == r.digest == hashlib.sha1(payload).hexdigest()
        else:
            assert r.metadata.page_id in (None, 1) and r.original.page_id == 2
            assert r.original.payload_bytes == 1200 and r.digest == r.original.payload_sha1
        assert r.request.record_id and r.request.record_id != r.record_id
    assert sum(r.record_type == "revisit" for r in got) == 2


def test_sizes_about_the_limit_and_repeated_rows(spark):
    rows = [(1, "a", "x" * 999, "", 0), (2, "b", "x" * 999, "", 0), (3, "c", "y" * 1000, "", 0),
            (4, "d", "y" * 1000, "", 0), (4, "d", "y" * 1000, "", 0)]
    _, got = roundtrip(spark, rows, with_payload=False)
    assert sorted((r.metadata.page_id, r.record_type) for r in got) == [
        (1, "response"), (2, "response"), (3, "revisit"), (4, "response"), (4, "response")]
    assert all(r.payload is None for r in got)
    assert len({r.record_id for r in got}) == 5


def test_every_row_is_a_capture_as_sql_has_it(spark, tmp_path):
    import duckdb
    from sheafline.llm.queries import QUERIES, SQL

    big, other = "z" * 1200, "w" * 1500
    rows = [(1, "a", big), (1, "a", big), (1, "b", big), (2, "c", big), (2, "c", big), (2, "d", big),
            (None, "e", big), (None, "e", big), (3, "f", "s"), (3, "f", "s"), (4, None, None), (4, None, None),
            (None, "g", other), (None, "h", other)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    expected = con.execute(f"SELECT {', '.join(names)} FROM ({SQL['op6_warc']})").fetchall()
    got = QUERIES["op6_warc"](spark, str(tmp_path)).select(names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected)) and len(got) == len(rows)


def test_files_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr("sheafline.llm.warc.FILE_BYTES", 40_000)
    rows = [(i, "u", f"{i} " * 3000, "", 0) for i in range(12)]
    path = scratch_path(spark, "warc")
    write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)
    assert spark.read.format("binaryFile").load(path).count() >= 3
    assert captures(read_archives(spark, path)).count() == 12


def test_no_pages(spark):
    assert roundtrip(spark, [])[1] == []


def test_archives_are_plain_warc(spark):
    path, _ = roundtrip(spark, [(9, "http://a/", "<p>", "", 0)])
    names = [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    text = b"".join(gzip.open(re.sub("^file:", "", n)).read() for n in names)
    kinds = [h["warc-type"] for h, _ in records(io.BytesIO(text))]
    assert sorted(kinds) == ["metadata", "request", "response"]
    assert text.endswith(b"\r\n\r\n")
    with pytest.raises(ValueError):
        list(records(io.BytesIO(b"junk\r\n")))
    with pytest.raises(ValueError):
        list(records(io.BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")))
