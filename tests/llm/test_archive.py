import base64
import hashlib

from stayline.llm import archive

SCHEMA = "page_id long, url string, html string, digest string, row long"


def written(spark, rows, tmp_path, **options):
    frame = spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA)
    return archive.write_archive(frame, str(tmp_path / "archive"), **options)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


ROWS = [
    (1, "http://a/1", "<p>one</p>"),
    (2, "http://a/2", "<p>öne 😀</p>"),
    (3, "http://a/3", "<p>one</p>"),
    (9, None, "<p>one</p>"),
    (4, "http://b/", None),
    (5, "http://b/5\r\nX-Evil: 1", ""),
    (6, "http://c/", "x" * 500_000),
    (None, "http://d/", "alone"),
]


def test_records_tell_type_digest_and_response(spark, tmp_path):
    got = {r.page_id: r for r in archive.read_records(spark, written(spark, ROWS, tmp_path)).collect()}
    html = {r[0]: r[2] for r in ROWS}
    assert len(got) == len(ROWS)
    for key, row in got.items():
        assert row.payload_digest == digest(html[key])
        assert row.payload_bytes == len((html[key] or "").encode())
    assert [(got[k].record_type, got[k].refers_to) for k in (1, 3, 9)] == [("revisit", 9), ("revisit", 9), ("response", None)]
    assert (got[4].record_type, got[4].refers_to) == ("revisit", 5)
    assert got[5].record_type == got[6].record_type == got[None].record_type == "response"


def test_payloads_are_stored_once_and_records_come_back_whole(spark, tmp_path):
    made = written(spark, ROWS, tmp_path)
    assert archive.read_payloads(spark, made).count() == len({r[2] or "" for r in ROWS})
    captures = {r.page_id: bytes(r.payload) for r in archive.restore_captures(spark, made).collect()}
    assert captures == {r[0]: (r[2] or "").encode() for r in ROWS}
    records = {r.page_id: bytes(r.record) for r in archive.restore_records(spark, made).collect()}
    head, http, body = records[2].split(b"\r\n\r\n", 2)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and http.startswith(b"HTTP/1.1 200 OK")
    payload = ROWS[1][2].encode()
    assert body == payload + b"\r\n\r\n"
    assert f"Content-Length: {len(http) + 4 + len(payload)}".encode() in head
    assert records[1].endswith(b"\r\n\r\n\r\n\r\n") and b"WARC-Refers-To: <urn:capture:" in records[1]
    assert b"\r\nX-Evil" not in records[5]


def test_small_payloads_are_all_responses(spark, tmp_path):
    got = archive.read_records(spark, written(spark, ROWS, tmp_path, revisit_from=5)).collect()
    assert {r.page_id for r in got if r.record_type == "revisit"} == {1, 3}


def test_repeated_rows_leave_one_response(spark, tmp_path):
    got = archive.read_records(spark, written(spark, [(7, "http://a/", "same")] * 5, tmp_path)).collect()
    assert sorted(r.record_type for r in got) == ["response"] + ["revisit"] * 4
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {7}


def test_empty_table(spark, tmp_path):
    assert archive.read_records(spark, written(spark, [], tmp_path)).count() == 0


def test_damaged_payload_is_noticed(spark, tmp_path):
    import pytest

    made = written(spark, [(1, "http://a/", "text")], tmp_path)
    bad = spark.read.parquet(made.payloads).selectExpr("digest", "cast('other' as binary) payload", "payload_bytes", "sha1")
    bad.write.parquet(str(tmp_path / "bad/payloads"))
    with pytest.raises(Exception, match="does not match its digest"):
        archive.read_payloads(spark, archive.Archive(str(tmp_path / "bad"))).collect()
