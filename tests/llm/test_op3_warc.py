import base64
import gzip
import hashlib
import random

import pytest

from sluicebox.llm import queries, warc
from sluicebox.llm.work import new_folder

SF_DIR = "/root/testdata/sf0.01"


def expected_rows(pages, least=0):
    largest = {}
    for page, html in pages:
        largest[html or ""] = max(largest.get(html or "", -1), page)
    rows = {}
    for page, html in pages:
        payload = (html or "").encode()
        origin = largest[html or ""]
        revisit = page != origin and len(payload) >= least
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        rows[page] = (len(payload), digest, "revisit" if revisit else "response", origin if revisit else None, None)
    return rows


def found_rows(df):
    rows = df.collect()
    found = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.error) for r in rows}
    assert len(found) == len(rows)
    return found


def test_query_equals_brute_force(spark):
    pages = [(row.page_id, row.html) for row in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()]
    assert found_rows(queries.op3_warc_segments(spark, SF_DIR)) == expected_rows(pages)


@pytest.mark.parametrize(("segment", "chunk", "least"), [(100, 7, 0), (16_384, 4096, 5), (1000, 100_000, 0)])
def test_round_trip(spark, segment, chunk, least):
    random.seed(segment)
    bodies = ["", None, "WARC/1.1\r\n\r\n0\r\n\r\n", "é" * 700, "a\r\nb", "x" * 30_000] + ["".join(random.choices("ab\r\n0é ", k=k)) for k in range(40)]
    pages = [(i, bodies[i * 5 % len(bodies)]) for i in range(120)]
    df = spark.createDataFrame([(i, f"http://a/{i} b\r\n", html, 1) for i, html in pages], "page_id long, url string, html string, error int")
    path = new_folder(spark, "archives")
    warc.write_archives(df.repartition(3), path, least, segment, chunk)
    assert found_rows(warc.page_records(spark, path)) == expected_rows(pages, least)
    read = {row.record_id.split(":")[2]: row.payload for row in warc.read_archives(spark, path, with_payload=True).collect() if row.payload is not None}
    assert read and all(bytes(payload).decode() == (dict(pages)[int(page)] or "") for page, payload in read.items())


def what(spark, path):
    rows = warc.page_records(spark, path).collect()
    assert all(row.error is None for row in rows)
    return sorted(((row.page_id, row.record_type, row.refers_to, row.payload_bytes) for row in rows), key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_a_record_for_every_row(spark, monkeypatch, least):
    """Rows repeated whole, with another url, without an id, and long ones in segments."""
    monkeypatch.setattr(warc, "REPEATS", 3)
    long = "long " * 50
    rows = [(5, "u", long)] * 8 + [(5, "v", long), (5, None, long), (5, "", long), (4, "u", long)] + [(None, "a", long), (None, "b", long), (None, "b", long)]
    rows += [(1, "u", "x"), (1, "u", "x"), (2, "u", "x"), (3, "w", "other")] + [(None, None, None)] * 4
    path = new_folder(spark, "archives")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), path, least, 100, 30)
    small = [(2, "response", None, 1), (1, "revisit", 2, 1), (1, "revisit", 2, 1)] if least == 0 else [(2, "response", None, 1)] + [(1, "response", None, 1)] * 2
    expected = [(5, "response", None, 250)] + [(5, "revisit", 5, 250)] * 10 + [(4, "revisit", 5, 250)] + [(None, "response", None, 250)] * 3
    expected += [*small, (3, "response", None, 5)] + [(None, "response", None, 0)] * 4
    assert what(spark, path) == sorted(expected, key=str)
    ids = [row.record_id for row in warc.read_archives(spark, path).collect()]
    assert len(ids) == len(set(ids)) == len(rows)


def test_edges(spark):
    rows = [(None, None, "x"), (1, "u", "x"), (2, "u", "x"), (2, "u", "x"), (7, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = new_folder(spark, "archives")
    warc.write_archives(df, path)
    assert what(spark, path) == [(1, "revisit", 2, 1), (2, "response", None, 1), (2, "revisit", 2, 1), (7, "response", None, 0), (None, "response", None, 1)]
    path = new_folder(spark, "archives")
    warc.write_archives(df.limit(0), path)
    assert warc.page_records(spark, path).collect() == []


def test_what_is_wrong_with_a_record_is_told(spark, tmp_path):
    records = list(warc._records_of(5, "u", b"0123456789" * 20, None, 100, 50))
    lost = records[:1] + records[2:]
    other = [record.replace(b"urn:page:5", b"urn:page:6") for record in list(warc._records_of(5, "u", b"0123456789" * 20, None, 100, 50))]
    other = [record.replace(b"789", b"798", 1) for record in other]
    short = [record.replace(b"urn:page:5", b"urn:page:8") for record in records[:-1]]
    lonely = list(warc._records_of(9, "u", b"gone", 10, 100, 50))
    content = b"".join(record + b"\r\n" for record in [*lost, *other, *short, *lonely])
    # Two members of one file.
    (tmp_path / "part-0.warc.gz").write_bytes(gzip.compress(content[:300]) + gzip.compress(content[300:]))
    found = {row.page_id: row.error for row in warc.page_records(spark, str(tmp_path)).collect()}
    assert found[5] == "a segment is missing" and "digest" in found[6]
    assert found[8] == "the segments have another length than stated" and "missing or differs" in found[9]
    with pytest.raises(ValueError):
        list(warc.parse(content[:-50]))


def test_foreign_framing():
    assert warc.unchunked(b"4;ext=1\r\nWiki\r\n5\r\npedia\r\n0\r\nTrailer: x\r\n\r\n") == b"Wikipedia"
    assert warc.payload_of(b"HTTP/1.1 200 OK\r\nTRANSFER-ENCODING: Chunked\r\n\r\n1\r\na\r\n0\r\n\r\n") == b"a"
    assert warc.payload_of(b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n1\r\na\r\n") == b"1\r\na\r\n"
