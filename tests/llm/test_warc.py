import base64
import glob
import hashlib

import zstandard
from cases import LONG

from rivulet.llm import warc
from rivulet.runtime import fresh_path

SCHEMA = "page_id long, url string, html string, _digest string"


def expected(rows, least=0):
    last, count = {}, {}
    for page, _, html, _ in rows:
        data = (html or "").encode()
        count[data] = count.get(data, 0) + 1
        if page is not None:
            last[data] = max(last.get(data, page), page)
    out = []
    for page, _, html, _ in rows:
        data = (html or "").encode()
        copy = count[data] > 1 and len(data) >= least and data in last and page != last[data]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, "revisit" if copy else "response", digest, len(data), None if copy else data, last[data] if copy else None))
    return sorted(out, key=repr)


def written(spark, rows, **more):
    folder = fresh_path(spark, "warc-test")
    archives = warc.write_archives(spark.createDataFrame(rows, SCHEMA), folder, **more)
    read = warc.read_archives(spark, folder) if rows else None
    got = [(r["page_id"], r["record_type"], r["payload_digest"], r["payload_bytes"],
            None if r["payload"] is None else bytes(r["payload"]), r["refers_to"]) for r in (read.collect() if read else [])]
    return folder, archives, sorted(got, key=repr)


ROWS = [
    (1, "http://a.example/", "<p>same</p>", "x"), (5, "http://b.example/?q=ü", "<p>same</p>", "x"),
    (3, None, "<p>same</p>", None), (4, "http://c.example/\r\nX: 1", None, "x"), (6, "http://d.example/", "", "x"),
    (7, "http://e.example/", "漢字 🙂\r\n\r\nbody", "x"), (None, "http://f.example/", "only this", "x"),
    (8, "http://g.example/", "".join(LONG % (i, i) for i in range(3000)), "x"), (-2, "http://h.example/", "below zero", "x"),
]


def test_round_trip(spark):
    folder, archives, got = written(spark, ROWS)
    assert got == expected(ROWS)
    assert archives.agg({"n_records": "sum"}).first()[0] == len(ROWS)
    assert written(spark, ROWS, min_bytes=12)[2] == expected(ROWS, 12)


def test_many_records_share_a_dictionary(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 60_000)
    rows = [(i, f"http://x.example/{i}", f"<html><body>page {i} of many, with a common frame</body></html>", "x") for i in range(600)]
    folder, archives, got = written(spark, rows)
    assert got == expected(rows)
    path = sorted(glob.glob(f"{folder}/*.warc.zst"))[0]
    with open(path, "rb") as file:
        data = file.read()
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
    size = int.from_bytes(data[4:8], "little")
    dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    first = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj().decompress(data[8 + size :])
    assert size > 0 and first.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    assert not glob.glob(f"{folder}/.*.draft")


def test_equal_rows_and_no_rows(spark):
    twice = [(2, "u", "same", "x"), (2, "u", "same", "x"), (1, "u", "same", "x")]
    assert written(spark, twice)[2] == expected(twice)
    nameless = [(None, "u", "same", "x"), (None, "v", "same", "x")]
    assert written(spark, nameless)[2] == expected(nameless)
    folder, archives, got = written(spark, [])
    assert archives.count() == 0 and got == []
