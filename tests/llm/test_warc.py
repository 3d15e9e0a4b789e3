import base64
import hashlib

import pytest

from fleetstar.llm import warc


def expected(rows, min_bytes=0):
    first, out = {}, []
    for page_id, _, html in rows:
        p = (html or "").encode()
        if page_id is not None and len(p) >= min_bytes:
            first[p] = min(first.get(p, page_id), page_id)
    for page_id, _, html in rows:
        p = (html or "").encode()
        to = first.get(p) if page_id is not None and len(p) >= min_bytes else None
        again = to is not None and to != page_id
        out.append((page_id, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=repr)


PAGES = ([(i, f"http://a.example/{i}", f"<p>{i % 7}\r\n\r\nWARC/1.0\r\n</p>") for i in range(60)]
         + [(100, None, None), (101, "", ""), (102, "http://b.example/a b  c\td", "ü日本\n"), (-5, "http://n.example", "<p>3\r\n\r\nWARC/1.0\r\n</p>"),
            (None, "http://c.example", "x"), (None, "http://c.example", "x"), (103, "http://d.example", "x"),
            (1, "http://a.example/1", "<p>1\r\n\r\nWARC/1.0\r\n</p>"), (104, "http://long.example", "0123456789" * 200_000),
            (105, "http://e.example", "HTTP/1.1 200 OK\r\n\r\nnot a header\n")])


@pytest.mark.parametrize("min_bytes", [0, 20])
def test_round_trip(spark, monkeypatch, min_bytes):
    monkeypatch.setattr(warc, "FILE_RECORDS", 8)
    monkeypatch.setattr(warc, "LARGE_BYTES", 16)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'x' AS record", "1 AS n").repartition(3)
    got = warc.read_back(spark, warc.convert(spark, warc.write_arc(pages), min_bytes))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(PAGES, min_bytes)


def test_large_pages_lie_in_files_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(warc, "LARGE_BYTES", 1000)
    rows = [(i, "http://a", "x" * (3000 if i % 5 == 0 else 900)) for i in range(50)]
    path = warc.convert(spark, warc.write_arc(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)))
    sizes = [len([1 for f, _ in warc.read_warc(warc.gunzip(bytes(r["content"]))) if f["WARC-Type"] != "warcinfo"])
             for r in warc._files(spark, f"{path}/large").collect()]
    assert sum(sizes) == 10 and max(sizes) == 1
    assert warc._files(spark, f"{path}/small").count() <= 2
    assert warc.read_back(spark, path).count() == 50


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_back(spark, warc.convert(spark, warc.write_arc(pages))).count() == 0


def block(version, *records):
    return warc.version_block(version) + b"".join(h + b"\n" + c + b"\n" for h, c in records)


def test_both_versions_and_declared_lengths():
    tricky = b"filedesc://x 0 0 a 3\n\n\nWARC/1.0\r\n\r\n"
    data = (block(1, (f"http://a/b c 1.2.3.4 20200102030405 text/html {len(tricky)}".encode(), tricky))
            + block(2, (b"http://d/ 1.2.3.4 20200102030406 text/plain 200 chk - 17 f.arc 2", b"ok")))
    records = list(warc.read_arc(data))
    assert [(r.version, r.url, r.date, r.mime, r.content) for r in records] == [
        (1, "http://a/b c", "20200102030405", "text/html", tricky), (2, "http://d/", "20200102030406", "text/plain", b"ok")]


@pytest.mark.parametrize("data", [b"http://a 1.2.3.4 20200102030405 text/html 2\nok\n",
                                  block(1, (b"http://a 1.2.3.4 20200102030405 text/html 9", b"ok")),
                                  block(1, (b"http://a 1.2.3.4 20200102030405 text/html two", b"ok"))])
def test_damaged_records_raise(data):
    with pytest.raises(ValueError):
        list(warc.read_arc(data))


def test_synthesised_fields():
    content = b"HTTP/1.1 200 OK\r\nX-Page-Id: -7\r\nContent-Length: 2\r\n\r\nok"
    record = warc.ArcRecord(1, "http://a", "1.2.3.4", "20200102030405", "text/html", content)
    [(fields, body)] = warc.read_warc(warc.to_warc(record) + b"\r\n\r\n")
    assert body == content and fields["WARC-Type"] == "response" and fields["WARC-Date"] == "2020-01-02T03:04:05Z"
    assert fields["WARC-Payload-Digest"] == "sha1:" + warc.digest(b"ok") and warc.page_of(fields["WARC-Record-ID"].strip("<>")) == -7
    [(fields, body)] = warc.read_warc(warc.to_warc(record, 3) + b"\r\n\r\n")
    assert fields["WARC-Type"] == "revisit" and body == content[:-2] and warc.page_of(fields["WARC-Refers-To"].strip("<>")) == 3
    with pytest.raises(ValueError):
        list(warc.read_warc(warc.to_warc(record).replace(b"ok", b"no") + b"\r\n\r\n"))
