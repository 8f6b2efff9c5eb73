from __future__ import annotations

import glob
import gzip
import hashlib

import pytest

from obslake.llm import warc

PAGES = "page_id long, url string, html string, size string, digest string"


def brute(pages):
    """Expected rows: the largest page_id among equal payloads of 1000 bytes or more is the response."""
    payloads = [(html or "").encode() for _, _, html, *_ in pages]
    out = []
    for (page, *_), payload in zip(pages, payloads, strict=True):
        ids = [p for (p, *_), other in zip(pages, payloads, strict=True) if other == payload and p is not None]
        revisit = len(payload) >= 1000 and ids and page != max(ids)
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", max(ids) if revisit else None))
    return sorted(out, key=repr)


def round_trip(spark, pages, path):
    warc.write_archives(spark.createDataFrame(pages, PAGES), path)
    rows = warc.read_archives(spark, path)
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted(map(tuple, rows.select(*fields).collect()), key=repr)


def page(k, html, url="https://h/x"):
    return (k, url, html, "s", "d")


HARD = "WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\nWARC/1.1\r\n\r\n\x00é😀 " * 30


def test_round_trip(spark, scratch):
    big, small = "x" * 1000, "y" * 999
    pages = [page(k, big) for k in range(40)] + [page(100 + k, small) for k in range(3)]
    pages += [page(200, HARD), page(201, HARD), page(202, None), page(203, ""), page(204, "é" * 500), page(205, "é" * 500)]
    pages += [page(300, big, None), page(301, "z", "http://h/a b\r\nX: é"), page(None, big), page(None, "n" * 2000), page(302, "t" * 3000), page(302, "t" * 3000)]
    assert round_trip(spark, pages, f"{scratch}/a") == brute(pages)


def test_archives_are_cut_and_hold_each_payload_once(spark, scratch, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    pages = [page(k, f"<p>{k % 7}</p>" * 900) for k in range(50)]
    assert round_trip(spark, pages, f"{scratch}/b") == brute(pages)
    archives = [gzip.open(f).read() for f in glob.glob(f"{scratch}/b/part-*")]
    assert len(archives) > 5 and max(map(len, archives)) < 40_000
    assert sum(a.count(b"WARC-Type: response") for a in archives) == 7
    headers, block = next(warc.parse(next(a for a in archives if a)))
    assert headers["WARC-Record-ID"].startswith("<urn:page:") and headers["Content-Length"] == str(len(block))


def test_an_altered_payload_is_an_error(spark, scratch):
    warc.write_archives(spark.createDataFrame([page(1, "a" * 50)], PAGES), f"{scratch}/c")
    (file,) = [f for f in glob.glob(f"{scratch}/c/part-*") if gzip.open(f).read()]
    altered = gzip.open(file).read().replace(b"aaa", b"bbb")
    with gzip.open(f"{scratch}/c/part-altered.txt.gz", "wb") as out:
        out.write(altered)
    with pytest.raises(Exception, match="is not the one it was written with"):
        warc.read_archives(spark, f"{scratch}/c").collect()


def test_empty_table(spark, scratch):
    assert round_trip(spark, [], f"{scratch}/d") == []
