import base64
import gzip
import hashlib
import os
import random

import pytest

from webkb.llm import arc

SCHEMA = "page_id long, url string, html string, digest string, type string"


def brute(rows):
    groups = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and p is not None:
            groups[b] = max(groups.get(b, p), p)
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        top = groups.get(b)
        again = top is not None and p != top
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


def found(df):
    return sorted([tuple(r) for r in df.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()], key=str)


def cases():
    rng = random.Random(1)
    big = "".join(rng.choice("abé日 \r\n<>") for _ in range(900)) + "\r\n\r\nWARC/1.0\r\n\r\n" * 20
    rows = [(None, None, None), (1, None, ""), (2, "http://a b\n/", big), (3, "http://c/", big), (9, "http://c/", big),
            (9, "http://c/", big), (None, "http://n/", big), (4, "x", "y" * 999), (5, "x", "y" * 999), (6, "x", "y" * 1000),
            (7, "x", "y" * 1000), (None, "z", "q" * 2000), (None, "z", "q" * 2000), (-5, "m", "\n\r\n\r" * 400),
            (8, "long", "long é" * 300_000)]
    return rows + [(100 + i, f"http://p/{i}", "copy " * 400) for i in range(50)]


def test_pages_round_trip(spark):
    rows = cases()
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)
    assert found(arc.archive_pages(pages)) == brute(rows)


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert found(arc.archive_pages(pages)) == brute([(r.page_id, r.url, r.html) for r in pages.collect()])


def test_empty(spark):
    assert arc.archive_pages(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions_and_files(spark, tmp_path, version):
    bodies = [b"", b"\n\n", b"HTTP/1.0 200 OK\nServer: x\n\n\xff\xfe body", b"plain \x00 bytes" * 99]
    data = arc.arc_head(version, "a.arc", "19970101000000")
    for i, b in enumerate(bodies):
        data += arc.arc_record(version, f"http://h/{i}", "199701", "text/html", b, "a.arc", len(data)) + b"\n" * (i % 2)
    assert [r["content"] for r in arc.parse_arc(data)] == bodies
    os.makedirs(tmp_path / "in")
    (tmp_path / "in/plain.arc").write_bytes(data)
    (tmp_path / "in/members.arc.gz").write_bytes(gzip.compress(data[:200]) + gzip.compress(data[200:]))
    out = str(tmp_path / "out")
    arc.convert(arc.arc_files(spark, f"file://{tmp_path}/in"), f"file://{out}")
    rows = {}
    for name in os.listdir(out):
        if name.endswith(".gz"):
            for headers, block in arc.parse_warc(iter([gzip.open(os.path.join(out, name)).read()])):
                rows.setdefault(headers["warc-target-uri"], []).append((headers, block))
    assert len(rows) == 4 and all(len(v) == 2 for v in rows.values())
    for i, body in enumerate(bodies):
        for headers, block in rows[f"http://h/{i}"]:
            payload = b"\xff\xfe body" if i == 2 else body
            assert block == body
            assert headers["warc-type"] == ("response" if i == 2 else "resource")
            assert headers["warc-date"] == "1997-01-01T00:00:00Z"
            assert headers["warc-record-id"].startswith("<urn:uuid:")
            assert headers["warc-payload-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_bad_archives():
    good = arc.arc_head(1, "a", "2000") + arc.arc_record(1, "u", "2000", "t", b"abc", "a", 0)
    for bad in (b"junk\n", good[:-3], good + b"only three fields\n", good.replace(b"1 0 crawl", b"7 0 crawl")):
        with pytest.raises(ValueError):
            list(arc.parse_arc(bad))


def test_warc_pieces():
    records = [(b"a" * n, arc.warc_record("u", "2000", "text/plain", b"a" * n, "i", "00" * 20, None)) for n in (0, 5, 3000)]
    data = b"".join(r + b"\r\n\r\n" for _, r in records)
    for step in (1, 7, 4096):
        got = [b for _, b in arc.parse_warc(data[i:i + step] for i in range(0, len(data), step))]
        assert got == [b for b, _ in records]


def test_files_are_bounded_by_bytes(spark, tmp_path):
    """Records of 1 MB and more: no file outgrows the bound but by one record, none is lost."""
    sizes = [1 << 20, 3 << 20, 10, 0, 1 << 20, 5 << 20, 2000, 1 << 20]
    data = arc.arc_head(1, "a.arc", "1997")
    for i, n in enumerate(sizes):
        data += arc.arc_record(1, f"http://h/{i}", "1997", "text/plain", bytes([97 + i]) * n, "a.arc", len(data))
    archives = spark.createDataFrame([("a.arc", gzip.compress(data))], "archive string, content binary")
    out = str(tmp_path / "out")
    arc.convert(archives, f"file://{out}", file_bytes=2 << 20)
    found = {}
    for name in sorted(os.listdir(out)):
        if name.endswith(".gz"):
            whole = gzip.open(os.path.join(out, name)).read()
            blocks = {h["warc-target-uri"]: b for h, b in arc.parse_warc([whole])}
            assert len(whole) < (2 << 20) + 4096 or len(blocks) == 1
            assert not found.keys() & blocks.keys()
            found |= blocks
    assert found == {f"http://h/{i}": bytes([97 + i]) * n for i, n in enumerate(sizes)}


@pytest.mark.parametrize("step", [1, 13, 5000])
def test_arc_in_pieces(step):
    bodies = [b"", b"\n\r\n", b"x" * 4000, b"last"]
    data = arc.arc_head(2, "a", "2000")
    for i, b in enumerate(bodies):
        data += arc.arc_record(2, f"u{i}", "2000", "t", b, "a", len(data))
    assert [r["content"] for r in arc.parse_arc(data[i:i + step] for i in range(0, len(data), step))] == bodies
    with pytest.raises(ValueError):
        list(arc.parse_arc([data[:-3]]))
