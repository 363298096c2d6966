"""Golden rows for the scalar expressions (values from the fixture notes)."""

import pytest
from pyspark.sql import functions as F

from webkb.functions import paths as PA
from webkb.functions import urls as U

BASE = "https://h.example.org/en/a/p.html?x=1#top"


def one(spark, col, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(col.alias("r")).first()["r"]


def test_element_id_sha(spark):
    got = one(spark, PA.element_id(F.col("v"), F.lit("J")), "https://h.example.org/en/a/p.html")
    assert got == "7b6d5a9b1ada0fb1a5eea06647348a95843b70d140a7d398272f7f48212d6ff8_J"


def test_job_id(spark):
    assert one(spark, PA.job_id(F.col("v").cast("timestamp")), "2024-01-02 03:04:05") == "20240102_030405"


def test_extension(spark):
    cases = {"abc_20240102_030405": ".jpeg", "a/b.PNG": ".png", "x.tar.gz": ".gz"}
    for v, want in cases.items():
        assert one(spark, PA.extension(F.col("v")), v) == want


def test_content_type(spark):
    cases = {"e.html": "text/html", "e.pdf": "application/pdf", "e.jpeg": "image/jpeg", "e.png": "image/png",
             "e.md": "text/markdown", "e": None, "j/raw/x.JPEG": "image/jpeg"}
    for v, want in cases.items():
        assert one(spark, PA.content_type(F.col("v")), v) == want
    assert one(spark, PA.content_type(F.col("v"), F.lit("image/gif")), "e.png") == "image/gif"


def test_stem_and_paths(spark):
    assert one(spark, PA.stem(F.col("v")), "/tmp/a.b.pdf") == "a"
    assert one(spark, PA.dirname(F.col("v")), "/tmp/a.b.pdf") == "/tmp"
    assert one(spark, PA.raw_path(F.lit("J"), F.col("v"), F.lit("Image")), "abc_J") == "J/raw/abc_J.jpeg"
    assert one(spark, PA.raw_path(F.lit("J"), F.col("v"), F.lit("PDF")), "abc_J") == "J/raw/abc_J.pdf"
    assert one(spark, PA.processed_path(F.lit("J"), F.col("v"), F.lit("Image")), "abc_J") == ""
    assert one(spark, PA.processed_path(F.lit("J"), F.col("v"), F.lit("URL")), "abc_J") == "J/processed/abc_J.md"


def test_pdf_predicate(spark):
    yes = ["direct.pdf", "path/file.pdf", "file.pdf?parameter=value", "file.pdf#section", "/r.pdf",
           "//cdn.example.net/z.pdf", "../up.pdf", "#a.pdf", " sp.pdf", "x.pdf ", "tab\t.pdf", "x.PDF?y=.pdf",
           "foo.pdfx/page", "http://o.example.com/a.pdf"]
    no = ["?q=a.pdf", "page?f=a.pdf", "A.PDF", "mailto:a@b", "data:image/png;base64,AA==", ""]
    for v in yes:
        assert one(spark, U.is_pdf_href(F.col("v")), v) is True, v
    for v in no:
        assert one(spark, U.is_pdf_href(F.col("v")), v) is False, v


def test_image_src(spark):
    assert one(spark, U.is_image_src(F.col("v")), " ") is True
    assert one(spark, U.is_image_src(F.col("v")), "") is False
    assert one(spark, U.is_image_src(F.col("v")), None) is False


def test_canonical_and_host(spark):
    assert one(spark, U.canonical_url(F.col("v")), "HTTP://H.Example.ORG?b=2&a=1#frag") == "http://h.example.org/?a=1&b=2"
    assert one(spark, U.canonical_url(F.col("v")), "mailto:a@b#x") == "mailto:a@b"
    assert one(spark, U.host(F.col("v")), "https://user@Sub.Example.org:8080/x") == "sub.example.org"
    assert one(spark, U.host(F.col("v")), "mailto:a@b") == ""


def test_followable(spark):
    assert one(spark, U.is_followable(F.col("v")), "https://h/x/page.html") is True
    assert one(spark, U.is_followable(F.col("v")), "https://h/x/doc.PDF") is False
    assert one(spark, U.is_followable(F.col("v")), "https://h/x/a.tar.gz") is False
    assert one(spark, U.is_followable(F.col("v")), "mailto:a@b") is False
    assert one(spark, U.is_followable(F.col("v")), "https://h/.hidden") is True


def test_percent_encode(spark):
    from urllib.parse import quote

    for v in ["a b/c~d*e+f.é中?&=", "plain", "x/y z", "Größe & ünï", "100% sure!"]:
        assert one(spark, U.percent_encode(F.col("v")), v) == quote(v)


def test_site_match(spark):
    c = U.site_matches(F.col("v"), ["example.org"])
    assert one(spark, c, "a.example.org") is True
    assert one(spark, c, "example.org") is True
    assert one(spark, c, "badexample.org") is False


@pytest.mark.parametrize("url,want", [
    ("http://h/a/./b/../c", "http://h/a/c"), ("http://h/../..", "http://h/"), ("http://h/a/..", "http://h/"),
    ("http://h/a/.", "http://h/a/"), ("http://h//a//../b", "http://h//a/b"), ("http://h/...", "http://h/..."),
    ("http://h:80/x", "http://h/x"), ("http://h:/x", "http://h/x"), ("https://h:0443", "https://h/"),
    ("https://h:80/", "https://h:80/"), ("http://H:8080/", "http://h:8080/"), ("ftp://h:21/f", "ftp://h/f"),
    ("http://h/%7euser/%41", "http://h/~user/A"), ("http://h/%c3%a9", "http://h/%C3%A9"), ("http://h/\u00e9", "http://h/%C3%A9"),
    ("http://h/a b|c", "http://h/a%20b%7Cc"), ("http://h/100%", "http://h/100%25"), ("http://h/%zz", "http://h/%25zz"),
    ("http://h/a%2Fb%2e%2e/", "http://h/a%2Fb../"), ("http://h/%2e%2E/x", "http://h/x"), ("http://h/\U0001f600", "http://h/%F0%9F%98%80"),
    ("http://h/?b=%61&a=%26#f", "http://h/?a=%26&b=a"), ("http://h?q=a b+c", "http://h/?q=a%20b+c"), ("mailto:a b@h", "mailto:a b@h"),
    ("http://h/plain?x=/./y", "http://h/plain?x=/./y"), (None, None), ("", ""),
])
def test_url_normal_form(spark, url, want):
    got = one(spark, U.canonical_url(F.col("v")), url)
    assert got == want
    assert url is None or one(spark, U.canonical_url(F.col("v")), got) == want  # a normal form stays as it is


def test_spellings_of_one_page_are_one_request(spark):
    from conftest import SF001
    from webkb.sources import fixtures as FX

    rows = FX.fx_spellings(spark, SF001).withColumn("k", U.canonical_url("raw")).withColumn("own", U.canonical_url("url"))
    assert rows.filter("spelling < 3 and k <> own").count() == 0 < rows.filter("spelling < 3 and raw <> url").count()
    per_page = rows.filter("spelling in (3, 4)").groupBy("page_id").agg(F.countDistinct("k").alias("n"))
    assert per_page.filter("n <> 1").count() == 0
