"""Generators over parsed pages: links, PDF links, images, link edges.

Each page is parsed once (one Python evaluation over Arrow batches); the
parsed array is then filtered and exploded with native expressions, so the
HTML column never reaches a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webkb.functions.html import parse_html_udf
from webkb.functions.paths import checksum
from webkb.functions.urls import canonical_url, is_followable, is_image_src, is_pdf_href


def parse_pages(pages: DataFrame, keep: tuple[str, ...] = (), with_checksum: bool = False) -> DataFrame:
    """``(page_id, url, *keep, [page_checksum,] items, parse_error)``;
    ``items`` = parsed links/images. The page checksum is taken in the same
    scan, before the HTML is dropped."""
    extra = [checksum("html").alias("page_checksum")] if with_checksum else []
    p = pages.select("page_id", "url", *keep, *extra, parse_html_udf("url", "html").alias("_p"))
    return p.select("page_id", "url", *keep, *(["page_checksum"] if with_checksum else []),
                    F.col("_p.items").alias("items"), F.col("_p.error").alias("parse_error"))


def pdf_items(items: Column) -> Column:
    return F.filter(items, lambda i: (i["kind"] == "a") & is_pdf_href(i["value"]))


def image_items(items: Column) -> Column:
    return F.filter(items, lambda i: (i["kind"] == "img") & is_image_src(i["value"]))


def link_items(items: Column) -> Column:
    return F.filter(items, lambda i: i["kind"].isin("a", "area"))


def extract_links(parsed: DataFrame) -> DataFrame:
    """All ``a``/``area`` links with an href, document order."""
    return parsed.select(
        "page_id", F.col("url").alias("page_url"), F.explode(link_items(F.col("items"))).alias("i")
    ).select(
        "page_id",
        "page_url",
        F.col("i.pos").alias("pos"),
        F.col("i.kind").alias("kind"),
        F.col("i.value").alias("href"),
        F.col("i.link_url").alias("link_url"),
        F.col("i.nofollow").alias("nofollow"),
    )


def extract_pdfs(parsed: DataFrame) -> DataFrame:
    """PDF links of each page, document order, duplicates kept."""
    return parsed.select(
        "page_id", F.col("url").alias("parent_url"), F.explode(pdf_items(F.col("items"))).alias("i")
    ).select("page_id", "parent_url", F.col("i.pos").alias("pos"), F.col("i.abs_url").alias("url"))


def extract_images(parsed: DataFrame) -> DataFrame:
    """Images with a non-empty src, document order, duplicates kept."""
    return parsed.select(
        "page_id", F.col("url").alias("parent_url"), F.explode(image_items(F.col("items"))).alias("i")
    ).select("page_id", "parent_url", F.col("i.pos").alias("pos"), F.col("i.abs_url").alias("url"))


def link_edges(parsed: DataFrame, edge_filter: Column | None = None) -> DataFrame:
    """Distinct followable edges ``(src, dst, nofollow)`` between canonical
    URLs. ``nofollow`` is recorded (true only if every link says so), not
    used to drop the edge. ``edge_filter`` is an extra predicate over
    ``src``/``dst``/``href`` (the request hook). A page's ``url_key`` is taken
    if ``parsed`` has it, so that its URL is not normalized again per link."""
    key = F.col("url_key") if "url_key" in parsed.columns else canonical_url("url")
    links = extract_links(parsed.withColumn("url", key)).filter(F.col("link_url").isNotNull() & is_followable("link_url"))
    e = links.select(
        F.col("page_url").alias("src"),
        canonical_url("link_url").alias("dst"),
        "href",
        "nofollow",
    )
    if edge_filter is not None:
        e = e.filter(edge_filter)
    # Partial (map-side) aggregation: duplicate links collapse before the shuffle.
    return e.groupBy("src", "dst").agg(F.min(F.col("nofollow").cast("int")).cast("boolean").alias("nofollow"))
