"""Element projection: a page yields one URL element, one PDF element per
PDF link and one Image element per image; plus metadata shaping, parent
resolution and rollups over stored metadata."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webkb.conf import KIND_RANK
from webkb.functions.paths import element_id
from webkb.operators.links import image_items, parse_pages, pdf_items
from webkb.schema import METADATA_COLUMNS

ELEMENT_COLUMNS = ["element_id", "url", "type", "parent_url", "parent_id", "depth", "pos", "page_id", "job_id"]


def _el(type_: str, url: Column, parent: Column, pos: Column, page_sum: Column | None = None) -> Column:
    fields = [F.lit(type_).alias("type"), url.alias("url"), parent.alias("parent_url"), pos.cast("int").alias("pos")]
    if page_sum is not None:
        fields.append(page_sum.alias("page_checksum"))
    return F.struct(*fields)


def kind_rank(type_col) -> Column:
    c = F.col(type_col) if isinstance(type_col, str) else type_col
    rank = F.lit(None).cast("int")
    for k, v in sorted(KIND_RANK.items(), key=lambda kv: -kv[1]):
        rank = F.when(c == k, F.lit(v)).otherwise(rank)
    return rank


def elements_from_parsed(parsed: DataFrame, job: str, parent_as_url: bool = False,
                         extra: list[Callable[[DataFrame], DataFrame]] | None = None) -> DataFrame:
    """Elements from ``(page_id, url, items[, depth])``.

    The page, its PDF links and its images are concatenated into one array
    per page and exploded once: the union needs no second pass over the
    parsed pages."""
    depth = F.col("depth") if "depth" in parsed.columns else F.lit(0)
    items = F.col("items")
    page_url = F.col("url")
    null_s = F.lit(None).cast("string")
    has_sum = "page_checksum" in parsed.columns
    psum = F.col("page_checksum") if has_sum else None
    nsum = null_s if has_sum else None
    arr = F.concat(
        F.array(_el("URL", page_url, null_s, F.lit(0), psum)),
        F.transform(pdf_items(items), lambda i: _el("PDF", i["abs_url"], page_url, i["pos"], nsum)),
        F.transform(image_items(items), lambda i: _el("Image", i["abs_url"], page_url, i["pos"], nsum)),
    )
    e = parsed.select("page_id", depth.cast("int").alias("depth"), F.explode(arr).alias("e")).select(
        "page_id", "depth", "e.*"
    )
    if extra:
        for fn in extra:
            more = fn(parsed).select("page_id", "depth", "type", "url", "parent_url", F.col("pos").cast("int"))
            if has_sum:
                more = more.withColumn("page_checksum", null_s)
            e = e.unionByName(more)
    # a reference that could not be joined has no URL, hence no key: see parse_failures
    e = e.filter(F.col("url").isNotNull())
    job_lit = F.lit(job)
    parent_id = F.col("parent_url") if parent_as_url else F.when(
        F.col("parent_url").isNotNull(), element_id("parent_url", job_lit)
    )
    return e.select(
        element_id("url", job_lit).alias("element_id"),
        "url",
        "type",
        "parent_url",
        parent_id.alias("parent_id"),
        "depth",
        "pos",
        "page_id",
        job_lit.alias("job_id"),
        *(["page_checksum"] if has_sum else []),
    )


def parse_failures(parsed: DataFrame, job: str) -> DataFrame:
    """Quarantine rows of the parse step: pages that could not be read to
    their end or have no URL, and PDF and image references without a URL."""
    job_lit = F.lit(job)
    null_s = F.lit(None).cast("string")
    page_id = element_id("url", job_lit)

    def row(eid: Column, url: Column, type_: Column, parent: Column, reason: Column) -> Column:
        return F.struct(eid.alias("element_id"), url.alias("url"), type_.alias("type"), parent.alias("parent_id"),
                        reason.alias("reason"))

    def lost(items: Column, type_: str) -> Column:
        return F.transform(F.filter(items, lambda i: i["abs_url"].isNull()), lambda i: row(
            null_s, i["value"], F.lit(type_), page_id, F.lit("reference cannot be resolved")))

    reason = F.when(F.col("url").isNull(), F.lit("page url is null")).otherwise(F.col("parse_error"))
    page = F.filter(F.array(row(page_id, F.col("url"), F.lit("URL"), null_s, reason)), lambda r: r["reason"].isNotNull())
    items = F.col("items")
    return parsed.select(F.explode(F.concat(page, lost(pdf_items(items), "PDF"), lost(image_items(items), "Image")))
                         .alias("r")).select(
        "r.element_id", "r.url", "r.type", "r.parent_id", F.lit("parse").alias("stage"), "r.reason",
        job_lit.alias("job_id"))


def elements(pages: DataFrame, job: str, parent_as_url: bool = False,
             extra: list[Callable[[DataFrame], DataFrame]] | None = None,
             with_checksum: bool = False) -> DataFrame:
    """Elements of every page in ``pages`` ``(page_id, url, html[, depth])``.

    ``with_checksum`` adds ``page_checksum`` (set on URL rows), taken in
    the parse pass so the content step needs no join back to the pages."""
    keep = ("depth",) if "depth" in pages.columns else ()
    return elements_from_parsed(parse_pages(pages, keep, with_checksum), job, parent_as_url, extra)


def order_struct() -> Column:
    return F.struct(
        F.col("depth").alias("o_depth"),
        F.coalesce(F.col("parent_url"), F.lit("")).alias("o_parent"),
        kind_rank("type").alias("o_kind"),
        F.col("pos").alias("o_pos"),
        F.col("page_id").alias("o_page"),
    )


def meta_columns(df: DataFrame) -> list[Column]:
    """The seven stored columns; unset strings become ''; ``url`` -> ``URL``."""
    unset = lambda c: F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("")
    found = {"element_id": F.col("element_id"), "URL": F.col("url"), "type": F.col("type"),
             "raw_content_path": unset("raw_content_path"), "processed_content_path": unset("processed_content_path"),
             "checksum": unset("checksum"), "parent_id": F.col("parent_id")}
    return [found[c].alias(c) for c in METADATA_COLUMNS]


def to_metadata(df: DataFrame) -> DataFrame:
    return df.select(*meta_columns(df))


def resolve_parents(meta: DataFrame) -> DataFrame:
    """Children with their parent's stored row, ``parent_found`` flags a
    child whose parent element is present (left join on the id)."""
    parents = meta.filter(F.col("type") == "URL").select(
        F.col("element_id").alias("parent_id"), F.col("URL").alias("parent_URL")
    )
    children = meta.filter(F.col("parent_id").isNotNull())
    return children.join(parents, "parent_id", "left").select(
        "element_id", "type", "parent_id", "parent_URL", F.col("parent_URL").isNotNull().alias("parent_found")
    )


def job_summary(meta: DataFrame) -> DataFrame:
    """Rows per job and type, and how many were not fetched (checksum '')."""
    return (
        meta.withColumn("job_id", F.substring_index("element_id", "_", -2))
        .groupBy("job_id", "type")
        .agg(
            F.count(F.lit(1)).alias("n_elements"),
            F.count_if(F.col("checksum") == "").alias("n_unfetched"),
        )
    )


def children_rollup(meta: DataFrame) -> DataFrame:
    """Children per parent page, by type (conditional counts, no pivot
    pass)."""
    return (
        meta.filter(F.col("parent_id").isNotNull())
        .groupBy("parent_id")
        .agg(
            F.count_if(F.col("type") == "PDF").alias("n_pdf"),
            F.count_if(F.col("type") == "Image").alias("n_image"),
            F.count(F.lit(1)).alias("n_children"),
        )
    )
