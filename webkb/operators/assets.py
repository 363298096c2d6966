"""Assets (PDF and image responses), content dispatch by element type, and
the PDF text job around the caller's extractor.

Element rows are reduced to one per element and type before any join, and
responses to one narrow row per URL ``(url, status, content_type, checksum)``:
a logo on every page is one row on either side. Content is read only where an
object is written or a PDF is converted.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webkb.conf import DEFAULT_IMAGE_CONTENT_TYPE, PDF_METHODS
from webkb.functions.html import held_slices, markdown_udf
from webkb.functions.paths import checksum, element_id, processed_path, raw_path
from webkb.operators.cache import PAGE_CONVERTER, content_key, convert_once, options_key
from webkb.operators.store import flag_first
from webkb.schema import PDF_BLOCK, QUARANTINE
from webkb.session import checkpoint

PDF_RESULT_SCHEMA = (
    "key string, markdown string, n_pages int, has_text_layer boolean, "
    "blocks array<struct<type:string,text:string,page_idx:int>>, error string"
)
_PDF_RESULT = pa.schema([
    ("key", pa.string()), ("markdown", pa.string()), ("n_pages", pa.int32()), ("has_text_layer", pa.bool_()),
    ("blocks", pa.list_(pa.struct([("type", pa.string()), ("text", pa.string()), ("page_idx", pa.int32())]))),
    ("error", pa.string())])


def one_response(assets: DataFrame) -> DataFrame:
    """Narrow responses, one per URL: ``url, asset_status, asset_content_type,
    asset_checksum``. A 200 is preferred to any other status, then the lower
    status and checksum: a partial aggregate over narrow columns, the checksum
    being taken before the shuffle."""
    narrow = assets.select("url", F.struct(
        (F.coalesce("status", F.lit(-1)) != 200).alias("failed"), F.col("status").alias("asset_status"),
        checksum("content").alias("asset_checksum"), F.col("content_type").alias("asset_content_type")).alias("r"))
    return narrow.groupBy("url").agg(F.min("r").alias("r")).select(
        "url", "r.asset_status", "r.asset_content_type", "r.asset_checksum")


def attach_assets(elements: DataFrame, assets: DataFrame, converts_pdfs: bool = True) -> DataFrame:
    """PDF/Image elements left-joined with the response of their URL.

    Status 200 gates checksum and paths; other statuses (or no response)
    keep the row with '' values. Without a PDF extractor a PDF has no
    processed path."""
    pdf_img = elements.filter(F.col("type") != "URL")
    j = pdf_img.join(one_response(assets), "url", "left")
    ok = F.col("asset_status") == 200
    processed = ok if converts_pdfs else ok & (F.col("type") != "PDF")
    return j.select(
        *elements.columns,
        F.col("asset_status").alias("status"),
        F.when(ok, F.col("asset_checksum")).otherwise(F.lit("")).alias("checksum"),
        F.when(ok, raw_path("job_id", "element_id", "type")).otherwise(F.lit("")).alias("raw_content_path"),
        F.when(processed, processed_path("job_id", "element_id", "type")).otherwise(F.lit("")).alias(
            "processed_content_path"),
        F.when(ok & (F.col("type") == "Image"),
               F.coalesce(F.col("asset_content_type"), F.lit(DEFAULT_IMAGE_CONTENT_TYPE)))
        .when(ok, F.lit("application/pdf")).alias("content_type"),
    )


# ---------------------------------------------------------------------------
# PDF -> Markdown
# ---------------------------------------------------------------------------
def check_method(method: str) -> None:
    if method not in PDF_METHODS:
        raise ValueError(f"unknown parse method {method!r}, only auto, ocr, txt allowed")


def blocks_to_markdown(blocks: list[tuple]) -> str:
    return "\n\n".join(text for _, text, _ in blocks if text)


def _pdf_partition(method: str, extractor_factory):
    def run(batches):
        extractor = None
        for pdf in (batch.slice(*part) for batch in batches for part in held_slices(batch.column("content"))):
            out = {name: [] for name in _PDF_RESULT.names}
            for key, content in zip(pdf.column("key").to_pylist(), pdf.column("content").to_pylist()):
                md, blocks, err = None, [], None
                try:
                    if extractor is None:
                        extractor = extractor_factory(method)  # once per partition
                    got = extractor(content if content is not None else b"")
                    blocks = [("text", got, 0)] if isinstance(got, str) else [tuple(b) for b in got]
                    if method == "txt" and not any(text for _, text, _ in blocks):
                        raise ValueError("no text layer")
                    md = blocks_to_markdown(blocks)
                except Exception as e:  # noqa: BLE001 - failure is a row, never a task error
                    blocks, err = [], f"{type(e).__name__}: {e}"
                out["key"].append(key)
                out["markdown"].append(md)
                out["n_pages"].append(None if err else max((int(b[2]) + 1 for b in blocks), default=0))
                out["has_text_layer"].append(None if err else any((b[1] or "").strip() for b in blocks))
                out["blocks"].append([{"type": b[0], "text": b[1], "page_idx": int(b[2])} for b in blocks])
                out["error"].append(err)
            yield pa.RecordBatch.from_pydict(out, _PDF_RESULT)

    return run


def pdf_to_markdown(pdfs: DataFrame, method: str = "auto", extractor_factory: Callable | None = None,
                    precomputed: DataFrame | None = None, key: str = "key") -> DataFrame:
    """``(key, markdown, n_pages, has_text_layer, blocks, error)`` per PDF.

    ``pdfs`` has ``key`` and ``content``; ``extractor_factory(method)`` makes
    the caller's extractor, once per partition, which turns the bytes of a
    file into a text or into blocks ``(type, text, page_idx)``. ``precomputed``
    (``key, model_json``) supplies block lists as JSON; those rows skip the
    extractor. A failing file gives a row with ``error`` set, never a failed
    task."""
    check_method(method)
    if extractor_factory is None and precomputed is None:
        raise ValueError("PDFs need an extractor_factory or precomputed blocks")
    src = pdfs.select(F.col(key).alias("key"), "content")
    done = None
    if precomputed is not None:
        given = precomputed.select(F.col(key).alias("key"), F.from_json(
            "model_json", f"array<{PDF_BLOCK.simpleString()}>").alias("blocks"))
        src = src.join(given.select("key"), "key", "left_anti")
        texts = F.filter(F.transform("blocks", lambda b: b["text"]), lambda t: t.isNotNull() & (t != ""))
        bad = F.col("blocks").isNull()
        done = given.select(
            "key",
            F.when(~bad, F.array_join(texts, "\n\n")).alias("markdown"),
            F.when(~bad, F.coalesce(F.array_max(F.transform("blocks", lambda b: b["page_idx"])) + 1, F.lit(0)))
            .alias("n_pages"),
            F.when(~bad, F.exists(texts, lambda t: F.trim(t) != "")).alias("has_text_layer"),
            "blocks",
            F.when(bad, F.lit("model_json is not a block list")).alias("error"),
        )
    if extractor_factory is None:
        return done
    out = src.mapInArrow(_pdf_partition(method, extractor_factory), PDF_RESULT_SCHEMA)
    return out.unionByName(done) if done is not None else out


def classify_pdfs(results: DataFrame) -> DataFrame:
    """``(key, has_text_layer, n_pages, error)``: text PDF versus scanned."""
    return results.select("key", "has_text_layer", "n_pages", "error")


def pdf_blocks(results: DataFrame) -> DataFrame:
    """Uniform content list: one row per block ``(key, idx, type, text, page_idx)``."""
    return results.select("key", F.posexplode("blocks").alias("idx", "b")).select(
        "key", "idx", "b.type", "b.text", "b.page_idx"
    )


# ---------------------------------------------------------------------------
# Content dispatch: type URL / PDF / Image
# ---------------------------------------------------------------------------
def first_per_type(elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(firsts, again)`` of a materialized table: the first writer of each
    element and type, and the rows that come after it, decided in one plan.
    What an element's content comes to depends on its URL and type alone, so
    the later rows need no content."""
    flagged = checkpoint(flag_first(elements.withColumn("_t", F.concat_ws(" ", "element_id", "type")), "_t").drop("_t"))
    return flagged.filter("is_first").drop("is_first"), flagged.filter("not is_first").drop("is_first")


def process_elements(elements: DataFrame, pages: DataFrame, assets: DataFrame, job: str,
                     pdf_method: str = "auto", extractor_factory: Callable | None = None,
                     remove=("footer", "header"), retain_images: bool = False,
                     materialized: bool = False, conversions: str | None = None,
                     extractor_version: str | None = None) -> dict[str, DataFrame]:
    """Fill checksum and content paths per element and build the objects.

    ``materialized=True`` says ``elements`` is already a checkpoint (it is
    then read as is instead of being checkpointed again).

    ``conversions`` names a cache of conversions: contents that it has are not
    converted again, new ones are added to it. PDFs take part if
    ``extractor_version`` tells the extractor from others. ``made`` is then in
    the result: ``(type, url, made)`` per page and PDF, true if this call
    converted its content.

    Returns ``rows`` (the first element of each id and type, with metadata
    fields), ``duplicates`` (the elements after it), ``objects`` (raw and
    processed content) and ``quarantine`` (pages and PDFs whose conversion
    failed, with the reason; they have no metadata row, as in the stored job).
    Without an extractor PDFs are stored but not converted."""
    check_method(pdf_method)
    job_lit = F.lit(job)
    # Element rows are narrow and read by several branches below: materialize
    # them once so the HTML parse behind them runs once.
    if not materialized:
        elements = checkpoint(elements)
    firsts, duplicates = first_per_type(elements)

    # Pages: the HTML is read once to be converted and once to be stored.
    pages = pages.filter(F.col("url").isNotNull())
    md = markdown_udf(remove, retain_images)
    made = []
    if conversions is None:
        converted_pages = checkpoint(pages.select("page_id", "url", md("url", "html").alias("_d")).select(
            "page_id", "url", "_d.markdown", "_d.error"))
        page_outcomes = converted_pages
    else:
        options = options_key("page", converter=PAGE_CONVERTER, remove=list(remove), retain_images=retain_images)
        outcomes, done = convert_once(
            pages.select(F.struct("page_id", "url").alias("id"), content_key("url", "html").alias("key"), "url", "html"),
            lambda d: d.select("key", md("url", "html").alias("_d")).select("key", "_d.markdown", "_d.error"),
            options, conversions)
        page_outcomes, converted_pages = outcomes.select("id.*", "error"), done.select("id.*", "markdown", "error")
        made.append(outcomes.select(F.lit("URL").alias("type"), "id.url", "made"))
    page_errors = page_outcomes.filter(F.col("error").isNotNull()).select("page_id", F.col("error").alias("page_error"))
    url_rows = firsts.filter(F.col("type") == "URL")
    if "page_checksum" in firsts.columns:  # taken in the parse pass
        firsts = firsts.drop("page_checksum")
    else:
        url_rows = url_rows.join(pages.select("page_id", checksum("html").alias("page_checksum")), "page_id", "left")
    url_rows = (
        url_rows.join(page_errors, "page_id", "left")
        .withColumn("checksum", F.coalesce("page_checksum", F.lit("")))
        .withColumn("raw_content_path", raw_path("job_id", "element_id", "type"))
        .withColumn("processed_content_path", processed_path("job_id", "element_id", "type"))
        .withColumn("status", F.lit(200))
        .withColumn("content_type", F.lit("text/html"))
        .drop("page_checksum")
    )
    asset_rows = attach_assets(firsts, assets, extractor_factory is not None)

    # Fetched assets with their element type (adaptive execution broadcasts
    # the distinct URLs where they measure small). PDFs are converted once and
    # the result is checkpointed: metadata and objects both read it.
    types = firsts.filter(F.col("type") != "URL").select("url", "type").distinct()
    ok_assets = assets.filter(F.col("status") == 200).join(types, "url")
    pdfs = ok_assets.filter(F.col("type") == "PDF").select(F.col("url").alias("key"), "content")
    if extractor_factory is None:
        converted = pdf_outcomes = pages.sparkSession.createDataFrame([], PDF_RESULT_SCHEMA)
    elif conversions is None or extractor_version is None:
        converted = pdf_outcomes = checkpoint(pdf_to_markdown(pdfs, pdf_method, extractor_factory))
    else:
        pdf_outcomes, done = convert_once(
            pdfs.select(F.col("key").alias("id"), content_key("content").alias("key"), "content"),
            lambda d: pdf_to_markdown(d, pdf_method, extractor_factory),
            options_key("pdf", extractor=extractor_version, method=pdf_method), conversions)
        converted = done.drop("key").withColumnRenamed("id", "key")
        pdf_outcomes = pdf_outcomes.drop("key").withColumnRenamed("id", "key")
        made.append(pdf_outcomes.select(F.lit("PDF").alias("type"), F.col("key").alias("url"), "made"))
    pdf_errors = pdf_outcomes.groupBy(F.col("key").alias("url")).agg(F.min("error").alias("pdf_error"))
    asset_rows = asset_rows.join(pdf_errors, "url", "left")
    failed = (F.col("type") == "PDF") & F.col("pdf_error").isNotNull()

    def quarantined(rows: DataFrame, reason: str) -> DataFrame:
        return rows.select("element_id", "url", "type", "parent_id", F.lit("processed").alias("stage"),
                           F.col(reason).alias("reason"), "job_id")

    quarantine = quarantined(asset_rows.filter(failed), "pdf_error").unionByName(
        quarantined(url_rows.filter(F.col("page_error").isNotNull()), "page_error"))
    rows = url_rows.filter(F.col("page_error").isNull()).drop("page_error").unionByName(
        asset_rows.filter(~failed).drop("pdf_error"))

    # Objects
    null_order = F.lit(None).cast("long").alias("order_key")
    eid = element_id("url", job_lit)
    page_raw = pages.filter(F.col("html").isNotNull()).select(
        raw_path(job_lit, eid, F.lit("URL")).alias("path"), eid.alias("element_id"),
        F.encode("html", "UTF-8").alias("content"), F.lit("text/html").alias("content_type"),
        F.lit("raw").alias("stage"), F.col("page_id").alias("order_key"),
    )
    page_md = converted_pages.filter(F.col("error").isNull()).select(
        processed_path(job_lit, eid, F.lit("URL")).alias("path"), eid.alias("element_id"),
        F.encode("markdown", "UTF-8").alias("content"), F.lit("text/markdown").alias("content_type"),
        F.lit("processed").alias("stage"), F.col("page_id").alias("order_key"),
    )
    asset_raw = ok_assets.select(
        raw_path(job_lit, eid, "type").alias("path"), eid.alias("element_id"), "content",
        F.when(F.col("type") == "PDF", F.lit("application/pdf"))
        .otherwise(F.coalesce("content_type", F.lit(DEFAULT_IMAGE_CONTENT_TYPE))).alias("content_type"),
        F.lit("raw").alias("stage"), null_order,
    )
    pdf_id = element_id("key", job_lit)
    pdf_md = converted.filter(F.col("error").isNull()).select(
        processed_path(job_lit, pdf_id, F.lit("PDF")).alias("path"), pdf_id.alias("element_id"),
        F.encode("markdown", "UTF-8").alias("content"), F.lit("text/markdown").alias("content_type"),
        F.lit("processed").alias("stage"), null_order,
    )
    objects = page_raw.unionByName(page_md).unionByName(asset_raw).unionByName(pdf_md).withColumn(
        "checksum", checksum("content")).withColumn("job_id", job_lit)
    out = {"rows": rows, "duplicates": duplicates, "objects": objects,
           "quarantine": quarantine.select(*QUARANTINE.fieldNames()), "converted": converted}
    return out | {"made": reduce(DataFrame.unionByName, made)} if made else out
