"""Scans: seeds, page store, asset store, fetch log, stored objects, metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webkb.functions.urls import canonical_url
from webkb.schema import ASSET, FETCH, METADATA_FILES, METADATA_STORED, OBJECT


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seeds(spark: SparkSession, urls) -> DataFrame:
    """Seed requests at depth 0, one per canonical URL.

    ``urls`` is a list of strings (the command-line seeds) or a DataFrame
    with a ``url`` column (a seed table)."""
    if isinstance(urls, DataFrame):
        df = urls.select(F.col("url").cast("string"))
    else:
        df = spark.createDataFrame([(u,) for u in urls], "url string")
    df = df.withColumn("url_key", canonical_url("url"))
    # smallest raw URL per canonical key: a partial aggregate (a seed table
    # may be large and hold many copies of one URL)
    return df.groupBy("url_key").agg(F.min("url").alias("url")).select("url", "url_key", F.lit(0).alias("depth"))


def seeds_from_text(spark: SparkSession, path: str) -> DataFrame:
    """Seed requests from text files with one URL per line (blank lines
    and surrounding blanks ignored)."""
    lines = spark.read.text(path).select(F.trim("value").alias("url")).filter(F.col("url") != "")
    return seeds(spark, lines)


def page_store(pages: DataFrame) -> DataFrame:
    """``(page_id, url, url_key, html)``, one page per canonical URL.

    When several pages share a canonical URL the lowest ``page_id`` is
    kept. Only the narrow ``(page_id, url_key)`` columns are aggregated (a
    partial ``min``, so one URL stored many times still combines map-side).
    Adaptive execution broadcasts the losing ids where their measured size
    allows it, and the HTML then does not move. A page without a URL is kept
    under a NULL key, for the parse step to report."""
    keyed = pages.select("page_id", "url", "html").withColumn("url_key", canonical_url("url"))
    keys = keyed.select("page_id", "url_key")
    firsts = keys.groupBy("url_key").agg(F.min("page_id").alias("keep"), F.count(F.lit(1)).alias("n"))
    losers = (
        keys.join(firsts.filter("n > 1").select("url_key", "keep"), "url_key")
        .filter(F.col("page_id") != F.col("keep"))
        .select("page_id")
    )
    return keyed.join(losers, "page_id", "left_anti")


def asset_store(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Asset responses ``(url, status, content_type, content)``.

    ``fmt='binaryFile'`` reads a folder of files: the file path is the URL,
    a present file has status 200."""
    if fmt == "binaryFile":
        raw = spark.read.format("binaryFile").load(path)
        return raw.select(
            F.col("path").alias("url"),
            F.lit(200).alias("status"),
            F.lit(None).cast("string").alias("content_type"),
            F.col("content"),
        )
    return spark.read.schema(ASSET).parquet(path)


def fetch_log(spark: SparkSession, path: str) -> DataFrame:
    """Fetch attempts ``(attempt_id, url, ts, status)``."""
    return spark.read.schema(FETCH).parquet(path)


def object_rows(spark: SparkSession, root: str, job_id: str | None = None, stage: str | None = None) -> DataFrame:
    """All stored object rows with the file each is in (``file_path``, and its
    hash ``file``); ``job_id`` and ``stage`` filters prune partitions."""
    df = spark.read.schema(OBJECT).parquet(root).select(*OBJECT.fieldNames(), "_metadata.file_path")
    if job_id is not None:
        df = df.filter(F.col("job_id") == job_id)
    if stage is not None:
        df = df.filter(F.col("stage") == stage)
    return df.withColumn("file", F.xxhash64("file_path"))


def read_object_rows(spark: SparkSession, root: str, job_id: str | None = None, stage: str | None = None) -> DataFrame:
    """All stored object rows, overwritten ones included; ``job_id`` and
    ``stage`` filters prune partitions."""
    return object_rows(spark, root, job_id, stage).select(*OBJECT.fieldNames())


def overwritten_rows(rows: DataFrame) -> DataFrame:
    """``path, version, row, file`` of the object rows that a later writer of
    their path, or the same row in another file (a compaction that did not come
    to its end), makes obsolete. Decided on narrow columns."""
    order = F.struct("version", F.coalesce("order_key", F.lit(-1)).alias("o"), "checksum", "row", "file")
    keys = rows.select("path", "version", "order_key", "checksum", "row", "file")
    last = keys.groupBy("path").agg(F.max(order).alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return keys.join(last, "path").filter(order != F.col("last")).select("path", "version", "row", "file")


def read_objects(spark: SparkSession, root: str, job_id: str | None = None, stage: str | None = None) -> DataFrame:
    """Stored objects, the last writer of each path.

    Writers only append. Which rows were overwritten is decided on the narrow
    columns, and those rows are taken out by an anti-join: their number is
    that of the overwrites, so the content of the others stays in place."""
    df = object_rows(spark, root, job_id, stage)
    return df.join(overwritten_rows(df), ["path", "version", "row", "file"], "left_anti").select(*OBJECT.fieldNames())


def read_metadata(spark: SparkSession, root: str, type_: str | None = None, element_id: str | None = None,
                  with_job: bool = False) -> DataFrame:
    """Stored metadata; ``type`` prunes partitions, ``element_id`` is pushed
    to the Parquet reader."""
    df = spark.read.schema(METADATA_FILES).parquet(root).select(*METADATA_STORED.fieldNames())
    if type_ is not None:
        df = df.filter(F.col("type") == type_)
    if element_id is not None:
        df = df.filter(F.col("element_id") == element_id)
    if not with_job:
        df = df.drop("job_id")
    return df
