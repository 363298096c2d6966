"""Breadth-first crawl over the stored link graph.

The only driver loop is over depth. The HTML never enters it. The narrow
edge table and the visited set are written once as tables bucketed by URL
key in the shared folder (a written table keeps its hash layout across
jobs, which a checkpoint does not under adaptive execution). A level then
shuffles only the frontier and its candidate edges: neither the edges nor
the visited set move again. Rows are dealt to their bucket and sorted by key
before the write, so a write makes one sorted file per bucket. A small
frontier is sent to the scan of the edges, and its candidates to that of the
visited set: buckets and row groups that cannot hold their keys are not read.
Each level is appended to the visited table (partitioned by depth), which cuts
lineage and lets a lost executor recompute one level only.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webkb.functions.urls import host
from webkb.session import checkpoint, delete_path, scratch_path

#: Up to so many keys of a level are sent to the scans they meet.
SENT_KEYS = 1000

CRAWLED = "url_key string, url string, page_id bigint, parent_key string, depth int"


def bucket_count(edges: DataFrame, rows_per_bucket: int = 2_000_000, least: int = 8) -> int:
    """Buckets for a materialized edge table: some 2,000,000 edges each."""
    return max(least, math.ceil(edges.count() / rows_per_bucket))


class Bucketed:
    """A table of the shared folder bucketed by ``key``, in the catalog while it is used."""

    def __init__(self, spark: SparkSession, key: str, buckets: int, partition_by: str | None = None):
        self.spark, self.key, self.buckets, self.partition_by = spark, key, buckets, partition_by
        self.name = f"webkb_tmp_{uuid.uuid4().hex[:12]}"
        self.path = scratch_path(spark, self.name)
        self.made = False

    def append(self, df: DataFrame) -> Bucketed:
        w = df.repartition(self.buckets, self.key).write.mode("append").bucketBy(self.buckets, self.key).sortBy(self.key)
        if self.partition_by:
            w = w.partitionBy(self.partition_by)
        (w if self.made else w.option("path", self.path)).saveAsTable(self.name)
        self.made = True
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self, files: bool) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        if files:
            delete_path(self.spark, self.path)


def page_edges(edges: DataFrame, store: DataFrame, buckets: int) -> Bucketed:
    """Edges whose target is in the page store, with the target's page,
    bucketed by source (read by every level without a shuffle)."""
    keys = store.select(F.col("url_key").alias("dst"), F.col("page_id").alias("dst_page_id"),
                        F.col("url").alias("dst_url"))
    return Bucketed(edges.sparkSession, "src", buckets).append(edges.select("src", "dst").join(keys, "dst"))


def _only(table: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of a bucketed ``table`` that can meet ``keys`` (one column):
    all of them, unless there are few keys. What is read differs, not what a
    join with ``keys`` gives."""
    few = keys.limit(SENT_KEYS + 1).collect()
    if len(few) > SENT_KEYS:
        return table
    return table.filter(F.col(key).isin([r[0] for r in few]) if few else F.lit(False))


def _within_cap(new: DataFrame, visited: DataFrame | None, cap: int | None) -> DataFrame:
    """The candidates of a level that their hosts still have room for, in
    order of URL. Ranks above the cap are cut before the shuffle as well."""
    if cap is None:
        return new
    ranked = new.withColumn("_host", host("url")).withColumn("_rank", F.row_number().over(
        Window.partitionBy("_host").orderBy("url_key"))).filter(F.col("_rank") <= cap)
    if visited is not None:
        taken = visited.groupBy(host("url").alias("_host")).agg(F.count(F.lit(1)).alias("_taken"))
        ranked = ranked.join(taken, "_host", "left").filter(F.col("_rank") + F.coalesce("_taken", F.lit(0)) <= cap)
    return ranked.select(*new.columns)


def crawl(seeds: DataFrame, store: DataFrame, edges: DataFrame, max_depth: int, follow: bool = True,
          partitions: int | None = None, edge_filter: Column | None = None,
          max_per_host: int | None = None) -> DataFrame:
    """Pages reached from ``seeds`` within ``max_depth`` levels.

    ``seeds``: ``(url, url_key, depth=0)``; ``store``: page store
    ``(page_id, url, url_key, ...)``; ``edges``: ``(src, dst)`` canonical.
    Returns ``(url_key, url, page_id, depth, parent_key)``: each page once,
    at its first-arrival depth, ``parent_key`` = smallest parent at the
    previous level. A request without a stored page is not fetched and is
    not expanded. ``max_per_host`` bounds the pages fetched from a host, level
    by level: a page beyond it is not fetched, hence not expanded."""
    spark: SparkSession = store.sparkSession
    cols = ["url_key", "url", "page_id", "depth", "parent_key"]
    if edge_filter is not None:
        edges = edges.filter(edge_filter)
    expand = follow and max_depth > 0
    edges = checkpoint(edges.select("src", "dst")) if expand else edges
    n = partitions or (bucket_count(edges) if expand else 8)
    keys = store.filter(F.col("url_key").isNotNull()).select("url_key", "page_id", "url")
    level0 = (
        seeds.select("url_key")
        .join(keys, "url_key")  # fetch: frontier joined with the page store
        .select("url_key", "url", "page_id", F.lit(None).cast("string").alias("parent_key"),
                F.lit(0).alias("depth"))
    )
    visited_table = Bucketed(spark, "url_key", n, "depth").append(_within_cap(level0, None, max_per_host))
    if expand:
        pe_table = page_edges(edges, store, n)
        for d in range(1, max_depth + 1):
            visited, pe = visited_table.read(), pe_table.read()
            frontier = visited.filter(F.col("depth") == d - 1).select(F.col("url_key").alias("src"))
            cand = checkpoint(
                frontier.join(_only(pe, "src", frontier), "src")
                .groupBy("dst")  # partial aggregation collapses duplicate arrivals map-side
                .agg(F.min("src").alias("parent_key"), F.first("dst_page_id").alias("page_id"),
                     F.first("dst_url").alias("url"))
            )
            seen = _only(visited, "url_key", cand.select("dst"))
            new = cand.join(seen.select(F.col("url_key").alias("dst")), "dst", "left_anti").select(
                F.col("dst").alias("url_key"), "url", "page_id", "parent_key", F.lit(d).alias("depth")
            )
            visited_table.append(_within_cap(new, visited, max_per_host))
            if not _has_files(spark, f"{visited_table.path}/depth={d}"):
                break  # an empty level makes no partition
        pe_table.drop(files=True)
    visited_table.drop(files=False)  # the result reads the files
    if not _has_files(spark, visited_table.path):
        return spark.createDataFrame([], CRAWLED).select(*cols)
    return spark.read.schema(CRAWLED).parquet(visited_table.path).select(*cols)


def _has_files(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def crawl_pages(crawled: DataFrame, store: DataFrame) -> DataFrame:
    """Crawled pages with their HTML ``(page_id, url, depth, parent_key, html)``.

    The HTML joins back once, on ``page_id``, after the loop."""
    return crawled.select("page_id", "depth", "parent_key").join(store.select("page_id", "url", "html"), "page_id")
