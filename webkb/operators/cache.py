"""What one job keeps for the next: responses and conversions.

Responses are kept by URL and request time, in partitions by day. A request is
served the latest one that is no older than the expiry; the choice is made on
narrow columns, of the days that can hold it. Conversions are kept by content:
a text that was converted with the same options, under whatever URL and in
whatever job, is not converted again. Their table is laid out by options and
the leading digit of the key, in key order and with a Bloom filter. One writer
per cache at a time is assumed.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webkb.conf import CACHE_EXPIRATION_SECS
from webkb.operators.fetchlog import is_cacheable
from webkb.operators.store import KEY_DIGITS, path_exists, reachable
from webkb.schema import CONVERSION, CONVERSION_FILES, RESPONSE
from webkb.session import checkpoint

#: Part of a page conversion's options; to be raised when its output changes.
PAGE_CONVERTER = "markdown 1"


# ---------------------------------------------------------------------------
# responses
# ---------------------------------------------------------------------------
def _at(ts: str) -> datetime:
    at = datetime.fromisoformat(ts)
    return at.replace(tzinfo=UTC) if at.tzinfo is None else at.astimezone(UTC)


def _micros(at: datetime) -> int:
    return (at - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)


def fresh_responses(spark: SparkSession, root: str, kind: str, ts: str,
                    ttl_secs: int = CACHE_EXPIRATION_SECS) -> DataFrame:
    """The responses of ``kind`` that a request at ``ts`` is served from the
    cache at ``root``: per ``key`` those of the latest time at or before
    ``ts``, if that is at most ``ttl_secs`` ago. An absent cache is empty.

    A job asks at one time, so the as-of join is a maximum per key, combined
    map-side over ``(key, ts_us)``; content is read for the chosen rows."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], RESPONSE)
    at = _at(ts)
    oldest = at - timedelta(seconds=ttl_secs)
    rows = spark.read.schema(RESPONSE).parquet(root).filter(
        (F.col("kind") == kind) & F.col("day").between(str(oldest.date()), str(at.date()))
        & F.col("ts_us").between(_micros(oldest), _micros(at)))
    latest = rows.groupBy("key").agg(F.max("ts_us").alias("ts_us"))
    return rows.join(latest, ["key", "ts_us"], "left_semi").select(*RESPONSE.fieldNames())


def store_responses(responses: DataFrame, root: str, kind: str, ts: str) -> None:
    """Append the cacheable ones of the responses that a job got at ``ts``:
    ``key, url, status, content_type, content`` and, of pages, ``page_id``."""
    at = _at(ts)
    if "page_id" not in responses.columns:
        responses = responses.withColumn("page_id", F.lit(None).cast("long"))
    rows = responses.filter(is_cacheable("status") & F.col("key").isNotNull()).withColumns(
        {"ts_us": F.lit(_micros(at)), "kind": F.lit(kind), "day": F.lit(str(at.date()))})
    rows.select(*RESPONSE.fieldNames()).write.mode("append").partitionBy("kind", "day").parquet(root)


def served_pages(store: DataFrame, fresh: DataFrame) -> DataFrame:
    """The page store ``(page_id, url, html, url_key)`` as a job sees it that
    has the cached responses ``fresh``, with ``served``: a cached page stands
    for the live one of its URL, and is there if the live one is gone. A
    ``page_id`` must name the same URL in all jobs that share a cache."""
    cached = fresh.select("page_id", "url", F.decode("content", "UTF-8").alias("html"), F.col("key").alias("url_key"),
                          F.lit(True).alias("served"))
    live = store.select("page_id", "url", "html", "url_key", F.lit(False).alias("served"))
    return live.join(cached.select("url_key"), "url_key", "left_anti").select(*live.columns).unionByName(cached)


def served_assets(assets: DataFrame, fresh: DataFrame) -> DataFrame:
    """Asset responses with the cached ones in place of the live ones of
    their URL, and ``served``."""
    cached = fresh.select("url", "status", "content_type", "content", F.lit(True).alias("served"))
    live = assets.select("url", "status", "content_type", "content", F.lit(False).alias("served"))
    return live.join(fresh.select("url").distinct(), "url", "left_anti").select(*live.columns).unionByName(cached)


# ---------------------------------------------------------------------------
# conversions
# ---------------------------------------------------------------------------
def options_key(kind: str, **options) -> str:
    """Short name of a kind of conversion with its options."""
    return hashlib.sha256(json.dumps([kind, options], sort_keys=True).encode()).hexdigest()[:16]


def content_key(*parts) -> Column:
    """Key of a content: a digest over all it is converted from. A NULL part
    differs from every text."""
    marked = [F.coalesce(F.sha2(p, 256), F.lit("-")) for p in parts]
    return F.sha2(F.concat_ws(" ", *marked), 256)


def convert_once(items: DataFrame, convert: Callable[[DataFrame], DataFrame], options: str,
                 root: str) -> tuple[DataFrame, DataFrame]:
    """``(outcomes, conversions)``: per distinct ``(id, key)`` of ``items`` the
    narrow ``id, key, error, made``, which is materialized, and the same with
    ``markdown, n_pages, has_text_layer, blocks``, read from the cache.

    ``items`` have an ``id``, the ``key`` of their content and what
    ``convert`` reads; ``convert`` returns ``key``, ``error`` and what it has of
    the columns of a conversion. Contents that the cache at ``root`` has
    under ``options`` are taken from there; of the others, one item per key is
    converted, and ``made`` is true for all items of that key. Failures are
    rows with ``error``; they are not kept, so the next job tries again."""
    spark = items.sparkSession
    narrow = checkpoint(items.select("id", "key").distinct())

    def kept(keys: DataFrame) -> DataFrame:
        if not path_exists(spark, root):
            return spark.createDataFrame([], CONVERSION)
        table = spark.read.schema(CONVERSION_FILES).parquet(root).filter(F.col("options") == options)
        return reachable(table, keys, "key").select(*CONVERSION.fieldNames())

    todo = checkpoint(narrow.join(kept(narrow.select("key")).select("key"), "key", "left_anti")
                      .groupBy("key").agg(F.min("id").alias("id")))
    made = convert(items.join(todo, ["id", "key"], "left_semi"))
    made = checkpoint(made.select(*[F.col(f.name) if f.name in made.columns else F.lit(None).cast(f.dataType).alias(f.name)
                                    for f in CONVERSION.fields], "error"))
    new = made.filter(F.col("error").isNull()).select(*CONVERSION.fieldNames()).withColumn(
        "options", F.lit(options)).withColumn("key_prefix", F.substring("key", 1, KEY_DIGITS))
    # an item may be there twice: equal keys meet in the partition they are written from
    laid = new.repartitionByRange("key").dropDuplicates(["key"]).sortWithinPartitions("key_prefix", "key")
    (laid.write.mode("append").option("parquet.bloom.filter.enabled#key", "true")
     .option("parquet.bloom.filter.adaptive.enabled", "true").partitionBy("options", "key_prefix").parquet(root))
    failed = made.filter(F.col("error").isNotNull()).groupBy("key").agg(F.min("error").alias("error"))
    outcomes = checkpoint(
        narrow.join(todo.select("key", F.lit(True).alias("made")), "key", "left").join(failed, "key", "left")
        .select("id", "key", "error", F.coalesce("made", F.lit(False)).alias("made")))
    return outcomes, outcomes.join(kept(narrow.select("key")), "key", "left")
