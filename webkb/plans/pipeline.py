"""The whole job: seeds -> crawl -> elements -> content -> stores.

``build_kb`` is one call from seed URLs to a searchable knowledge base.
Each page is parsed once (one Arrow pass, checkpointed); the link graph,
the crawl and the element projection all read that parse. The pages that
were reached are then set aside with their HTML, once: what stores or converts
them does not go over the page store again.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webkb.conf import JobConf
from webkb.operators import assets as AS
from webkb.operators import cache as CA
from webkb.operators import crawl as CR
from webkb.operators import elements as EL
from webkb.operators import fetchlog as FL
from webkb.operators import links as LK
from webkb.operators import store as ST
from webkb.session import checkpoint, delete_path, stored
from webkb.sources import tables as TB


def job_id_of(ts: str) -> str:
    """Job id of the job timestamp, evaluated once on the driver."""
    return datetime.fromisoformat(ts).strftime("%Y%m%d_%H%M%S")


def build_kb(spark: SparkSession, pages: DataFrame, assets: DataFrame, conf: JobConf, root: str,
             seeds: DataFrame | None = None, robots: DataFrame | None = None,
             edge_filter: Column | None = None,
             extractors: list[Callable[[DataFrame], DataFrame]] | None = None,
             transforms: list[Callable[[DataFrame], DataFrame]] | None = None,
             extractor_factory: Callable | None = None, attempts: DataFrame | None = None,
             cache: str | None = None) -> dict:
    """Run one crawl-and-ingest job over stored pages and assets.

    - ``pages``: page store input ``(page_id, url, html)``;
    - ``assets``: responses ``(url, status, content_type, content)``;
    - ``seeds``: seed table with ``url`` (else ``conf.seeds``);
    - ``robots``: rules ``(host, agent, directive, path)``, applied for
      ``conf.user_agent``; a disallowed URL is never fetched, hence never
      expanded;
    - ``attempts``: fetch log; ``assets`` then carry ``attempt_id`` and the
      attempt that ends a URL's retries is its response;
    - ``edge_filter``: request hook, a predicate over ``src, dst, href``;
    - ``extractors``: extra element generators over the parsed pages;
    - ``transforms``: ordered item pipelines applied to element rows;
    - ``cache``: folder that jobs share. A request whose URL has a cacheable
      response there, got at most ``conf.cache_ttl_secs`` before
      ``conf.job_ts``, is served that instead of the live one, and what is
      fetched live is added at the job's end. Contents converted by an earlier
      job are not converted again (PDFs if ``conf.extractor_version`` is set).
      The result then has ``served`` (type, url, served) of every URL that was
      fetched and ``made`` (type, url, made) of every content.

    ``conf.max_requests_per_domain`` bounds the pages fetched from a host
    level by level. Writes ``root/objects``, ``root/metadata``,
    ``root/quarantine`` and ``root/rejects``; a re-run of the job adds no rows
    to them but new versions of the objects, and readers see the newest."""
    job = job_id_of(conf.job_ts)
    store = TB.page_store(pages)
    if attempts is not None:
        assets = FL.final_responses(assets, attempts)
    if cache is not None:
        responses, conversions = os.path.join(cache, "responses"), os.path.join(cache, "conversions")
        fresh = {kind: CA.fresh_responses(spark, responses, kind, conf.job_ts, conf.cache_ttl_secs)
                 for kind in ("page", "asset")}
        store = CA.served_pages(store, fresh["page"])
        assets = CA.served_assets(assets, fresh["asset"])
    if robots is not None:
        store = FL.robots_filter(store, robots, conf.user_agent).filter("allowed").drop("allowed", "rule")
    parsed = checkpoint(LK.parse_pages(store, ("url_key",), with_checksum=True))
    edges = LK.link_edges(parsed, edge_filter)
    seed_df = TB.seeds(spark, seeds if seeds is not None else conf.seeds)
    crawled = CR.crawl(seed_df, store, edges, conf.max_depth, conf.follow, conf.partitions,
                       max_per_host=conf.max_requests_per_domain)
    levels = crawled.select("page_id", "depth")
    reached = parsed.join(levels, "page_id")
    els = checkpoint(EL.elements_from_parsed(reached, job, conf.parent_as_url, extractors))
    crawled_pages, aside = stored(store.join(levels, "page_id", "left_semi"), "crawled")
    out = AS.process_elements(els, crawled_pages, assets, job, conf.pdf_method, extractor_factory,
                              conf.remove_selectors, conf.retain_images, materialized=True,
                              conversions=conversions if cache is not None else None,
                              extractor_version=conf.extractor_version)
    rows = out["rows"]
    for t in transforms or []:
        rows = rows.transform(t)
    ST.write_objects(out["objects"], os.path.join(root, "objects"))
    ins = ST.insert_metadata(rows, os.path.join(root, "metadata"), [job], out["duplicates"])
    quarantine = out["quarantine"].unionByName(EL.parse_failures(reached, job))
    ST.write_quarantine(quarantine, os.path.join(root, "quarantine"))
    ST.write_rejects(ins["rejects"], os.path.join(root, "rejects"))
    more = {}
    if cache is not None:
        asked = els.filter(F.col("type") != "URL").select("url", "type").distinct()
        got = assets.join(asked, "url")
        more = {"made": out["made"], "served": checkpoint(
            crawled_pages.select(F.lit("URL").alias("type"), "url", "served")
            .unionByName(got.select("type", "url", "served").distinct()))}
        live_pages = crawled_pages.filter(~F.col("served") & F.col("html").isNotNull()).select(
            F.col("url_key").alias("key"), "page_id", "url", F.lit(200).alias("status"),
            F.lit("text/html").alias("content_type"), F.encode("html", "UTF-8").alias("content"))
        live_assets = assets.join(asked.select("url"), "url", "left_semi").filter(~F.col("served")).select(
            F.col("url").alias("key"), "url", "status", "content_type", "content")
        CA.store_responses(live_pages, responses, "page", conf.job_ts)
        CA.store_responses(live_assets, responses, "asset", conf.job_ts)
    delete_path(spark, aside)
    return more | {
        "job_id": job,
        "crawled": crawled,
        "inserted": ins["inserted"],
        "rejects": ins["rejects"],
        "quarantine": quarantine,
        "metadata": TB.read_metadata(spark, os.path.join(root, "metadata")),
        "objects": TB.read_objects(spark, os.path.join(root, "objects"), job_id=job),
    }
