"""Registered queries: one Spark plan and one DuckDB oracle per key.

Every query reads the driver tables of ``sf_dir`` (or what Spark derives
from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from webkb.plans import oracle_sql as O
from webkb.sources import fixtures as FX

JOB_TS = "2024-01-02 03:04:05"
JOB = O.JOB

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return deco


# ---------------------------------------------------------------------------
# Step 1: elements
# ---------------------------------------------------------------------------
from webkb.operators import elements as EL  # noqa: E402


@register(
    "elements_union",
    f"""with {O.fx_cte()}, {O.elements_cte()}
    select element_id, url, type, parent_url, parent_id, depth, pos, page_id, job_id from els""",
)
def q_elements_union(spark, sf_dir):
    """Page, PDF and image elements of every fx page."""
    return EL.elements(FX.fx(spark, sf_dir), JOB)


# ---------------------------------------------------------------------------
# Step 2: link graph and crawl
# ---------------------------------------------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from webkb.functions import urls as U  # noqa: E402
from webkb.operators import crawl as CR  # noqa: E402
from webkb.operators import links as LK  # noqa: E402
from webkb.sources import tables as TB  # noqa: E402


def _parsed_fx(spark, sf_dir):
    return LK.parse_pages(FX.fx(spark, sf_dir))


@register(
    "extract_links",
    f"""with {O.fx_cte()}, {O.anchors_cte()}
    select page_id, page_url, pos, 'a' as kind, href, {O.resolve('page_url', 'trim(href)')} as link_url, nofollow
    from anchors""",
)
def q_extract_links(spark, sf_dir):
    """Every a/area link of every fx page, document order."""
    return LK.extract_links(_parsed_fx(spark, sf_dir))


@register(
    "extract_pdfs",
    f"""with {O.fx_cte()}, {O.anchors_cte()}
    select page_id, page_url as parent_url, pos, {O.resolve('page_url', 'href')} as url from anchors
    where contains(href, '.pdf') and contains(lower(split_part(href, '?', 1)), '.pdf')""",
)
def q_extract_pdfs(spark, sf_dir):
    """PDF links per page, duplicates kept."""
    return LK.extract_pdfs(_parsed_fx(spark, sf_dir))


@register(
    "extract_images",
    f"""with {O.fx_cte()}, {O.images_cte()}
    select page_id, page_url as parent_url, pos, {O.resolve('page_url', 'src')} as url from imgs where src <> ''""",
)
def q_extract_images(spark, sf_dir):
    """Images with a non-empty src per page."""
    return LK.extract_images(_parsed_fx(spark, sf_dir))


def _edges_sql(src: str = "fx"):
    link = O.resolve("page_url", "trim(href)")
    return f"""{O.anchors_cte(src)},
    edges as (
      select {O.canonical('page_url')} as src, {O.canonical(link)} as dst, bool_and(nofollow) as nofollow
      from anchors where {O.followable(link)} group by all)"""


@register("link_edges", f"with {O.fx_cte()}, {_edges_sql()} select src, dst, nofollow from edges")
def q_link_edges(spark, sf_dir):
    """Distinct followable edges between canonical URLs."""
    return LK.link_edges(_parsed_fx(spark, sf_dir))


def _crawl_ctes(max_depth: int) -> str:
    # a fetch returns one page per canonical URL (the lowest page_id): only
    # the links of that page are followed
    return f"""{O.fx_cte()},
    keys as (select {O.canonical('url')} as url_key, min(page_id) as page_id from fx group by all),
    fxk as (select * from fx where page_id in (select page_id from keys)),
    {_edges_sql('fxk')},
    pe as (select e.src, e.dst from edges e join keys k on k.url_key = e.dst),
    seed as (select {O.canonical('url')} as url_key from fx where page_id = (select min(page_id) from fx)),
    r(u, d) as (select k.url_key, 0 from seed s join keys k on k.url_key = s.url_key
                union select pe.dst, r.d + 1 from r join pe on pe.src = r.u where r.d < {max_depth}),
    reach as (select u, min(d) as d from r group by u)"""


def _crawl_sql(max_depth: int) -> str:
    return f"""with recursive {_crawl_ctes(max_depth)}
    select c.u as url_key, k.page_id, cast(c.d as integer) as depth,
           (select min(pe.src) from pe join reach p on p.u = pe.src and p.d = c.d - 1 where pe.dst = c.u) as parent_key
    from reach c join keys k on k.url_key = c.u"""


def _crawl(spark, sf_dir, max_depth, follow=True, cap=None):
    fxp = FX.fx(spark, sf_dir)
    store = TB.page_store(fxp)
    first = fxp.groupBy().agg(F.min("page_id").alias("page_id"))
    seed_df = TB.seeds(spark, fxp.join(first, "page_id").select("url"))
    edges = LK.link_edges(LK.parse_pages(store))
    out = CR.crawl(seed_df, store, edges, max_depth, follow, max_per_host=cap)
    return out.select("url_key", "page_id", "depth", "parent_key")


@register("crawl_depth6", _crawl_sql(6))
def q_crawl_depth6(spark, sf_dir):
    """BFS from the first page to depth 6."""
    return _crawl(spark, sf_dir, 6)


@register("crawl_depth1", _crawl_sql(1))
def q_crawl_depth1(spark, sf_dir):
    """BFS to depth 1."""
    return _crawl(spark, sf_dir, 1)


@register("crawl_nofollow", _crawl_sql(0))
def q_crawl_nofollow(spark, sf_dir):
    """Follow toggle off: the seed page only."""
    return _crawl(spark, sf_dir, 6, follow=False)


CRAWL_CAP = 2


def _capped_sql(max_depth: int, cap: int) -> str:
    """The capped crawl level by level: a host's pages so far leave room for
    ``cap`` in all, taken in order of URL."""
    keyed = f"""{O.fx_cte()},
    keys as (select {O.canonical('url')} as url_key, min(page_id) as page_id from fx group by all),
    fxk as (select * from fx where page_id in (select page_id from keys)),
    hosts as (select k.url_key, k.page_id, {O.host('fxk.url')} as host from keys k join fxk on fxk.page_id = k.page_id),
    {_edges_sql('fxk')},
    pe as (select e.src, e.dst from edges e join keys k on k.url_key = e.dst),
    v0 as (select h.*, 0 as depth, cast(null as varchar) as parent_key from hosts h
           where h.url_key = (select {O.canonical('url')} from fx where page_id = (select min(page_id) from fx)))"""
    for d in range(1, max_depth + 1):
        keyed += f""",
    c{d} as (select pe.dst, min(pe.src) as parent_key from pe join v{d - 1} v on v.url_key = pe.src and v.depth = {d - 1}
             where pe.dst not in (select url_key from v{d - 1}) group by pe.dst),
    r{d} as (select h.*, c.parent_key, row_number() over (partition by h.host order by h.url_key) as rn
             from c{d} c join hosts h on h.url_key = c.dst),
    v{d} as (select * from v{d - 1} union all
             select r.url_key, r.page_id, r.host, {d}, r.parent_key from r{d} r
             left join (select host, count(*) as n from v{d - 1} group by host) t on t.host = r.host
             where r.rn + coalesce(t.n, 0) <= {cap})"""
    return f"with {keyed} select url_key, page_id, cast(depth as integer) as depth, parent_key from v{max_depth}"


@register("crawl_capped", _capped_sql(6, CRAWL_CAP))
def q_crawl_capped(spark, sf_dir):
    """BFS to depth 6 with at most 2 pages per host: a page beyond its host's cap is not
    fetched, hence not expanded (W03)."""
    return _crawl(spark, sf_dir, 6, cap=CRAWL_CAP)


@register(
    "canonical_urls",
    f"""select page_id, url, {O.canonical('url')} as url_key, {O.host('url')} as host,
    {O.followable('url')} as followable from pages""",
)
def q_canonical_urls(spark, sf_dir):
    """Canonical request URL, host and follow test of every raw page URL."""
    p = TB.read_table(spark, sf_dir, "pages")
    return p.select("page_id", "url", U.canonical_url("url").alias("url_key"), U.host("url").alias("host"),
                    U.is_followable("url").alias("followable"))


@register(
    "url_normal_forms",
    f"""select page_id, spelling, raw, {O.normal_url('raw')} as url_key,
      spelling < 3 and {O.normal_url('raw')} = {O.canonical('url')} as same from ({FX.duck_fx_spellings()}) r""",
)
def q_url_normal_forms(spark, sf_dir):
    """Request URL of every page URL in six other spellings (dot segments, default and other ports,
    escaped and bare characters), and whether it is that of the page (E12)."""
    key = U.canonical_url("raw")
    return FX.fx_spellings(spark, sf_dir).select(
        "page_id", "spelling", "raw", key.alias("url_key"),
        ((F.col("spelling") < 3) & (key == U.canonical_url("url"))).alias("same"))


# ---------------------------------------------------------------------------
# Step 3: content fields, assets, dispatch
# ---------------------------------------------------------------------------
from webkb.functions import paths as PA  # noqa: E402
from webkb.operators import assets as AS  # noqa: E402
from webkb.operators import export as EX  # noqa: E402
from webkb.operators import store as ST  # noqa: E402
from webkb.session import checkpoint, delete_path, qualified, scratch_path, stored  # noqa: E402


@register(
    "checksums",
    f"""select page_id, concat(sha256(url), '_', '{JOB}') as element_id, sha256(html) as checksum,
    sha256(encode(html)) as checksum_bytes, octet_length(encode(html)) as n_bytes from pages""",
)
def q_checksums(spark, sf_dir):
    """Element id and SHA-256 of every raw page, as text and as UTF-8 bytes."""
    p = TB.read_table(spark, sf_dir, "pages")
    b = F.encode("html", "UTF-8")
    return p.select("page_id", PA.element_id("url", F.lit(JOB)).alias("element_id"),
                    PA.checksum("html").alias("checksum"), PA.checksum(b).alias("checksum_bytes"),
                    F.octet_length(b).cast("bigint").alias("n_bytes"))


@register("job_ids", "select event_id, strftime(ts, '%Y%m%d_%H%M%S') as job_id from events")
def q_job_ids(spark, sf_dir):
    """Job id of every event timestamp."""
    e = TB.read_table(spark, sf_dir, "events")
    return e.select("event_id", PA.job_id(F.col("ts")).alias("job_id"))


@register(
    "object_keys",
    f"""with {O.fx_cte()}, {O.elements_cte()}
    select element_id, type, {O.raw_path_sql('job_id', 'element_id', 'type')} as raw_path,
      {O.processed_path_sql('job_id', 'element_id', 'type')} as processed_path,
      {O.ext_sql('url')} as url_extension,
      split_part(regexp_extract(url, '([^/]*)$', 1), '.', 1) as url_stem,
      regexp_extract(url, '^(.*)/[^/]*$', 1) as url_dir,
      concat_ws('/', job_id, 'raw', element_id) as joined
    from els""",
)
def q_object_keys(spark, sf_dir):
    """Raw/processed keys, extension, stem and dirname per fx element."""
    e = EL.elements(FX.fx(spark, sf_dir), JOB)
    return e.select(
        "element_id", "type",
        PA.raw_path("job_id", "element_id", "type").alias("raw_path"),
        PA.processed_path("job_id", "element_id", "type").alias("processed_path"),
        PA.extension("url").alias("url_extension"),
        PA.stem("url").alias("url_stem"),
        PA.dirname("url").alias("url_dir"),
        PA.join_path("job_id", F.lit("raw"), "element_id").alias("joined"),
    )


def _mime_case(ext: str) -> str:
    from webkb.conf import MIME_BY_EXTENSION

    whens = " ".join(f"when '{k}' then '{v}'" for k, v in MIME_BY_EXTENSION.items())
    return f"(case {ext} {whens} else null end)"


@register(
    "content_types",
    f"""with {O.fx_cte()}, {O.elements_cte()},
    paths as (select element_id, type, {O.raw_path_sql('job_id', 'element_id', 'type')} as p from els
              union all
              select element_id, type, concat(job_id, '/processed/', element_id, '.md') from els where type <> 'Image'
              union all
              select element_id, type, url from els)
    select element_id, type, p as path,
      {_mime_case("regexp_extract(p, '(?:^|/)\\.*[^/.][^/]*\\.([^./]*)$', 1)")} as content_type,
      replace(url_encode(p), '%2F', '/') as quoted
    from paths""",
)
def q_content_types(spark, sf_dir):
    """Guessed content type and percent-encoding of raw keys, processed keys and URLs."""
    e = EL.elements(FX.fx(spark, sf_dir), JOB)
    paths = (
        e.select("element_id", "type", PA.raw_path("job_id", "element_id", "type").alias("path"))
        .unionByName(e.filter(F.col("type") != "Image").select(
            "element_id", "type", PA.processed_path("job_id", "element_id", "type").alias("path")))
        .unionByName(e.select("element_id", "type", F.col("url").alias("path")))
    )
    return paths.select("element_id", "type", "path", PA.content_type("path").alias("content_type"),
                        U.percent_encode("path").alias("quoted"))


def _fx_inputs(spark, sf_dir, with_checksum=False, written=False):
    """fx pages, their elements and the derived asset table; elements and
    assets are materialized once (checkpoints) since several steps read
    them, and the pages (``written``) where a job reads them again and again."""
    pages = FX.fx(spark, sf_dir)
    if written:
        pages = stored(pages, "fx-pages")[0]
    els = checkpoint(EL.elements(pages, JOB, with_checksum=with_checksum))
    return pages, els, checkpoint(FX.fx_assets(els))


@register(
    "asset_status",
    f"""with {O.fx_cte()}, {O.elements_cte()}, {O.assets_cte()}, {O.rows_cte('true')}
    select r.element_id, r.url, r.type, r.status, r.checksum, r.raw_content_path, r.processed_content_path,
      case when r.status = 200 and r.type = 'Image' then coalesce(a.content_type, 'image/jpeg')
           when r.status = 200 then 'application/pdf' end as content_type
    from rows r left join assets a on a.url = r.url where r.type <> 'URL'""",
)
def q_asset_status(spark, sf_dir):
    """PDF/Image elements joined with their responses, read from a stored asset table in which
    fetched URLs also have a failed and a repeated response; status 200 gates
    (S03, J05, F03, E11, K03)."""
    _, els, assets = _fx_inputs(spark, sf_dir)
    path = scratch_path(spark, "assets")
    failed = assets.filter("status = 200").select(
        "url", F.lit(500).alias("status"), F.lit("text/plain").alias("content_type"),
        F.encode(F.lit("error"), "UTF-8").alias("content"))
    assets.unionByName(failed).unionByName(assets).write.parquet(path)
    r = AS.attach_assets(els, TB.asset_store(spark, path))
    return r.select("element_id", "url", "type", "status", "checksum", "raw_content_path",
                    "processed_content_path", "content_type")


# ---------------------------------------------------------------------------
# Step 4: store
# ---------------------------------------------------------------------------
def _processed_fx(spark, sf_dir):
    # elements are parsed once: the checkpointed rows feed both the asset
    # fixture and the content step
    pages, els, assets = _fx_inputs(spark, sf_dir, with_checksum=True)
    return AS.process_elements(els, pages, assets, JOB, extractor_factory=FX.fx_extractor, materialized=True)


@register(
    "metadata_first_writer",
    f"with {O.metadata_sql()} select * from meta",
)
def q_metadata_first_writer(spark, sf_dir):
    """Seven-column metadata rows after the content pipeline, first writer per element_id
    (F06, C07, P12, P13, W01, K08)."""
    rows = _processed_fx(spark, sf_dir)["rows"]
    winners, _ = ST.first_writer(rows)
    return EL.to_metadata(winners)


@register(
    "pk_conflicts",
    f"""with {O.metadata_sql()}
    select element_id, url as URL, type, parent_id, page_id, pos, 'duplicate element_id in batch' as reason
    from ranked where rn > 1""",
)
def q_pk_conflicts(spark, sf_dir):
    """Rows that lose the primary-key race, with a reason."""
    out = _processed_fx(spark, sf_dir)
    cols = ["element_id", "url", "type", "parent_id", "parent_url", "depth", "page_id", "pos"]
    failed = out["quarantine"].select("element_id", "type").distinct()
    again = out["duplicates"].join(failed, ["element_id", "type"], "left_anti").select(*cols)
    # the first of a type may still come after the first of another type
    _, losers = ST.first_writer(out["rows"].select(*cols))
    return again.unionByName(losers).select("element_id", F.col("url").alias("URL"), "type", "parent_id", "page_id", "pos",
                         F.lit("duplicate element_id in batch").alias("reason"))


@register(
    "object_last_writer",
    f"""with {O.fx_cte()}, {O.elements_cte()},
    k as (select *, {O.raw_path_sql('job_id', 'element_id', 'type')} as path from els),
    r as (select *, row_number() over (partition by path order by depth desc, coalesce(parent_url, '') desc,
                 {O.KIND_RANK_SQL} desc, pos desc, page_id desc) as rn from k)
    select path, element_id, page_id, pos, parent_url from r where rn = 1""",
)
def q_object_last_writer(spark, sf_dir):
    """Winner per object key when several elements upload the same key."""
    e = EL.elements(FX.fx(spark, sf_dir), JOB).withColumn("path", PA.raw_path("job_id", "element_id", "type"))
    winners, _ = ST.last_writer(e, "path")
    return winners.select("path", "element_id", "page_id", "pos", "parent_url")


@register(
    "metadata_incremental",
    f"""with {O.metadata_sql()}
    select *, case when type = 'Image' then 2 else 1 end as batch from meta""",
)
def q_metadata_incremental(spark, sf_dir):
    """Two inserts into one table: pages and PDFs, then everything again; the second adds only
    the images, re-inserted keys add nothing (X01, K06, K08, S06)."""
    rows = _processed_fx(spark, sf_dir)["rows"]
    root = scratch_path(spark, "metadata")
    ST.ensure_table(spark, root)
    first = ST.insert_metadata(rows.filter(F.col("type") != "Image"), root)
    first["inserted"].count()
    second = ST.insert_metadata(rows, root)
    b2 = second["inserted"].select("element_id")
    stored = TB.read_metadata(spark, root)
    return stored.join(b2.withColumn("batch", F.lit(2)), "element_id", "left").select(
        *stored.columns, F.coalesce("batch", F.lit(1)).alias("batch"))


@register(
    "metadata_validate",
    f"""with {O.metadata_sql()}
    select element_id, type,
      case when not regexp_full_match(element_id, '[0-9a-f]{{64}}_[0-9]{{8}}_[0-9]{{6}}') then 'element_id malformed'
           when not regexp_full_match(checksum, '([0-9a-f]{{64}})?') then 'checksum malformed' end as reason
    from meta""",
)
def q_metadata_validate(spark, sf_dir):
    """Row validation with a reason per row."""
    rows = _processed_fx(spark, sf_dir)["rows"]
    winners, _ = ST.first_writer(rows)
    v = ST.validate_metadata(EL.to_metadata(winners))
    return v.select("element_id", "type", "reason")


@register(
    "quarantine_rows",
    f"""with {O.fx_cte()}, {O.elements_cte()}, {O.assets_cte()}
    select distinct e.element_id, e.url, e.type, 'processed' as stage, 'ValueError: not a PDF file' as reason,
      e.job_id from els e left join assets a on e.type <> 'URL' and a.url = e.url where {O.FAILED_PDF}""",
)
def q_quarantine_rows(spark, sf_dir):
    """PDFs whose conversion fails: no metadata row, a quarantine row with the reason."""
    return _processed_fx(spark, sf_dir)["quarantine"].select("element_id", "url", "type", "stage", "reason", "job_id")


FAULTS = ["URL is null", "type not in URL/PDF/Image", "element_id malformed", "checksum malformed",
          "element_id is null", "checksum is null"]


@register(
    "metadata_invalid",
    f"""with p as (select page_id, url, concat(sha256(url), '_', '{JOB}') as eid, page_id % 8 as f from pages),
    r as (select page_id,
            case when f = 4 then null when f = 2 then substr(eid, 2) else eid end as element_id,
            case when f <> 0 then url end as "URL", case when f = 1 then 'Video' else 'URL' end as type,
            case f when 0 then '{FAULTS[0]}' when 1 then '{FAULTS[1]}' when 2 then '{FAULTS[2]}' when 3 then '{FAULTS[3]}'
                   when 4 then '{FAULTS[4]}' end as reason from p),
    n as (select *, row_number() over (partition by element_id, reason is null order by page_id) as rn from r)
    select element_id, "URL", type,
      case when reason is null and rn > 1 then 'duplicate element_id in batch' else reason end as reason,
      reason is null and rn = 1 as stored from n""",
)
def q_metadata_invalid(spark, sf_dir):
    """One insert of all pages of which five in eight break a check: broken and duplicate rows are
    rejects with a reason, the others are what the table holds; a NULL key never gets in; inserting
    again adds nothing (F13, K08, X01)."""
    p = TB.read_table(spark, sf_dir, "pages")
    fault = F.col("page_id") % 8
    eid = PA.element_id("url", F.lit(JOB))
    rows = p.select(
        F.when(fault == 4, F.lit(None).cast("string")).when(fault == 2, F.substring(eid, 2, 1000)).otherwise(eid)
        .alias("element_id"),
        F.when(fault != 0, F.col("url")).alias("url"), F.when(fault == 1, "Video").otherwise("URL").alias("type"),
        F.lit(None).cast("string").alias("parent_url"), F.lit(None).cast("string").alias("parent_id"),
        F.lit(0).alias("depth"), F.lit(0).alias("pos"), "page_id", F.lit(JOB).alias("job_id"),
        F.when(fault == 3, F.lit("xyz")).otherwise(PA.checksum("html")).alias("checksum"),
        F.lit("raw").alias("raw_content_path"), F.lit("md").alias("processed_content_path"))
    root = scratch_path(spark, "invalid")
    rejects = ST.insert_metadata(rows, root)["rejects"]
    ST.insert_metadata(rows, root)
    cols = ["element_id", "URL", "type"]
    return TB.read_metadata(spark, root).select(*cols, F.lit(None).cast("string").alias("reason"),
                                                F.lit(True).alias("stored")).unionByName(
        rejects.select(*cols, "reason", F.lit(False).alias("stored")))


@register(
    "object_manifest",
    f"""with {O.fx_cte()}, {O.elements_cte()}, {O.assets_cte()},
    t as (select distinct url, type from els where type <> 'URL'),
    page as (select concat(sha256(url), '_', '{JOB}') as id, html from fx
             where page_id in (select max(page_id) from fx group by url)),  -- last writer per object key
    file as (select concat(sha256(a.url), '_', '{JOB}') as id, a.*, t.type from assets a join t on t.url = a.url
             where a.status = 200),
    objs as (
      select 'raw' as stage, concat('{JOB}/raw/', id, '.html') as path, encode(html) as content,
             'text/html' as content_type from page
      union all
      select 'processed', concat('{JOB}/processed/', id, '.md'), null, 'text/markdown' from page
      union all
      select 'raw', {O.raw_path_sql("'" + JOB + "'", 'id', 'type')}, content,
             case when type = 'PDF' then 'application/pdf' else coalesce(content_type, 'image/jpeg') end from file
      union all
      select 'processed', concat('{JOB}/processed/', id, '.md'), encode(url), 'text/markdown' from file
      where type = 'PDF' and not {FX.BROKEN_ASSET})
    select stage, path, sha256(content) as checksum, content_type, octet_length(content) as size from objs""",
)
def q_object_manifest(spark, sf_dir):
    """Write raw and processed objects partitioned by job and stage, read both back with partition
    pruning, and list path, checksum, type and size; the Markdown of pages is listed without its
    digest, which SQL has no second path to (K01-K05, K07, S05)."""
    out = _processed_fx(spark, sf_dir)
    root = scratch_path(spark, "objects")
    ST.write_objects(out["objects"], root)
    raw, done = (ST.manifest(TB.read_objects(spark, root, job_id=JOB, stage=s)).withColumn("stage", F.lit(s))
                 for s in ("raw", "processed"))
    pages = TB.read_objects(spark, root, job_id=JOB, stage="raw").filter("content_type = 'text/html'").select(
        F.replace(F.replace("path", F.lit("/raw/"), F.lit("/processed/")), F.lit(".html"), F.lit(".md")).alias("path"),
        F.lit(True).alias("of_page"))
    done = done.join(pages, "path", "left")
    hidden = F.col("of_page").isNull()
    done = done.withColumn("checksum", F.when(hidden, F.col("checksum"))).withColumn("size", F.when(hidden, F.col("size")))
    cols = ["stage", "path", "checksum", "content_type", "size"]
    return raw.select(*cols).unionByName(done.select(*cols))


def _write_raw_pages(pages, root):
    """One batch run that stores the raw objects of ``pages``."""
    content = F.encode("html", "UTF-8")
    ST.write_objects(pages.withColumn("element_id", PA.element_id("url", F.lit(JOB))).select(
        PA.raw_path(F.lit(JOB), "element_id", F.lit("URL")).alias("path"), "element_id", content.alias("content"),
        F.lit("text/html").alias("content_type"), PA.checksum(content).alias("checksum"),
        F.col("page_id").alias("order_key"), F.lit(JOB).alias("job_id"), F.lit("raw").alias("stage")), root)


_RERUN_SQL = (
    f"""with o as (
      select concat('{JOB}/raw/', sha256(url), '_{JOB}.html') as path, page_id, 0 as version, encode(html) as content
      from pages
      union all
      select concat('{JOB}/raw/', sha256(url), '_{JOB}.html'), page_id, 1, encode(concat(html, '<!-- again -->')) from pages
      where length(html) % 2 = 0),
    n as (select *, row_number() over (partition by path order by version desc, page_id desc) as rn from o)
    select path, sha256(content) as checksum, octet_length(content) as size from n where rn = 1"""
)


@register("objects_rerun", _RERUN_SQL)
def q_objects_rerun(spark, sf_dir):
    """The raw pages written by one run, and the pages of even length again with other content by
    a second: one row per path, the newest content (W02, K01)."""
    return ST.manifest(TB.read_objects(spark, _two_runs(spark, sf_dir), JOB)).select("path", "checksum", "size")


def _two_runs(spark, sf_dir):
    p = TB.read_table(spark, sf_dir, "pages")
    root = scratch_path(spark, "rerun")
    _write_raw_pages(p, root)
    _write_raw_pages(p.filter(F.length("html") % 2 == 0).withColumn("html", F.concat("html", F.lit("<!-- again -->"))), root)
    return root


@register("objects_compacted", _RERUN_SQL)
def q_objects_compacted(spark, sf_dir):
    """As objects_rerun, and the files that hold overwritten rows rewritten: every row that the
    store then holds, without the reader's own choice of the last writer (W02, S05)."""
    root = _two_runs(spark, sf_dir)
    ST.compact_objects(spark, root, JOB)
    return ST.manifest(TB.read_object_rows(spark, root, JOB)).select("path", "checksum", "size")


@register(
    "objects_exported",
    f"""select concat('{JOB}/raw/', sha256(url), '_{JOB}.html') as path, octet_length(encode(html)) as size from pages
    where page_id in (select max(page_id) from pages group by url)""",
)
def q_objects_exported(spark, sf_dir):
    """One file per raw page object under the shared folder, written by a data source that commits;
    the committed listing, joined with the files read back (K10)."""
    p = TB.read_table(spark, sf_dir, "pages").select("page_id", "html", PA.element_id("url", F.lit(JOB)).alias("id"))
    last = p.groupBy("id").agg(F.max("page_id").alias("page_id"))
    root = qualified(spark, scratch_path(spark, "export"))
    listed = EX.export_objects(p.join(last, ["id", "page_id"], "left_semi").select(
        PA.raw_path(F.lit(JOB), "id", F.lit("URL")).alias("path"), F.encode("html", "UTF-8").alias("content")), root)
    files = TB.asset_store(spark, f"{root}/{JOB}/raw", "binaryFile").select(
        F.concat(F.lit(f"{JOB}/raw/"), F.substring_index("url", "/", -1)).alias("path"),
        F.length("content").cast("long").alias("size"))
    return listed.join(files, ["path", "size"], "full").select("path", "size")


def _meta_fx(spark, sf_dir):
    rows = _processed_fx(spark, sf_dir)["rows"]
    winners, _ = ST.first_writer(rows)
    return EL.to_metadata(winners)


@register(
    "parents_resolved",
    f"""with {O.metadata_sql()}
    select c.element_id, c.type, c.parent_id, p.URL as parent_URL, p.URL is not null as parent_found
    from meta c left join (select element_id, URL from meta where type = 'URL') p on p.element_id = c.parent_id
    where c.parent_id is not null""",
)
def q_parents_resolved(spark, sf_dir):
    """Children joined with their parent page row."""
    return EL.resolve_parents(_meta_fx(spark, sf_dir))


@register(
    "children_rollup",
    f"""with {O.metadata_sql()}
    select parent_id, cast(count(*) filter (where type = 'PDF') as bigint) as n_pdf,
      cast(count(*) filter (where type = 'Image') as bigint) as n_image, count(*) as n_children
    from meta where parent_id is not null group by parent_id""",
)
def q_children_rollup(spark, sf_dir):
    """Children per parent page by type."""
    return EL.children_rollup(_meta_fx(spark, sf_dir))


@register(
    "job_summary",
    f"""with {O.metadata_sql()}
    select split_part(element_id, '_', 2) || '_' || split_part(element_id, '_', 3) as job_id, type,
      count(*) as n_elements, count(*) filter (where checksum = '') as n_unfetched
    from meta group by all""",
)
def q_job_summary(spark, sf_dir):
    """Rows by job and type, with the unfetched count."""
    return EL.job_summary(_meta_fx(spark, sf_dir))


# ---------------------------------------------------------------------------
# Step 5: fetch log
# ---------------------------------------------------------------------------
from webkb.conf import JobConf  # noqa: E402
from webkb.operators import fetchlog as FL  # noqa: E402

DOMAIN_CAP_N = 5


@register(
    "robots_allowed",
    f"""with robots as ({O.duck_fx_robots()}),
    u as (select page_id, url, {O.host('url')} as host,
      case when starts_with(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1), '/')
           then regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1)
           else concat('/', regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1)) end as pq
      from pages),
    m as (select u.page_id, max(length(r.path) * 2 + case when r.directive = 'allow' then 1 else 0 end) as best
          from u join robots r on r.host = u.host and starts_with(u.pq, r.path) group by u.page_id)
    select u.page_id, u.url, coalesce(m.best % 2 = 1, true) as allowed from u left join m on m.page_id = u.page_id""",
)
def q_robots_allowed(spark, sf_dir):
    """Robots exclusion of every page URL: longest rule wins, allow wins ties."""
    pages = TB.read_table(spark, sf_dir, "pages").select("page_id", "url")
    return FL.robots_filter(pages, FX.fx_robots(spark, sf_dir)).select("page_id", "url", "allowed")


@register(
    "retry_fold",
    f"""with a as ({O.duck_fx_attempts()}),
    n as (select *, cast(ts as date) as day,
                 row_number() over (partition by url, cast(ts as date) order by ts, attempt_id) as attempt from a),
    g as (select url, day,
            min(attempt) filter (where status not in (500, 502, 503, 504, 408, 429)) as first_ok,
            max(attempt) as last_n
          from n where attempt <= 4 group by url, day)
    select g.url, g.day, n.status as final_status, cast(n.attempt as integer) as attempts,
           n.attempt_id as final_attempt_id, g.first_ok is null as exhausted
    from g join n on n.url = g.url and n.day = g.day and n.attempt = coalesce(g.first_ok, g.last_n)""",
)
def q_retry_fold(spark, sf_dir):
    """Retry outcome per (url, day) over a stored fetch log: 1 + 3 attempts, first non-retryable
    status wins (S04, A03, W04, F08)."""
    path = scratch_path(spark, "fetch-log")
    FX.fx_attempts(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(path)
    return FL.fold_retries(TB.fetch_log(spark, path))


@register(
    "cache_asof",
    f"""with a as ({O.duck_fx_attempts()}),
    k as (select url, ts, max(attempt_id) as attempt_id from a
          where status not in (503, 504, 505, 500, 400, 401, 402, 403, 404) group by url, ts)
    select q.attempt_id, q.url, q.ts, k.attempt_id as cached_attempt_id, k.ts as cached_ts,
           epoch_us(q.ts) - epoch_us(k.ts) as age_us,
           coalesce(epoch_us(q.ts) - epoch_us(k.ts) <= 86400000000, false) as fresh
    from a q asof left join k on q.url = k.url and q.ts >= k.ts""",
)
def q_cache_asof(spark, sf_dir):
    """Latest cacheable response at or before every attempt of the log, and its freshness: 429 may
    be cached, 404 and 503 may not (J04, F09)."""
    a = checkpoint(FX.fx_attempts(spark, sf_dir))
    return FL.cache_lookup(a, a.filter(FL.is_cacheable("status")))


@register(
    "robots_agent",
    f"""with robots as (select *, '*' as grp from ({O.duck_fx_robots()}) t union all
      select distinct {O.host('url')}, 'KbBot', 'disallow', '/fr/', 'own' from pages where length({O.host('url')}) % 4 = 0),
    g as (select host, max(grp = 'own') as own from robots group by host),
    rules as (select r.* from robots r join g on g.host = r.host where (r.grp = 'own') = g.own),
    u as (select page_id, url, {O.host('url')} as host,
      regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1) as rest from pages),
    m as (select u.page_id, max(length(r.path) * 2 + case when r.directive = 'allow' then 1 else 0 end) as best
          from u join rules r on r.host = u.host
           and starts_with(case when starts_with(u.rest, '/') then u.rest else concat('/', u.rest) end, r.path)
          group by u.page_id)
    select u.page_id, u.url, coalesce(m.best % 2 = 1, true) as allowed from u left join m on m.page_id = u.page_id""",
)
def q_robots_agent(spark, sf_dir):
    """Robots exclusion for the job's own agent: a host's own group replaces its * group."""
    pages = TB.read_table(spark, sf_dir, "pages").select("page_id", "url")
    own = pages.select(U.host("url").alias("host")).distinct().filter(F.length("host") % 4 == 0).select(
        "host", F.lit("KbBot").alias("agent"), F.lit("disallow").alias("directive"), F.lit("/fr/").alias("path"))
    rules = FX.fx_robots(spark, sf_dir).unionByName(own)
    return FL.robots_filter(pages, rules, JobConf(user_agent="KbBot").user_agent).select("page_id", "url", "allowed")


@register(
    "domain_cap",
    f"""select url, {O.host('url')} as host, cast(r as integer) as rank from (
      select url, row_number() over (partition by {O.host('url')} order by url) as r from pages) t
    where r <= {DOMAIN_CAP_N}""",
)
def q_domain_cap(spark, sf_dir):
    """At most 5 requests per host over all page URLs (W03; the job default is 1000)."""
    p = TB.read_table(spark, sf_dir, "pages").select("url")
    return FL.domain_cap(p, DOMAIN_CAP_N).select("url", "host", F.col("rank").cast("int"))


# ---------------------------------------------------------------------------
# Step 6: text (HTML -> Markdown, PDF -> Markdown)
# ---------------------------------------------------------------------------
from webkb.functions.html import markdown_udf  # noqa: E402


@register(
    "markdown_profile",
    f"""with {O.fx_cte()},
    f as (select page_id, html, regexp_extract(html, '&middot; ([^<]*)</footer>', 1) as footer_text from fx)
    select page_id,
      cast(len(regexp_extract_all(html, '<h1[\\s>]')) as integer) as n_h1,
      cast(len(regexp_extract_all(html, '<li[\\s>]')) as integer) as n_items,
      cast(len(regexp_extract_all(html, '<a\\s')) as integer) as n_links,
      contains(regexp_replace(html, '(?s)<footer>.*?</footer>', '', 'g'), footer_text) as footer_leak,
      false as script_leak, false as has_images, true as converted
    from f""",
)
def q_markdown_profile(spark, sf_dir):
    """HTML to Markdown of every fx page with footer/header removed and images dropped:
    heading, list-item and link counts, and no footer, script or image text (C01-C03)."""
    pages = FX.fx(spark, sf_dir)
    md = pages.select("page_id", "html", markdown_udf(("footer", "header"), False)("url", "html").alias("d")).select(
        "page_id", "html", F.col("d.markdown").alias("md"))
    lines = F.split("md", "\n")
    footer = F.regexp_extract("html", "&middot; ([^<]*)</footer>", 1)
    return md.select(
        "page_id",
        F.size(F.filter(lines, lambda ln: ln.startswith("# "))).alias("n_h1"),
        F.size(F.filter(lines, lambda ln: ln.startswith("- "))).alias("n_items"),
        (F.size(F.split("md", r"\]\(")) - 1).alias("n_links"),
        F.col("md").contains(footer).alias("footer_leak"),
        F.col("md").contains("track(").alias("script_leak"),
        F.col("md").contains("![").alias("has_images"),
        F.col("md").isNotNull().alias("converted"),
    )


GIVEN = "doc_id % 3 = 0"  # documents whose blocks were computed before


def _pdf_results(spark, sf_dir):
    """Every document's whole text as a file, through the caller's extractor, but for those whose
    blocks are given as JSON (one block with the text)."""
    files = FX.fx_pdf_files(spark, sf_dir).withColumn("key", F.col("doc_id").cast("string"))
    docs = TB.read_table(spark, sf_dir, "documents")
    block = F.array(F.struct(F.lit("text").alias("type"), F.col("text"), F.lit(2).alias("page_idx")))
    given = docs.filter(GIVEN).select(F.col("doc_id").cast("string").alias("key"), F.to_json(block).alias("model_json"))
    return AS.pdf_to_markdown(files, "auto", FX.fx_extractor, given)


_PDF_CTE = f"""lines as (select doc_id, case when {GIVEN} then [text] when text = '' then [] else string_split(text, chr(10))
             end as ls, ({FX.BROKEN_DOC}) and not ({GIVEN}) as broken, {GIVEN} as given from documents)"""


@register(
    "pdf_roundtrip",
    f"""with {_PDF_CTE}
    select doc_id, case when not broken then array_to_string(list_filter(ls, lambda l: l <> ''), chr(10) || chr(10)) end
      as text, case when broken then 'ValueError: not a PDF file' end as error from lines""",
)
def q_pdf_roundtrip(spark, sf_dir):
    """Markdown of every document's file by the extractor, or from blocks given as JSON; broken files
    are rows with an error (H04, F12, C06, C08, E14)."""
    out = _pdf_results(spark, sf_dir)
    return out.select(F.col("key").cast("long").alias("doc_id"), F.col("markdown").alias("text"), "error")


@register(
    "pdf_classify",
    f"""with {_PDF_CTE}
    select doc_id, case when not broken then len(list_filter(ls, lambda l: trim(l) <> '')) > 0 end as has_text_layer,
      cast(case when broken then null when given then 3 else (len(ls) + {FX.LINES_PER_PAGE - 1}) // {FX.LINES_PER_PAGE} end
           as integer) as n_pages, case when broken then 'ValueError: not a PDF file' end as error from lines""",
)
def q_pdf_classify(spark, sf_dir):
    """Text layer present versus scanned, and page count, per file."""
    out = AS.classify_pdfs(_pdf_results(spark, sf_dir))
    return out.select(F.col("key").cast("long").alias("doc_id"), "has_text_layer", "n_pages", "error")


@register(
    "pdf_blocks",
    f"""with {_PDF_CTE}
    select doc_id, cast(i - 1 as integer) as idx, ls[i] as text,
      cast(case when given then 2 else (i - 1) // {FX.LINES_PER_PAGE} end as integer) as page_idx
    from (select *, unnest(range(1, len(ls) + 1)) as i from lines where not broken) t""",
)
def q_pdf_blocks(spark, sf_dir):
    """Block list of every file, extracted or given."""
    out = AS.pdf_blocks(_pdf_results(spark, sf_dir))
    return out.select(F.col("key").cast("long").alias("doc_id"), "idx", "text", "page_idx")


# ---------------------------------------------------------------------------
# Step 7: search
# ---------------------------------------------------------------------------
from webkb.operators import search as SE  # noqa: E402

SEARCH_K = 10
SEARCH_SITES = ["example.org"]


def _bm25_sql(docs_sql: str, site_pred: str | None = None, queries: str = "select item_id as query_id, text from benchmark") -> str:
    tok = "list_filter(regexp_split_to_array(lower({c}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"
    cand = f"where p.doc_id in (select doc_id from docs where {site_pred})" if site_pred else ""
    return f"""docs as ({docs_sql}),
    d as (select doc_id, {tok.format(c='text')} as toks from docs),
    dl as (select doc_id, len(toks) as dl from d),
    st as (select count(*) as n, avg(dl) as avgdl from dl),
    q as (select distinct query_id, term from
          (select query_id, unnest({tok.format(c='text')}) as term from ({queries}) t1) t0),
    tok as (select doc_id, unnest(toks) as term from d),
    post as (select term, doc_id, count(*) as tf from tok where term in (select term from q) group by all),
    dfq as (select term, count(*) as df from post group by term),
    sc as (select q.query_id, p.doc_id,
             sum(ln((st.n - dfq.df + 0.5) / (dfq.df + 0.5) + 1) * p.tf * {BM25_K1 + 1}
                 / (p.tf + {BM25_K1} * ({1 - BM25_B} + {BM25_B} * dl.dl / st.avgdl))) as score
           from post p join q on q.term = p.term join dfq on dfq.term = p.term join dl on dl.doc_id = p.doc_id
           join st on true {cand}
           group by all),
    r as (select *, row_number() over (partition by query_id order by round(score, 9) desc, doc_id) as rn from sc)
    select query_id, cast(rn as integer) as rank, doc_id, cast(round(score * 1000000) as bigint) as score_e6
    from r where rn <= {SEARCH_K}"""


from webkb.conf import BM25_B, BM25_K1  # noqa: E402


@register("kb_search_topk", "with " + _bm25_sql("select doc_id, text from documents"))
def q_kb_search_topk(spark, sf_dir):
    """BM25 top 10 documents for every benchmark query over all documents."""
    docs = TB.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    qs = TB.read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    r = SE.kb_search(docs, qs, SEARCH_K)
    return r.select("query_id", "rank", "doc_id", F.round(F.col("score") * 1e6).cast("long").alias("score_e6"))


@register(
    "kb_search_site",
    f"with {O.fx_cte()}, "
    + _bm25_sql("select page_id as doc_id, url, regexp_replace(html, '<[^>]*>', ' ', 'g') as text from fx",
                f"{O.host('url')} = 'example.org' or ends_with({O.host('url')}, '.example.org')"),
)
def q_kb_search_site(spark, sf_dir):
    """BM25 top 10 pages per benchmark query, restricted to the example.org site."""
    kb = FX.fx(spark, sf_dir).select(F.col("page_id").alias("doc_id"), "url",
                                      F.regexp_replace("html", "<[^>]*>", " ").alias("text"))
    qs = TB.read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    r = SE.kb_search(kb, qs, SEARCH_K, sites=SEARCH_SITES)
    return r.select("query_id", "rank", "doc_id", F.round(F.col("score") * 1e6).cast("long").alias("score_e6"))


@register("kb_search_again", "with " + _bm25_sql(
    "select doc_id, text from documents", queries="select conv_id as query_id, text from conversations where turn = 0"))
def q_kb_search_again(spark, sf_dir):
    """A stored index over all documents, searched for the benchmark and then, without reading a
    document, for the first turn of every conversation (L01)."""
    root = SE.build_index(TB.read_table(spark, sf_dir, "documents").select("doc_id", "text"), scratch_path(spark, "index"))
    for table, key, keep in (("benchmark", "item_id", "true"), ("conversations", "conv_id", "turn = 0")):
        qs = TB.read_table(spark, sf_dir, table).filter(keep).select(F.col(key).alias("query_id"), "text")
        r = SE.search_index(spark, root, qs, SEARCH_K)
    return r.select("query_id", "rank", "doc_id", F.round(F.col("score") * 1e6).cast("long").alias("score_e6"))


# ---------------------------------------------------------------------------
# Steps 8 and 9: streaming ingest, whole job
# ---------------------------------------------------------------------------
from webkb.plans.pipeline import build_kb  # noqa: E402
from webkb.streaming import ingest as SI  # noqa: E402
from webkb.streaming import keyed as SK  # noqa: E402


@register("stream_ingest", f"with {O.metadata_sql()} select * from meta")
def q_stream_ingest(spark, sf_dir):
    """Pages streamed from the sf folder, neighbours joined from the static table, each
    micro-batch inserted through the keyed sinks (T01-T03)."""
    static = TB.read_table(spark, sf_dir, "pages").select("page_id", "url")
    n_pages = static.count()
    _, _, assets = _fx_inputs(spark, sf_dir)
    root = scratch_path(spark, "stream")
    # as a glob, for the table may be one file or a folder of files
    stream = SI.read_page_stream(spark, f"{sf_dir}/{{pages.parquet}}")
    t = FX.neighbour_links(static, n_pages)
    q = SI.stream_ingest(stream, assets, JOB, root, scratch_path(spark, "stream-ckpt"), t,
                         extractor_factory=FX.fx_extractor)
    q.awaitTermination()  # replays adding nothing is a test (tests/test_operators.py)
    return TB.read_metadata(spark, f"{root}/metadata")


@register(
    "stream_two_batches",
    f"""with {O.metadata_sql()},
    page as (select concat(sha256(url), '_', '{JOB}') as id, html from fx
             where page_id in (select max(page_id) from fx group by url)),
    again as (select element_id, 'element_id already stored' as reason from meta)
    select 'metadata' as kind, element_id as key, checksum as value from meta
    union all select 'object', concat('{JOB}/raw/', id, '.html'), sha256(encode(concat(html, '<!-- again -->'))) from page
    union all select distinct 'quarantine', e.element_id, 'ValueError: not a PDF file'
      from els e left join assets a on e.type <> 'URL' and a.url = e.url where {O.FAILED_PDF}
    union all select 'reject', element_id, reason from again""",
)
def q_stream_two_batches(spark, sf_dir):
    """Two landed folders, two micro-batches, the second with every page again and other content:
    metadata keeps the first writer, page objects the last, refused rows and broken PDFs are listed
    once (T01, T02, W01, W02, K09)."""
    pages, _, assets = _fx_inputs(spark, sf_dir)
    pages = checkpoint(pages)
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    progress = scratch_path(spark, "stream-ckpt")
    again = pages.withColumn("html", F.concat("html", F.lit("<!-- again -->")))
    for i, landed in enumerate((pages, again)):
        landed.write.parquet(f"{landing}/{i}")
        SI.stream_ingest(SI.read_page_stream(spark, f"{landing}/*"), assets, JOB, root, progress,
                         extractor_factory=FX.fx_extractor).awaitTermination()
    kind = lambda df, name, key, value: df.select(
        F.lit(name).alias("kind"), F.col(key).alias("key"), F.col(value).alias("value"))
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    objects = ST.manifest(TB.read_objects(spark, f"{root}/objects", JOB, "raw").filter("content_type = 'text/html'"))
    stored = read("rejects").filter("reason = 'element_id already stored'")
    return (kind(TB.read_metadata(spark, f"{root}/metadata"), "metadata", "element_id", "checksum")
            .unionByName(kind(objects, "object", "path", "checksum"))
            .unionByName(kind(read("quarantine").select("element_id", "reason").distinct(), "quarantine", "element_id",
                              "reason"))
            .unionByName(kind(stored.select("element_id", "reason").distinct(), "reject", "element_id", "reason")))


@register(
    "stream_stateful",
    f"""with {O.fx_cte()}, {O.elements_cte()},
    land as (select page_id, 0 as batch, '' as mark from fx where page_id % 3 = 0
      union all select page_id, 1, '<!-- 1 -->' from fx where page_id % 3 < 2
      union all select page_id, 2, '<!-- 2 -->' from fx),
    r as (select e.*, batch, mark, row_number() over (partition by element_id order by batch, depth, coalesce(parent_url, ''),
            {O.KIND_RANK_SQL}, pos, e.page_id) as rn from els e join land l on l.page_id = e.page_id)
    select r.element_id, r.url as "URL", r.type, r.parent_id, cast(r.batch as bigint) as batch,
      case when r.type = 'URL' then sha256(concat(fx.html, r.mark)) else '' end as checksum
    from r join fx on fx.page_id = r.page_id where rn = 1""",
)
def q_stream_stateful(spark, sf_dir):
    """Three landings that repeat pages with other content, the stream restarted from its checkpoint
    before each: the state store keeps the first writer of every element (T02, W01)."""
    pages = checkpoint(FX.fx(spark, sf_dir))
    landing, root, progress = (scratch_path(spark, n) for n in ("landing", "index", "stream-ckpt"))
    for i, most in enumerate((1, 2, 3)):
        landed = pages.filter(F.col("page_id") % 3 < most)
        (landed.withColumn("html", F.concat("html", F.lit(f"<!-- {i} -->"))) if i else landed).write.parquet(f"{landing}/{i}")
        SK.stream_stateful(SI.read_page_stream(spark, f"{landing}/*"), JOB, root, progress).awaitTermination()
    return SK.read_index(spark, root)


@register(
    "objects_mixed",
    f"""with {O.fx_cte()},
    o as (select url, page_id, 0 as version, html as content from fx
      union all select url, page_id, 1, concat(html, '<!-- second -->') from fx where page_id % 2 = 0
      union all select url, page_id, 2, concat(html, '<!-- streamed -->') from fx where page_id % 3 = 0
      union all select url, page_id, 3, concat(html, '<!-- last -->') from fx where page_id % 5 = 0),
    n as (select *, row_number() over (partition by url order by version desc, page_id desc) as rn from o)
    select concat('{JOB}/raw/', sha256(url), '_{JOB}.html') as path, sha256(encode(content)) as checksum,
      octet_length(encode(content)) as size from n where rn = 1""",
)
def q_objects_mixed(spark, sf_dir):
    """One store written by two batch runs, a stream with a fresh checkpoint, a third batch run and a
    replay of the stream's micro-batch (its commit is gone, as after a driver loss): every page's
    newest content is served, whoever wrote it (W02, T01, K01)."""
    pages, _, assets = _fx_inputs(spark, sf_dir)
    pages = checkpoint(pages)
    root, landing, progress = (scratch_path(spark, n) for n in ("mixed", "landing", "stream-ckpt"))
    marked = lambda n, mark: pages.filter(F.col("page_id") % n == 0).withColumn("html", F.concat("html", F.lit(mark)))

    def stream():
        SI.stream_ingest(SI.read_page_stream(spark, landing), assets, JOB, root, progress,
                         extractor_factory=FX.fx_extractor).awaitTermination()

    _write_raw_pages(pages, f"{root}/objects")
    _write_raw_pages(marked(2, "<!-- second -->"), f"{root}/objects")
    marked(3, "<!-- streamed -->").write.parquet(landing)
    stream()
    _write_raw_pages(marked(5, "<!-- last -->"), f"{root}/objects")
    delete_path(spark, f"{progress}/commits")
    stream()
    objects = TB.read_objects(spark, f"{root}/objects", JOB, "raw").filter("content_type = 'text/html'")
    return ST.manifest(objects).select("path", "checksum", "size")


def _build_kb_sql(max_depth: int) -> str:
    head = f"""recursive {_crawl_ctes(max_depth)},
    crawl as (select k.page_id, c.d as depth from reach c join keys k on k.url_key = c.u),
    fxc as (select fx.page_id, fx.url, fx.html, crawl.depth from fx join crawl on crawl.page_id = fx.page_id)"""
    return f"with {O.metadata_sql(prefix=head, src='fxc', depth='depth')} select * from meta"


def _kb(spark, sf_dir, **hooks):
    pages, _, assets = _fx_inputs(spark, sf_dir, written=True)
    first = pages.groupBy().agg(F.min("page_id").alias("page_id"))
    conf = JobConf(job_ts=JOB_TS, max_depth=6)
    return build_kb(spark, pages, assets, conf, scratch_path(spark, "kb"),
                    seeds=pages.join(first, "page_id").select("url"), extractor_factory=FX.fx_extractor, **hooks)


@register("build_kb", _build_kb_sql(6))
def q_build_kb(spark, sf_dir):
    """Whole job from the first fx page: crawl to depth 6, elements with depths, content,
    objects and metadata; the stored metadata is returned."""
    return _kb(spark, sf_dir)["metadata"]


AGAIN_TS = (JOB_TS, "2024-01-02 04:04:05", "2024-01-03 04:04:05")
CHANGED_PAGE, CHANGED_BY = "page_id % 5 = 0", "<p>updated</p>"


def _again_sql() -> str:
    new = f"type = 'URL' and {CHANGED_PAGE}"
    return _build_kb_sql(6).replace("select * from meta", "") + f"""
    , fetched as (select r.page_id, r.url as "URL", r.type, r.status, r.checksum,
        sha256(concat(f.html, '{CHANGED_BY}')) as changed
      from ranked r left join fx f on r.type = 'URL' and f.page_id = r.page_id where r.rn = 1)
    select run, "URL", type, case when run = 3 and {new} then changed else checksum end as checksum,
      run = 2 and status = 200 as served,
      case when type = 'Image' or status <> 200 then null when run = 3 then {new} else run = 1 end as made
    from fetched cross join (select unnest([1, 2, 3]) as run)"""


@register("build_kb_again", _again_sql())
def q_build_kb_again(spark, sf_dir):
    """Three jobs with one cache: the first fetches and converts everything, an hour later every
    cacheable response is served from the cache although every fifth page has changed, and a day
    after that only the changed pages are converted. Per job and stored element: its checksum, if
    its response was served from the cache, if its content was converted by that job (J04, C08)."""
    pages, _, assets = _fx_inputs(spark, sf_dir, written=True)
    first = pages.groupBy().agg(F.min("page_id").alias("page_id"))
    seeds = pages.join(first, "page_id").select("url")
    changed = pages.withColumn("html", F.when(F.expr(CHANGED_PAGE), F.concat("html", F.lit(CHANGED_BY)))
                               .otherwise(F.col("html")))
    root, cache, runs = scratch_path(spark, "kb"), scratch_path(spark, "kb-cache"), []
    for i, ts in enumerate(AGAIN_TS):
        conf = JobConf(job_ts=ts, max_depth=6, extractor_version="fx 1")
        out = build_kb(spark, changed if i else pages, assets, conf, root, seeds=seeds,
                       extractor_factory=FX.fx_extractor, cache=cache)
        rows = out["metadata"].filter(F.col("element_id").endswith(out["job_id"])).withColumnRenamed("URL", "url")
        runs.append(rows.join(out["served"], ["type", "url"], "left").join(out["made"], ["type", "url"], "left").select(
            F.lit(i + 1).alias("run"), F.col("url").alias("URL"), "type", "checksum", "served", "made"))
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


def _hooks_sql(max_depth: int) -> str:
    """As build_kb, over pages reached without links to /es/; every page also yields an element
    for its print form; images are dropped by the item pipeline."""
    sql = _build_kb_sql(max_depth)
    sql = sql.replace("pe as (select e.src, e.dst from edges e join keys k on k.url_key = e.dst)",
                      "pe as (select e.src, e.dst from edges e join keys k on k.url_key = e.dst "
                      "where not contains(e.dst, '/es/'))")
    sql = sql.replace("els as (\n      select concat", """elsx as (select * from els0 union all
      select page_id, concat(url, '#print.pdf'), 'PDF', url, 0 from fxc),
    els as (\n      select concat""").replace("from els0 e join", "from elsx e join")
    # the assets are those of all fx elements, the print forms have no response
    return sql.replace("select * from meta", "select * from meta").replace(
        "partition by element_id order by", "partition by element_id, type = 'Image' order by").replace(
        "from ranked where rn = 1", "from ranked where rn = 1 and type <> 'Image'").replace(
        "from (select distinct url, type from els where type <> 'URL') d)",
        "from (select distinct url, type from els where type <> 'URL' and not contains(url, '#print.pdf')) d)")


@register("build_kb_hooks", _hooks_sql(6))
def q_build_kb_hooks(spark, sf_dir):
    """The whole job with a page callback that adds an element per page, a request hook that keeps
    links to /es/ from being followed, and an item pipeline that drops images (H01-H03)."""
    def printed(parsed):
        return parsed.select("page_id", "depth", F.lit("PDF").alias("type"),
                             F.concat("url", F.lit("#print.pdf")).alias("url"), F.col("url").alias("parent_url"),
                             F.lit(0).alias("pos"))

    return _kb(spark, sf_dir, extractors=[printed], edge_filter=~F.col("dst").contains("/es/"),
               transforms=[lambda rows: rows.filter("type <> 'Image'")])["metadata"]


@register("kb_search_built")
def q_kb_search_built(spark, sf_dir):
    """BM25 top 10 over what the job stored: the processed Markdown of the built knowledge base."""
    objects = _kb(spark, sf_dir)["objects"].filter("stage = 'processed'")
    kb = objects.select("path", F.decode("content", "UTF-8").alias("text"))
    qs = TB.read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    r = SE.kb_search(kb, qs, SEARCH_K, doc_key="path")
    return r.select("query_id", "rank", F.col("doc_id").alias("path"), "score")
