"""Derived test inputs, built from the driver tables by the same SQL text in
Spark and in DuckDB (``{pages}``-style placeholders name the inputs).

- ``fx``: pages with linked neighbours, PDF links and images injected;
- ``fx_attempts``: a fetch-attempt log made from ``events``;
- ``fx_robots``: robots rules per host;
- ``fx_assets``: PDF and image responses of elements;
- ``fx_pdf_files``: whole document texts as files for an extractor.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# what the files of these fixtures start with, and where their extractor ends a page
PDF_HEADER = "%PDF-1.4"
LINES_PER_PAGE = 40

FX_SQL = """
select p.page_id, regexp_replace(p.url, '#.*$', '') as url,
  replace(p.html, '</article>', concat(
    '<a href="', n1.url, '">next</a>',
    '<a href="', n2.url, '" rel="nofollow">alt</a>',
    '<a href="', n1.url, '">again</a>',
    '<a href="/files/', cast(p.page_id % 17 as string), '.pdf?v=1">doc</a>',
    '<a href="/files/', cast(p.page_id % 17 as string), '.pdf#sec">doc</a>',
    '<a href="/BROCHURE.PDF">no</a><a href="/view?f=x.pdf">no</a><a href="mailto:a@b">m</a>',
    '<img src="/img/', cast(p.page_id % 10 as string), '.png"><img src=""><img alt="x"></article>')) as html
from (select page_id, url, html,
             (page_id * 3 + 1) % (select count(*) from {pages}) as k1,
             (page_id * 7 + 2) % (select count(*) from {pages}) as k2
      from {pages}) p
join (select page_id, url from {pages}) n1 on n1.page_id = p.k1
join (select page_id, url from {pages}) n2 on n2.page_id = p.k2
"""

FX_ATTEMPTS_SQL = """
select e.event_id as attempt_id, p.url, e.ts,
  case e.event_type when 'view' then 200 when 'click' then 200
       when 'purchase' then 404 when 'signup' then 429 else 503 end as status
from (select event_id, ts, event_type, user_id % (select count(*) from {pages}) as k from {events}) e
join (select page_id, url from {pages}) p on p.page_id = e.k
"""

FX_ROBOTS_SQL = """
with h as (select distinct lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) as host from {pages})
select host, '*' as agent, 'disallow' as directive, '/en/' as path from h where length(host) % 2 = 0
union all select host, '*', 'allow', '/en/5' from h where length(host) % 3 = 0
union all select host, '*', 'disallow', '/de' from h where length(host) % 5 = 0
"""

def sql_text(template: str, dialect: str, **names: str) -> str:
    """Fill the table placeholders."""
    return template.format(**names)


def pdf_bytes_sql(body: str, dialect: str, broken: str = "false") -> str:
    """SQL expression: a file that the fixtures' extractor reads as ``body``,
    or refuses where ``broken`` holds."""
    text = f"concat(case when {broken} then 'no header' else '{PDF_HEADER}' end, chr(10), {body})"
    return f"encode({text}, 'UTF-8')" if dialect == "spark" else f"encode({text})"


def fx_extractor(method: str) -> Callable[[bytes], list[tuple]]:
    """The fixtures' extractor: a block per line, a page per 40 lines."""
    def extract(content: bytes) -> list[tuple]:
        head, found, body = content.decode("utf-8").partition("\n")
        if head != PDF_HEADER:
            raise ValueError("not a PDF file")
        lines = body.split("\n") if body else []
        return [("text", line, i // LINES_PER_PAGE) for i, line in enumerate(lines)]

    return extract


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dealt by page id, as a page table of many files would be: the driver's
    small tables are one file each."""
    pages = _read(spark, sf_dir, "pages")
    made = spark.sql(sql_text(FX_SQL, "spark", pages="{pages}"), pages=pages)
    return made.repartition(spark.sparkContext.defaultParallelism, "page_id")


def fx_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    events = _read(spark, sf_dir, "events")
    return spark.sql(sql_text(FX_ATTEMPTS_SQL, "spark", pages="{pages}", events="{events}"), pages=pages,
                     events=events)


def fx_robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return spark.sql(sql_text(FX_ROBOTS_SQL, "spark", pages="{pages}"), pages=pages)


#: Page URLs in other spellings; the same text in both dialects.
SPELLINGS = """
select page_id, url, spelling, case spelling
    when 0 then concat(sch, '://', h, '/./a/%2e%2E', tail)
    when 1 then concat(upper(sch), '://', h, case when sch = 'https' then ':443' else ':80' end, tail)
    when 2 then concat(sch, '://', h, replace(tail, 'e', '%65'))
    when 3 then concat(sch, '://', h, '/na\u00efve \u00e9|"q"', tail)
    when 4 then concat(sch, '://', h, '/na%c3%afve%20%C3%A9%7c%22q%22', tail)
    else concat(sch, '://', h, ':8080/../../%zz%2Fb/.', tail) end as raw
from (select page_id, url, spelling, split_part(url, '://', 1) as sch,
        split_part(split_part(url, '://', 2), '/', 1) as h,
        substr(url, length(split_part(url, '://', 1)) + length(split_part(split_part(url, '://', 2), '/', 1)) + 4) as tail
      from (select page_id, url, {six} as spelling from {pages}) p) t
"""


def fx_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, url, spelling, raw)``: each page URL in six other spellings."""
    return spark.sql(SPELLINGS.replace("{six}", "explode(sequence(0, 5))"),
                     pages=_read(spark, sf_dir, "pages"))


def duck_fx_spellings() -> str:
    return SPELLINGS.format(pages="pages", six="unnest(range(6))")


BROKEN_DOC = "doc_id % 50 = 7"
BROKEN_ASSET = "length(url) % 11 = 0"


def fx_pdf_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, content)``: each document's whole text as a file; every
    fiftieth file is broken."""
    return _read(spark, sf_dir, "documents").selectExpr(
        "doc_id", f"{pdf_bytes_sql('text', 'spark', BROKEN_DOC)} as content")


def fx_assets(elements: DataFrame) -> DataFrame:
    """``(url, status, content_type, content)``: 404 when ``length(url) % 7
    = 0``; no content type when ``length(url) % 3 = 0``; PDFs carry a file
    whose text is the URL (broken when ``length(url) % 11 = 0``), images the
    bytes ``asset:<url>``."""
    d = elements.filter(F.col("type") != "URL").select("url", "type").distinct()
    return d.select(
        "url",
        F.when(F.length("url") % 7 == 0, F.lit(404)).otherwise(F.lit(200)).alias("status"),
        F.when(F.length("url") % 3 == 0, F.lit(None).cast("string"))
        .when(F.col("type") == "PDF", F.lit("application/pdf"))
        .otherwise(F.lit("image/png"))
        .alias("content_type"),
        F.when(F.col("type") == "PDF", F.expr(pdf_bytes_sql("url", "spark", BROKEN_ASSET)))
        .otherwise(F.encode(F.concat(F.lit("asset:"), F.col("url")), "UTF-8"))
        .alias("content"),
    )


def neighbour_links(static_pages: DataFrame, n_pages: int) -> Callable[[DataFrame], DataFrame]:
    """Stream-static form of ``fx``: each arriving page gets links to two
    stored neighbour pages, two PDFs and images."""
    n1 = static_pages.select(F.col("page_id").alias("n1_id"), F.col("url").alias("n1_url"))
    n2 = static_pages.select(F.col("page_id").alias("n2_id"), F.col("url").alias("n2_url"))
    # the same literals as FX_SQL
    body = FX_SQL[FX_SQL.index("regexp_replace(p.url"):FX_SQL.index("\nfrom (select")]
    body = body.replace("p.", "").replace("n1.url", "n1_url").replace("n2.url", "n2_url")
    url_sql, _, html_sql = body.partition(" as url,")

    def t(p: DataFrame) -> DataFrame:
        p = p.withColumn("k1", (F.col("page_id") * 3 + 1) % F.lit(n_pages)).withColumn(
            "k2", (F.col("page_id") * 7 + 2) % F.lit(n_pages))
        j = p.join(n1, F.col("k1") == F.col("n1_id")).join(n2, F.col("k2") == F.col("n2_id"))
        return j.selectExpr("page_id", f"{url_sql} as url", html_sql)

    return t


# DuckDB forms (the oracle side), as CTE bodies over the driver views.
def duck_fx() -> str:
    return sql_text(FX_SQL, "duckdb", pages="pages")


def duck_fx_attempts() -> str:
    return sql_text(FX_ATTEMPTS_SQL, "duckdb", pages="pages", events="events")


def duck_fx_robots() -> str:
    return sql_text(FX_ROBOTS_SQL, "duckdb", pages="pages")
