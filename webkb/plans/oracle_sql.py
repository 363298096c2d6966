"""DuckDB oracle fragments: the same fixtures, and regex-based extraction
as an independent second path to the HTML parser."""

from __future__ import annotations

from webkb.sources.fixtures import BROKEN_ASSET, duck_fx, duck_fx_attempts, duck_fx_robots, pdf_bytes_sql

JOB = "20240102_030405"

SCHEME_RE = "^[A-Za-z][A-Za-z0-9+.-]*:"
ORIGIN_RE = "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
PARTS_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?([^#]*))?"


def resolve(base: str, href: str) -> str:
    """SQL form of joining a reference with a base URL (no dot segments)."""
    return f"""(case
      when regexp_matches({href}, '{SCHEME_RE}') then {href}
      when starts_with({href}, '//') then concat(regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1), ':', {href})
      when starts_with({href}, '/') then concat(regexp_extract({base}, '{ORIGIN_RE}', 1), {href})
      when {href} = '' then {base}
      when starts_with({href}, '#') then concat(regexp_replace({base}, '#.*$', ''), {href})
      when starts_with({href}, '?') then concat(regexp_replace({base}, '[?#].*$', ''), {href})
      else concat(regexp_replace(regexp_replace({base}, '[?#].*$', ''), '[^/]*$', ''), {href}) end)"""


def canonical(u: str) -> str:
    """SQL form of the canonical request URL."""
    v = f"regexp_replace({u}, '#.*$', '')"
    return f"(case when regexp_extract({v}, '{PARTS_RE}', 1) <> '' then {normal_url(u)} else {v} end)"


def normal_url(u: str) -> str:
    """SQL form of the request URL of a hierarchical URL in any spelling, without
    the engine's short way for plain ones. Dot segments are resolved on a growing text here, not on a list."""
    kept = r"A-Za-z0-9._~!#$&''()*+,/:;=?@\[\]\-"
    v = f"regexp_replace({u}, '#.*$', '')"
    part = lambda i: f"regexp_extract({v}, '{PARTS_RE}', {i})"
    char = "chr(cast(concat('0x', substr(t, 2, 2)) as integer))"
    pieces = lambda x: f"regexp_extract_all({x}, '%[0-9A-Fa-f]{{2}}|[{kept}]+|[^{kept}%]+|%')"
    plain = lambda x: f"""array_to_string(list_transform({pieces(x)}, lambda t:
      case when t = '%' then '%25' when starts_with(t, '%') and regexp_full_match({char}, '[A-Za-z0-9._~-]') then {char}
           when starts_with(t, '%') then upper(t) when regexp_matches(t, '^[{kept}]') then t else url_encode(t) end), '')"""  # noqa: E731
    segments = f"(string_split({plain(part(3))}, '/'))[2:]"
    path = f"""concat(list_reduce({segments}, lambda a, s: case s when '.' then a
      when '..' then regexp_replace(a, '/[^/]*$', '') else concat(a, '/', s) end, ''),
      case when list_last({segments}) in ('.', '..') then '/' else '' end)"""
    port = f"""case lower({part(1)}) when 'http' then ':0*80$|:$' when 'https' then ':0*443$|:$'
      when 'ftp' then ':0*21$|:$' else ':$' end"""
    return f"""concat(lower({part(1)}), '://', regexp_replace(lower({part(2)}), {port}, ''),
      case when {part(3)} = '' then '/' else {path} end, case when {part(5)} <> '' then
        concat('?', array_to_string(list_sort(string_split({plain(part(5))}, '&')), '&')) else '' end)"""


FOLLOW_SCHEMES_SQL = "('http', 'https', 'ftp', 'file')"


def followable(u: str) -> str:
    """Scheme and extension rules, told by the last dotted parts of the path
    rather than by a pattern: ``tar.gz`` is the one entry of two parts."""
    from webkb.conf import DENIED_EXTENSIONS

    path = f"lower(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1))"
    denied = ", ".join(f"'{e}'" for e in DENIED_EXTENSIONS)
    parts = f"string_split({path}, '.')"
    return (f"(lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) in {FOLLOW_SCHEMES_SQL} "
            f"and not (contains({path}, '.') and ({parts}[-1] in ({denied}) "
            f"or (len({parts}) > 2 and concat({parts}[-2], '.', {parts}[-1]) in ({denied})))))")


def host(u: str) -> str:
    return f"lower(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1))"


def fx_cte() -> str:
    return f"fx as ({duck_fx()})"


def anchors_cte(src: str = "fx", name: str = "anchors") -> str:
    """``anchors(page_id, page_url, pos, href, nofollow)`` by regex over the tags."""
    return f"""{name} as (
      select page_id, page_url, pos, regexp_extract(tag, 'href="([^"]*)"', 1) as href,
             regexp_matches(tag, 'rel="[^"]*nofollow') as nofollow
      from (select page_id, page_url, cast(unnest(range(len(ts))) as integer) as pos, unnest(ts) as tag
            from (select page_id, url as page_url,
                         regexp_extract_all(html, '<a\\s[^>]*href="[^"]*"[^>]*>', 0) as ts from {src}) t0) t)"""


def images_cte(src: str = "fx", name: str = "imgs") -> str:
    return f"""{name} as (
      select page_id, page_url, cast(unnest(range(len(ss))) as integer) as pos, unnest(ss) as src
      from (select page_id, url as page_url,
                   regexp_extract_all(html, '<img\\s[^>]*src="([^"]+)"', 1) as ss from {src}) t)"""


def elements_cte(job: str = JOB, src: str = "fx", depth: str = "0") -> str:
    """``els(element_id, url, type, parent_url, parent_id, depth, pos, page_id, job_id)`` over ``src``
    (``src`` has page_id, url, html and the column named by ``depth``)."""
    return f"""{anchors_cte(src, src + '_a')}, {images_cte(src, src + '_i')},
    els0 as (
      select page_id, url, 'URL' as type, cast(null as varchar) as parent_url, 0 as pos from {src}
      union all
      select page_id, {resolve('page_url', 'href')} as url, 'PDF', page_url, pos from {src}_a
       where contains(href, '.pdf') and contains(lower(split_part(href, '?', 1)), '.pdf')
      union all
      select page_id, {resolve('page_url', 'src')} as url, 'Image', page_url, pos from {src}_i where src <> ''),
    els as (
      select concat(sha256(e.url), '_', '{job}') as element_id, e.url, e.type, e.parent_url,
             case when e.parent_url is not null then concat(sha256(e.parent_url), '_', '{job}') end as parent_id,
             cast(s.d as integer) as depth, cast(e.pos as integer) as pos, e.page_id, '{job}' as job_id
      from els0 e join (select page_id, {depth} as d from {src}) s on s.page_id = e.page_id)"""


__all__ = [
    "JOB", "resolve", "canonical", "host", "fx_cte", "anchors_cte", "images_cte", "elements_cte",
    "duck_fx_attempts", "duck_fx_robots", "pdf_bytes_sql",
]


KIND_RANK_SQL = "(case type when 'URL' then 0 when 'PDF' then 1 else 2 end)"


def ext_sql(c: str) -> str:
    return (f"(case when instr({c}, '.') > 0 then concat('.', lower(regexp_extract({c}, '([^.]*)$', 1))) "
            f"else '.jpeg' end)")


def raw_path_sql(job: str, eid: str, typ: str) -> str:
    return (f"concat({job}, '/raw/', {eid}, case {typ} when 'URL' then '.html' when 'PDF' then '.pdf' "
            f"else {ext_sql(eid)} end)")


def processed_path_sql(job: str, eid: str, typ: str) -> str:
    return f"(case when {typ} = 'Image' then '' else concat({job}, '/processed/', {eid}, '.md') end)"


def assets_cte() -> str:
    """fx_assets over the distinct PDF/Image URLs of ``els``."""
    return f"""assets as (
      select url,
        case when length(url) % 7 = 0 then 404 else 200 end as status,
        case when length(url) % 3 = 0 then null when type = 'PDF' then 'application/pdf' else 'image/png' end
          as content_type,
        case when type = 'PDF' then {pdf_bytes_sql('url', 'duckdb', BROKEN_ASSET)} else encode(concat('asset:', url)) end
          as content
      from (select distinct url, type from els where type <> 'URL') d)"""


FAILED_PDF = f"(e.type = 'PDF' and a.status = 200 and {BROKEN_ASSET.replace('url', 'a.url')})"


def rows_cte(keep: str = f"not coalesce({FAILED_PDF}, false)") -> str:
    """Elements of fx with checksum and paths filled (status 200 gates);
    PDFs that cannot be converted have no row."""
    ok = "(e.type = 'URL' or a.status = 200)"
    return f"""rows as (
      select e.element_id, e.url, e.type, e.parent_url, e.parent_id, e.depth, e.pos, e.page_id, e.job_id,
        case when e.type = 'URL' then sha256(f.html) when a.status = 200 then sha256(a.content) else '' end
          as checksum,
        case when {ok} then {raw_path_sql('e.job_id', 'e.element_id', 'e.type')} else '' end as raw_content_path,
        case when {ok} then {processed_path_sql('e.job_id', 'e.element_id', 'e.type')} else '' end
          as processed_content_path,
        case when e.type = 'URL' then 200 else a.status end as status
      from els e
      left join fx f on e.type = 'URL' and f.page_id = e.page_id
      left join assets a on e.type <> 'URL' and a.url = e.url
      where {keep})"""


def ranked_cte(desc: bool = False) -> str:
    d = " desc" if desc else ""
    return f"""ranked as (
      select *, row_number() over (partition by element_id order by depth{d}, coalesce(parent_url, ''){d},
             {KIND_RANK_SQL}{d}, pos{d}, page_id{d}) as rn from rows)"""


def metadata_sql(prefix: str | None = None, src: str = "fx", depth: str = "0") -> str:
    """First-writer metadata rows (all CTEs) of the pages in ``src``;
    assets are those of all fx elements."""
    head = prefix if prefix is not None else fx_cte()
    return f"""{head}, {elements_cte(src=src, depth=depth)}, {assets_cte()}, {rows_cte()}, {ranked_cte()},
    meta as (select element_id, url as URL, type, raw_content_path, processed_content_path, checksum, parent_id
             from ranked where rn = 1)"""
