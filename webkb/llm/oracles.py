"""DuckDB SQL for the operators whose result SQL can express."""

from __future__ import annotations

from webkb.llm.decontam import MASKS, SPAN

#: Words as the contracts define them.
WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


def _masked(words: str, at: str, mask: tuple[int, ...]) -> str:
    return "concat_ws(' ', " + ", ".join(f"{words}[{at} + {p + 1}]" for p in mask) + ")"


def _seeds(table: str, name: str) -> str:
    """One row per window (``pos``, from 0) and mask of ``table`` (..., w)."""
    windows = f"(select *, unnest(range(0, len(w) - {SPAN - 1})) as pos from {table})"
    return f"{name} as (" + " union all ".join(
        f"select *, {m} as mask, {_masked('w', 'pos', mask)} as seed from {windows} t{m}"
        for m, mask in enumerate(MASKS)) + ")"


def _tokens(column: str) -> str:
    return f"list_filter(string_split_regex(lower(coalesce({column}, '')), '[^\\p{{L}}\\p{{N}}\\p{{M}}]+'), lambda x: x <> '')"


DECONTAMINATION = f"""
with d as (select doc_id, {_tokens('text')} as w from documents),
i as (select distinct item_id, {_tokens('text')} as w from benchmark),
{_seeds('d', 'ds')}, {_seeds('i', 'bs')},
hits as (select distinct ds.doc_id, ds.w, bs.item_id, bs.w as item, bs.pos as item_at, ds.pos - bs.pos as shift
         from ds join bs on ds.mask = bs.mask and ds.seed = bs.seed),
al as (select *, greatest(0, -shift) as lo, least(len(item), len(w) - shift) as hi, least(13, len(item)) as need from hits),
eq as (select *, hi - lo as n, list_transform(range(lo, hi), lambda p: cast(item[p + 1] = w[p + shift + 1] as integer)) as e from al),
st as (select *, list_max(list_transform(
           range(greatest(0, item_at - lo - need + 1), least(n - need, item_at - lo + {SPAN - 1}) + 1),
           lambda k: list_sum(e[k + 1:k + need]))) as stretch from eq where n >= need),
ok as (select doc_id, item_id, len(item) as item_words, n as overlap_words, cast(list_sum(e) as integer) as equal_words
       from st where stretch >= need * 0.8),
r as (select *, row_number() over (partition by doc_id, item_id order by equal_words desc, overlap_words desc) as rn from ok)
select doc_id, item_id, cast(item_words as integer) as item_words, cast(overlap_words as integer) as overlap_words, equal_words
from r where rn = 1"""

SUBSTRINGS = f"""
with d as (select doc_id, {WORDS} as w from documents),
win as (select doc_id, i, array_to_string(w[i:i + 49], ' ') as seq
        from (select *, unnest(range(1, len(w) - 48)) as i from d) t),
firsts as (select seq, min(doc_id) as first from win group by seq),
gone as (select distinct doc_id, unnest(range(i, i + 50)) as j
         from win join firsts using (seq) where firsts.first < win.doc_id),
word as (select doc_id, unnest(range(1, len(w) + 1)) as j, unnest(w) as x from d),
kept as (select doc_id, count(*) as n, string_agg(x, ' ' order by j) as s from word anti join gone using (doc_id, j)
         group by doc_id)
select d.doc_id, len(d.w) as n_words, len(d.w) - coalesce(k.n, 0) as n_removed, sha256(coalesce(k.s, '')) as kept_sha256
from d left join kept k on k.doc_id = d.doc_id"""

ARCHIVES = """
with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
n as (select page_id, payload, octet_length(payload) as payload_bytes, max(page_id) over (partition by payload) as top from p)
select page_id, payload_bytes, sha1(payload) as payload_digest,
  case when payload_bytes >= 1000 and top <> page_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and top <> page_id then top end as refers_to from n"""

FILTER_AUDIT = f"""
with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, {WORDS} as w from documents),
f as (select doc_id, part, list_filter([
        case when len(w) < 200 then 'A' end, case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' end,
        case when 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) then 'C' end,
        case when regexp_matches(t, '[#$%&*|]') then 'D' end,
        case when doc_id > min(doc_id) over (partition by t) then 'E' end], lambda x: x is not null) as fails from d),
l as (select doc_id, max(quality) as quality, max(toxic) as toxic from labels group by doc_id),
m as (select part, fails, count(*) as n, count(*) filter (quality = 1) as good, count(*) filter (toxic = 1) as toxic
      from f left join l using (doc_id) group by part, fails),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as c),
orders as (select a.c || b.c || c.c || d.c || e.c as filter_order from x a, x b, x c, x d, x e
           where len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
steps as (select filter_order, step, filter_order[step] as here, filter_order[1:step - 1] as before
          from orders, (select unnest(range(1, 6)) as step) s),
r as (select part, filter_order, step, here,
        sum(n) filter (not list_has_any(fails, string_split(before || here, ''))) as kept,
        sum(n) filter (list_contains(fails, here) and not list_has_any(fails, string_split(before, ''))) as removed,
        sum(n) filter (list_contains(fails, here) and list_has_any(fails, string_split(before, ''))) as redundant,
        sum(n) filter (fails = [here]) as unique_fails,
        sum(good) filter (list_contains(fails, here) and not list_has_any(fails, string_split(before, ''))) as good_lost,
        sum(toxic) filter (list_contains(fails, here) and not list_has_any(fails, string_split(before, ''))) as toxic_lost
      from m, steps group by all)
select part, filter_order, cast(step as integer) as step, cast(coalesce(kept, 0) as bigint) as kept,
  cast(coalesce(removed, 0) as bigint) as removed, cast(coalesce(redundant, 0) as bigint) as redundant,
  cast(coalesce(unique_fails, 0) as bigint) as unique_fails, cast(coalesce(good_lost, 0) as bigint) as good_lost,
  cast(coalesce(toxic_lost, 0) as bigint) as toxic_lost,
  cast(sum(coalesce(removed, 0)) over (partition by part, here) as bigint) as shapley from r"""

FILL_IN_MIDDLE = """
with d as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as w,
             sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
n as (select *, len(w) as n, list_transform(range(0, 4), lambda i: cast('0x' || h[8 * i + 1:8 * i + 8] as bigint)) as k from d),
c as (select *, least(k[1] % (n + 1), k[2] % (n + 1)) as a, greatest(k[1] % (n + 1), k[2] % (n + 1)) as b,
        case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or k[3] % 100 >= 90 then 'plain'
             when k[4] % 100 < 20 then 'spm' else 'psm' end as form from n),
p as (select *, array_to_string(w[1:a], '') as prefix, array_to_string(w[a + 1:b], '') as middle,
        array_to_string(w[b + 1:], '') as suffix from c)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
  case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(t) as restored_sha256 from p"""
