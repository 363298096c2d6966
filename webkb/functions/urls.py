"""URL expressions as native Spark Columns (no Python in the hot path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webkb.conf import DENIED_EXTENSIONS, FOLLOW_SCHEMES

_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"
# scheme, authority, path, query (fragment already removed)
_PARTS = rf"^({_SCHEME})://([^/?#]*)([^?#]*)(\?([^#]*))?"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def drop_fragment(col) -> Column:
    return F.regexp_replace(_c(col), "#.*$", "")


def scheme(col) -> Column:
    return F.lower(F.regexp_extract(_c(col), rf"^({_SCHEME}):", 1))


def host(col) -> Column:
    """Lower-case host (no user info, no port); '' for non-hierarchical URLs."""
    return F.lower(F.regexp_extract(_c(col), rf"^{_SCHEME}://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def url_path(col) -> Column:
    """Path part of an absolute URL ('' when absent)."""
    return F.regexp_extract(_c(col), rf"^{_SCHEME}://[^/?#]*([^?#]*)", 1)


def path_and_query(col) -> Column:
    """Path plus query, '/' when the path is empty (robots matching)."""
    pq = F.regexp_extract(_c(col), rf"^{_SCHEME}://[^/?#]*([^#]*)", 1)
    return F.when(F.substring(pq, 1, 1) == "/", pq).otherwise(F.concat(F.lit("/"), pq))


def path_extension(path_col) -> Column:
    """Lower-case extension of the last path segment (no dot), '' if none.

    Leading dots of a segment do not start an extension (``/.profile``).
    """
    return F.lower(F.regexp_extract(_c(path_col), r"/\.*[^/.][^/]*\.([^./]*)$", 1))


#: Characters that a URL holds as they are, '%' aside (a fixed value: unreserved and reserved).
_KEPT = r"A-Za-z0-9._~!#$&'()*+,/:;=?@\[\]\-"
_PIECES = rf"%[0-9A-Fa-f]{{2}}|[{_KEPT}]+|[^{_KEPT}%]+|%"
#: Not in normal form, as far as one look tells.
_ODD = rf"[^{_KEPT}]|/\.|^[^/]+//[^/?]*:[0-9]*(?:[/?]|$)"
DEFAULT_PORTS = {"http": "80", "https": "443", "ftp": "21"}


def percent_normal(col) -> Column:
    """Normal form of percent-encoding: triplets of unreserved characters are
    decoded, all others upper-cased; a '%' that opens no triplet and every
    character that a URL cannot hold are encoded (UTF-8)."""
    def one(piece: Column) -> Column:
        char = F.chr(F.conv(F.substring(piece, 2, 2), 16, 10).cast("int"))
        triplet = F.when(char.rlike("^[A-Za-z0-9._~-]$"), char).otherwise(F.upper(piece))
        other = F.when(piece.rlike(rf"^[{_KEPT}]"), piece).otherwise(F.replace(F.url_encode(piece), F.lit("+"), F.lit("%20")))
        return F.when(piece == "%", F.lit("%25")).when(F.substring(piece, 1, 1) == "%", triplet).otherwise(other)

    return F.array_join(F.transform(F.regexp_extract_all(_c(col), F.lit(_PIECES), F.lit(0)), one), "")


def remove_dot_segments(path) -> Column:
    """An absolute path without '.' and '..' segments; '..' at the root stays there."""
    segments = F.split(F.substring(_c(path), 2, 1 << 30), "/")
    kept = F.aggregate(segments, F.array().cast("array<string>"), lambda found, s: F.when(s == ".", found).when(
        s == "..", F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0)))).otherwise(F.concat(found, F.array(s))))
    ends = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(
        F.array().cast("array<string>"))
    return F.concat(F.lit("/"), F.array_join(F.concat(kept, ends), "/"))


def canonical_url(col) -> Column:
    """Request identity: fragment dropped, scheme and host lower-cased, the
    scheme's own port dropped, path and query in the normal form of
    percent-encoding, dot segments resolved, empty path made '/', query
    arguments sorted. Non-hierarchical URLs (mailto:, data:) only lose their
    fragment. A URL that is plain already takes the short way."""
    u = drop_fragment(col)
    sch = F.lower(F.regexp_extract(u, _PARTS, 1))
    auth = F.lower(F.regexp_extract(u, _PARTS, 2))
    path = F.regexp_extract(u, _PARTS, 3)
    has_q = F.regexp_extract(u, _PARTS, 4) != ""
    q = F.regexp_extract(u, _PARTS, 5)
    path = F.when(path == "", F.lit("/")).otherwise(path)

    def joined(auth: Column, path: Column, q: Column) -> Column:
        sorted_q = F.array_join(F.array_sort(F.split(q, "&")), "&")
        tail = F.when(has_q & (q != ""), F.concat(F.lit("?"), sorted_q)).otherwise(F.lit(""))
        return F.concat(sch, F.lit("://"), auth, path, tail)

    own = F.regexp_replace(auth, ":$", "")
    for name, port in DEFAULT_PORTS.items():
        own = F.when(sch == name, F.regexp_replace(auth, f":(?:0*{port})?$", "")).otherwise(own)
    normal = joined(own, remove_dot_segments(percent_normal(path)), percent_normal(q))
    hierarchical = F.regexp_extract(u, _PARTS, 1) != ""
    return F.when(hierarchical & u.rlike(_ODD), normal).when(hierarchical, joined(auth, path, q)).otherwise(u)


def denied_extension_regex() -> str:
    """Lower-cased path ends with '.' + a denied extension."""
    return r"\.(?:" + "|".join(e.replace(".", r"\.") for e in DENIED_EXTENSIONS) + r")$"


def is_followable(col) -> Column:
    """Default link extractor filter: allowed scheme, and the lower-cased
    path does not end with a denied extension."""
    ok_scheme = scheme(col).isin(*FOLLOW_SCHEMES)
    return ok_scheme & ~F.lower(url_path(col)).rlike(denied_extension_regex())


def is_pdf_href(col) -> Column:
    """PDF link test on the raw attribute: contains '.pdf' (case-sensitive)
    and the part before the first '?' contains '.pdf' ignoring case."""
    h = _c(col)
    return h.contains(".pdf") & F.lower(F.substring_index(h, "?", 1)).contains(".pdf")


def is_image_src(col) -> Column:
    """Image kept when its src is present and non-empty (a blank is kept)."""
    s = _c(col)
    return s.isNotNull() & (s != "")


def percent_encode(col) -> Column:
    """Percent-encoding with '/' kept, as the standard quote() does."""
    e = F.url_encode(_c(col))
    e = F.replace(e, F.lit("+"), F.lit("%20"))
    e = F.replace(e, F.lit("%2F"), F.lit("/"))
    e = F.replace(e, F.lit("%7E"), F.lit("~"))
    return F.replace(e, F.lit("*"), F.lit("%2A"))


def site_matches(host_col, sites: list[str]) -> Column:
    """Host equals a site or is a sub-domain of it; a site given as a URL
    prefix (with scheme) matches by prefix instead."""
    h = _c(host_col)
    cond = F.lit(False)
    for s in sites:
        s_low = s.lower()
        if "://" in s_low:
            continue
        cond = cond | (h == s_low) | h.endswith("." + s_low)
    return cond


def url_prefix_matches(url_col, sites: list[str]) -> Column:
    u = _c(url_col)
    cond = F.lit(False)
    for s in sites:
        if "://" in s:
            cond = cond | u.startswith(s)
    return cond
