"""Ids, checksums, object keys, extensions and content types (native)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webkb.conf import DEFAULT_IMAGE_EXTENSION, JOB_ID_FORMAT, MIME_BY_EXTENSION


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def element_id(url, job) -> Column:
    """``sha256hex(url) + '_' + job_id`` over the exact URL (fragment kept)."""
    return F.concat(F.sha2(_c(url), 256), F.lit("_"), _c(job) if not isinstance(job, str) else F.lit(job))


def checksum(col) -> Column:
    """SHA-256 hex of a string (UTF-8 bytes) or of a binary column."""
    return F.sha2(_c(col), 256)


def job_id(ts) -> Column:
    """Job id from a timestamp, ``yyyyMMdd_HHmmss``."""
    t = F.to_timestamp(F.lit(ts)) if isinstance(ts, str) else _c(ts)
    return F.date_format(t, JOB_ID_FORMAT)


def extension(col) -> Column:
    """'.' + lower-cased text after the last dot; '.jpeg' when no dot."""
    c = _c(col)
    return F.when(F.instr(c, ".") > 0, F.concat(F.lit("."), F.lower(F.substring_index(c, ".", -1)))).otherwise(
        F.lit(DEFAULT_IMAGE_EXTENSION)
    )


def raw_path(job, eid, typ, ext_source=None) -> Column:
    """Raw object key: ``{job}/raw/{id}.html|.pdf|<image extension>``.

    The image extension is taken from ``ext_source`` (the element id by
    default, which has no dot, hence '.jpeg')."""
    j, e, t = _c(job), _c(eid), _c(typ)
    img_ext = extension(ext_source if ext_source is not None else e)
    ext = F.when(t == "URL", F.lit(".html")).when(t == "PDF", F.lit(".pdf")).otherwise(img_ext)
    return F.concat(j, F.lit("/raw/"), e, ext)


def processed_path(job, eid, typ) -> Column:
    """Processed key ``{job}/processed/{id}.md``; '' for images."""
    j, e, t = _c(job), _c(eid), _c(typ)
    return F.when(t == "Image", F.lit("")).otherwise(F.concat(j, F.lit("/processed/"), e, F.lit(".md")))


def _mime_map() -> Column:
    kv = []
    for k, v in MIME_BY_EXTENSION.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def guessed_content_type(path) -> Column:
    """Mime type from the last extension of the path's final segment."""
    ext = F.regexp_extract(_c(path), r"(?:^|/)\.*[^/.][^/]*\.([^./]*)$", 1)
    exact = F.element_at(_mime_map(), ext)
    return F.when(ext == "", F.lit(None).cast("string")).otherwise(
        F.coalesce(exact, F.element_at(_mime_map(), F.lower(ext)))
    )


def content_type(path, explicit=None) -> Column:
    """Explicit content type when given, else guessed from the path."""
    guessed = guessed_content_type(path)
    if explicit is None:
        return guessed
    return F.coalesce(_c(explicit), guessed)


def stem(col) -> Column:
    """Base name up to its first dot (``/tmp/a.b.pdf`` -> ``a``)."""
    return F.substring_index(F.substring_index(_c(col), "/", -1), ".", 1)


def dirname(col) -> Column:
    """Everything before the last '/' ('' when none)."""
    return F.regexp_extract(_c(col), r"^(.*)/[^/]*$", 1)


def join_path(*parts) -> Column:
    return F.concat_ws("/", *[_c(p) for p in parts])
