"""Declared schemas of the tables the pipeline reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# One metadata row per element (seven columns of the stored row).
METADATA = T.StructType(
    [
        T.StructField("element_id", S, False),
        T.StructField("URL", S, False),
        T.StructField("type", S, False),
        T.StructField("raw_content_path", S, False),
        T.StructField("processed_content_path", S, False),
        T.StructField("checksum", S, False),
        T.StructField("parent_id", S, True),
    ]
)
METADATA_COLUMNS = [f.name for f in METADATA.fields]

# Stored metadata adds the partition column job_id.
METADATA_STORED = T.StructType(METADATA.fields + [T.StructField("job_id", S, False)])

# As its files are laid out: by job, type and the leading digits of the key.
METADATA_FILES = T.StructType(METADATA_STORED.fields + [T.StructField("key_prefix", S, False)])

# Parsed items of one page: links, areas and images in document order.
PARSED_ITEM = T.StructType(
    [
        T.StructField("kind", S, False),  # 'a' | 'area' | 'img'
        T.StructField("pos", T.IntegerType(), False),  # ordinal within its group
        T.StructField("value", S, True),  # attribute value as decoded
        T.StructField("abs_url", S, True),  # joined with the page URL
        T.StructField("link_url", S, True),  # stripped, joined with <base>
        T.StructField("nofollow", T.BooleanType(), False),
    ]
)
PARSED = T.ArrayType(PARSED_ITEM)

# One parsed page: its items, and why it could not be read to its end.
PARSED_PAGE = T.StructType([T.StructField("items", PARSED, False), T.StructField("error", S, True)])

# Stored object (raw or processed content), partitioned by job_id, stage.
# ``version`` counts the writes (runs or micro-batches), ``row`` tells all
# rows apart: the last writer of a path has the largest (version, order_key).
OBJECT = T.StructType(
    [
        T.StructField("path", S, False),
        T.StructField("element_id", S, False),
        T.StructField("content", T.BinaryType(), True),
        T.StructField("content_type", S, True),
        T.StructField("checksum", S, True),
        T.StructField("metadata", T.MapType(S, S), True),
        T.StructField("order_key", T.LongType(), True),
        T.StructField("version", T.LongType(), False),
        T.StructField("row", T.LongType(), False),
        T.StructField("job_id", S, False),
        T.StructField("stage", S, False),
    ]
)

FETCH = T.StructType(
    [
        T.StructField("attempt_id", T.LongType(), False),
        T.StructField("url", S, False),
        T.StructField("ts", T.TimestampType(), False),
        T.StructField("status", T.IntegerType(), False),
    ]
)

ASSET = T.StructType(
    [
        T.StructField("url", S, False),
        T.StructField("status", T.IntegerType(), True),
        T.StructField("content_type", S, True),
        T.StructField("content", T.BinaryType(), True),
    ]
)

PDF_BLOCK = T.StructType(
    [
        T.StructField("type", S, False),
        T.StructField("text", S, True),
        T.StructField("page_idx", T.IntegerType(), False),
    ]
)

# Rows that did not become metadata, with the stage and the reason.
QUARANTINE = T.StructType(
    [
        T.StructField("element_id", S, True),
        T.StructField("url", S, True),
        T.StructField("type", S, True),
        T.StructField("parent_id", S, True),
        T.StructField("stage", S, False),
        T.StructField("reason", S, False),
        T.StructField("job_id", S, False),
    ]
)
REJECT = T.StructType([T.StructField(f.name, f.dataType, True) for f in METADATA.fields]
                      + [T.StructField("reason", S, False), T.StructField("job_id", S, False)])

# Kept responses, partitioned by kind ('page', 'asset') and day. ``key`` is what
# is requested (a page's canonical URL, an asset's URL), ``ts_us`` when, in UTC.
RESPONSE = T.StructType(
    [
        T.StructField("key", S, False),
        T.StructField("page_id", T.LongType(), True),
        T.StructField("url", S, False),
        T.StructField("status", T.IntegerType(), True),
        T.StructField("content_type", S, True),
        T.StructField("content", T.BinaryType(), True),
        T.StructField("ts_us", T.LongType(), False),
        T.StructField("kind", S, False),
        T.StructField("day", S, False),
    ]
)

# Kept conversions by content, and as their files are laid out.
CONVERSION = T.StructType(
    [
        T.StructField("key", S, False),
        T.StructField("markdown", S, True),
        T.StructField("n_pages", T.IntegerType(), True),
        T.StructField("has_text_layer", T.BooleanType(), True),
        T.StructField("blocks", T.ArrayType(PDF_BLOCK), True),
    ]
)
CONVERSION_FILES = T.StructType(CONVERSION.fields + [T.StructField("options", S, False),
                                                     T.StructField("key_prefix", S, False)])
