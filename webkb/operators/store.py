"""Keyed sinks: objects, manifest, metadata insert with a primary key,
validation, quarantine and rejects.

Parquet has no primary key or MERGE. Metadata keys are enforced by
validation, a first-writer aggregation inside the batch and a lookup of the
stored keys, then an append: re-running an insert adds no rows. Stored rows
are laid out by the leading digits of their key, in key order and with a
Bloom filter, so a lookup reads the files its keys can be in. Objects are
appended with a version and the last writer of a path is what readers see, so
a later upload of a key replaces the earlier one; batch runs and streams take
their versions from one series kept beside the store. One writer per table at
a time is assumed.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webkb.conf import ELEMENT_TYPES
from webkb.operators.elements import meta_columns, order_struct
from webkb.schema import METADATA_COLUMNS, METADATA_FILES, METADATA_STORED, OBJECT, QUARANTINE, REJECT
from webkb.session import checkpoint, delete_path
from webkb.sources.tables import object_rows, overwritten_rows

KEY_LAYOUT = ("job_id", "type", "key_prefix")
#: Leading digits of an element id that name a partition: 16 to the power of it a job and type.
KEY_DIGITS = 1
#: A lookup of at most so many keys sends them to the reader one by one.
PUSHED_KEYS = 256
#: Runs whose versions are remembered; a stream replays its last micro-batch only.
KEPT_VERSIONS = 100


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p)


# ---------------------------------------------------------------------------
# first / last writer per key (aggregations, so hot keys combine map-side)
# ---------------------------------------------------------------------------
def first_writer(rows: DataFrame, key: str = "element_id", last: bool = False,
                 order: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """``(winners, losers)`` per ``key`` by the declared arrival order.

    The winner is a ``min_by``/``max_by`` over the order (a partial
    aggregation, safe when one key holds a large share of rows); a hash of
    the row breaks ties so the choice is deterministic. Losers come from a
    join back on the key, which adaptive execution splits when a key is
    hot."""
    o = order if order is not None else order_struct()
    cols = list(rows.columns)
    hashable = [c for c in cols if not isinstance(rows.schema[c].dataType, T.MapType)]
    packed = rows.select(
        F.col(key).alias("_k"),
        F.struct(o.alias("o"), F.xxhash64(*hashable).alias("h")).alias("_o"),
        F.struct(*cols).alias("_r"),
    )
    pick = F.max_by if last else F.min_by
    best = F.max if last else F.min
    win = packed.groupBy("_k").agg(pick("_r", "_o").alias("_w"), best("_o").alias("_wo"))
    winners = win.select("_w.*")
    losers = packed.join(win.select("_k", "_wo"), "_k").filter(F.col("_o") != F.col("_wo")).select("_r.*")
    return winners, losers


def last_writer(rows: DataFrame, key: str = "path", order: Column | None = None) -> tuple[DataFrame, DataFrame]:
    return first_writer(rows, key, last=True, order=order)


def flag_first(rows: DataFrame, key: str, order: Column | None = None) -> DataFrame:
    """``rows`` with ``is_first``: one row per ``key``, the first in the
    declared arrival order. ``rows`` must be a checkpoint or a written table,
    whose row numbers break the ties of equal rows. Firsts and others come from
    one aggregation (combined map-side) and one join, which adaptive execution
    splits when a key is hot."""
    o = order if order is not None else order_struct()
    names = list(rows.columns)
    hashable = [c for c in names if not isinstance(rows.schema[c].dataType, T.MapType)]
    placed = rows.withColumn("_o", F.struct(o.alias("o"), F.xxhash64(*hashable).alias("h"),
                                            F.monotonically_increasing_id().alias("row")))
    first = placed.groupBy(key).agg(F.min("_o").alias("_first"))
    return placed.join(first, key).select(*names, (F.col("_o") == F.col("_first")).alias("is_first"))


# ---------------------------------------------------------------------------
# validation and rejects
# ---------------------------------------------------------------------------
def validation_reason(row: str | None = None) -> Column:
    """First failing check of a metadata row (or of the struct column
    ``row`` that holds one), null when valid."""
    col = lambda c: F.col(f"{row}.{c}" if row else c)
    required = ("element_id", "URL", "type", "raw_content_path", "processed_content_path", "checksum")
    checks = [(col(c).isNull(), f"{c} is null") for c in required] + [
        (~col("type").isin(*ELEMENT_TYPES), "type not in URL/PDF/Image"),
        (~col("element_id").rlike(r"^[0-9a-f]{64}_[0-9]{8}_[0-9]{6}$"), "element_id malformed"),
        (~col("checksum").rlike(r"^([0-9a-f]{64})?$"), "checksum malformed"),
    ]
    reason = F.lit(None).cast("string")
    for cond, text in reversed(checks):
        reason = F.when(cond, F.lit(text)).otherwise(reason)
    return reason


def validate_metadata(df: DataFrame) -> DataFrame:
    """Rows with ``reason`` (null = valid)."""
    return df.withColumn("reason", validation_reason())


def split_rejects(df: DataFrame, reason_col: str = "reason") -> tuple[DataFrame, DataFrame]:
    """``(valid, rejects)`` by a status column produced upstream."""
    return df.filter(F.col(reason_col).isNull()).drop(reason_col), df.filter(F.col(reason_col).isNotNull())


# ---------------------------------------------------------------------------
# sinks
# ---------------------------------------------------------------------------
def ensure_table(spark: SparkSession, root: str, name: str | None = None) -> DataFrame:
    """Create the metadata table if absent (else leave it) and return it.

    ``name`` also registers it in the catalog (``CREATE TABLE IF NOT
    EXISTS ... USING parquet PARTITIONED BY (job_id, type, key_prefix)``)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    if name:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in METADATA_FILES.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet PARTITIONED BY ({', '.join(KEY_LAYOUT)}) "
            f"LOCATION '{root}'"
        )
    return spark.read.schema(METADATA_FILES).parquet(root).drop("key_prefix")


def stored_keys(keys: DataFrame, root: str, job_ids: list[str] | None = None) -> DataFrame:
    """``element_id`` of the stored rows that a lookup of ``keys``
    (element_id) has to see: a superset of the keys that are stored.

    Only the partitions of the keys' leading digits are read. A lookup of few
    keys is sent to the reader as equalities, which skip the row groups whose
    range or Bloom filter excludes them all; what is read differs, never the
    result. The driver sees one count, the digits (a fixed number of them)
    and at most ``PUSHED_KEYS`` keys."""
    table = keys.sparkSession.read.schema(METADATA_FILES).parquet(root)
    if job_ids:
        table = table.filter(F.col("job_id").isin(*job_ids))
    return reachable(table, keys, "element_id").select("element_id")


def reachable(table: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """The part of a stored ``table``, laid out by ``key_prefix`` and with a
    Bloom filter on ``name``, that can hold one of ``keys`` (a column ``name``)."""
    n, found = keys.agg(F.count("*"), F.collect_set(F.substring(name, 1, KEY_DIGITS))).first()
    if not n:
        return table.filter(F.lit(False))
    # partitions may have been named by more or fewer digits
    prefixes = sorted({p[:i] for p in found for i in range(1, len(p) + 1)})
    table = table.filter(F.substring("key_prefix", 1, KEY_DIGITS).isin(prefixes))
    if n <= PUSHED_KEYS:
        terms = [F.col(name) == r[0] for r in keys.distinct().collect()]
        while len(terms) > 1:  # a balanced tree of alternatives
            terms = [reduce(Column.__or__, terms[i:i + 2]) for i in range(0, len(terms), 2)]
        table = table.filter(terms[0])
    return table


def insert_metadata(rows: DataFrame, root: str, job_ids: list[str] | None = None,
                    duplicates: DataFrame | None = None) -> dict[str, DataFrame]:
    """Insert element rows into the metadata table at ``root``.

    ``rows`` are elements with metadata fields and the order columns.
    Steps: validation (F13; a NULL key never reaches the table), first writer
    per element_id in the batch (W01), lookup of stored keys (X01), append
    laid out by ``job_id, type, key_prefix``. What becomes of a row is decided
    once, in one plan. Returns the ``inserted`` rows and ``rejects`` with a
    reason and the job: every row of ``rows`` is in exactly one of the two.
    ``duplicates`` are elements already known to come after a row of ``rows``;
    they are listed among the rejects."""
    spark = rows.sparkSession
    tagged = checkpoint(rows.select("element_id", "depth", "parent_url", "pos", "page_id", "job_id",
                                    F.struct(*meta_columns(rows)).alias("_m")).withColumn(
        "_reason", validation_reason("_m")))
    tagged = tagged.withColumn("type", F.col("_m.type")).withColumn(
        "_o", F.struct(order_struct().alias("o"), F.xxhash64("_m").alias("h"), F.monotonically_increasing_id().alias("row")))
    valid = tagged.filter(F.col("_reason").isNull())
    ensure_table(spark, root)
    stored = stored_keys(valid.select("element_id"), root, job_ids).withColumn("_stored", F.lit(True))
    firsts = valid.groupBy("element_id").agg(F.min("_o").alias("_first")).join(stored, "element_id", "left")
    reason = (F.when(F.col("_reason").isNotNull(), F.col("_reason"))
              .when(F.col("_o") != F.col("_first"), F.lit("duplicate element_id in batch"))
              .when(F.col("_stored"), F.lit("element_id already stored")))
    decided = checkpoint(tagged.join(firsts, "element_id", "left").select("_m.*", reason.alias("reason"), "job_id"))
    new = decided.filter(F.col("reason").isNull()).drop("reason").withColumn(
        "job_id", F.substring_index("element_id", "_", -2)).select(*METADATA_STORED.fieldNames())
    rejects = decided.filter(F.col("reason").isNotNull()).select(*REJECT.fieldNames())
    if duplicates is not None:
        rejects = rejects.unionByName(duplicates.select(
            *meta_columns(duplicates), F.lit("duplicate element_id in batch").alias("reason"), "job_id"))
    laid = new.withColumn("key_prefix", F.substring("element_id", 1, KEY_DIGITS)).repartitionByRange(
        *KEY_LAYOUT, "element_id").sortWithinPartitions(*KEY_LAYOUT, "element_id")
    (laid.write.mode("append").option("parquet.bloom.filter.enabled#element_id", "true")
     .option("parquet.bloom.filter.adaptive.enabled", "true").partitionBy(*KEY_LAYOUT).parquet(root))
    return {"inserted": new.drop("job_id"), "rejects": rejects}


def append_new(df: DataFrame, root: str, schema) -> None:
    """Append the rows that are not stored yet; re-running adds nothing.

    A row is known by two 64-bit hashes, stored with it and partitioned by the
    first one's leading digit: a lookup reads the hashes of the batch's jobs
    and digits, not the rows."""
    spark = df.sparkSession
    names = schema.fieldNames()
    both = ["row_hash", "row_hash2"]
    hashed = checkpoint(df.select(*names).distinct().withColumn("row_hash", F.xxhash64(*names)).withColumn(
        "row_hash2", F.xxhash64(F.lit(1), *names)).withColumn("part", F.hex(F.shiftrightunsigned("row_hash", 60))))
    if path_exists(spark, root):
        seen = hashed.select("job_id", "part").distinct().collect()
        old = spark.read.schema("row_hash long, row_hash2 long, job_id string, part string").parquet(root).filter(
            F.col("job_id").isin([r["job_id"] for r in seen]) & F.col("part").isin([r["part"] for r in seen]))
        hashed = hashed.join(old.select(*both), both, "left_anti")
    hashed.select(*names, *both, "part").repartitionByRange("job_id", "part", "row_hash").write.mode(
        "append").partitionBy("job_id", "part").parquet(root)


def write_quarantine(df: DataFrame, root: str) -> None:
    append_new(df, root, QUARANTINE)


def write_rejects(df: DataFrame, root: str) -> None:
    append_new(df, root, REJECT)


def claim_version(spark: SparkSession, root: str, run: str | None = None) -> int:
    """The version under which ``run`` writes to the object store at ``root``:
    one more than every version claimed before, whoever claimed it, or the one
    that this run has claimed already (a replayed micro-batch is no new writer).

    Claims are rows of a small table beside the store, of which the latest
    ``KEPT_VERSIONS`` stay. A version that is claimed and never written (a
    crash in between) is skipped by the next run and taken up by a replay."""
    path = f"{root.rstrip('/')}-versions"
    schema = "run string, version long"
    version = 0
    if path_exists(spark, path):
        claims = spark.read.schema(schema).parquet(path)
        mine, top = claims.agg(F.max(F.when(F.col("run") == run, F.col("version"))), F.max("version")).first()
        if mine is not None:
            return mine
        version = 0 if top is None else top + 1
    claim = spark.createDataFrame([(run, version)], schema).coalesce(1)
    claim.write.mode("append").partitionBy("version").parquet(path)
    if version >= KEPT_VERSIONS:
        delete_path(spark, f"{path}/version={version - KEPT_VERSIONS}")
    return version


def write_objects(objects: DataFrame, root: str, run: str | None = None) -> None:
    """Append objects (one row per object, not one file per object),
    partitioned by ``job_id, stage``. The content is written where it was
    made: no aggregate and no shuffle moves it. The last writer of a path wins
    when the store is read (W02): the largest version, then the largest
    ``order_key``. Every call is a new writer, unless ``run`` names one that
    has written before (a micro-batch that is replayed)."""
    spark = objects.sparkSession
    for c, kind in (("order_key", "long"), ("metadata", "map<string,string>")):
        if c not in objects.columns:
            objects = objects.withColumn(c, F.lit(None).cast(kind))
    out = objects.withColumn("version", F.lit(claim_version(spark, root, run or uuid.uuid4().hex)).cast("long"))
    # tells apart the rows of all writes, a replayed micro-batch's included
    row = F.xxhash64(F.lit(uuid.uuid4().hex), F.monotonically_increasing_id())
    out = out.withColumn("row", row).select(*OBJECT.fieldNames())
    out.write.mode("append").partitionBy("job_id", "stage").parquet(root)


def manifest(objects: DataFrame) -> DataFrame:
    """Upload manifest: ``path, checksum, content_type, metadata, size``."""
    return objects.select(
        "path",
        F.sha2("content", 256).alias("checksum"),
        "content_type",
        "metadata",
        F.length("content").cast("bigint").alias("size"),
    )


def compact_objects(spark: SparkSession, root: str, job_id: str | None = None, stage: str | None = None) -> list[str]:
    """Take overwritten rows out of the store at ``root`` for good; the files
    that were replaced are returned.

    Only files that hold such rows are read and rewritten, content included;
    all others stay as they are. The rows that remain are appended first and
    the old files deleted then. In between, and after a crash in between,
    readers count a row that is in two files once, and the next compaction
    finishes the work. File names come to the driver, rows don't."""
    rows = object_rows(spark, root, job_id, stage)
    old = checkpoint(overwritten_rows(rows))
    held = rows.select("file", F.col("file_path")).distinct().join(old.select("file").distinct(), "file", "left_semi")
    files = [r["file_path"] for r in held.collect()]
    if files:
        kept = rows.filter(F.col("file_path").isin(files)).join(old, ["path", "version", "row", "file"], "left_anti")
        kept.select(*OBJECT.fieldNames()).write.mode("append").partitionBy("job_id", "stage").parquet(root)
        for file in files:
            delete_path(spark, file, encoded=True)
    return files


__all__ = [
    "first_writer", "last_writer", "validate_metadata", "split_rejects", "ensure_table", "insert_metadata",
    "write_objects", "claim_version", "stored_keys", "flag_first", "write_quarantine", "write_rejects", "append_new", "manifest", "compact_objects",
    "METADATA_COLUMNS",
]
