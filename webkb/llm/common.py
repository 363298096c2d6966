"""Helpers shared by the training-data operators.

Words are the maximal runs of ``[^\\x20\\x09-\\x0D]`` throughout. On UTF-8
bytes that is what ``bytes.split()`` yields, and ``bytes.lower()`` lower-cases
A-Z alone, so the Python steps work on bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webkb.session import scratch_path

#: Separators of words, as a Java regex.
SPACE = "[\\x20\\x09-\\x0D]+"


#: Bytes of a batch that Spark hands to Python; by rows alone (10,000), long texts make batches of any size.
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table; a session that has no bound on the bytes of a batch gets ``BATCH_BYTES``."""
    if BATCH_CONF not in spark.conf.getAll:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends
    there, on storage every executor sees, so a lost executor costs no more
    than the running stage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def drop_cut(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`cut` that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.cut_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a NULL id: crc32 of '')."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def text_key() -> list[Column]:
    """128 bits that identify a text: two independent 64-bit hashes ``t1, t2``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2")]


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


#: Bytes of text that a column's function has as Python objects at once.
PIECE_BYTES = 1 << 20


def pieces(texts: pa.Array) -> Iterator[list[str | None]]:
    """The texts as Python objects, about ``PIECE_BYTES`` of them at a time."""
    for part in slices([pa.RecordBatch.from_arrays([texts], names=["text"])], "text", PIECE_BYTES):
        yield part.column(0).to_pylist()


def text_column(kind: str, make: Callable[[], Callable[[str | None], object]]) -> Column:
    """A column of ``text``: what the function that ``make`` gives (once a task)
    returns for each text. A batch becomes Python objects a slice at a time,
    so what a worker holds of them is bounded however many rows a batch has."""

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        value = make()
        for texts in batches:
            for part in pieces(texts):
                yield pa.array([value(t) for t in part])

    return run(F.col("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about ``most_bytes`` of ``column``
    (a longer value is a batch of its own): bounds what a Python step holds."""
    for batch in batches:
        values = batch.column(column)
        n, start, held = batch.num_rows, 0, 0
        lengths = pc.fill_null(pc.binary_length(values), 0).to_pylist()
        for i in range(n):
            if held and held + lengths[i] > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += lengths[i]
        if start < n:
            yield batch.slice(start)
