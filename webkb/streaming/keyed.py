"""First writer of each element over a stream, decided in the state store.

``streaming.ingest`` looks the keys of a micro-batch up in the stored table.
Here the keys live in Spark's state store instead: a streaming aggregation
keeps the earliest row of every element id, combined map-side before the
shuffle, so an image that is on every page is one row per task. A micro-batch
reads and writes state for its own keys only, however many are stored, and the
state comes back from the checkpoint after a restart. It grows with the keys
of the stream: job-scoped, as element ids are. For more keys than fit the
executors' memory choose the RocksDB provider
(``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from webkb.operators import elements as EL
from webkb.operators import links as LK
from webkb.session import checkpoint

#: Rows of the element index; ``batch`` is the micro-batch that brought the element.
INDEX_COLUMNS = "element_id string, URL string, type string, parent_id string, checksum string, batch long"


def first_elements(pages_stream: DataFrame, job: str) -> DataFrame:
    """The streaming elements of ``pages_stream`` (page_id, url, html) in
    update mode: per element id seen in the micro-batch its first row over the
    whole stream, and ``is_new``: it came with this micro-batch.

    First is by micro-batch, then by the declared arrival order. A micro-batch
    is known by its trigger time, which a replay takes from the checkpoint;
    the driver's clock must not go back between micro-batches."""
    els = EL.elements_from_parsed(LK.parse_pages(pages_stream, (), with_checksum=True), job)
    row = F.struct("url", "type", "parent_id", F.coalesce("page_checksum", F.lit("")).alias("checksum"),
                   F.current_timestamp().alias("arrived"))
    order = F.struct(F.current_timestamp().alias("arrived"), EL.order_struct().alias("o"))
    first = els.select("element_id", row.alias("row"), order.alias("order")).groupBy("element_id").agg(
        F.min_by("row", "order").alias("first"))
    return first.select("element_id", F.col("first.url").alias("URL"), "first.type", "first.parent_id", "first.checksum",
                        (F.col("first.arrived") == F.current_timestamp()).alias("is_new"))


def stream_stateful(pages_stream: DataFrame, job: str, root: str, checkpoint_location: str,
                    available_now: bool = True) -> StreamingQuery:
    """Start writing the index of elements to ``root``, one folder per
    micro-batch, which a replay writes anew: each element once, as its first
    writer had it. No stored row is read."""

    def each(batch: DataFrame, batch_id: int) -> None:
        new = checkpoint(batch.filter("is_new").drop("is_new"))
        new.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    w = first_elements(pages_stream, job).writeStream.outputMode("update").foreachBatch(each).option(
        "checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def read_index(spark, root: str) -> DataFrame:
    return spark.read.schema(INDEX_COLUMNS).parquet(root)
