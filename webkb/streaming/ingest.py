"""Incremental ingest with Structured Streaming.

Pages arrive as files in a landing folder; each micro-batch is turned into
elements, processed, and written through the same keyed sinks as the batch
job. Metadata keeps the first writer of a key: the insert looks up the stored
keys. Objects keep the last: a micro-batch takes the store's next version, as
any batch run does, and keeps it when it is replayed. Failures go to the
quarantine and refused rows to the rejects, both without doubles, so a replay
(after a driver or executor loss) changes nothing. Progress is tracked by the
checkpoint in the shared folder.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from webkb.operators import assets as AS
from webkb.operators import elements as EL
from webkb.operators import links as LK
from webkb.operators import store as ST
from webkb.session import checkpoint

PAGES_SCHEMA = "page_id bigint, url string, html string"


def read_page_stream(spark: SparkSession, folder: str, glob: str | None = None,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of page files ``(page_id, url, html)``: all files that
    have landed make a micro-batch, unless the caller bounds their number."""
    r = spark.readStream.schema(PAGES_SCHEMA)
    if max_files_per_trigger is not None:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.parquet(folder)


def stream_id(spark: SparkSession, checkpoint_location: str) -> str:
    """The id of the stream whose progress is kept at ``checkpoint_location``:
    a new one for a new checkpoint, the same after a restart."""
    rows = spark.read.text(f"{checkpoint_location}/metadata").collect()
    return json.loads("".join(r[0] for r in rows))["id"]


def ingest_batch(pages: DataFrame, assets: DataFrame, job: str, root: str, run: str | None = None,
                 pdf_method: str = "auto", extractor_factory: Callable | None = None) -> None:
    """One micro-batch (or one batch job) of pages into the stores under
    ``root``. ``run`` names the micro-batch, for its replay to be known."""
    parsed = checkpoint(LK.parse_pages(pages, (), with_checksum=True))
    els = checkpoint(EL.elements_from_parsed(parsed, job))
    out = AS.process_elements(els, pages, assets, job, pdf_method, extractor_factory, materialized=True)
    ST.write_objects(out["objects"], os.path.join(root, "objects"), run)
    ins = ST.insert_metadata(out["rows"], os.path.join(root, "metadata"), [job], out["duplicates"])
    ST.write_quarantine(out["quarantine"].unionByName(EL.parse_failures(parsed, job)), os.path.join(root, "quarantine"))
    ST.write_rejects(ins["rejects"], os.path.join(root, "rejects"))


def stream_ingest(pages_stream: DataFrame, assets: DataFrame, job: str, root: str, checkpoint_location: str,
                  transform: Callable[[DataFrame], DataFrame] | None = None, available_now: bool = True,
                  extractor_factory: Callable | None = None) -> StreamingQuery:
    """Start the ingest into ``root/metadata``, ``root/objects``,
    ``root/quarantine`` and ``root/rejects``: ``transform`` runs on the stream
    before the sink (e.g. a stream-static join), then each micro-batch goes
    through ``ingest_batch``."""
    s = transform(pages_stream) if transform is not None else pages_stream

    def each(batch: DataFrame, batch_id: int) -> None:
        run = f"{stream_id(batch.sparkSession, checkpoint_location)}/{batch_id}"
        ingest_batch(batch, assets, job, root, run, extractor_factory=extractor_factory)

    w = s.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
