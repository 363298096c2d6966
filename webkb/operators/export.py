"""Export of stored objects as one file each, as a Spark data source that commits.

Every task writes its own objects and one list of them; the lists of the tasks
that succeeded become the export's listing when the job commits. A task that
fails, is retried or runs twice leaves no list, so nothing of it is listed but
what its successful attempt wrote. Files of an attempt that failed stay as they
are (they may have replaced files of an earlier export) and are written again
by the next attempt.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "webkb_object_files"
#: Folder under the export's root that holds the listings, one folder a run.
LISTINGS = "_listings"
LISTING = "path string, size bigint"


@dataclass
class Listed(WriterCommitMessage):
    """The list that a task wrote; none if it had no object."""

    name: str | None


class ObjectFileWriter(DataSourceArrowWriter):
    """Writes ``path, content`` rows as files under a root."""

    def __init__(self, root: str, run: str):
        self.root, self.run = root, run

    def _open(self):
        import pyarrow.fs as pafs

        fs, base = pafs.FileSystem.from_uri(self.root)
        lists = f"{base}/{LISTINGS}/{self.run}"
        return fs, base, lists, f"{lists}.pending"

    def write(self, iterator: Iterator) -> Listed:
        import pyarrow as pa
        import pyarrow.parquet as pq

        fs, base, _, pending = self._open()
        name = f"{uuid.uuid4().hex}.parquet"
        schema = pa.schema([("path", pa.string()), ("size", pa.int64())])
        listing, folders = None, set()
        try:
            for batch in iterator:
                paths, sizes = batch.column("path").to_pylist(), []
                for path, content in zip(paths, batch.column("content")):
                    data = content.as_py() or b""
                    folder = f"{base}/{path}".rsplit("/", 1)[0]
                    if folder not in folders:
                        fs.create_dir(folder, recursive=True)
                        folders.add(folder)
                    # a file is replaced as a whole: readers see the old or the new one
                    part = f"{folder}/_{uuid.uuid4().hex}"
                    with fs.open_output_stream(part) as f:
                        f.write(data)
                    fs.move(part, f"{base}/{path}")
                    sizes.append(len(data))
                if paths:
                    if listing is None:
                        fs.create_dir(pending, recursive=True)
                        listing = pq.ParquetWriter(f"{pending}/{name}", schema, filesystem=fs)
                    listing.write_batch(pa.RecordBatch.from_arrays(
                        [pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], schema=schema))
        finally:
            if listing is not None:
                listing.close()
        return Listed(name if listing is not None else None)

    def commit(self, messages: list[Listed | None]) -> None:
        """The lists named by the tasks' messages become the run's listing; a
        list per task is moved, no list of objects comes to the driver."""
        fs, _, lists, pending = self._open()
        fs.create_dir(lists, recursive=True)
        for message in messages:
            if message is not None and message.name:
                fs.move(f"{pending}/{message.name}", f"{lists}/{message.name}")
        self._drop(fs, pending)

    def abort(self, messages: list[Listed | None]) -> None:
        fs, _, _, pending = self._open()
        self._drop(fs, pending)

    @staticmethod
    def _drop(fs, folder: str) -> None:
        import pyarrow.fs as pafs

        if fs.get_file_info(folder).type == pafs.FileType.Directory:
            fs.delete_dir(folder)


class ObjectFiles(DataSource):
    """Options: ``root`` (a URI that pyarrow can write and every executor reaches) and ``run``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, content binary"

    def writer(self, schema, overwrite: bool) -> ObjectFileWriter:
        return ObjectFileWriter(self.options["root"].rstrip("/"), self.options["run"])


def listing(spark: SparkSession, root: str, run: str) -> DataFrame:
    """``path, size`` of the objects that a committed export wrote."""
    return spark.read.schema(LISTING).parquet(f"{root.rstrip('/')}/{LISTINGS}/{run}")


def export_objects(objects: DataFrame, root: str, run: str | None = None) -> DataFrame:
    """One file per object under ``root/<path>`` (the folder layout of the
    object store); the listing ``(path, size)`` of what was written is returned
    and stays under ``root``. ``run`` names it; an export is a new run if unset.

    ``root`` is a URI with a scheme that pyarrow can write and every executor
    reaches; a bare path would name each executor's own disk and is refused. If
    a task fails for good the export fails and has no listing. An empty table
    gives an empty listing; NULL content is an empty file. Objects that repeat a
    path are each listed, and the file is that of the one written last."""
    if "://" not in root:
        raise ValueError(f"export needs a URI with a scheme, not {root!r}")
    spark, run = objects.sparkSession, run or uuid.uuid4().hex
    spark.dataSource.register(ObjectFiles)
    (objects.select("path", "content").write.format(FORMAT).mode("append").option("root", root).option("run", run).save())
    return listing(spark, root, run)
