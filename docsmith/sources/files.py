"""A sink of plain files: many small files, all of them or none.

Rows ``(path, data, owner, error)`` become files under one folder: the data of
consecutive rows of a path, one after the other, so that a file of any size is
streamed and never held whole.  Rows of a path must stand together in one
partition (see :func:`together`).  ``owner`` says what the file is made from; a
path with rows of two owners fails the write.  A row with an ``error`` gives no
file, only an outcome.

Commit: tasks write into a folder of this write beside the target, each file
under a name of its attempt first and then renamed, so that a retried or
speculative task leaves whole files.  When all tasks are done the folder takes
the target's place by two renames; until then, and if any task fails, the
previous output stays as it was.  A write that stopped between the two renames
is put right by the next one.  Every task lists its files' outcomes in
``_outcomes``.

A file too large for one task to order its rows is written in pieces
(:func:`write_files_in_pieces`): each is a file of its own in a folder beside the
target, dealt out like any file, and the sink then copies the pieces of a path
one after the other, in chunks, into its file.

Files are written through Arrow's file systems (local and mounted folders,
HDFS, S3, GCS, by URI) in Spark's Python data source API.  The renames are
atomic where the file system's are; on object stores they copy.
"""

from __future__ import annotations

import contextlib
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "docsmith_files"
OUTCOMES = "_outcomes"
OUTCOME = "path string, bytes long, error string"
CHUNK = 1 << 20


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _exists(fs: pafs.FileSystem, path: str) -> bool:
    return fs.get_file_info(path).type != pafs.FileType.NotFound


def _safe(path: str) -> bool:
    """The path names a file below the folder."""
    return bool(path) and "\0" not in path and all(p not in ("", ".", "..") for p in path.split("/")) and path.split("/")[0] != OUTCOMES


@dataclass
class FilesWritten(WriterCommitMessage):
    files: int


class FilesWriter(DataSourceArrowWriter):
    def __init__(self, out: str, pieces: str | None = None):
        self.out, self.pieces = out.rstrip("/"), pieces
        self.staged, self.old = f"{self.out}.staged-{uuid.uuid4().hex}", f"{self.out}.old"
        fs, root = _open(self.out)
        if not _exists(fs, root) and _exists(fs, _open(self.old)[1]):  # a commit stopped half way
            fs.move(_open(self.old)[1], root)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> FilesWritten:
        fs, root = _open(self.staged)
        task = TaskContext.get()
        attempt, part = task.taskAttemptId(), task.partitionId()
        made: set[str] = set()
        outcomes: list[dict] = []
        path, owner, stream, error, size = None, None, None, None, 0

        def opened(name: str):
            folder = f"{root}/{name}".rpartition("/")[0]
            if folder not in made:
                fs.create_dir(folder, recursive=True)
                made.add(folder)
            return fs.open_output_stream(f"{root}/{name}.attempt-{attempt}")

        def close(name: str, out) -> None:
            out.close()
            if _exists(fs, f"{root}/{name}"):
                fs.delete_file(f"{root}/{name}")
            fs.move(f"{root}/{name}.attempt-{attempt}", f"{root}/{name}")

        def finish() -> None:
            if path is None:
                return
            if stream is not None:
                close(path, stream)
            outcomes.append({"path": path, "bytes": size, "error": error, "owner": owner})

        def chunks(piece: str) -> Iterator[bytes]:
            pieces, folder = _open(self.pieces)
            with pieces.open_input_stream(f"{folder}/{piece}", compression=None) as given:
                while chunk := given.read(CHUNK):
                    yield chunk

        for batch in iterator:
            for p, data, o, e, piece in zip(*(batch.column(c) for c in ("path", "data", "owner", "error", "piece")), strict=True):
                p, o, e, piece = p.as_py(), o.as_py(), e.as_py(), piece.as_py()
                if p is None or p != path:
                    finish()
                    if p is None or not _safe(p):
                        raise ValueError(f"not the path of a file below {self.out}: {p!r}")
                    path, owner, error, size = p, o, e, 0
                    stream = opened(p) if e is None else None
                elif o != owner:
                    raise ValueError(f"{p} has rows from {owner!r} and from {o!r}")
                if stream is not None and data.is_valid:
                    stream.write(data.as_buffer())
                    size += len(data.as_buffer())
                elif stream is not None and piece is not None:
                    for chunk in chunks(piece):
                        stream.write(chunk)
                        size += len(chunk)
        finish()
        if outcomes:
            listing = f"{OUTCOMES}/part-{part:06d}.json"
            out = opened(listing)
            out.write("".join(json.dumps(x) + "\n" for x in outcomes).encode())
            close(listing, out)
        return FilesWritten(sum(x["error"] is None for x in outcomes))

    def commit(self, messages: list[FilesWritten | None]) -> None:
        fs, root = _open(self.out)
        staged, old = _open(self.staged)[1], _open(self.old)[1]
        fs.create_dir(f"{staged}/{OUTCOMES}", recursive=True)  # also where no task had a row
        if _exists(fs, root):
            if _exists(fs, old):
                fs.delete_dir(old)
            fs.move(root, old)
        fs.move(staged, root)
        if _exists(fs, old):
            fs.delete_dir(old)

    def abort(self, messages: list[FilesWritten | None]) -> None:
        fs, staged = _open(self.staged)
        for _ in range(10):  # other tasks of the write are being stopped and may still make files
            with contextlib.suppress(OSError):
                if _exists(fs, staged):
                    fs.delete_dir(staged)
            time.sleep(0.1)


class FilesSource(DataSource):
    """Write format ``docsmith_files``; option ``path``: the folder; option
    ``pieces``: the folder of the files that rows with a ``piece`` name."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> FilesWriter:
        if not overwrite:
            raise ValueError("this sink replaces its folder: use mode('overwrite')")
        return FilesWriter(self.options["path"], self.options.get("pieces"))


def together(rows: DataFrame, *order: str | Column) -> DataFrame:
    """``rows`` with those of a path in one partition, in ``order``."""
    return rows.repartition("path").sortWithinPartitions("path", *order)


def write_files(rows: DataFrame, path: str, pieces: str | None = None) -> None:
    """Replace the folder ``path`` by the files of ``rows``: ``path``, ``data``
    (text or bytes) and, if they have them, ``owner`` and ``error``.  The data of
    a row with a ``piece`` are those of this file below the folder ``pieces``."""
    from pyspark import cloudpickle

    import docsmith

    cloudpickle.register_pickle_by_value(docsmith)  # executors need no copy of this package
    rows.sparkSession.dataSource.register(FilesSource)
    more = [(F.col(c) if c in rows.columns else F.lit(None)).cast("string").alias(c) for c in ("owner", "error", "piece")]
    out = rows.select("path", F.col("data").cast("binary").alias("data"), *more).write.format(FORMAT).mode("overwrite").option("path", path)
    (out.option("pieces", pieces) if pieces else out).save()


def write_files_in_pieces(rows: DataFrame, path: str, order: list[str], failed: DataFrame) -> None:
    """:func:`write_files` of ``rows`` with a column ``piece``, for files of any
    size: the rows of a ``(path, piece)`` are dealt out and sorted by ``order``
    together, and a file is its pieces in the order of their names.  ``failed``
    ``(path, error)``: files that are not written."""
    spark, folder = rows.sparkSession, f"{path.rstrip('/')}.pieces-{uuid.uuid4().hex}"
    dealt = rows.repartition("path", "piece").sortWithinPartitions("path", "piece", *order)
    try:
        write_files(dealt.select(F.concat("path", F.lit("/"), "piece").alias("path"), "data", "owner"), folder)
        made = spark.read.schema("path string, owner string").json(f"{folder}/{OUTCOMES}").withColumnRenamed("path", "piece")
        none = F.lit(None).cast("string")
        whole = made.select(F.regexp_extract("piece", r"(?s)^(.*)/[^/]*$", 1).alias("path"), "owner", none.alias("error"), "piece")
        bad = failed.select("path", none.alias("owner"), "error", none.alias("piece"))
        write_files(together(whole, "owner", "piece").unionByName(bad).withColumn("data", F.lit(None).cast("binary")), path, folder)
    finally:
        fs, root = _open(folder)
        if _exists(fs, root):
            fs.delete_dir(root)


def file_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, error) of each file of the last write to the folder ``path``."""
    return spark.read.schema(OUTCOME).json(f"{path.rstrip('/')}/{OUTCOMES}")


def read_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, data): the files below the folder ``path`` whose names match
    ``glob``, paths relative to it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select(F.substr("path", F.lit(len(folder) + 2)).alias("path"), F.col("content").alias("data"))
