"""A run tree as tables: names and file evidence are listed, and files hashed, by tasks."""

from __future__ import annotations

import hashlib
import posixpath
from collections.abc import Iterator
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The files of a run that are parsed.
SOURCE_NAMES = ("frequencies.tsv", "aggregate.tsv", "instrument.json", "freq-*.pcap")
#: Tasks per core over which folders and files are dealt; a task takes them one by one.
TASKS_PER_CORE = 2
_BLOCK_BYTES = 1 << 20
_BATCH_ROWS = 10_000
_CHILDREN = "name string, path string, is_dir boolean"
_FILES = "run_id string, name string, path string, size bigint, modified bigint"


def tasks(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism * TASKS_PER_CORE


def _batches(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), _BATCH_ROWS):
        columns = list(zip(*rows[at : at + _BATCH_ROWS]))
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _entries(path: str):
    files, inner = FileSystem.from_uri(path)
    return files.get_file_info(FileSelector(inner, allow_not_found=True))


def list_children(spark: SparkSession, root: str) -> DataFrame:
    """Registry (name, path, is_dir) of the direct children of a run tree.

    File sources cannot see empty directories, and an empty run directory is a malformed attempt, not a missing hour. One
    folder is one listing, so one task makes it; a root that is absent has no children.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                rows = [(e.base_name, posixpath.join(folder, e.base_name), e.type == FileType.Directory) for e in _entries(folder)]
                yield from _batches(rows, ["name", "path", "is_dir"], [pa.string(), pa.string(), pa.bool_()])

    return spark.createDataFrame([(root.rstrip("/"),)], "path string").coalesce(1).mapInArrow(run, _CHILDREN)


def list_sources(children: DataFrame) -> DataFrame:
    """(run_id, name, path, size, modified) of the parsed files of every folder among the children of a run tree.

    Folders are dealt over tasks; no file is opened. `modified` is in nanoseconds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        for batch in batches:
            for run_id, folder in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = [
                    (run_id, e.base_name, posixpath.join(folder, e.base_name), e.size, e.mtime_ns)
                    for e in _entries(folder)
                    if e.type == FileType.File and any(fnmatchcase(e.base_name, n) for n in SOURCE_NAMES)
                ]
                yield from _batches(rows, ["run_id", "name", "path", "size", "modified"], kinds)

    folders = children.where("is_dir").select(F.regexp_replace("name", "^run_id=", "").alias("run_id"), "path")
    return folders.repartition(tasks(children.sparkSession), "run_id").mapInArrow(run, _FILES)


def hash_files(files: DataFrame) -> DataFrame:
    """(run_id, name, size, modified, sha256) of listed files, read in blocks: a file may have any size.

    A file that cannot be read has no hash; it differs from whatever was recorded.
    """

    def digest(path: str) -> str | None:
        own = hashlib.sha256()
        try:
            store, inner = FileSystem.from_uri(path)
            with store.open_input_stream(inner, compression=None) as stream:
                while block := stream.read(_BLOCK_BYTES):
                    own.update(block)
        except OSError:
            return None
        return own.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = pa.array([digest(p) for p in batch.column("path").to_pylist()], pa.string())
            yield pa.record_batch(
                [*(batch.column(c) for c in ("run_id", "name", "size", "modified")), hashes],
                names=["run_id", "name", "size", "modified", "sha256"],
            )

    rows = files.select("run_id", "name", "size", "modified", "path").repartition(tasks(files.sparkSession), "run_id", "name")
    return rows.mapInArrow(run, "run_id string, name string, size bigint, modified bigint, sha256 string")


def file_identity(files: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(run_id, name, size, modified, sha256) of listed files.

    Every file is read, unless hashes `known` for the same name, size and time of change are given: then only the others are.
    That misses a change that keeps both.
    """
    if known is None:
        return hash_files(files)
    same = ["run_id", "name", "size", "modified"]
    known = known.where("sha256 is not null and modified is not null").select(*same, "sha256").dropDuplicates(same)
    fresh = hash_files(files.join(known, same, "left_anti"))
    return files.join(known, same).select(*same, "sha256").unionByName(fresh)
