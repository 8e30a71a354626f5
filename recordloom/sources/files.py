"""Binary files: digests, sizes and copies."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage

# Files up to this size are read whole; larger ones are hashed in pieces.
WHOLE_FILE_BYTES = 64 << 20
_PIECE = 1 << 20

#: What a task reads, and what a file costs besides its bytes.
READ_BYTES, OPEN_COST = 64 << 20, 64 << 10
#: With so many folders a task goes down from each to the last; with fewer, their own folders are shared out first.
MANY_FOLDERS = 256
_LISTED = 10_000


def list_files(spark: SparkSession, root: str, empty: bool = False) -> DataFrame:
    """Path relative to ``root`` and size of every file below it now; no content is read.

    As in Spark's own listing, names that begin with ``.`` or ``_`` are left out, and empty files unless ``empty``. That one gathers the files on the driver and
    then plans them into very many small tasks; here tasks list the folders and write what they find.
    """
    spark_path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = spark_path.getFileSystem(spark._jsc.hadoopConfiguration())
    roots = system.globStatus(system.makeQualified(spark_path))
    if not roots:
        raise FileNotFoundError(f"no files at {root}")
    schema = "uri string, bytes bigint"
    found = spark.createDataFrame(
        [(status.getPath().toString(), None if status.isDirectory() else status.getLen()) for status in roots], schema
    )
    levels = []
    while True:
        levels.append(found.where("bytes >= 0" if empty else "bytes > 0"))
        folders = found.where("bytes IS NULL").select("uri")
        n = folders.count()
        if not n:
            break
        tasks = max(1, min(n, n * OPEN_COST // READ_BYTES + spark.sparkContext.defaultParallelism))
        lister = _lister(n >= MANY_FOLDERS, empty)
        found = stage(folders.repartition(tasks, "uri").mapInArrow(lister, schema), "files")
        if n >= MANY_FOLDERS:
            levels.append(found)
            break
    files = reduce(DataFrame.unionByName, levels)
    return files.select(relative_path("uri", root).alias("path"), "uri", "bytes")


def _hidden(name: str, folder: bool) -> bool:
    """What Spark's listing leaves out."""
    if name.endswith("._COPYING_") or name.startswith("."):
        return True
    kept = folder and name.startswith(("_common_metadata", "_metadata"))
    return name.startswith("_") and "=" not in name and not kept


def _entries(uri: str) -> Iterator[tuple[str, int | None]]:
    """Names in a folder with the sizes of files; a folder has none."""
    from pyarrow import fs

    system, path = _file_system(uri)
    if isinstance(system, fs.LocalFileSystem):
        with os.scandir(path) as entries:
            for entry in entries:
                try:
                    yield entry.name, None if entry.is_dir() else entry.stat().st_size
                except FileNotFoundError:
                    continue
        return
    for info in system.get_file_info(fs.FileSelector(path)):
        if info.type != fs.FileType.NotFound:
            yield info.base_name, None if info.type == fs.FileType.Directory else info.size


def _lister(deep: bool, empty: bool):
    """A task function listing folders: what is in them, or every file below them if ``deep``."""

    def batch(found):
        return pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64())], ["uri", "bytes"]
        )

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for given in batches:
            waiting = given.column(0).to_pylist()
            while waiting:
                folder = waiting.pop()
                for name, size in _entries(folder):
                    if _hidden(name, size is None) or size == 0 and not empty:
                        continue
                    uri = f"{folder.rstrip('/')}/{name}"
                    if deep and size is None:
                        waiting.append(uri)
                        continue
                    found.append((uri, size))
                    if len(found) >= _LISTED:
                        yield batch(found)
                        found = []
        yield batch(found)

    return listed


def spread(files: DataFrame, by: str, size: Column) -> DataFrame:
    """Files shared out over tasks, as many as their number and ``size`` ask for."""
    total = files.agg(F.sum(F.coalesce(size, F.lit(0)) + OPEN_COST)).first()[0] or 0
    return files.repartition(total // READ_BYTES + 1, by)


def relative_path(column: str, root: str, encoded: bool = False):
    """The part of a file path below ``root``; metadata columns hold it URL-encoded."""
    plain = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    path = F.col(column)
    if encoded:
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.substring_index(path, f"{plain}/", -1)


def qualified(spark: SparkSession, location: str) -> str:
    """The location with its scheme, as Spark's own readers and writers would take it.

    Tasks open files themselves; without a scheme they would look on their own disks.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


#: Hadoop's names of schemes that pyarrow knows by another one.
_SCHEMES = {"s3a:": "s3:", "s3n:": "s3:", "abfs:": "abfss:"}


def _file_system(location: str):
    """The file system of a path or URI as Spark writes them, and the path on it."""
    from urllib.parse import quote

    from pyarrow import fs

    if location.startswith("/"):
        return fs.LocalFileSystem(), location
    if location.startswith("file:"):
        return fs.LocalFileSystem(), "/" + location.removeprefix("file:").lstrip("/")
    for hadoop, arrow in _SCHEMES.items():
        if location.startswith(hadoop):
            location = arrow + location.removeprefix(hadoop)
    return fs.FileSystem.from_uri(quote(location, safe="/:@"))


def _open(uri: str):
    system, path = _file_system(uri)
    return system.open_input_stream(path)


def _hasher(whole: int):
    """A task function digesting files; those beyond ``whole`` bytes piece by piece."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            digests, lines = [], []
            for uri, size in zip(batch["uri"], batch["bytes"]):
                digest, ends = hashlib.sha256(), 0
                with _open(uri) as stream:
                    while piece := stream.read(_PIECE if size > whole else size + 1):
                        digest.update(piece)
                        ends += piece.count(b"\n")
                digests.append(digest.hexdigest())
                lines.append(ends)
            found = batch.assign(sha256=digests, lines=lines)
            yield found[["path", "uri", "sha256", "bytes", "lines"]]

    return hashed


def hash_files(spark: SparkSession, root: str, whole: int = WHOLE_FILE_BYTES, empty: bool = False) -> DataFrame:
    """``path, uri, sha256, bytes, lines`` of every file below ``root``, empty ones only if ``empty``; lines are line ends.

    The files are shared out by number and size and read in the tasks, those beyond ``whole`` bytes piece by piece.
    """
    files = spread(list_files(spark, root, empty), "uri", F.col("bytes"))
    return files.mapInPandas(_hasher(whole), "path string, uri string, sha256 string, bytes bigint, lines bigint")


def total_bytes(files: DataFrame) -> DataFrame:
    """Number of files and their bytes together."""
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("total_bytes"),
    )


def decode_body(column):
    """Bytes of a stored body: strict base64 is decoded, anything else kept as it is."""
    strict = column.rlike(r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$")
    decoded = F.when(strict, F.try_to_binary(column, F.lit("base64")))
    return F.coalesce(decoded, F.encode(column, "utf-8"))
