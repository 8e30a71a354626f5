"""Stored tables whose commits rewrite only the files that they change.

A table is a folder of data files, of manifests and of versions. A manifest is a Parquet table with a row per data file:
its path, the range of its keys, its rows. A version is one small file that names a manifest and the commits so far; it is
moved to its final name last, without replacing another. Readers go by the highest version, so a crash at any step
leaves the old table or the new one, and of two writers that started from one version the second is refused. Files that
no version names are left behind by crashes and old versions; ``vacuum`` removes them.

Keys are whole numbers, texts or dates, and unique. Of each file one manifest row reaches the driver, never its records.

The data files of one write stand in one folder by their numbers. Tasks write them and return their manifest rows: thousands of
files are neither moved one by one by the driver, nor listed, nor read again.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import col
from ..operators.ordering import global_rank
from ..session import file_names, move_new, read_text, remove, stage, write_text
from .files import _file_system, qualified

FILE = "_file"
#: Rows of a new file.
FILE_ROWS = 1_000_000
#: Up to so many files of a folder are read by their names.
FEW_FILES = 32
#: What a task holds of a file before it writes that much.
HELD_BYTES, HELD_ROWS = 64 << 20, 1 << 17


class CommitError(RuntimeError):
    """A write that was not carried out; the table is as it was."""


@dataclass(frozen=True)
class Version:
    """``kept``, ``rewritten``, ``added`` and ``dropped`` count files against the version before."""

    number: int
    manifest: str
    schema: str
    key: str
    commits: tuple[str, ...]
    rows: int
    kept: int = 0
    rewritten: int = 0
    added: int = 0
    dropped: int = 0


@dataclass(frozen=True)
class KeyedTable:
    """One version of a stored table; commits return the next one."""

    spark: SparkSession
    path: str
    version: Version

    @classmethod
    def create(cls, df: DataFrame, path: str, key: str, file_rows: int = FILE_ROWS) -> KeyedTable:
        """Store ``df`` in key order, ``file_rows`` rows a file."""
        spark, path = df.sparkSession, path.rstrip("/")
        if file_names(spark, f"{path}/versions"):
            raise CommitError(f"there is a table at {path}")
        table = cls(spark, path, Version(-1, "", df.schema.json(), key, (), 0))
        files, rows = table._write(_numbered_files(df, key, file_rows))
        return table._publish(files, None, rows, rows, added=_count(files))

    @classmethod
    def open(cls, spark: SparkSession, path: str, number: int | None = None) -> KeyedTable:
        """The newest version, or an earlier one that has not been vacuumed."""
        path = path.rstrip("/")
        names = sorted(name for name in file_names(spark, f"{path}/versions") if name.endswith(".json"))
        if number is not None:
            names = [name for name in names if name == _version_name(number)]
        if not names:
            raise FileNotFoundError(f"no table at {path}")
        facts = json.loads(read_text(spark, f"{path}/versions/{names[-1]}"))
        return cls(spark, path, Version(**{**facts, "commits": tuple(facts["commits"])}))

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.version.schema))

    def manifest(self) -> DataFrame:
        """``path, low, high, rows`` of each file."""
        kind = self.schema[self.version.key].dataType.simpleString()
        return self.spark.read.schema(f"path string, low {kind}, high {kind}, rows bigint").parquet(
            f"{self.path}/{self.version.manifest}"
        )

    def read(self, ranges: Sequence[tuple] | None = None) -> DataFrame:
        """The table, or its records with keys in ``ranges`` (bounds included): other files are not opened."""
        files = self.manifest().where("rows > 0")
        if ranges is None:
            return self._read([row["path"] for row in files.select("path").collect()])
        meets = reduce(or_, [(F.col("low") <= high) & (F.col("high") >= low) for low, high in ranges], F.lit(False))
        key = col(self.version.key)
        wanted = reduce(or_, [(key >= low) & (key <= high) for low, high in ranges], F.lit(False))
        return self._read([row["path"] for row in files.where(meets).select("path").collect()]).where(wanted)

    def _read(self, paths: Sequence[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows, wanted = self._scan(paths)
        if wanted is not None:
            rows = rows.withColumn("_place", _place()).join(F.broadcast(wanted.select("_place")), "_place", "left_semi")
        return rows.select(*[col(name) for name in self.schema.names])

    def _scan(self, paths: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
        """A scan that holds the records of ``paths``, and their places if it holds more than that.

        Spark lists files given by name in a task each. So a folder is given as a whole if most of the files from the first
        wanted one to the last are wanted; those before and beyond are left out by their names.
        """
        folders: dict[str, list[int]] = {}
        for path in paths:
            folder, _, name = path.rpartition("/")
            if name.removesuffix(_SUFFIX).isdigit():
                folders.setdefault(folder, []).append(int(name.removesuffix(_SUFFIX)))
        whole = {f: n for f, n in folders.items() if len(n) > FEW_FILES and 2 * len(n) > max(n) - min(n)}
        named = [path for path in paths if path.rpartition("/")[0] not in whole]
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{place}" for place in (*whole, *named)])
        if not whole:
            return rows, None
        spans = [
            F.col("_metadata.file_path").contains(f"/{folder}/")
            & F.col("_metadata.file_name").between(_file_name(min(n)), _file_name(max(n)))
            for folder, n in whole.items()
        ]
        listed = reduce(or_, [F.col("_metadata.file_path").contains(f"/{folder}/") for folder in whole])
        rows = rows.where(reduce(or_, spans) | ~listed if named else reduce(or_, spans))
        gaps = any(len(n) <= max(n) - min(n) for n in whole.values())
        return rows, self._places(paths) if gaps else None

    def _places(self, paths: Sequence[str]) -> DataFrame:
        """Files and their numbers among ``paths``."""
        return self.spark.createDataFrame(
            [(path.removeprefix("data/"), i) for i, path in enumerate(paths)], f"_place string, {FILE} int"
        )

    def touched(self, keys: DataFrame) -> list[str]:
        """Files whose key range holds one of ``keys`` (its first column).

        File ranges are laid out in layers of disjoint ranges, so each key is looked up once a layer.
        """
        files = sorted((row["low"], row["high"], row["path"]) for row in self.manifest().collect() if row["rows"])
        layers: list[list[tuple]] = []
        for file in files:
            layer = next((layer for layer in layers if layer[-1][1] < file[0]), None)
            layers.append([file]) if layer is None else layer.append(file)
        if not layers:
            return []
        shared = self.spark.sparkContext.broadcast([([f[1] for f in layer], layer) for layer in layers])

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = set()
            for batch in batches:
                for key in batch.column(0).drop_null().to_pylist():
                    for highs, layer in shared.value:
                        at = bisect_left(highs, key)
                        if at < len(layer) and layer[at][0] <= key:
                            found.add(layer[at][2])
            yield pa.RecordBatch.from_pydict({"path": pa.array(sorted(found), pa.string())})

        kind = self.schema[self.version.key].dataType
        wanted = keys.select(F.col(keys.columns[0]).cast(kind).alias("key"))
        return sorted(row["path"] for row in wanted.mapInArrow(meet, "path string").distinct().collect())

    def rewrite(
        self, old: Sequence[str], changed: DataFrame | None, created: DataFrame | None, rows: int,
        commit_id: str | None = None, file_rows: int = FILE_ROWS,
    ) -> KeyedTable:
        """Replace the files ``old`` by the rows of ``changed`` and add those of ``created``.

        ``changed`` comes from ``with_files`` and keeps its rows in files of the same ranges. The table must have ``rows`` rows
        afterwards, counted while they are written.
        """
        before = self.manifest()
        gone = self.spark.createDataFrame([(path,) for path in old], "path string")
        kept = before.join(F.broadcast(gone), "path", "left_anti") if old else before
        parts, written, rewritten, added = [], 0, 0, 0
        if changed is not None and old:
            files, n = self._write(changed)
            parts, written, rewritten = [files], n, _count(files)
        if created is not None:
            files, n = self._write(_numbered_files(created, self.version.key, file_rows))
            parts, written, added = [*parts, files], written + n, _count(files)
        left = kept.agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files")).first()
        for part in parts:
            kept = kept.unionByName(part)
        dropped = len(old) - rewritten
        return self._publish(
            kept, commit_id, (left["rows"] or 0) + written, rows, kept=left["files"], rewritten=rewritten, added=added, dropped=dropped
        )

    def with_files(self, paths: Sequence[str]) -> DataFrame:
        """The records of some files, each with the number of its file."""
        rows, _ = self._scan(paths)
        return rows.withColumn("_place", _place()).join(F.broadcast(self._places(paths)), "_place").drop("_place")

    def _write(self, numbered: DataFrame) -> tuple[DataFrame, int]:
        """Write rows, one data file for each value of ``_file``; manifest rows of the files, and the number of rows.

        Files grow aside and are moved to their names when complete, so a repeated task is harmless.
        """
        key = self.version.key
        kind = self.schema[key].dataType.simpleString()
        folder = f"data/{uuid4().hex}"
        aside = qualified(self.spark, f"{self.path}/{folder}.growing")
        writer = _writer(qualified(self.spark, f"{self.path}/{folder}"), aside, folder, key, self.schema.names, self.spark.version)
        columns = [col(name) for name in self.schema.names]
        spread = numbered.select(*columns, col(FILE)).repartition(col(FILE)).sortWithinPartitions(FILE, key)
        try:
            files = stage(spread.mapInArrow(writer, f"path string, low {kind}, high {kind}, rows bigint"), "manifest")
        finally:
            remove(self.spark, aside)
        rows = files.agg(F.sum("rows")).first()[0] or 0
        if not rows:
            return self.manifest().limit(0) if self.version.number >= 0 else self._no_files(), 0
        return files, rows

    def _no_files(self) -> DataFrame:
        kind = self.schema[self.version.key].dataType.simpleString()
        return self.spark.createDataFrame([], f"path string, low {kind}, high {kind}, rows bigint")

    def _publish(self, files: DataFrame, commit_id: str | None, rows: int, expected: int, **counts: int) -> KeyedTable:
        number, manifest = self.version.number + 1, f"manifests/{uuid4().hex}"
        if rows != expected:
            raise CommitError(f"{rows} rows were written where {expected} belong")
        files.coalesce(1).write.parquet(f"{self.path}/{manifest}")
        commits = [*self.version.commits, *([commit_id] if commit_id else [])]
        facts = {
            "number": number, "manifest": manifest, "schema": self.version.schema, "key": self.version.key,
            "commits": commits, "rows": rows, **counts,
        }
        aside = f"{self.path}/versions/.{uuid4().hex}.tmp"
        write_text(self.spark, aside, json.dumps(facts))
        if not move_new(self.spark, aside, f"{self.path}/versions/{_version_name(number)}"):
            remove(self.spark, aside)
            raise CommitError("another commit came first")
        return KeyedTable.open(self.spark, self.path, number)

    def history(self) -> DataFrame:
        """A row for each version that is left: files kept, rewritten, added and dropped, and the rows afterwards."""
        names = sorted(name for name in file_names(self.spark, f"{self.path}/versions") if name.endswith(".json"))
        facts = [json.loads(read_text(self.spark, f"{self.path}/versions/{name}")) for name in names]
        columns = ("number", "kept", "rewritten", "added", "dropped", "rows")
        rows = [tuple(f.get(c, 0) for c in columns) + (f["commits"][-1] if f["commits"] else None,) for f in facts]
        return self.spark.createDataFrame(rows, ", ".join(f"{c} bigint" for c in columns) + ", commit_id string")

    def vacuum(self, versions: int = 1) -> int:
        """Remove all but the last ``versions`` versions and what only they or no version names; return removed folders."""
        names = sorted(name for name in file_names(self.spark, f"{self.path}/versions") if name.endswith(".json"))
        gone, stays = names[:-versions], names[-versions:]
        needed, manifests = set(), set()
        for name in stays:
            table = KeyedTable.open(self.spark, self.path, int(name.removesuffix(".json")))
            manifests.add(table.version.manifest.split("/")[1])
            folders = table.manifest().select(F.split("path", "/")[1].alias("folder")).distinct().collect()
            needed |= {row["folder"] for row in folders}
        removed = 0
        for name in gone:
            remove(self.spark, f"{self.path}/versions/{name}")
        for place, used in (("data", needed), ("manifests", manifests)):
            for folder in set(file_names(self.spark, f"{self.path}/{place}")) - used:
                removed += int(remove(self.spark, f"{self.path}/{place}/{folder}"))
        return removed


_SUFFIX = ".parquet"


def _file_name(number: int) -> str:
    return f"{number:010d}{_SUFFIX}"


def _place():
    """Folder and name of the file a record comes from."""
    return F.element_at(F.split(F.col("_metadata.file_path"), "/data/"), -1)


def _writer(root: str, aside: str, folder: str, key: str, names: Sequence[str], version: str):
    """A task function writing rows that are sorted by ``_file``; returns a manifest row for each file.

    Spark takes dates and times for what they are if the file names it as writer.
    """
    writes = {b"org.apache.spark.version": version.encode()}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import parquet

        system, base = _file_system(root)
        _, growing = _file_system(aside)
        number = None

        def flush():
            nonlocal held
            if held:
                out.write_table(pa.Table.from_batches(held))
            held = []

        def finish():
            flush()
            out.close()
            system.move(partial, f"{base}/{_file_name(number)}")
            row = [[f"{folder}/{_file_name(number)}"], [low], [high], [rows]]
            return pa.RecordBatch.from_arrays(
                [pa.array(row[0], pa.string()), pa.array(row[1], kind), pa.array(row[2], kind), pa.array(row[3], pa.int64())],
                ["path", "low", "high", "rows"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            of = batch.column(batch.schema.names.index(FILE)).to_numpy()
            columns = [batch.column(i) for i in range(len(names))]
            schema = pa.schema([batch.schema.field(i) for i in range(len(names))], writes)
            data = pa.RecordBatch.from_arrays(columns, schema=schema)
            kind = schema.field(names.index(key)).type
            edges = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
            for start, end in zip(edges, edges[1:]):
                if number is None or number != of[start]:
                    if number is not None:
                        yield finish()
                    if number is None:
                        system.create_dir(base, recursive=True)
                        system.create_dir(growing, recursive=True)
                    number, low, high, rows, held = int(of[start]), None, None, 0, []
                    partial = f"{growing}/{uuid4().hex}"
                    out = parquet.ParquetWriter(partial, schema, filesystem=system, compression="snappy")
                part = data.slice(start, end - start)
                ends = pc.min_max(part.column(names.index(key))).as_py()
                if ends["min"] is not None:
                    low = ends["min"] if low is None else min(low, ends["min"])
                    high = ends["max"] if high is None else max(high, ends["max"])
                rows += part.num_rows
                held.append(part)
                if sum(p.num_rows for p in held) >= HELD_ROWS or sum(p.nbytes for p in held) >= HELD_BYTES:
                    flush()
        if number is not None:
            yield finish()

    return write


def _numbered_files(df: DataFrame, key: str, file_rows: int) -> DataFrame:
    """Rows with file numbers by their rank in key order."""
    ranked = global_rank(df, [key], "_rank")
    return ranked.withColumn(FILE, F.floor((F.col("_rank") - 1) / file_rows).cast("int")).drop("_rank")


def _count(files: DataFrame) -> int:
    return files.select("path").count()


def _version_name(number: int) -> str:
    return f"{number:020d}.json"
