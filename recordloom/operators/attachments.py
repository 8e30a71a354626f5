"""Versioned files held in cells: selection, naming, copying and status.

A file cell is ``struct<fileName, versions: array<struct<versionNumber, fileName, size>>>``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from uuid import uuid4

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import col, resolve, resolve_all
from ..session import remove, stage
from ..sources.files import _PIECE, _file_system, _open, qualified, spread
from .ordering import running_sum, sorted_slices

#: What a task copies, and what a file costs besides its bytes.
PACK_BYTES, FILE_COST = 256 << 20, 256 << 10
#: A task that reads files hands them on when it holds so much.
HELD_BYTES = 4 << 20
#: Files, and bytes in them, of an archive that is removed once it has been read again.
STANDING_FILES, STANDING_BYTES = 1_000_000, 4 << 30
#: Folders of files that don't need folders of their own.
FEW_FOLDERS = 1024

# Version modes, characters file names may not hold, longest stored name.
VERSION_MODES = ("all", "latest", "none")
ILLEGAL_CHARACTERS = '<>:"/\\|?*'
CONTROL_CHARACTERS = "".join(map(chr, [*range(32), 127]))
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
NAME_BYTES = 200

_JOB_KEYS = ["record_id", "field_id", "version_number"]


def _numbered(cell: Column) -> Column:
    """The cell's versions as (number, version) pairs, which sort by number; null if it has none."""
    return F.transform(
        cell["versions"], lambda v: F.struct(v["versionNumber"].alias("number"), v.alias("version"))
    )


def file_name(cell: Column, version: Column, field_id: int | Column) -> Column:
    """The version's own name, else the cell's, else one made from field and version."""
    made = F.concat(
        F.lit("fid"),
        (field_id if isinstance(field_id, Column) else F.lit(field_id)).cast("string"),
        F.lit("_v"),
        version["versionNumber"].cast("string"),
        F.lit(".bin"),
    )
    return F.coalesce(
        F.nullif(version["fileName"], F.lit("")), F.nullif(cell["fileName"], F.lit("")), made
    )


def latest_version(cell: Column, field_id: int | Column) -> Column:
    """``struct<version_number, file_name>`` of the newest version; null for an empty cell."""
    newest = F.array_max(_numbered(cell))["version"]
    found = F.struct(
        newest["versionNumber"].alias("version_number"),
        file_name(cell, newest, field_id).alias("file_name"),
    )
    return F.when(newest.isNotNull(), found)


def select_versions(cell: Column, mode: str = "all") -> Column:
    """Versions in ascending order, only the newest, or none."""
    if mode not in VERSION_MODES:
        raise ValueError(f"unknown version mode {mode!r}; one of {VERSION_MODES}")
    ordered = F.sort_array(_numbered(cell))
    chosen = {
        "all": ordered,
        "latest": F.slice(ordered, F.greatest(F.size(ordered), F.lit(1)), F.lit(1)),
        "none": F.slice(ordered, 1, 0),
    }[mode]
    return F.transform(chosen, lambda pair: pair["version"])


def _cells(df: DataFrame, key: str, fields: Mapping[str, int]) -> DataFrame:
    """One row per record and file field."""
    names = dict(zip(resolve_all(df.columns, fields), fields.values()))
    each = F.array(
        *[
            F.struct(F.lit(number).alias("field_id"), col(name).alias("cell"))
            for name, number in names.items()
        ]
    )
    key = resolve(df.columns, key)
    exploded = df.select(col(key).alias("record_id"), F.explode(each).alias("_c"))
    return exploded.select("record_id", "_c.field_id", "_c.cell")


def version_problems(df: DataFrame, key: str, fields: Mapping[str, int]) -> DataFrame:
    """File cells whose version numbers are missing, below 1 or repeated."""
    numbers = F.transform(F.col("cell.versions"), lambda v: v["versionNumber"])
    invalid = F.exists(numbers, lambda n: n.isNull() | (n < 1))
    repeated = F.size(numbers) != F.size(F.array_distinct(numbers))
    problems = F.array_compact(
        F.array(
            F.when(invalid, F.lit("invalid version number")),
            F.when(repeated, F.lit("repeated version number")),
        )
    )
    return _cells(df, key, fields).select(
        "record_id", "field_id", F.explode(problems).alias("problem")
    )


def latest_rows(versions: DataFrame, group: Sequence[str], version: str) -> DataFrame:
    """The newest version per group when versions are kept as rows of their own."""
    others = [name for name in versions.columns if name not in group]
    newest = F.max_by(F.struct(*[col(name) for name in others]), col(version)).alias("_newest")
    grouped = versions.groupBy(*[col(name) for name in group]).agg(newest)
    return grouped.select(*[col(name) for name in group], "_newest.*")


def clean_name(name: Column) -> Column:
    """Name of a downloaded file: illegal characters and outer blanks removed."""
    clean = F.btrim(F.translate(name, ILLEGAL_CHARACTERS, ""), F.lit(BLANKS))
    return F.coalesce(F.nullif(clean, F.lit("")), F.lit("attachment.bin"))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _within_bytes(name: Column) -> Column:
    """The longest prefix of whole characters that fits into NAME_BYTES."""
    cut = F.substring(name.cast("binary"), 1, NAME_BYTES).cast("string")
    # Cutting bytes can only break the last character, which then has to go.
    whole = F.substring(name, F.lit(1), F.length(cut) - 1)
    return (
        F.when(F.octet_length(name) <= NAME_BYTES, name)
        .when(F.is_valid_utf8(cut), cut)
        .otherwise(whole)
    )


def archive_name(name: Column, field_id: Column, version: Column) -> Column:
    """Name of an archived file: also without control characters, outer dots or excess bytes."""
    clean = F.translate(name, ILLEGAL_CHARACTERS + CONTROL_CHARACTERS, "")
    clean = F.btrim(F.btrim(clean, F.lit(BLANKS)), F.lit("."))
    clean = F.nullif(clean, F.lit(""))
    made = F.concat(
        F.lit("fid"), field_id.cast("string"), F.lit("_v"), version.cast("string"), F.lit(".bin")
    )
    return _once(F.coalesce(clean, made), _within_bytes)


def _visible(name: Column) -> Column:
    """Spark does not list files starting with an underscore, so none is stored like that."""
    return F.when(name.startswith("_"), F.concat(F.lit("file"), name)).otherwise(name)


def attachment_jobs(
    df: DataFrame, key: str, fields: Mapping[str, int], table: str, mode: str = "all"
) -> DataFrame:
    """One row per selected version with the path it is archived under.

    A projection and two explodes: no shuffle, whatever the number of files.
    """
    cells = _cells(df, key, fields)
    jobs = cells.withColumn("version", F.explode(select_versions(F.col("cell"), mode))).select(
        "record_id",
        "field_id",
        F.col("version.versionNumber").alias("version_number"),
        file_name(F.col("cell"), F.col("version"), F.col("field_id")).alias("file_name"),
        F.col("version.size").alias("size"),
    )
    stored = _once(
        archive_name(F.col("file_name"), F.col("field_id"), F.col("version_number")), _visible
    )
    parts = ["record_id", "field_id", "version_number"]
    path = F.concat_ws(
        "/",
        F.lit(f"tables/{table}/attachments"),
        *[F.col(part).cast("string") for part in parts],
        stored,
    )
    return jobs.withColumn("path", path)


def download_jobs(
    df: DataFrame, key: str, fields: Mapping[str, int], with_field_id: bool | None = None
) -> DataFrame:
    """The latest version of every file cell and its flat download name.

    The field id becomes part of the name when a whole table is downloaded.
    """
    if with_field_id is None:
        with_field_id = len(fields) > 1
    latest = _cells(df, key, fields).withColumn(
        "latest", latest_version(F.col("cell"), F.col("field_id"))
    )
    parts = ["record_id", "field_id"] if with_field_id else ["record_id"]
    return (
        latest.where(F.col("latest").isNotNull() & F.col("record_id").isNotNull())
        .select("record_id", "field_id", "latest.version_number", "latest.file_name")
        .withColumn(
            "path",
            F.concat_ws("_", *[F.col(p).cast("string") for p in parts], clean_name(F.col("file_name"))),
        )
    )


def _writer(root: str, aside: str, has_uri: bool, keep_going: bool):
    """A task function writing one file per row; returns digest, size and status.

    Files grow in the folder ``aside`` and are moved to their names when complete.
    """

    def pieces(row):
        if not has_uri:
            yield row.content
            return
        with _open(row.uri) as stream:
            while piece := stream.read(_PIECE):
                yield piece

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        system, base = _file_system(root)
        _, growing = _file_system(aside)
        # a folder a task: many tasks creating files in one wait for each other
        growing = f"{growing}/{uuid.uuid4().hex}"
        system.create_dir(growing, recursive=True)
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                digest, size, status, error = hashlib.sha256(), 0, "downloaded", None
                target = f"{base}/{row.path}"
                partial = f"{growing}/{uuid.uuid4().hex}"
                try:
                    if (row.uri if has_uri else row.content) is None:
                        raise FileNotFoundError("no content for this attachment")
                    system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                    with system.open_output_stream(partial) as stream:
                        for piece in pieces(row):
                            digest.update(piece)
                            size += len(piece)
                            stream.write(piece)
                    system.move(partial, target)
                except Exception as problem:
                    if not keep_going:
                        raise
                    status, error = "failed", str(problem)
                ok = status == "downloaded"
                out.append((digest.hexdigest() if ok else None, size if ok else None, status, error))
            written = pd.DataFrame(out, columns=["sha256", "bytes", "status", "error"])
            written["bytes"] = written["bytes"].astype("Int64")
            kept = batch.drop(columns=["uri" if has_uri else "content"]).reset_index(drop=True)
            yield pd.concat([kept, written], axis=1)

    return write


def _packed(work: DataFrame) -> DataFrame:
    """Jobs spread over tasks by the bytes to copy: a large file has a task of its own, small ones share one."""
    known = F.coalesce(F.col("size"), F.lit(0)) if "size" in work.columns else F.lit(0)
    sized = work.withColumn("_bytes", F.greatest(known.cast("bigint"), F.lit(0)) + FILE_COST)
    slices = sorted_slices(sized, [*_JOB_KEYS], "attachment-jobs")
    placed = running_sum(slices, [], "_bytes", "_at").withColumn("_pack", F.floor(F.col("_at") / PACK_BYTES))
    packs = (placed.agg(F.max("_pack")).first()[0] or 0) + 1
    return placed.repartitionByRange(packs, "_pack").select(*work.columns)


def _written(jobs: DataFrame, contents: DataFrame, root: str, keep_going: bool, name: str, finish) -> DataFrame:
    """Write every job's file and stage ``finish`` of the outcome.

    What failed, repeated or lost tasks have left unfinished stands in one folder, which goes with the job.
    """
    source = "uri" if "uri" in contents.columns else "content"
    spark = jobs.sparkSession
    work = jobs.join(contents.select(*_JOB_KEYS, source), _JOB_KEYS, "left")
    if source == "uri":
        work = _packed(work)
    root = qualified(spark, root)
    aside = f"{root.rstrip('/')}/.growing-{uuid4().hex}"
    kept = [f for f in work.schema.fields if f.name != source]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    schema += ", sha256 string, bytes bigint, status string, error string"
    try:
        return stage(finish(work.mapInPandas(_writer(root, aside, source == "uri", keep_going), schema)), name)
    finally:
        remove(spark, aside)


def archive(jobs: DataFrame, contents: DataFrame, root: str) -> DataFrame:
    """Write every job's bytes below ``root``; return the index with digests and sizes.

    ``contents`` has the job keys and either the bytes or the ``uri`` to copy in pieces.
    Files appear under their final name only when complete, so a repeated task is harmless.
    Any missing content fails the job.
    """
    return _written(jobs, contents, root, False, "attachment-index", lambda index: index.drop("status", "error"))


def in_few_folders(jobs: DataFrame) -> DataFrame:
    """The jobs of ``attachment_jobs`` with paths in few folders; three folders for each file take more room than a small file.

    Names tell the files apart by field, version and record.
    """
    folder = F.pmod(F.xxhash64("record_id"), F.lit(FEW_FOLDERS)).cast("string")
    keys = [F.col(key).cast("string") for key in ("field_id", "version_number", "record_id")]
    return jobs.withColumn("path", F.concat_ws("/", folder, F.concat_ws("_", *keys, F.substring_index("path", "/", -1))))


def remove_archive(index: DataFrame, root: str) -> None:
    """Remove a whole archive; the tasks remove the folders of the records in ``index``, or files without such, and the rest is little."""
    spark = index.sparkSession
    places = index.select(F.regexp_replace("path", "(/[^/]*){3}$", "").alias("place")).distinct()
    # only what is below the root
    places = places.where(~F.array_contains(F.split("place", "/"), "..") & ~F.col("place").startswith("/"))
    removed = spread(places, "place", F.lit(0)).mapInArrow(_remover(qualified(spark, root)), "removed bigint")
    removed.agg(F.sum("removed")).first()
    remove(spark, root)


def _remover(root: str):
    """A task function removing files and folders below ``root``; what is gone already is no error."""

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = _file_system(root)
        n = 0
        for batch in batches:
            for place in batch.column(0).to_pylist():
                path = f"{base}/{place}"
                kind = system.get_file_info(path).type
                if kind == fs.FileType.NotFound:
                    continue
                (system.delete_dir if kind == fs.FileType.Directory else system.delete_file)(path)
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["removed"])

    return removed


def fetch(jobs: DataFrame, contents: DataFrame, root: str, existing: DataFrame) -> DataFrame:
    """Write the files not there yet; one status row per job: downloaded, skipped or failed.

    ``existing`` lists the paths already below ``root``. A failing file does not stop others.
    """
    present = existing.select("path").distinct()
    skipped = jobs.join(present, "path", "left_semi")
    missing = jobs.join(present, "path", "left_anti")
    columns = [*jobs.columns, "bytes", "status", "error"]
    idle = skipped.select(
        *jobs.columns,
        F.lit(None).cast("bigint").alias("bytes"),
        F.lit("skipped").alias("status"),
        F.lit(None).cast("string").alias("error"),
    )
    finish = lambda done: done.select(*columns).unionByName(idle)
    return _written(missing, contents, root, True, "attachment-status", finish)


def status_counts(statuses: DataFrame) -> DataFrame:
    return statuses.groupBy("status").agg(F.count(F.lit(1)).alias("files"))


def raise_failures(statuses: DataFrame) -> None:
    """Fail once all files have been tried; the status table stays readable."""
    failed = statuses.where(F.col("status") == "failed").count()
    if failed:
        raise RuntimeError(f"{failed} attachments failed")


def delete_version(
    df: DataFrame, key: str, record_id: int, field: str, version_number: int
) -> DataFrame:
    """The table without one version of a cell; version 0 means the latest."""
    if not isinstance(version_number, int) or version_number < 0:
        raise ValueError("version_number must be a non-negative integer")
    key, name = resolve(df.columns, key), resolve(df.columns, field)
    cell = col(name)
    gone = (
        F.lit(version_number)
        if version_number
        else F.array_max(F.transform(cell["versions"], lambda v: v["versionNumber"]))
    )
    left = F.filter(cell["versions"], lambda v: ~v["versionNumber"].eqNullSafe(gone))
    changed = cell.withField("versions", left)
    hit = (col(key) == record_id) & cell["versions"].isNotNull()
    return df.withColumn(name, F.when(hit, changed).otherwise(cell))


def as_base64(
    df: DataFrame, key: str, fields: Mapping[str, int], contents: DataFrame
) -> DataFrame:
    """Latest contents as base64, one row per record and file field; null when absent.

    ``contents`` has the job keys and either the bytes or a ``uri``; only the files that are asked for are read, in the tasks,
    and a file that isn't there is absent.
    """
    cells = _cells(df, key, fields)
    latest = cells.select(
        "record_id",
        "field_id",
        latest_version(F.col("cell"), F.col("field_id"))["version_number"].alias("version_number"),
    )
    if "uri" not in contents.columns:
        return latest.join(contents.select(*_JOB_KEYS, "content"), _JOB_KEYS, "left").select(
            "record_id", "field_id", F.base64("content").alias("base64")
        )
    placed = latest.join(contents.select(*_JOB_KEYS, "uri"), _JOB_KEYS, "left").select("record_id", "field_id", "uri")
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.schema.fields[:2])
    placed = spread(stage(placed, "places"), "uri", F.lit(0))
    read = placed.mapInPandas(_reader, f"{kept}, content binary")
    return read.select("record_id", "field_id", F.base64("content").alias("base64"))


def _reader(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of each row's file, handed on before they get many."""
    for batch in batches:
        kept, contents, start, held = batch.drop(columns="uri"), [], 0, 0
        for uri in batch["uri"]:
            content = None
            if uri is not None:
                try:
                    with _open(uri) as stream:
                        content = stream.read()
                except FileNotFoundError:
                    pass
            contents.append(content)
            held += len(content or b"")
            if held >= HELD_BYTES:
                yield kept.iloc[start : start + len(contents)].assign(content=contents)
                start, held, contents = start + len(contents), 0, []
        if contents:
            yield kept.iloc[start:].assign(content=contents)
