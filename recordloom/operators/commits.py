"""Writes that take effect: stage the changed table, check it, and swap it for the old one."""

from __future__ import annotations

import json
from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import col, resolve
from ..session import exists, publish, read_text, recover, remove, stage, write_text
from ..sources.keyed import FILE, FILE_ROWS, CommitError, KeyedTable
from .changes import delete_records
from .query import Where
from .upsert import UpsertResult, check_result, upsert

# Hidden from Spark's readers; it travels with the table.
_LEDGER = "_commits.json"


def _done(spark: SparkSession, path: str) -> list[str]:
    ledger = f"{path.rstrip('/')}/{_LEDGER}"
    if not exists(spark, ledger):
        return []
    return json.loads(read_text(spark, ledger))


def _swap(spark: SparkSession, path: str, table: DataFrame, rows: int, commit_id: str | None) -> None:
    """Write ``table``, make sure it has ``rows`` rows, and put it in the place of ``path``."""
    staged = f"{path.rstrip('/')}.{uuid4().hex}.tmp"
    try:
        table.write.parquet(staged)
        written = spark.read.schema(table.schema).parquet(staged).count()
        if written != rows:
            raise CommitError(f"{written} rows were written where {rows} belong")
        done = _done(spark, path) + ([commit_id] if commit_id else [])
        write_text(spark, f"{staged}/{_LEDGER}", json.dumps(done))
        publish(spark, staged, path.rstrip("/"))
    except BaseException:
        remove(spark, staged)
        raise


def commit_upsert(
    spark: SparkSession, path: str, source: DataFrame, key: str, commit_id: str | None = None, **options
) -> DataFrame | None:
    """Merge ``source`` into the Parquet table at ``path``; return the outcome of every line.

    Lines with errors change nothing, as in ``upsert``, whose options apply. The old table stays until the new one is complete
    and its result is sound. A ``commit_id`` that the table has seen writes nothing and
    returns None, so a run that was cut short can be started again.
    """
    recover(spark, path)
    if commit_id and commit_id in _done(spark, path):
        return None
    target = spark.read.parquet(path)
    result: UpsertResult = upsert(target, source, key, **options)
    lines = stage(result.lines, "commit-lines")
    if broken := [row["rule"] for row in check_result(lines, source.count()).collect()]:
        raise CommitError(f"the outcome is not sound: {', '.join(broken)}")
    created = lines.where(F.col("action") == "created").count()
    _swap(spark, path, result.merged, target.count() + created, commit_id)
    return lines


def commit_delete(
    spark: SparkSession, path: str, where: Where | Sequence[int] | DataFrame, key: str | None = None,
    commit_id: str | None = None,
) -> int | None:
    """Delete records of the Parquet table at ``path``; return how many, or None for a repeated commit."""
    recover(spark, path)
    if commit_id and commit_id in _done(spark, path):
        return None
    target = spark.read.parquet(path)
    result = delete_records(target, where, key)
    deleted = result.number_deleted().first()["number_deleted"]
    _swap(spark, path, result.kept, target.count() - deleted, commit_id)
    return deleted


def commit_upsert_files(
    table: KeyedTable, source: DataFrame, commit_id: str | None = None, file_rows: int = FILE_ROWS, **options
) -> tuple[KeyedTable, DataFrame | None]:
    """Merge ``source`` into a keyed table; return its next version and the outcome of every line.

    Only files that hold an updated record are rewritten, created records go to files of their own. Merged on the record
    key, files beyond the keys of the lines are not even read, unless a rule asks for unique values or they stand among many
    that are read. A ``commit_id`` that the table has seen writes nothing and returns no lines.
    """
    if commit_id and commit_id in table.version.commits:
        return table, None
    key, merge_on = table.version.key, options.get("merge_on")
    by_key = merge_on is not None and resolve(table.schema.names, merge_on) == key
    if by_key and not any(rule.unique for rule in options.get("rules", ()) if resolve(table.schema.names, rule.label) != key):
        others = (options.get("line", "line"), options.get("present"))
        given = next(name for name in source.columns if name not in others and resolve(table.schema.names, name) == key)
        target = table._read(table.touched(source.select(col(given))))
    else:
        target = table.read()
    result: UpsertResult = upsert(target, source, key, **options)
    lines = stage(result.lines, "commit-lines")
    if broken := [row["rule"] for row in check_result(lines, source.count(), numbered=False).collect()]:
        raise CommitError(f"the outcome is not sound: {', '.join(broken)}")
    counts = {row["action"]: row["count"] for row in lines.groupBy("action").count().collect()}
    if not counts.keys() & {"created", "updated"}:
        rows = table.version.rows
        return table.rewrite([], None, None, rows, commit_id) if commit_id else table, lines
    updated = lines.where(F.col("action") == "updated").select("record_id")
    old = table.touched(updated) if "updated" in counts else []
    changed = result.updated_rows(table.with_files(old)) if old else None
    created = result.created_rows() if "created" in counts else None
    rows = table.version.rows + counts.get("created", 0)
    return table.rewrite(old, changed, created, rows, commit_id, file_rows), lines


def commit_delete_files(
    table: KeyedTable, where: Where | Sequence[int] | DataFrame, commit_id: str | None = None
) -> tuple[KeyedTable, int | None]:
    """Delete records of a keyed table; return its next version and how many there were.

    Only files that hold one of them are rewritten, and dropped if nothing is left in them.
    """
    if commit_id and commit_id in table.version.commits:
        return table, None
    key = table.version.key
    deleted = stage(delete_records(table.read(), where, key).deleted.select(col(key)), "deleted")
    n = deleted.count()
    if not n:
        return table.rewrite([], None, None, table.version.rows, commit_id) if commit_id else table, 0
    old = table.touched(deleted)
    rows = table.with_files(old)
    kept = rows.join(deleted.select(col(key).alias("_gone")), col(key) == F.col("_gone"), "left_anti")
    return table.rewrite(old, kept.select(*table.schema.names, FILE), None, table.version.rows - n, commit_id), n
