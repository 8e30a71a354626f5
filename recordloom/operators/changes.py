"""Change feeds, table differences and deletes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import col, resolve, resolve_all
from ..functions.literals import utc_second_literal
from ..functions.predicates import truth
from .query import Where, as_predicate

# Change types.
CREATE, MODIFY, DELETE = "CREATE", "MODIFY", "DELETE"


def modified_since(
    df: DataFrame,
    modified: str,
    after: datetime | str,
    key: str,
    fields: Sequence[str] = (),
    created: str | None = None,
) -> DataFrame:
    """Records changed at or after the whole second of ``after``.

    With a ``created`` timestamp column new records are told from modified ones.
    """
    modified, key = resolve(df.columns, modified), resolve(df.columns, key)
    start = utc_second_literal(after, df.schema[modified].dataType)
    kind = F.lit(MODIFY)
    if created:
        kind = F.when(col(resolve(df.columns, created)) >= start, CREATE).otherwise(MODIFY)
    return df.where(col(modified) >= start).select(
        col(key).alias("record_id"),
        kind.alias("change_type"),
        col(modified).alias("changed_at"),
        *[col(name) for name in resolve_all(df.columns, fields)],
    )


def table_diff(
    before: DataFrame,
    after: DataFrame,
    key: str,
    fields: Sequence[str] | None = None,
    include_details: bool = False,
) -> DataFrame:
    """Records created, modified or deleted between two states, with the fields changed.

    Only the compared fields are read and shuffled.
    """
    key = resolve(before.columns, key)
    names = resolve_all(before.columns, fields or [n for n in before.columns if n != key])
    old = before.select(
        col(key).alias("_old"), *[col(n).alias(f"_a{i}") for i, n in enumerate(names)]
    )
    new = after.select(
        col(resolve(after.columns, key)).alias("_new"),
        *[col(resolve(after.columns, n)).alias(f"_b{i}") for i, n in enumerate(names)],
    )
    kind = (
        F.when(F.col("_old").isNull(), CREATE)
        .when(F.col("_new").isNull(), DELETE)
        .otherwise(MODIFY)
    )
    differing = [
        F.when(~F.col(f"_a{i}").eqNullSafe(F.col(f"_b{i}")), F.lit(n)) for i, n in enumerate(names)
    ]
    changed = F.when(kind == MODIFY, F.array_compact(F.array(*differing))).otherwise(
        F.array().cast("array<string>")
    )
    rows = old.join(new, F.col("_old") == F.col("_new"), "full").select(
        F.coalesce("_old", "_new").alias("record_id"),
        kind.alias("change_type"),
        changed.alias("changed_fields"),
        *(_details(names) if include_details else []),
    )
    return rows.where((F.col("change_type") != MODIFY) | (F.size("changed_fields") > 0))


def _details(names: Sequence[str]):
    for side, prefix, mark in (("before", "_a", "_old"), ("after", "_b", "_new")):
        values = F.struct(*[F.col(f"{prefix}{i}").alias(n) for i, n in enumerate(names)])
        yield F.when(F.col(mark).isNotNull(), values).alias(side)


def change_count(entries: DataFrame) -> DataFrame:
    """Entries per change type."""
    return entries.groupBy("change_type").agg(F.count(F.lit(1)).alias("changes"))


def changed_tables(
    tables: Mapping[str, DataFrame],
    modified: Mapping[str, str],
    since: datetime | str,
    fail: bool = False,
) -> DataFrame:
    """Per table: records changed since a capture began, and whether there are any."""
    parts = []
    for name, df in tables.items():
        column = resolve(df.columns, modified[name])
        start = utc_second_literal(since, df.schema[column].dataType)
        parts.append(
            df.where(col(column) >= start)
            .agg(F.count(F.lit(1)).alias("changes"))
            .select(F.lit(name).alias("table"), "changes", (F.col("changes") > 0).alias("changed"))
        )
    result = reduce(DataFrame.unionByName, parts)
    if fail:
        names = sorted(row["table"] for row in result.where("changed").collect())
        if names:
            raise RuntimeError(f"tables changed during the capture: {names}")
    return result


#: Up to so many ids are written into the predicate, where they reach the scan.
FEW_IDS = 100


@dataclass(frozen=True)
class DeleteResult:
    kept: DataFrame
    deleted: DataFrame

    def number_deleted(self) -> DataFrame:
        return self.deleted.agg(F.count(F.lit(1)).alias("number_deleted"))


def delete_records(
    df: DataFrame, where: Where | Sequence[int] | DataFrame, key: str | None = None
) -> DeleteResult:
    """Split a table into kept and deleted rows by predicate, id list or id table.

    Ids may repeat or be unknown. A short list reaches the scan; a long list or an id table becomes a join, which Spark
    broadcasts only if the ids are measured small.
    """
    if isinstance(where, (list, tuple, set)):
        ids = sorted({int(i) for i in where})
        if key is not None and len(ids) <= FEW_IDS:
            listed = col(resolve(df.columns, key)).isin(ids)
            return DeleteResult(df.where(~truth(listed)), df.where(listed))
        where = df.sparkSession.createDataFrame([(i,) for i in ids], "id bigint")
    if isinstance(where, DataFrame):
        if key is None:
            raise ValueError("deleting by id needs the key column")
        ids = where.select(col(where.columns[0]).alias("_id"))
        match = col(resolve(df.columns, key)) == F.col("_id")
        return DeleteResult(df.join(ids, match, "left_anti"), df.join(ids, match, "left_semi"))
    predicate = as_predicate(df, where)
    if predicate is None or isinstance(where, (int, float, bool)):
        raise ValueError("where must be a predicate or record ids")
    return DeleteResult(df.where(~truth(predicate)), df.where(predicate))


def filter_ids(df: DataFrame, key: str, ids: Sequence[int] | DataFrame, few: int = FEW_IDS) -> DataFrame:
    """Keep the records with the given ids: a pushed-down list, or a semi join for many."""
    key = resolve(df.columns, key)
    if not isinstance(ids, DataFrame):
        ids = sorted({int(i) for i in ids})
        if len(ids) <= few:
            return df.where(col(key).isin(ids))
        ids = df.sparkSession.createDataFrame([(i,) for i in ids], "id bigint")
    wanted = ids.select(col(ids.columns[0]).alias("_id"))
    return df.join(wanted, col(key) == F.col("_id"), "left_semi")
