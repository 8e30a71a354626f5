"""Parent/child relationships: lookup fields, summary fields and data checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import LabelError, col, quoted, resolve, resolve_all, unique_labels
from ..functions.literals import LIST_SEPARATOR
from .query import Where, as_predicate

# Accumulation types of summary fields.
ACCUMULATIONS = (
    "AVG", "SUM", "MAX", "MIN", "STD-DEV", "COUNT",
    "COMBINED-TEXT", "COMBINED-USER", "DISTINCT-COUNT",
)


@dataclass(frozen=True)
class Summary:
    """One summary field: an aggregate over the children of each parent."""

    kind: str
    field: str | None = None
    label: str | None = None
    where: Where = None
    #: Child fields that ``where`` reads; a derivation adds those before the summary.
    where_fields: Sequence[str] = ()

    def __post_init__(self):
        if self.kind not in ACCUMULATIONS:
            raise ValueError(f"unknown accumulation type: {self.kind}")
        if self.kind == "COUNT" and self.field not in (None, 0):
            raise ValueError("COUNT summaries take no field")
        if self.kind != "COUNT" and self.field is None:
            raise ValueError(f"{self.kind} summaries need a field")

    @property
    def name(self) -> str:
        return self.label or (self.kind if self.kind == "COUNT" else f"{self.kind} {self.field}")


def lookup_label(fk_label: str, parent_label: str) -> str:
    return f"{fk_label} - {parent_label}"


def add_lookups(
    child: DataFrame,
    parent: DataFrame,
    fk: str,
    key: str,
    fields: Sequence[str],
    fk_label: str | None = None,
) -> DataFrame:
    """Copy parent columns onto child rows; rows without a parent get nulls.

    A plain left join: Spark broadcasts the parent if it is measured small enough and
    otherwise splits hot foreign keys at run time.
    """
    fk, key = resolve(child.columns, fk), resolve(parent.columns, key)
    names = resolve_all(parent.columns, fields)
    labels = [lookup_label(fk_label or fk, name) for name in names]
    unique_labels([*child.columns, *labels])
    side = parent.select(
        col(key).alias("_parent_key"), *[col(n).alias(a) for n, a in zip(names, labels)]
    )
    return child.join(side, col(fk) == F.col("_parent_key"), "left").drop("_parent_key")


def _aggregate(summary: Summary, value: Column, keep: Column) -> Column:
    given = F.when(keep, value)
    if summary.kind == "COUNT":
        return F.count(F.when(keep, F.lit(1)))
    if summary.kind == "DISTINCT-COUNT":
        return F.count_distinct(given)
    return {
        "AVG": F.avg,
        "SUM": F.sum,
        "MAX": F.max,
        "MIN": F.min,
        "STD-DEV": F.stddev_samp,
    }[summary.kind](given)


def _finish(summary: Summary, found: Column) -> Column:
    """Values of parents without children: zero counts, otherwise null."""
    if summary.kind in ("COUNT", "DISTINCT-COUNT"):
        return F.coalesce(found, F.lit(0).cast("bigint"))
    if summary.kind == "COMBINED-TEXT":
        return F.nullif(F.array_join(F.sort_array(found), LIST_SEPARATOR), F.lit(""))
    if summary.kind == "COMBINED-USER":
        return F.when(F.size(found) > 0, F.sort_array(found))
    return found


def summarize(child: DataFrame, fk: str, summaries: Sequence[Summary]) -> list[DataFrame]:
    """Summaries per foreign key, as one aggregation of the children for each of up to four groups of kinds.

    Plain sums, distinct counts and combined values are aggregated apart: mixing them makes Spark copy every child row once
    per kind, or gather values as objects beside the sums. Combined values are made distinct first, by parent and value, so a
    parent owning most children costs no more than another; only its different values meet in its row.
    """
    fk = resolve(child.columns, fk)
    types = {field.name: field.dataType for field in child.schema.fields}
    conditions = [as_predicate(child, summary.where) for summary in summaries]
    rows = child.where(col(fk).isNotNull())
    if all(condition is not None for condition in conditions):
        rows = rows.where(reduce(or_, conditions))
    key = col(fk).alias("_fk")
    plain, distinct, texts, parts = [], [], {}, []
    for i, (summary, condition) in enumerate(zip(summaries, conditions)):
        keep = F.lit(True) if condition is None else condition
        field = resolve(child.columns, summary.field) if summary.field else None
        value = col(field) if field else F.lit(1)
        if summary.kind == "COMBINED-TEXT":
            text = value.cast("string")
            texts[i] = F.when(keep & (F.trim(text) != ""), F.struct(F.lit(i).alias("_i"), text.alias("_v")))
        elif summary.kind == "COMBINED-USER":
            each = F.explode(value) if isinstance(types[field], T.ArrayType) else value
            users = rows.where(keep).select(key, each.alias("_v")).where(F.col("_v").isNotNull()).distinct()
            parts.append(users.groupBy("_fk").agg(F.collect_list("_v").alias(f"_v{i}")))
        else:
            group = distinct if summary.kind == "DISTINCT-COUNT" else plain
            group.append(_aggregate(summary, value, keep).alias(f"_v{i}"))
    if texts:
        # all texts in one pass over the children
        held = rows.select(key, F.explode(F.array_compact(F.array(*texts.values()))).alias("_p"))
        held = held.select("_fk", "_p.*").distinct()
        lists = [F.collect_list(F.when(F.col("_i") == i, F.col("_v"))).alias(f"_v{i}") for i in texts]
        parts.append(held.groupBy("_fk").agg(*lists))
    return [rows.groupBy(key).agg(*group) for group in (plain, distinct) if group] + parts


def add_summaries(
    parent: DataFrame, child: DataFrame, key: str, fk: str, summaries: Sequence[Summary]
) -> DataFrame:
    """Add summary fields to the parent.

    The parent is shuffled once: every aggregation arrives partitioned by the key already.
    """
    key = resolve(parent.columns, key)
    unique_labels([*parent.columns, *[summary.name for summary in summaries]])
    result = parent
    for part in summarize(child, fk, summaries):
        result = result.join(part, col(key) == F.col("_fk"), "left").drop("_fk")
    outputs = [_finish(s, F.col(f"_v{i}")).alias(s.name) for i, s in enumerate(summaries)]
    return result.select(*[col(name) for name in parent.columns], *outputs)


def check_relationship(
    parent: DataFrame,
    child: DataFrame,
    key: str,
    fk: str,
    lookups: Sequence[str] = (),
    summaries: Sequence[Summary] = (),
    fk_label: str | None = None,
) -> DataFrame:
    """Data that would break a relationship: one row per rule with the rows offending.

    Wrong labels, incomparable key types and colliding generated labels are errors.
    """
    key, fk = resolve(parent.columns, key), resolve(child.columns, fk)
    lookups = resolve_all(parent.columns, lookups)
    for summary in summaries:
        if summary.field:
            resolve(child.columns, summary.field)
    unique_labels([*child.columns, *[lookup_label(fk_label or fk, n) for n in lookups]])
    unique_labels([*parent.columns, *[summary.name for summary in summaries]])
    key_type, fk_type = parent.schema[key].dataType, child.schema[fk].dataType
    numeric = isinstance(key_type, T.NumericType) and isinstance(fk_type, T.NumericType)
    if not numeric and key_type != fk_type:
        raise LabelError(f"{quoted(fk)} cannot refer to {quoted(key)}: types differ")
    repeated = parent.groupBy(col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    facts = repeated.agg(
        F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("_n"))), F.lit(0)).alias("nulls"),
        F.coalesce(
            F.sum(F.when(F.col("_k").isNotNull() & (F.col("_n") > 1), F.col("_n"))), F.lit(0)
        ).alias("repeats"),
    )
    return facts.selectExpr(
        "stack(2, 'parent key is null', nulls, 'parent key repeats', repeats) AS (rule, records)"
    )


def integrity(parent: DataFrame, child: DataFrame, key: str, fk: str) -> DataFrame:
    """Foreign keys without a parent, and parents without children, with row counts.

    Children are counted per key first: the joins then see each key once.
    """
    keys = parent.select(col(resolve(parent.columns, key)).alias("key"))
    used = (
        child.select(col(resolve(child.columns, fk)).alias("key"))
        .where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("records"))
    )
    orphans = used.join(keys, "key", "left_anti").select(
        F.lit("orphan").alias("problem"), "key", "records"
    )
    childless = keys.join(used, "key", "left_anti").select(
        F.lit("childless").alias("problem"), "key", F.lit(0).cast("bigint").alias("records")
    )
    return orphans.unionByName(childless)
