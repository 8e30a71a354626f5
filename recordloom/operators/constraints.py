"""Field rules and the rows of a table that break them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import col, resolve, unique_labels
from ..functions.literals import is_text
from ..session import stage


@dataclass(frozen=True)
class FieldRule:
    """What one field must look like. An attribute left at None is not checked."""

    label: str
    type: str | None = None
    required: bool | None = None
    unique: bool | None = None
    choices: Sequence[str] | None = None
    field_id: int | None = None
    properties: Mapping | None = None
    mode: str | None = None
    formula: str | None = None
    depends_on: Sequence[str] = ()
    source: str | None = None
    where: str | None = None

    def __post_init__(self):
        if self.mode not in (None, "", "formula", "lookup", "summary"):
            raise ValueError(f"unknown field mode {self.mode!r}")


def blank(column: Column, dtype: T.DataType) -> Column:
    """Null, or empty text."""
    return column.isNull() | (column == "") if is_text(dtype) else column.isNull()


def safe_cast(column: Column, given: T.DataType, wanted: str) -> Column:
    """``try_cast`` that does not raise inside for text that is plainly no whole number.

    A failing cast costs far more than the pattern, and a wrong column fails on every row.
    """
    cast = column.try_cast(wanted)
    if is_text(given) and wanted in ("tinyint", "smallint", "int", "bigint"):
        return F.when(column.rlike(r"^[\s\p{Cntrl}]*[+-]?[0-9]+[\s\p{Cntrl}]*$"), cast)
    return cast


def cast_fails(column: Column, given: T.DataType, wanted: str) -> Column:
    return column.isNotNull() & safe_cast(column, given, wanted).isNull()


def not_a_choice(column: Column, choices: Sequence[str]) -> Column:
    return column.isNotNull() & ~column.isin(*choices)


def row_checks(df: DataFrame, rules: Sequence[FieldRule]) -> list[tuple[str, str, Column]]:
    """(field, rule, predicate true on an offending row) for all row-level rules."""
    types = {field.name: field.dataType for field in df.schema.fields}
    checks = []
    for rule in rules:
        name = resolve(df.columns, rule.label)
        if rule.required:
            checks.append((name, "required", blank(col(name), types[name])))
        if rule.choices is not None:
            checks.append((name, "choice", not_a_choice(col(name), rule.choices)))
        if rule.type and types[name].simpleString() != rule.type:
            checks.append((name, "type", cast_fails(col(name), types[name], rule.type)))
    return checks


def repeats(df: DataFrame, name: str) -> DataFrame:
    """One row: how many rows hold a value of ``name`` that other rows hold too."""
    counts = (
        df.where(col(name).isNotNull())
        .groupBy(col(name).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return counts.agg(
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("violations")
    )


def counted(df: DataFrame, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Offending rows per check, all counted in a single pass."""
    facts = df.agg(*[F.count_if(check).alias(f"_c{i}") for i, (_, _, check) in enumerate(checks)])
    rows = [
        F.struct(F.lit(f).alias("field"), F.lit(r).alias("rule"), F.col(f"_c{i}").alias("violations"))
        for i, (f, r, _) in enumerate(checks)
    ]
    return facts.select(F.inline(F.array(*rows)))


def check_constraints(
    df: DataFrame, key: str, rules: Sequence[FieldRule] = (), exact_fields: bool = False
) -> DataFrame:
    """Rows breaking each rule: ``field, rule, violations``, also where there are none."""
    unique_labels(rule.label for rule in rules)
    key = resolve(df.columns, key)
    checks = [(key, "null key", col(key).isNull())]
    if isinstance(df.schema[key].dataType, T.NumericType):
        checks.append((key, "positive key", col(key) < 1))
    checks += row_checks(df, rules)
    parts = [counted(df, checks)]
    unique = [key] + [resolve(df.columns, rule.label) for rule in rules if rule.unique]
    for name in dict.fromkeys(unique):
        rule = "unique key" if name == key else "unique"
        parts.append(
            repeats(df, name).select(
                F.lit(name).alias("field"), F.lit(rule).alias("rule"), "violations"
            )
        )
    if exact_fields:
        known = {resolve(df.columns, rule.label) for rule in rules} | {key}
        extra = [(name, "unexpected field", 1) for name in df.columns if name not in known]
        if extra:
            schema = "field string, rule string, violations bigint"
            parts.append(df.sparkSession.createDataFrame(extra, schema))
    return reduce(DataFrame.unionByName, parts)


def violating_rows(df: DataFrame, key: str, rules: Sequence[FieldRule] = ()) -> DataFrame:
    """The rows behind the counts of ``check_constraints``: all columns, ``_field`` and ``_rule``.

    A row stands there once for each rule it breaks. Repeated values are found by an aggregate
    and written, so the join with them has two plain sides and hot values can be split.
    """
    key = resolve(df.columns, key)
    checks = [(key, "null key", col(key).isNull())]
    if isinstance(df.schema[key].dataType, T.NumericType):
        checks.append((key, "positive key", col(key) < 1))
    checks += row_checks(df, rules)
    broken = F.array_compact(
        F.array(*[
            F.when(check, F.struct(F.lit(name).alias("_field"), F.lit(rule).alias("_rule")))
            for name, rule, check in checks
        ])
    )
    named = [F.col("_broken._field").alias("_field"), F.col("_broken._rule").alias("_rule")]
    own = [col(name) for name in df.columns]
    parts = [df.select(*own, F.explode(broken).alias("_broken")).select(*own, *named)]
    unique = [key] + [resolve(df.columns, rule.label) for rule in rules if rule.unique]
    for name in dict.fromkeys(unique):
        counts = df.where(col(name).isNotNull()).groupBy(col(name).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        shared = stage(counts.where("_n > 1").select("_v"), "repeated-values")
        rule = "unique key" if name == key else "unique"
        parts.append(
            df.join(shared, col(name) == F.col("_v"), "left_semi").select(
                *own, F.lit(name).alias("_field"), F.lit(rule).alias("_rule")
            )
        )
    return reduce(DataFrame.unionByName, parts)


def check_parts(
    parts: Mapping[str, DataFrame], expected_rows: Mapping[str, int] | None = None
) -> DataFrame:
    """Parts of one table must agree on every field's id, label and type, and on counts.

    Only schemas and one count per part are looked at.
    """
    first = next(iter(parts.values()))
    signature = _signature(first)
    rows = []
    for name, part in parts.items():
        count = part.agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(name).alias("part"),
            F.lit(_signature(part) == signature).alias("same_fields"),
            "records",
        )
        wanted = None if expected_rows is None else expected_rows.get(name)
        rows.append(
            count.withColumn(
                "same_count",
                F.lit(True) if wanted is None else F.col("records") == F.lit(wanted),
            )
        )
    return reduce(DataFrame.unionByName, rows)


def _signature(df: DataFrame) -> list[tuple]:
    return [
        (field.metadata.get("field_id"), field.name, field.dataType.simpleString())
        for field in df.schema.fields
    ]
