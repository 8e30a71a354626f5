"""Hold a table against a declared contract, and change it to conform.

A column's identity and declared attributes live in its metadata (``field_id``, ``mode``,
``required`` ...), which survives files and renames.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import LabelError, col
from ..session import publish, scratch_path
from .constraints import FieldRule, blank, cast_fails, counted, not_a_choice, repeats, safe_cast
from .formulas import Formula

REPORT = (
    "field string, action string, column string, before string, after string, "
    "reason string, offending_rows bigint"
)

_MANAGED = ("required", "unique", "choices", "formula", "source", "where")


class ConformanceError(ValueError):
    """A table cannot be made to follow its contract."""


def with_field_ids(df: DataFrame, ids: Mapping[str, int]) -> DataFrame:
    """Give columns a stable id that a later rename keeps."""
    for name, number in ids.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, "field_id": number})
    return df


def _canonical(value) -> str | None:
    return None if value is None else json.dumps(value, sort_keys=True, default=list)


def _attributes(rule: FieldRule, field: T.StructField) -> list[tuple]:
    """(name, before, after) of managed attributes that differ; None means not managed."""
    found = []
    if rule.label != field.name:
        found.append(("label", field.name, rule.label))
    if rule.type and rule.type != field.dataType.simpleString():
        found.append(("type", field.dataType.simpleString(), rule.type))
    for name in _MANAGED:
        wanted, current = getattr(rule, name), field.metadata.get(name)
        if wanted is not None and _canonical(wanted) != _canonical(current):
            found.append((name, current, wanted))
    current = json.loads(field.metadata.get("properties", "{}"))
    for name, wanted in (rule.properties or {}).items():
        if _canonical(wanted) != _canonical(current.get(name)):
            found.append((f"properties.{name}", current.get(name), wanted))
    return found


def _match(rule: FieldRule, schema: T.StructType) -> tuple[T.StructField | None, str | None]:
    """The column a rule speaks of: by bound id, else by label ignoring case."""
    bound = [
        f for f in schema.fields if rule.field_id and f.metadata.get("field_id") == rule.field_id
    ]
    if bound:
        return bound[0], None
    # An id may be declared before any column carries one; only a lost id is a conflict.
    if rule.field_id and any("field_id" in f.metadata for f in schema.fields):
        return None, f"no column carries field id {rule.field_id}"
    same = [f for f in schema.fields if f.name.casefold() == rule.label.casefold()]
    if len(same) > 1:
        return None, "several columns match ignoring case"
    return (same[0] if same else None), None


def _conflict(rule: FieldRule, field: T.StructField) -> str | None:
    mode = field.metadata.get("mode", "")
    wanted = rule.mode if rule.mode is not None else ("formula" if rule.formula else None)
    if wanted is not None and wanted != mode:
        return f"field mode is {mode!r}, not {wanted!r}"
    if rule.source is not None and field.metadata.get("source", rule.source) != rule.source:
        return f"{mode} points at {field.metadata['source']!r}"
    if mode == "summary" and rule.where is not None and field.metadata.get("where") != rule.where:
        return "the summary filter differs"
    return None


def _cycle(rules: Sequence[FieldRule]) -> set[str]:
    needs = {rule.label: set(rule.depends_on) for rule in rules}
    sorter = TopologicalSorter(needs)
    try:
        sorter.prepare()
    except CycleError:
        pass
    free: set[str] = set()
    while ready := sorter.get_ready():
        free.update(ready)
        sorter.done(*ready)
    return needs.keys() - free


def _data_checks(rule: FieldRule, field: T.StructField):
    """Row-level predicates behind a rule, each true on a row that breaks it."""
    column = col(field.name)
    if rule.type and rule.type != field.dataType.simpleString():
        yield "values do not cast", cast_fails(column, field.dataType, rule.type)
    if rule.required:
        yield "values are missing", blank(column, field.dataType)
    if rule.choices is not None:
        yield "values are no allowed choice", not_a_choice(column, rule.choices)


def _offending(df: DataFrame, pairs) -> dict[str, list[tuple[str, int]]]:
    """Rows breaking each rule: one pass for all row checks, one count per unique field."""
    checks, frames = [], []
    for rule, field in pairs:
        checks += [(rule.label, reason, check) for reason, check in _data_checks(rule, field)]
        if rule.unique:
            frames.append(
                repeats(df, field.name).select(
                    F.lit(rule.label).alias("field"), F.lit("values repeat").alias("rule"), "violations"
                )
            )
    if checks:
        frames.append(counted(df, checks))
    found: dict[str, list[tuple[str, int]]] = {}
    if frames:
        result = frames[0]
        for frame in frames[1:]:
            result = result.unionByName(frame)
        for row in result.where(F.col("violations") > 0).collect():
            found.setdefault(row["field"], []).append((row["rule"], row["violations"]))
    return found


def _decide(df: DataFrame, rules: Sequence[FieldRule]) -> list[dict]:
    """One decision per rule; only counts per rule leave the cluster."""
    cyclic = _cycle(rules)
    matches = {rule.label: _match(rule, df.schema) for rule in rules}
    pairs = [(rule, matches[rule.label][0]) for rule in rules if matches[rule.label][0]]
    broken = _offending(df, pairs)
    decisions, conflicts = {}, set()
    for rule in rules:
        field, reason = matches[rule.label]
        attributes = _attributes(rule, field) if field else []
        if reason is None and rule.label in cyclic:
            reason = "its dependencies form a cycle"
        if reason is None and field:
            reason = _conflict(rule, field)
        rows = 0
        if reason is None and rule.label in broken:
            reason = "; ".join(text for text, _ in sorted(broken[rule.label]))
            rows = sum(count for _, count in broken[rule.label])
        if reason:
            action = "conflict"
            conflicts.add(rule.label)
        else:
            action = "create" if field is None else "update" if attributes else "unchanged"
        decisions[rule.label] = {
            "rule": rule, "field": field, "action": action, "attributes": attributes,
            "reason": reason, "rows": rows,
        }
    _block_dependants(decisions, conflicts)
    return list(decisions.values())


def _block_dependants(decisions: dict, conflicts: set[str]) -> None:
    spreading = True
    while spreading:
        spreading = False
        for label, decision in decisions.items():
            if label not in conflicts and conflicts & set(decision["rule"].depends_on):
                decision.update(action="conflict", reason="a field it depends on has a conflict")
                conflicts.add(label)
                spreading = True


def _text(attributes, position: int) -> str | None:
    parts = [f"{item[0]}={_canonical(item[position])}" for item in attributes]
    return "; ".join(parts) or None


def conformance(df: DataFrame, rules: Sequence[FieldRule]) -> DataFrame:
    """One row per declared field: create, update, unchanged or conflict, and why."""
    rows = [
        (
            d["rule"].label,
            d["action"],
            d["field"].name if d["field"] else None,
            _text(d["attributes"], 1),
            _text(d["attributes"], 2),
            d["reason"],
            d["rows"],
        )
        for d in _decide(df, rules)
    ]
    return df.sparkSession.createDataFrame(rows, REPORT)


def _metadata(rule: FieldRule, current: Mapping) -> dict:
    result = dict(current)
    for name in _MANAGED:
        value = getattr(rule, name)
        if value is not None:
            result[name] = list(value) if name == "choices" else value
    if rule.field_id:
        result["field_id"] = rule.field_id
    if rule.mode or rule.formula:
        result["mode"] = rule.mode or "formula"
    if rule.properties:
        merged = {**json.loads(result.get("properties", "{}")), **rule.properties}
        result["properties"] = json.dumps(merged, sort_keys=True)
    return result


Deriver = Callable[[DataFrame], DataFrame]


def conform(
    df: DataFrame, rules: Sequence[FieldRule], derived: Mapping[str, Deriver] | None = None
) -> DataFrame:
    """The table changed to follow its contract; columns are added, renamed or cast, not dropped.

    ``derived`` supplies, per label, the step adding a lookup or summary column. Conflicts,
    or a result that still does not conform, are errors.
    """
    decisions = _decide(df, rules)
    conflicts = [d["rule"].label for d in decisions if d["action"] == "conflict"]
    if conflicts:
        raise ConformanceError(f"fields in conflict: {conflicts}")
    existing = {d["field"].name: d["rule"] for d in decisions if d["field"]}
    columns = []
    for field in df.schema.fields:
        rule = existing.get(field.name)
        if rule is None:
            columns.append(col(field.name))
            continue
        value = col(field.name)
        if rule.type and rule.type != field.dataType.simpleString():
            value = safe_cast(value, field.dataType, rule.type)
        columns.append(value.alias(rule.label, metadata=_metadata(rule, field.metadata)))
    result = df.select(*columns)
    created = {d["rule"].label: d["rule"] for d in decisions if d["action"] == "create"}
    needs = {label: set(rule.depends_on) & created.keys() for label, rule in created.items()}
    for label in TopologicalSorter(needs).static_order():
        result = _create(result, created[label], (derived or {}).get(label))
    left = [d["rule"].label for d in _decide(result, rules) if d["action"] != "unchanged"]
    if left:
        raise ConformanceError(f"fields still not conforming: {left}")
    return result


def _create(df: DataFrame, rule: FieldRule, step: Deriver | None) -> DataFrame:
    if step is not None:
        df = step(df)
        if rule.label not in df.columns:
            raise LabelError(f"the derivation of {rule.label!r} did not add it")
    else:
        value = Formula(rule.formula).column() if rule.formula else F.lit(None)
        df = df.withColumn(rule.label, value.cast(rule.type or "string"))
    return df.withMetadata(rule.label, _metadata(rule, df.schema[rule.label].metadata))


def publish_conformed(
    df: DataFrame,
    rules: Sequence[FieldRule],
    path: str,
    derived: Mapping[str, Deriver] | None = None,
) -> DataFrame:
    """Conform, write aside, check what was written, and only then move it to ``path``."""
    spark = df.sparkSession
    result = conform(df, rules, derived)
    staged = scratch_path(spark, "conformed")
    result.write.parquet(staged)
    written = spark.read.schema(result.schema).parquet(staged)
    if any(d["action"] != "unchanged" for d in _decide(written, rules)):
        raise ConformanceError("the written table does not conform")
    publish(spark, staged, path)
    return spark.read.schema(result.schema).parquet(path)


def drop_fields(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Drop columns by exact label."""
    unknown = sorted(set(labels) - set(df.columns))
    if unknown:
        raise LabelError(f"no such fields: {unknown}")
    return df.drop(*labels)
