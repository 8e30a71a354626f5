"""Insert-or-update with an outcome for every input line."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import col, resolve, resolve_all
from ..functions.predicates import truth
from ..session import stage
from .constraints import FieldRule, blank, cast_fails, not_a_choice, safe_cast
from .ordering import global_rank

LINE, PRESENT = "_line", "_present"


@dataclass(frozen=True)
class UpsertResult:
    """``lines``: line, record_id, action, errors. ``merged``: the table afterwards."""

    lines: DataFrame
    merged: DataFrame
    key: str
    #: Any part of the target with updates applied, further columns kept; and the created records.
    updated_rows: Callable[[DataFrame], DataFrame]
    created_rows: Callable[[], DataFrame]

    def summary(self) -> DataFrame:
        return outcome(self.lines)

    def returned(self, fields: Sequence[str] = ()) -> DataFrame:
        """The written records: the key and the fields asked for."""
        names = dict.fromkeys([self.key, *resolve_all(self.merged.columns, fields)])
        written = self.lines.where(F.col("action") != "error").select(
            F.col("record_id").alias("_id")
        )
        return self.merged.join(written, col(self.key) == F.col("_id"), "left_semi").select(
            *[col(name) for name in names]
        )


def _provided(name: str) -> Column:
    return F.array_contains(F.col(PRESENT), name)


def _row_errors(source: DataFrame, target: DataFrame, rules, names) -> list[Column]:
    """Messages a line earns on its own values."""
    by_label = {resolve(target.columns, rule.label): rule for rule in rules}
    errors = []
    for name in names:
        given, wanted = source.schema[name].dataType, target.schema[name].dataType
        rule = by_label.get(name)
        if given != wanted:
            failed = cast_fails(col(name), given, wanted.simpleString())
            message = F.lit(f"{name}: not a valid {wanted.simpleString()}")
            errors.append(F.when(failed, message))
        if rule and rule.choices is not None:
            bad = not_a_choice(col(name), rule.choices)
            errors.append(F.when(bad, F.lit(f"{name}: not an allowed choice")))
        if rule and rule.required:
            missing = _provided(name) & blank(col(name), given)
            errors.append(F.when(missing, F.lit(f"{name}: a value is required")))
    return errors


def _check_lines(source: DataFrame, target: DataFrame, merge_on: str | None, rules) -> DataFrame:
    """Typed lines with their errors, including missing and repeated merge keys."""
    names = [name for name in source.columns if name not in (LINE, PRESENT)]
    errors = _row_errors(source, target, rules, names)
    if merge_on:
        errors.append(F.when(col(merge_on).isNull(), F.lit(f"{merge_on}: the merge key is missing")))
    typed = [
        safe_cast(
            col(name), source.schema[name].dataType, target.schema[name].dataType.simpleString()
        ).alias(name)
        for name in names
    ]
    listed = F.array_compact(F.array(*errors)) if errors else F.array().cast("array<string>")
    lines = source.select(LINE, PRESENT, *typed, listed.alias("_errors"))
    if not merge_on:
        return lines
    # Lines without a key are errors already and take no part in the join.
    keyed, blank_key = lines.where(col(merge_on).isNotNull()), lines.where(col(merge_on).isNull())
    firsts = _repeated(keyed, col(merge_on)).withColumnRenamed("_value", "_key")
    joined = keyed.join(firsts, col(merge_on) == F.col("_key"), "left")
    repeated = F.concat(
        F.lit(f"{merge_on}: already used on line "), F.col("_first").cast("string")
    )
    marked = joined.withColumn(
        "_errors",
        F.when(
            truth(F.col(LINE) != F.col("_first")), F.array_append("_errors", repeated)
        ).otherwise(F.col("_errors")),
    )
    return marked.drop("_key", "_first").unionByName(blank_key)


def _repeated(lines: DataFrame, value: Column) -> DataFrame:
    """Values that several lines hold, with the first of these lines.

    Found by a combining aggregate and written: few rows are broadcast by their measured size, and
    with many the join with them has two plain sides, whose hot values Spark splits.
    """
    counted = lines.groupBy(value.alias("_value")).agg(
        F.min(LINE).alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    return stage(counted.where("_n > 1").drop("_n"), "upsert-repeated")


def _match(lines, target, key, merge_on, names) -> DataFrame:
    """Existing records the valid lines refer to, and whether they would change them.

    An inner join from the staged lines: with few lines Spark broadcasts them by their
    measured size and the target is read without a shuffle.
    """
    valid = lines.where(F.size("_errors") == 0).where(col(merge_on).isNotNull())
    compared = [name for name in names if name != merge_on]
    current = target.select(
        col(merge_on).alias("_key"),
        col(key).alias("record_id"),
        *[col(name).alias(f"_t{i}") for i, name in enumerate(compared)],
    )
    changed = F.lit(False)
    for i, name in enumerate(compared):
        changed = changed | (_provided(name) & ~col(name).eqNullSafe(F.col(f"_t{i}")))
    met = current.join(valid, F.col("_key") == col(merge_on)).select(
        LINE, "record_id", F.when(changed, "updated").otherwise("unchanged").alias("action")
    )
    # several records with one key can't be told apart
    found = met.groupBy(LINE).agg(
        F.min("record_id").alias("record_id"), F.min("action").alias("action"), F.count(F.lit(1)).alias("_n")
    )
    message = F.lit(f"{merge_on}: several records have this key")
    return found.select(
        LINE,
        F.when(F.col("_n") == 1, F.col("record_id")).alias("record_id"),
        F.when(F.col("_n") == 1, F.col("action")).alias("action"),
        F.when(F.col("_n") > 1, message).alias("_shared"),
    )


def _add_unique_errors(lines, target, key, unique, names) -> DataFrame:
    """Mark lines whose unique fields clash with an earlier line or with another record."""
    valid = lines.where(F.size("_errors") == 0)
    parts = []
    for name in [n for n in names if n in unique]:
        values = valid.where(col(name).isNotNull()).select(
            LINE, "record_id", col(name).alias("_value")
        )
        firsts = _repeated(values, F.col("_value"))
        in_source = values.join(firsts, "_value").where(F.col(LINE) > F.col("_first"))
        holders = target.select(col(name).alias("_value"), col(key).alias("_holder"))
        in_target = holders.join(values, "_value").where(
            ~F.col("_holder").eqNullSafe(F.col("record_id"))
        )
        message = F.lit(f"{name}: the value is already in use").alias("message")
        parts += [in_source.select(LINE, message), in_target.select(LINE, message)]
    messages = (
        reduce(DataFrame.union, parts)
        .groupBy(LINE)
        .agg(F.sort_array(F.collect_set("message")).alias("_more"))
    )
    return lines.join(messages, LINE, "left").withColumn(
        "_errors", F.coalesce("_more", "_errors")
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    merge_on: str | None = None,
    line: str = "line",
    rules: Sequence[FieldRule] = (),
    present: str | None = None,
) -> UpsertResult:
    """Merge ``source`` lines into ``target``.

    ``line`` numbers the input. All other source columns are provided values, unless
    ``present`` names an array column listing the fields a line really carries. Lines without
    a match create records: with the given key if that is the merge key, otherwise with the
    next ids in line order. Lines with errors change nothing.
    """
    key = resolve(target.columns, key)
    merge_on = resolve(target.columns, merge_on) if merge_on else None
    given = [name for name in source.columns if name not in (line, present)]
    renamed = {name: resolve(target.columns, name) for name in given}
    if key in renamed.values() and merge_on != key:
        raise ValueError("record keys are assigned, not written, unless they are the merge key")
    if merge_on and merge_on not in renamed.values():
        raise ValueError(f"the source lacks the merge key {merge_on!r}")
    carried = col(present) if present else F.array(*[F.lit(name) for name in renamed.values()])
    source = source.select(
        col(line).cast("bigint").alias(LINE),
        carried.alias(PRESENT),
        *[col(name).alias(label) for name, label in renamed.items()],
    )
    names = list(renamed.values())
    lines = stage(_check_lines(source, target, merge_on, rules), "upsert-lines")
    if merge_on:
        matches = _match(lines, target, key, merge_on, names)
        lines = lines.join(matches, LINE, "left")
        shared = F.array_append("_errors", F.col("_shared"))
        lines = lines.withColumn(
            "_errors", F.when(F.col("_shared").isNotNull(), shared).otherwise(F.col("_errors"))
        ).drop("_shared")
    else:
        lines = lines.withColumn("record_id", F.lit(None).cast(target.schema[key].dataType)).withColumn(
            "action", F.lit(None).cast("string")
        )
    lines = _creation_errors(lines, target, names, rules, key)
    unique = {resolve(target.columns, r.label) for r in rules if r.unique} - {merge_on, key}
    if unique & set(names):
        lines = _add_unique_errors(stage(lines, "upsert-matched"), target, key, unique, names)
    failed = F.size("_errors") > 0
    created = col(key) if merge_on == key else F.lit(None).cast(target.schema[key].dataType)
    lines = lines.withColumn(
        "action",
        F.when(failed, F.lit("error")).otherwise(F.coalesce(F.col("action"), F.lit("created"))),
    ).withColumn("record_id", F.when(~failed, F.coalesce(F.col("record_id"), created)))
    # Written once: the size of the files decides how the target is joined with its updates.
    lines = stage(lines, "upsert-actions")
    if merge_on != key:
        lines = _assign_ids(lines, target, key)
    return UpsertResult(
        lines.select(
            F.col(LINE).alias("line"), "record_id", "action", F.col("_errors").alias("errors")
        ),
        _updated(target, lines, key, names).unionByName(_created(target, lines, key, names)),
        key,
        lambda part: _updated(part, lines, key, names),
        lambda: _created(target, lines, key, names),
    )


def _creation_errors(lines, target, names, rules, key) -> DataFrame:
    """A record can only be created with all its required fields."""
    missing = []
    for rule in rules:
        name = resolve(target.columns, rule.label)
        if rule.required and name != key:
            absent = ~_provided(name) if name in names else F.lit(True)
            missing.append(F.when(absent, F.lit(f"{name}: a value is required")))
    if not missing:
        return lines
    creates = F.col("record_id").isNull() & (F.size("_errors") == 0)
    return lines.withColumn(
        "_errors",
        F.when(creates, F.array_compact(F.array(*missing))).otherwise(F.col("_errors")),
    )


def _assign_ids(lines: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Number the created records after the highest id, in line order."""
    highest = target.agg(F.max(col(key))).first()[0] or 0
    created = global_rank(lines.where(F.col("action") == "created"), [LINE], "_rank")
    created = created.withColumn("record_id", F.col("_rank") + F.lit(highest)).drop("_rank")
    return lines.where(F.col("action") != "created").unionByName(created)


def _updated(target: DataFrame, lines: DataFrame, key: str, names: list[str]) -> DataFrame:
    """The target with updates applied."""
    written = [name for name in names if name != key]
    updates = lines.where(F.col("action") == "updated").select(
        F.col("record_id").alias("_id"),
        F.col(PRESENT),
        *[col(name).alias(f"_u{i}") for i, name in enumerate(written)],
    )
    values = {name: F.col(f"_u{i}") for i, name in enumerate(written)}
    return target.join(updates, col(key) == F.col("_id"), "left").select(
        *[
            F.when(truth(_provided(name)), values[name]).otherwise(col(name)).alias(name)
            if name in values
            else col(name)
            for name in target.columns
        ]
    )


def _created(target: DataFrame, lines: DataFrame, key: str, names: list[str]) -> DataFrame:
    """The created records."""
    return lines.where(F.col("action") == "created").select(
        *[
            F.col("record_id").cast(field.dataType).alias(field.name)
            if field.name == key
            else F.when(_provided(field.name), col(field.name)).alias(field.name)
            if field.name in names
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in target.schema.fields
        ]
    )


def outcome(lines: DataFrame) -> DataFrame:
    """One row of counts and the overall outcome: success, partial or failed."""
    counts = lines.agg(
        F.count(F.lit(1)).alias("total_processed"),
        *[
            F.count_if(F.col("action") == action).alias(name)
            for action, name in (
                ("created", "created"),
                ("updated", "updated"),
                ("unchanged", "unchanged"),
                ("error", "failed_lines"),
            )
        ],
    )
    verdict = (
        F.when(F.col("failed_lines") == 0, "success")
        .when(F.col("failed_lines") == F.col("total_processed"), "failed")
        .otherwise("partial")
    )
    return counts.withColumn("outcome", verdict)


def line_errors(lines: DataFrame) -> DataFrame:
    """One row per message of a failed line."""
    return lines.where(F.col("action") == "error").select(
        "line", F.explode("errors").alias("message")
    )


def check_result(lines: DataFrame, submitted: int, numbered: bool = True) -> DataFrame:
    """Write-result rules that do not hold; empty when the outcome is sound.

    ``numbered``: lines are numbered from 1, as all lines of a source are but not those of one batch.
    """
    facts = lines.agg(
        (F.count(F.lit(1)) != submitted).alias("processed differs from submitted"),
        (F.lit(numbered) & (F.count_if(~F.col("line").between(1, submitted)) > 0)).alias("position out of range"),
        (F.count_if((F.col("action") != "error") & truth(F.col("record_id") < 1)) > 0).alias(
            "record id not positive"
        ),
        (F.count_if((F.col("action") != "error") & F.col("record_id").isNull()) > 0).alias(
            "record id missing"
        ),
        (F.count_if((F.col("action") == "error") & (F.size("errors") == 0)) > 0).alias(
            "error without message"
        ),
    )
    rows = [
        F.struct(F.lit(name).alias("rule"), col(name).alias("broken")) for name in facts.columns
    ]
    return facts.select(F.inline(F.array(*rows))).where("broken").select("rule")


def batch_report(lines: DataFrame, batches: DataFrame, assigned: DataFrame) -> DataFrame:
    """Outcome per batch of a write: line range, bytes and counts per action.

    ``assigned`` maps lines to batch numbers. All batches are written by one job, so a batch
    is either completed together with the others or not reported at all.
    """
    counted = (
        lines.join(assigned, "line")
        .groupBy("batch_number")
        .agg(
            *[
                F.count_if(F.col("action") == action).alias(name)
                for action, name in (
                    ("created", "created"),
                    ("updated", "updated"),
                    ("unchanged", "unchanged"),
                    ("error", "failed_lines"),
                )
            ]
        )
    )
    return batches.join(counted, "batch_number").withColumn("status", F.lit("completed"))
