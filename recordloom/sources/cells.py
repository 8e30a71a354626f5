"""Wire records: one JSON object per record, keyed by field id, each cell wrapped in a value."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import LabelError, col, resolve


# Nulls are kept and timestamps keep their microseconds, so values survive a round trip.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "allowSingleQuotes": "false",
    "mode": "FAILFAST",
}


@dataclass(frozen=True)
class WireField:
    """One captured field: id, label and Spark type."""

    id: int
    label: str
    type: str = "string"


def check_fields(fields: Sequence[WireField]) -> None:
    for field in fields:
        if not isinstance(field.id, int) or isinstance(field.id, bool):
            raise ValueError("field ids must be integers")
    for what, values in (("ids", [f.id for f in fields]), ("labels", [f.label for f in fields])):
        if len(set(values)) != len(values):
            raise LabelError(f"field {what} are not unique")


def wire_fields(df: DataFrame, key: str, key_id: int = 3, first_id: int = 6) -> list[WireField]:
    """Fields of a table: ids from column metadata where present, else numbered in order."""
    key = resolve(df.columns, key)
    known = {f.name: f.metadata["field_id"] for f in df.schema.fields if "field_id" in f.metadata}
    known.setdefault(key, key_id)
    free = (i for i in range(first_id, 10**9) if i not in set(known.values()))
    return [
        WireField(known.get(f.name) or next(free), f.name, f.dataType.simpleString())
        for f in df.schema.fields
    ]


def to_wire(df: DataFrame, fields: Sequence[WireField], alias: str = "value") -> Column:
    """Each row as its wire record; keys sorted as text, nulls kept, no NaN or infinity."""
    check_fields(fields)
    types = {field.name: field.dataType for field in df.schema.fields}
    cells = []
    for field in sorted(fields, key=lambda f: str(f.id)):
        value = all_finite(col(field.label), types[field.label], field.label)
        cells.append(F.struct(value.alias("value")).alias(str(field.id)))
    return F.to_json(F.struct(*cells), JSON_OPTIONS).alias(alias)


def _holds_numbers_with_fractions(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _holds_numbers_with_fractions(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _holds_numbers_with_fractions(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return any(_holds_numbers_with_fractions(field.dataType) for field in dtype.fields)
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def all_finite(value: Column, dtype: T.DataType, label: str) -> Column:
    """The value, failing the job on NaN or infinity anywhere inside it."""
    if not _holds_numbers_with_fractions(dtype):
        return value
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda item: all_finite(item, dtype.elementType, label))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value, lambda _, item: all_finite(item, dtype.valueType, label))
    if isinstance(dtype, T.StructType):
        parts = [all_finite(value[f.name], f.dataType, label).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    return finite(value, label)


def finite(value: Column, label: str) -> Column:
    """The value, failing the job on NaN or infinity: neither exists in JSON."""
    broken = F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(broken, F.raise_error(F.lit(f"{label}: not a finite number"))).otherwise(value)


def wire_schema(fields: Sequence[WireField]) -> str:
    return ", ".join(f"`{field.id}` STRUCT<value: {field.type}>" for field in fields)


def unknown_ids(line: Column, fields: Sequence[WireField]) -> Column:
    known = F.array(*[F.lit(str(field.id)) for field in fields])
    return F.array_except(F.json_object_keys(line), known)


def from_wire(df: DataFrame, fields: Sequence[WireField], line: str = "value") -> DataFrame:
    """Label columns from wire records; a missing cell or value is null.

    A line that is no object, or holds an id no field has, fails the job.
    """
    check_fields(fields)
    text = col(line)
    extra = unknown_ids(text, fields)
    parsed = (
        F.when(
            F.json_object_keys(text).isNull() | ~_one_value(text),
            F.raise_error(F.concat(F.lit("not a record object: "), text)),
        )
        .when(
            F.size(extra) > 0,
            F.raise_error(
                F.concat(F.lit("unknown fields "), F.array_join(extra, ", "), F.lit(" in: "), text)
            ),
        )
        .otherwise(F.from_json(text, wire_schema(fields), JSON_OPTIONS))
    )
    return df.select(parsed.alias("_record")).select(
        *[F.col(f"_record.`{field.id}`.value").alias(field.label) for field in fields]
    )


def _one_value(line: Column) -> Column:
    """Whether nothing follows the first value of a line.

    Spark's parsers stop there. The line is therefore looked at as the only item of an array
    and as the only value of an object: text that closes one of them early cannot fit the
    other.
    """
    items = F.json_array_length(F.concat(F.lit("["), line, F.lit("]")))
    keys = F.json_object_keys(F.concat(F.lit('{"v":'), line, F.lit("}")))
    return F.coalesce((items == 1) & (F.size(keys) == 1), F.lit(False))


def is_json(line: Column) -> Column:
    """Whether the whole line is one JSON value."""
    item = F.concat(F.lit("["), line, F.lit("]"))
    parsed = F.from_json(item, "array<string>", {"allowSingleQuotes": "false"})
    begins = line.rlike(r"^\s*[\[{\"\-0-9tfnNI]")
    return F.coalesce(F.when(begins & _one_value(line), F.size(parsed) == 1), F.lit(False))


def line_kinds(line: Column) -> Column:
    """What a JSON line holds: ``object``, ``other`` or ``invalid``."""
    return F.when(~is_json(line), "invalid").when(line.rlike(r"^\s*\{"), "object").otherwise("other")


def check_json_lines(df: DataFrame, line: str, group: Sequence[str] = ()) -> DataFrame:
    """Counts per file or group: items (valid lines), invalid lines, lines that are no object."""
    kinds = df.select(*[col(name) for name in group], line_kinds(col(line)).alias("_kind"))
    return kinds.groupBy(*[col(name) for name in group]).agg(
        F.count_if(F.col("_kind") != "invalid").alias("items"),
        F.count_if(F.col("_kind") == "invalid").alias("invalid"),
        F.count_if(F.col("_kind") == "other").alias("non_objects"),
    )
