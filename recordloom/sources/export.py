"""Exports: CSV, deterministic JSON lines, and copies of a set of tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import col, resolve
from ..operators.query import TOP_K_LIMIT, Where, _count, select_where
from ..operators.ordering import global_rank
from ..session import publish, remove
from .cells import JSON_OPTIONS, all_finite


#: Values keep their blanks, quotes are doubled, null is an empty field and blank text is ``""``.
CSV_OPTIONS = {
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "escape": '"',
    "emptyValue": '""',
    "nullValue": "",
}


def _in_key_order(df: DataFrame, key: str, record_limit: int | None) -> DataFrame:
    """Range-partitioned and sorted by key, cut to the first ``record_limit`` records."""
    if record_limit is not None:
        if record_limit <= TOP_K_LIMIT:
            df = df.orderBy(col(key)).limit(record_limit)
        else:
            ranked = global_rank(df, [key], "_rank").where(F.col("_rank") <= record_limit)
            df = ranked.drop("_rank")
    return df.repartitionByRange(col(key)).sortWithinPartitions(col(key))


def export_csv(
    df: DataFrame,
    table: str,
    output_dir: str,
    key: str,
    where: Where = None,
    record_limit: int | None = None,
    on: date | None = None,
    single_file: bool = False,
) -> str:
    """Write matching records in key order to ``{table}_{date}.csv``; return its path.

    The result is a folder of key-ordered parts, each with the header, or one part with
    ``single_file``. Nothing matching writes nothing and returns ``""``. An earlier export of
    the same name is replaced only once the new one is complete.
    """
    _count(record_limit, "record_limit", optional=True)
    spark, key = df.sparkSession, resolve(df.columns, key)
    rows = select_where(df, where)
    if record_limit == 0 or rows.isEmpty():
        return ""
    name = f"{table}_{(on or date.today()).isoformat()}.csv"
    final = f"{output_dir.rstrip('/')}/{name}"
    staged = f"{output_dir.rstrip('/')}/.{name}.{uuid4().hex}.tmp"
    ordered = _in_key_order(rows, key, record_limit)
    if single_file:
        ordered = ordered.repartition(1).sortWithinPartitions(col(key))
    try:
        ordered.write.options(**CSV_OPTIONS, header=True).csv(staged)
        publish(spark, staged, final)
    except BaseException:
        remove(spark, staged)
        raise
    return final


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows written by ``export_csv``, line ends inside values included.

    Whatever the reader is told null looks like is what it takes empty fields for; a value that no text
    holds keeps blank text apart.
    """
    options = {**CSV_OPTIONS, "emptyValue": "", "nullValue": "\0"}
    return spark.read.schema(schema).options(**options, header=True, multiLine=True).csv(path)


def json_line(df: DataFrame, alias: str = "value"):
    """Each row as JSON with sorted keys, nulls kept, failing on NaN and infinity at any depth."""
    columns = []
    for field in sorted(df.schema.fields, key=lambda f: f.name):
        columns.append(all_finite(col(field.name), field.dataType, field.name).alias(field.name))
    return F.to_json(F.struct(*columns), JSON_OPTIONS).alias(alias)


def write_json_lines(df: DataFrame, path: str, key: str) -> None:
    """Key-ordered JSON-lines parts; digests come from ``hash_files`` on the folder."""
    ordered = _in_key_order(df, resolve(df.columns, key), None)
    ordered.select(json_line(df)).write.text(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows written by ``write_json_lines``."""
    parsed = F.from_json("value", schema, JSON_OPTIONS).alias("_row")
    return spark.read.text(path).select(parsed).select("_row.*")


def copy_tables(
    tables: Mapping[str, DataFrame], output_dir: str, with_rows: bool = True
) -> dict[str, DataFrame]:
    """Copy a dataset, or only its empty tables, and read it back."""
    copies = {}
    for name, df in tables.items():
        path = f"{output_dir.rstrip('/')}/{name}"
        (df if with_rows else df.limit(0)).write.parquet(path)
        copies[name] = df.sparkSession.read.schema(df.schema).parquet(path)
    return copies
