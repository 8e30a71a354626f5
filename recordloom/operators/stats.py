"""Measurement tables: sample summaries, regression signals, profiles and workloads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import col
from ..session import stage
from .ordering import SMALL_GROUP, exact_median, join_groups

# Fixed values of generated workloads.
STATUSES = ("Ready", "Running", "Complete")
FIRST_DAY = date(2026, 1, 1)


def sample_summary(
    df: DataFrame, group: Sequence[str], value: str, small_group: int = SMALL_GROUP
) -> DataFrame:
    """Per group: samples, median, min, max, sample deviation and coefficient of variation."""
    rows = df.where(col(value).isNotNull())
    # one row per group, read again for the sizes
    stats = rows.groupBy(*[col(name) for name in group]).agg(
        F.count(F.lit(1)).alias("samples"),
        F.min(col(value)).alias("min"),
        F.max(col(value)).alias("max"),
        F.avg(col(value)).alias("_mean"),
        F.coalesce(F.stddev_samp(col(value)), F.lit(0.0)).alias("stdev"),
    )
    stats = stage(stats, "samples")
    sizes = stats.select(*[col(name) for name in group], F.col("samples").alias("_size"))
    medians = exact_median(rows, group, value, "median", small_group, sizes)
    ratio = F.when(F.col("_mean") == 0, 0.0).otherwise(F.col("stdev") / F.col("_mean"))
    return join_groups(stats, medians, group).select(
        *[col(name) for name in group],
        "samples", "median", "min", "max", "stdev",
        ratio.alias("coefficient_of_variation"),
    )


def regression_signals(
    current: DataFrame,
    baseline: DataFrame,
    group: Sequence[str],
    value: str,
    higher_is_better: Column | bool = False,
    threshold_percent: float = 15.0,
) -> DataFrame:
    """Compare medians with a baseline.

    A signal needs the median to move by the threshold and the sample ranges not to meet in
    that direction; everything else is stable, or unavailable without a usable baseline.
    """
    if not 0 < threshold_percent < float("inf"):
        raise ValueError("threshold_percent must be positive and finite")
    now = sample_summary(current, group, value).select(
        *[col(n) for n in group], *[F.col(n).alias(f"current_{n}") for n in ("median", "min", "max")]
    )
    then = sample_summary(baseline, group, value).select(
        *[col(n) for n in group],
        *[F.col(n).alias(f"baseline_{n}") for n in ("median", "min", "max")],
    )
    better = F.lit(higher_is_better) if isinstance(higher_is_better, bool) else higher_is_better
    usable = F.col("baseline_median").isNotNull() & (F.col("baseline_median") != 0)
    median, old = F.col("current_median"), F.col("baseline_median")
    delta = F.when(usable, (median - old) / old * 100)
    gain = F.when(better, F.col("delta_percent")).otherwise(-F.col("delta_percent"))
    above = F.col("current_min") > F.col("baseline_max")
    below = F.col("current_max") < F.col("baseline_min")
    worse, improved = F.when(better, below).otherwise(above), F.when(better, above).otherwise(below)
    signal = (
        F.when(F.col("delta_percent").isNull(), "unavailable")
        .when((gain <= -threshold_percent) & worse, "regression_signal")
        .when((gain >= threshold_percent) & improved, "improvement_signal")
        .otherwise("stable")
    )
    joined = join_groups(now, then, group, how="left").withColumn("delta_percent", delta)
    return joined.withColumn(
        "ranges_overlap", F.when(F.col("delta_percent").isNotNull(), ~(above | below))
    ).withColumn("classification", signal)


def profile(
    tables: Mapping[str, DataFrame], exact: bool = False, skip: int = 0, top: int | None = None
) -> DataFrame:
    """Per table and column: rows, filled rows, distinct values, lowest and highest value."""
    if skip < 0 or (top is not None and top < 1):
        raise ValueError("skip must not be negative and top must be at least 1")
    listed = [(name, field) for name, df in tables.items() for field in df.schema.fields]
    listed = listed[skip : None if top is None else skip + top]
    parts = []
    for name, df in tables.items():
        fields = [field for table, field in listed if table == name]
        if fields:
            parts.append(_profile_table(name, df, fields, exact))
    return reduce(DataFrame.unionByName, parts)


def _profile_table(name: str, df: DataFrame, fields: Sequence[T.StructField], exact: bool):
    facts = [F.count(F.lit(1)).alias("_rows")]
    for i, field in enumerate(fields):
        column = col(field.name)
        orderable = not isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
        facts.append(F.count(column).alias(f"_f{i}"))
        for label, aggregate in (("_a", F.min), ("_z", F.max)):
            found = aggregate(column).cast("string") if orderable else F.lit(None).cast("string")
            facts.append((found if orderable else F.max(found)).alias(f"{label}{i}"))
        if not exact:
            text = column if orderable else _nested_text(column)
            facts.append(F.approx_count_distinct(text).alias(f"_d{i}"))
    rows = [
        F.struct(
            F.lit(name).alias("table"),
            F.lit(field.name).alias("column"),
            F.col("_rows").alias("rows"),
            F.col(f"_f{i}").alias("filled"),
            (F.lit(None).cast("bigint") if exact else F.col(f"_d{i}")).alias("distinct_values"),
            F.col(f"_a{i}").alias("lowest"),
            F.col(f"_z{i}").alias("highest"),
        )
        for i, field in enumerate(fields)
    ]
    result = df.agg(*facts).select(F.inline(F.array(*rows)))
    if not exact:
        return result
    return result.drop("distinct_values").join(_distinct(df, fields), "column", "left").select(
        "table", "column", "rows", "filled",
        F.coalesce("distinct_values", F.lit(0).cast("bigint")).alias("distinct_values"),
        "lowest", "highest",
    )


def _nested_text(value: Column) -> Column:
    return F.when(value.isNotNull(), F.to_json(F.struct(value)))


def _distinct(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """Exact distinct counts: values are combined per task, then shuffled by column and value."""
    cells = F.array(
        *[
            F.struct(
                F.lit(field.name).alias("column"),
                (
                    _nested_text(col(field.name))
                    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
                    else col(field.name).cast("string")
                ).alias("value"),
            )
            for field in fields
        ]
    )
    values = df.select(F.inline(cells)).where(F.col("value").isNotNull())
    distinct = values.groupBy("column", "value").agg(F.lit(1).alias("_one"))
    return distinct.groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))


def workload_records(df: DataFrame, index: str, prefix: str) -> DataFrame:
    """One deterministic record per row of ``df``, made from its 0-based index."""
    i = col(index)
    number = F.lpad(i.cast("string"), 5, "0")
    padded = F.when(F.length(i.cast("string")) >= 5, i.cast("string")).otherwise(number)
    statuses = F.array(*[F.lit(status) for status in STATUSES])
    return df.select(
        i.alias("index"),
        F.concat(F.lit(f"{prefix}-"), padded).alias("Fixture Key"),
        F.concat(F.lit("Workload record "), padded).alias("Name"),
        F.round((i + 1) * 1.25, 2).alias("Amount"),
        F.element_at(statuses, (i % len(STATUSES) + 1).cast("int")).alias("Status"),
        (i % 2 == 0).alias("Active"),
        F.date_add(F.lit(FIRST_DAY), (i % 365).cast("int")).alias("Event Date"),
    )


def update_pass(records: DataFrame, every: int, index: str = "index") -> DataFrame:
    """The same records with 1000 added to the amount of every ``every``-th one."""
    if every < 1:
        raise ValueError("every must be at least 1")
    raised = F.when(col(index) % every == 0, F.col("Amount") + 1000).otherwise(F.col("Amount"))
    return records.withColumn("Amount", raised)
