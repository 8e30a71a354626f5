"""Global order without a single-task sort: ranks, running sums and exact medians.

The rows are range-partitioned on the order columns, sorted inside each range and written
once. A row's global position is then its place in its file plus the sizes of the files
before it; only one small row per file is ever added up on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import col
from ..session import stage

SLICE, POSITION = "_slice", "_position"

# A group below this many rows may be aggregated in one task's memory.
SMALL_GROUP = 1_000_000


def join_groups(
    left: DataFrame, right: DataFrame, group: Sequence[str], on: Sequence[str] = (), how: str = "inner"
) -> DataFrame:
    """Join on group columns, where null is a group like any other, and on plain columns ``on``.

    The columns joined on come from ``left`` only, as in a join by names.
    """
    names = [*group, *on]
    right = right.select(
        *[col(name).alias(f"_right{i}") for i, name in enumerate(names)],
        *[col(name) for name in right.columns if name not in names],
    )
    met = [
        col(name).eqNullSafe(F.col(f"_right{i}")) if i < len(group) else col(name) == F.col(f"_right{i}")
        for i, name in enumerate(names)
    ]
    joined = left.join(right, met, how) if met else left.crossJoin(right)
    return joined.drop(*[f"_right{i}" for i in range(len(names))])


def sorted_slices(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Write ``df`` globally sorted; return it with task number and 0-based place in its file."""
    keys = [col(key) if isinstance(key, str) else key for key in order]
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return (
        stage(ordered, name)
        .withColumn(SLICE, F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int"))
        .withColumn(POSITION, F.col("_metadata.row_index"))
    )


def _slice_offsets(slices: DataFrame) -> DataFrame:
    """Rows before each file; task numbers follow the range order."""
    counts = slices.groupBy(SLICE).agg(F.count(F.lit(1)).alias("n")).orderBy(SLICE).collect()
    rows, before = [], 0
    for row in counts:
        rows.append((row[SLICE], before))
        before += row["n"]
    # as an Arrow table: rows would go through Python workers of a pool of their own, which stay in the executors
    named = pa.table(list(zip(*rows)) or [[], []], schema=pa.schema([(SLICE, pa.int32()), ("_before", pa.int64())]))
    return slices.sparkSession.createDataFrame(named)


def global_rank(df: DataFrame, order: Sequence[str | Column], rank: str) -> DataFrame:
    """Add the 1-based rank in ``order``, which must be a total order."""
    slices = sorted_slices(df, order, "rank")
    return (
        slices.join(F.broadcast(_slice_offsets(slices)), SLICE)
        .withColumn(rank, F.col("_before") + F.col(POSITION) + 1)
        .drop(SLICE, POSITION, "_before")
    )


def running_sum(slices: DataFrame, group: Sequence[str], value: str, total: str) -> DataFrame:
    """Exclusive running sum of ``value`` per group along the sorted slices.

    No window holds more than one slice: a group spanning many slices only meets one
    partial sum per slice.
    """
    parts = slices.groupBy(SLICE, *group).agg(F.sum(value).alias("_part"))
    across = Window.partitionBy(*group).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(
        SLICE, *group, F.coalesce(F.sum("_part").over(across), F.lit(0)).alias("_before")
    )
    inside = (
        Window.partitionBy(SLICE, *group)
        .orderBy(POSITION)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    added = slices.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        join_groups(added, before, group, [SLICE])
        .withColumn(total, F.col("_before") + F.col("_inside"))
        .drop("_before", "_inside")
    )


def exact_median(
    df: DataFrame, group: Sequence[str], value: str, alias: str, small_group: int = SMALL_GROUP,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Exact median per group.

    Groups whose checked size is small use the built-in aggregate. Otherwise equal values are
    counted first, the counts are ranked globally, and the middle one or two places of each
    group are looked up in them: neither a hot group nor a hot value is gathered in one task.
    A null group column makes a group of its own, whatever its size.
    ``sizes`` (group columns and ``_size``) saves a scan where they are known.
    """
    rows = df.where(col(value).isNotNull()).select(*[col(key) for key in group], col(value))
    if sizes is None:
        sizes = rows.groupBy(*[col(key) for key in group]).agg(F.count(F.lit(1)).alias("_size"))
    largest = sizes.agg(F.max("_size")).first()[0] or 0
    if largest <= small_group:
        return rows.groupBy(*[col(key) for key in group]).agg(F.median(col(value)).alias(alias))
    counts = rows.groupBy(*[col(key) for key in group], col(value)).agg(F.count(F.lit(1)).alias("_n"))
    slices = sorted_slices(counts, [*group, value], "median")
    ranked = running_sum(slices, group, "_n", "_rank")

    def holds(place: Column) -> Column:
        return (F.col("_rank") <= place) & (place < F.col("_rank") + F.col("_n"))

    low, high = holds(F.floor((F.col("_size") - 1) / 2)), holds(F.floor(F.col("_size") / 2))
    return (
        join_groups(ranked, sizes, group)
        .where(low | high)
        .groupBy(*[col(key) for key in group])
        .agg(
            ((F.sum(F.when(low, col(value))) + F.sum(F.when(high, col(value)))) / 2).alias(alias)
        )
    )


def first_rows(df: DataFrame, count: int) -> DataFrame:
    """Any ``count`` rows, taken in parallel: whole files of one write, and part of one more."""
    slices = (
        stage(df, "prefix")
        .withColumn(SLICE, F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int"))
        .withColumn(POSITION, F.col("_metadata.row_index"))
    )
    placed = slices.join(_slice_offsets(slices), SLICE)
    return placed.where(F.col("_before") + F.col(POSITION) < count).drop(SLICE, POSITION, "_before")
