"""Differences of two states of a table by trees of digests over key ranges.

A leaf of the tree holds the number of rows of a range of ``2 ** LEAF_BITS`` keys and an order-free digest of them; each level above
joins ``2 ** FAN_BITS`` ranges into one. The tree of a state is written once and kept with it. Two trees are compared from
the top, only below ranges that differ; then only rows in such ranges are read, shuffled and compared. Ranges reach the
scan as bounds on the key, so sorted files outside them are skipped.

Keys are whole numbers, unique and not null. A digest is two 64-bit hashes of the rows, of different seeds, combined by exclusive or.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import col, resolve, resolve_all
from ..session import stage
from .changes import table_diff

LEAF_BITS, FAN_BITS = 12, 4
#: Levels are added until so few ranges are left; also the most ranges that are read apart.
FEW_RANGES = 256


def digest_tree(df: DataFrame, key: str, fields: Sequence[str] | None = None, leaf_bits: int = LEAF_BITS) -> DataFrame:
    """``level, range, bits, rows, first, second``: all levels of the tree, written.

    ``bits``: a range holds the keys that are equal after so many bits are cut off.
    """
    key = resolve(df.columns, key)
    names = resolve_all(df.columns, fields or [name for name in df.columns if name != key])
    # hashes pass over nulls, so these are told apart first
    values = [F.isnull(col(name)) for name in names] + [col(name) for name in names]
    rows = df.where(col(key).isNotNull()).select(
        F.shiftright(col(key).cast("bigint"), leaf_bits).alias("range"), F.lit(1).cast("bigint").alias("rows"),
        F.xxhash64(col(key), *values).alias("first"), F.xxhash64(F.lit("second"), col(key), *values).alias("second"),
    )
    level, bits = 0, leaf_bits
    levels = [stage(_joined(rows, F.col("range")), "digests")]
    while levels[-1].count() > FEW_RANGES and bits + FAN_BITS < 64:
        level, bits = level + 1, bits + FAN_BITS
        levels.append(stage(_joined(levels[-1], F.shiftright("range", FAN_BITS)), "digests"))
    numbered = [
        part.select(F.lit(i).alias("level"), "range", F.lit(leaf_bits + i * FAN_BITS).alias("bits"), "rows", "first", "second")
        for i, part in enumerate(levels)
    ]
    return reduce(DataFrame.unionByName, numbered)


def _joined(rows: DataFrame, place: Column) -> DataFrame:
    return rows.groupBy(place.alias("range")).agg(
        F.sum("rows").alias("rows"), F.bit_xor("first").alias("first"), F.bit_xor("second").alias("second")
    )


def changed_ranges(before: DataFrame, after: DataFrame, most: int = FEW_RANGES) -> list[tuple[int, int]]:
    """Key ranges ``(low, high)``, both included, outside of which two states are equal; at most ``most`` of them.

    Goes down from the highest level of both trees as long as that few ranges differ; where more differ, the ranges of
    the level above stand, and hold equal rows as well.
    """
    tops = [tree.agg(F.max("level").alias("level")).first()["level"] for tree in (before, after)]
    if None in tops:
        # one state has no rows: everything differs, if there is anything
        return [] if tops == [None, None] else [(-(1 << 63), (1 << 63) - 1)]
    found: list[int] | None = None
    bits = 0
    for level in range(min(tops), -1, -1):
        sides = [_level(tree, level, found) for tree in (before, after)]
        bits_here = sides[0].select("bits").first() or sides[1].select("bits").first()
        one, other = (side.select("range", F.struct("rows", "first", "second").alias(f"_{i}")) for i, side in enumerate(sides))
        differ = one.join(other, "range", "full").where(~F.col("_0").eqNullSafe(F.col("_1"))).select("range")
        ranges = sorted(row["range"] for row in differ.limit(most + 1).collect())
        if len(ranges) > most:
            break
        found, bits = ranges, bits_here["bits"] if bits_here else bits
        if not ranges:
            return []
    if found is None:
        return [(-(1 << 63), (1 << 63) - 1)]
    merged: list[tuple[int, int]] = []
    for place in found:
        low, high = place << bits, ((place + 1) << bits) - 1
        if merged and merged[-1][1] + 1 == low:
            merged[-1] = (merged[-1][0], high)
        else:
            merged.append((low, high))
    return merged


def _level(tree: DataFrame, level: int, above: list[int] | None) -> DataFrame:
    rows = tree.where(F.col("level") == level)
    return rows if above is None else rows.where(F.shiftright("range", FAN_BITS).isin(above))


def in_ranges(key: Column, ranges: Sequence[tuple[int, int]]) -> Column:
    return reduce(or_, [(key >= low) & (key <= high) for low, high in ranges], F.lit(False))


def diff_by_digest(
    before: DataFrame, after: DataFrame, key: str, before_tree: DataFrame, after_tree: DataFrame,
    fields: Sequence[str] | None = None, include_details: bool = False,
) -> DataFrame:
    """``table_diff`` of two states, read only where their trees differ.

    The trees are those of the compared fields.
    """
    ranges = changed_ranges(before_tree, after_tree)
    parts = [df.where(in_ranges(col(resolve(df.columns, key)), ranges)) for df in (before, after)]
    return table_diff(*parts, key, fields, include_details)
