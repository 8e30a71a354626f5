"""Cut an ordered table into batches of bounded serialized size.

The rule is sequential: a batch takes lines until the next one would not fit. It is still
computed in parallel and exactly. Lines are laid out along a byte axis and cut into blocks
no batch can span more than two of. Each block works out, for every line a batch might
open on, which line of the next block the following batches lead to. Those maps are joined
pairwise until the true opening line of every block is known, and the blocks are then
packed independently.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import col, resolve_all
from ..session import stage
from .ordering import join_groups, running_sum, sorted_slices

# Largest request, and the bytes between two records.
MAX_BATCH_BYTES = 40_000_000
SEPARATOR_BYTES = 2

# A block is packed in one task: its bytes and, for tiny records, its rows are bounded. One batch
# always fits into a block.
_BLOCK_BYTES = 256 << 20
_BLOCK_ROWS = 2_000_000


class BatchSizeError(ValueError):
    """A record does not fit into any batch."""


def payload_bytes(df: DataFrame, labels: list[str] | None = None) -> Column:
    """Serialized JSON size of each row in bytes, nulls included."""
    names = resolve_all(df.columns, labels or df.columns)
    body = F.to_json(F.struct(*[col(name) for name in names]), {"ignoreNullFields": "false"})
    return F.octet_length(body).cast("bigint")


@dataclass(frozen=True)
class BatchRule:
    """How lines are ordered, measured and grouped into batches.

    ``line`` orders the rows of a shard and is unique in it; ``size`` is the row's serialized
    size. Without ``shard`` the whole table is one sequence; lines without a shard are a shard.
    """

    line: str
    size: Column
    shard: Sequence[str] = ()
    envelope_bytes: int = 0
    max_bytes: int = MAX_BATCH_BYTES
    block_bytes: int = _BLOCK_BYTES

    def __post_init__(self):
        limit = self.max_bytes
        if not isinstance(limit, int) or isinstance(limit, bool) or limit < 1:
            raise ValueError("max_bytes must be a positive integer")
        if self.envelope_bytes > limit:
            raise ValueError("the envelope alone exceeds max_bytes")

    @property
    def room(self) -> int:
        """Bytes a batch may span when every line carries its separator."""
        return self.max_bytes - self.envelope_bytes + SEPARATOR_BYTES

    @property
    def names(self) -> list[str]:
        return [f"_s{i}" for i in range(len(self.shard))] or ["_s0"]


def plan_batches(df: DataFrame, rule: BatchRule) -> DataFrame:
    """Batches per shard: number, first and last line, records and bytes."""
    batches = _numbered(_pack(_opened_blocks(df, rule), rule), rule)
    return batches.select(
        *_shard_columns(rule), "batch_number", "start_line", "end_line", "records", "payload_bytes"
    )


def assign_batches(df: DataFrame, rule: BatchRule) -> DataFrame:
    """The batch number of every line."""
    lines = _numbered(_pack(_opened_blocks(df, rule), rule, per_line=True), rule)
    return lines.select(*_shard_columns(rule), F.col("_line").alias(rule.line), "batch_number")


def _shard_columns(rule: BatchRule) -> list[Column]:
    return [F.col(alias).alias(name) for name, alias in zip(rule.shard, rule.names)]


def _opened_blocks(df: DataFrame, rule: BatchRule) -> DataFrame:
    """Lines by block, each block knowing the line its first batch opens on."""
    names, room = rule.names, rule.room
    shards = [col(n).alias(a) for n, a in zip(rule.shard, names)] or [F.lit(0).alias("_s0")]
    sized = df.select(
        *shards, col(rule.line).alias("_line"), (rule.size + SEPARATOR_BYTES).alias("_step")
    )
    slices = sorted_slices(sized, [*names, "_line"], "batch-lines")
    oversize = F.when(F.col("_step") > room, F.col("_line"))
    facts = slices.agg(F.min(oversize).alias("line"), F.avg("_step").alias("mean")).first()
    worst = facts["line"]
    if worst is not None:
        raise BatchSizeError(f"record at position {worst} exceeds {rule.max_bytes} bytes")
    mean = math.ceil(facts["mean"] or 1)
    width = max(room, min(64 * room, rule.block_bytes, _BLOCK_ROWS * mean))
    placed = running_sum(slices, names, "_step", "_at").select(*names, "_line", "_step", "_at")
    blocks = stage(_with_halo(placed, width, room), "batch-blocks")
    return join_groups(blocks, _block_openings(blocks, names, width, room), names, ["_block"])


def _numbered(packed: DataFrame, rule: BatchRule) -> DataFrame:
    """Turn numbers within a block into numbers within the shard."""
    names = rule.names
    packed = stage(packed, "batches")
    per_block = packed.groupBy(*names, "_block").agg(F.max("_index").alias("_n"))
    earlier = (
        Window.partitionBy(*names).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = per_block.select(
        *names, "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    return join_groups(packed, before, names, ["_block"]).withColumn(
        "batch_number", F.col("_before") + F.col("_index")
    )


def _with_halo(placed: DataFrame, width: int, room: int) -> DataFrame:
    """Give each line to its block, and to the block before if a batch may reach it from there."""
    block = F.floor(F.col("_at") / width).cast("bigint")
    reachable = (F.col("_at") % width < room) & (block > 0)
    homes = F.array_compact(F.array(block, F.when(reachable, block - 1)))
    return placed.withColumn("_home", block).withColumn("_block", F.explode(homes))


def _jump(at: np.ndarray, step: np.ndarray, room: int) -> np.ndarray:
    """For each line, the index of the first line its batch cannot take."""
    return np.searchsorted(at + step, at + room, side="right")


def _block_openings(blocks: DataFrame, names: list[str], width: int, room: int) -> DataFrame:
    """The line on which the first batch starting in each block opens."""
    first = (
        blocks.where(F.col("_at") == 0)
        .where(F.col("_block") == 0)
        .select(*names, F.lit(0).cast("bigint").alias("_seg"), F.col("_line").alias("_entry"))
    )
    last_block = blocks.agg(F.max("_home")).first()[0] or 0
    if last_block == 0:
        return first.withColumnRenamed("_seg", "_block")

    dtype = {field.name: field.dataType.simpleString() for field in blocks.schema.fields}
    keys = ", ".join(f"{name} {dtype[name]}" for name in names)
    schema = f"{keys}, _seg bigint, _entry bigint, _exit bigint"

    def trace(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_at", ignore_index=True)
        block = pdf["_block"].iat[0]
        own = int((pdf["_home"] == block).sum())
        at, step = pdf["_at"].to_numpy(), pdf["_step"].to_numpy()
        target = _jump(at, step, room)
        target = np.append(target, len(at))
        target[own:] = np.arange(own, len(at) + 1)
        while (target[:own] < own).any():
            target = target[target]
        entries = np.flatnonzero(at[:own] < block * width + room)
        lines = np.append(pdf["_line"].to_numpy(), 0)
        leaves = target[entries]
        out = pd.DataFrame({name: pdf[name].iloc[0] for name in names}, index=entries)
        out["_seg"] = block
        out["_entry"] = lines[entries]
        out["_exit"] = pd.array(lines[leaves], dtype="Int64")
        out.loc[leaves == len(at), "_exit"] = pd.NA
        return out

    levels = [stage(blocks.groupBy(*names, "_block").applyInPandas(trace, schema), "batch-map")]
    while last_block >> len(levels):
        levels.append(stage(_compose(levels[-1], names), "batch-map"))
    known = first
    for level in reversed(levels):
        known = stage(_descend(known, level, names), "batch-entry")
    return known.withColumnRenamed("_seg", "_block")


def _compose(level: DataFrame, names: list[str]) -> DataFrame:
    """Join each even segment's map with the odd one after it."""
    left = level.where(F.col("_seg") % 2 == 0)
    right = level.where(F.col("_seg") % 2 == 1).select(
        *names,
        (F.col("_seg") - 1).alias("_seg"),
        F.col("_entry").alias("_exit"),
        F.col("_exit").alias("_beyond"),
        F.lit(True).alias("_met"),
    )
    return join_groups(left, right, names, ["_seg", "_exit"], "left").select(
        *names,
        (F.col("_seg") / 2).cast("bigint").alias("_seg"),
        "_entry",
        F.when(F.col("_met"), F.col("_beyond")).otherwise(F.col("_exit")).alias("_exit"),
    )


def _descend(known: DataFrame, level: DataFrame, names: list[str]) -> DataFrame:
    """From the openings of double segments to those of their halves."""
    halves = known.withColumn("_seg", F.col("_seg") * 2)
    second = (
        join_groups(halves, level, names, ["_seg", "_entry"])
        .where(F.col("_exit").isNotNull())
        .select(*names, (F.col("_seg") + 1).alias("_seg"), F.col("_exit").alias("_entry"))
    )
    return halves.unionByName(second)


def _pack(blocks: DataFrame, rule: BatchRule, per_line: bool = False) -> DataFrame:
    """Cut every block into batches from its known opening line."""
    names, room, envelope = rule.names, rule.room, rule.envelope_bytes
    dtype = {field.name: field.dataType.simpleString() for field in blocks.schema.fields}
    keys = ", ".join(f"{name} {dtype[name]}" for name in names)
    ranges = (
        f"start_line {dtype['_line']}, end_line {dtype['_line']}, "
        "records bigint, payload_bytes bigint"
    )
    output = f"_line {dtype['_line']}" if per_line else ranges

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_at", ignore_index=True)
        at, step = pdf["_at"].to_numpy(), pdf["_step"].to_numpy()
        line = pdf["_line"].to_numpy()
        own = int((pdf["_home"] == pdf["_block"]).sum())
        target = _jump(at, step, room)
        starts, here = [], int(np.flatnonzero(line == pdf["_entry"].iat[0])[0])
        while here < own:
            starts.append(here)
            here = int(target[here])
        first = np.array(starts, dtype=np.int64)
        last = target[first] - 1
        if per_line:
            inside = np.arange(first[0], last[-1] + 1) if len(first) else first
            out = pd.DataFrame({"_line": line[inside]})
            out["_index"] = np.searchsorted(first, inside, side="right")
        else:
            out = pd.DataFrame({"start_line": line[first], "end_line": line[last]})
            out["_index"] = np.arange(1, len(first) + 1)
            out["records"] = last - first + 1
            out["payload_bytes"] = at[last] + step[last] - at[first] - SEPARATOR_BYTES + envelope
        out["_block"] = pdf["_block"].iat[0]
        for name in names:
            out[name] = pdf[name].iat[0]
        return out

    schema = f"{keys}, _block bigint, _index bigint, {output}"
    return blocks.groupBy(*names, "_block").applyInPandas(pack, schema)


def to_global_lines(lines: DataFrame, batches: DataFrame, line: str) -> DataFrame:
    """Rebase 1-based positions local to a batch onto global lines: start + local - 1."""
    return (
        lines.join(batches.select("batch_number", "start_line"), "batch_number")
        .withColumn("global_line", F.col("start_line") + col(line) - 1)
        .drop("start_line")
    )
