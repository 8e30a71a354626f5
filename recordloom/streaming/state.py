"""The newest record of every key, kept in the state of a streaming query.

The engine's state store holds one row a key, the newest by time and sequence, however many changes there were. A change that
comes late finds it there and loses, whether or not earlier output has been compacted. Each micro-batch writes the
keys it has met to a folder of its own, so a repeated one replaces its output. Compaction merges folders; it decides
nothing, as the last output of a key is its newest record.

State grows with the number of keys; set ``spark.sql.streaming.stateStore.providerClass`` to Spark's RocksDB provider
where that exceeds executor memory. The number of state partitions is that of ``spark.sql.shuffle.partitions`` at the first start.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.labels import col
from ..operators.changes import DELETE
from ..session import file_names, move_new, remove
from .ingest import ChangeFeed, newest_per_key

_BATCH = "batch_id"


def keep_state(stream: DataFrame, path: str, checkpoint: str, feed: ChangeFeed) -> StreamingQuery:
    """Write the newest record of each key that a micro-batch meets to ``path``; process all available changes."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/parts/{_BATCH}={batch_id}")

    return (
        newest_per_key(stream, feed)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(name.split("=")[1]) for name in file_names(spark, folder) if name.startswith(_BATCH))


def _rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The last merged folder, and the output of the micro-batches after it."""
    typed = T.StructType([*schema.fields, T.StructField(_BATCH, T.LongType())])
    merged, parts = _numbers(spark, f"{path}/merged")[-1:], _numbers(spark, f"{path}/parts")
    last = merged[0] if merged else -1
    rows = spark.createDataFrame([], typed)
    if any(number > last for number in parts):
        rows = spark.read.schema(typed).parquet(f"{path}/parts").where(F.col(_BATCH) > last)
    if merged:
        rows = rows.unionByName(spark.read.schema(typed).parquet(f"{path}/merged").where(F.col(_BATCH) == last))
    return rows


def _last(parts: DataFrame, feed: ChangeFeed) -> DataFrame:
    others = [name for name in parts.columns if name != feed.key]
    last = parts.groupBy(col(feed.key)).agg(F.max_by(F.struct(*map(col, others)), _BATCH).alias("_last"))
    return last.select(col(feed.key), "_last.*")


def read_state(spark: SparkSession, path: str, schema: T.StructType, feed: ChangeFeed) -> DataFrame:
    """The newest record of every key; keys whose newest change deletes them are gone."""
    newest = _last(_rows(spark, path, schema), feed).drop(_BATCH)
    return newest.where(col(feed.change_type) != DELETE)


def compact_state(spark: SparkSession, path: str, schema: T.StructType, feed: ChangeFeed) -> int:
    """Merge the output of all micro-batches so far; return how many there were.

    Deleted keys stay, as rows that say so. The merged folder gets its name last and then hides what it was made from, so a
    crash at any step loses nothing; what is hidden is removed by the next compaction if this one didn't.
    """
    parts, merged = _numbers(spark, f"{path}/parts"), _numbers(spark, f"{path}/merged")
    last = max([*parts, *merged], default=-1)
    fresh = [number for number in parts if number > max(merged, default=-1)]
    if fresh:
        aside = f"{path}/merging-{uuid4().hex}"
        rows = _rows(spark, path, schema).where(F.col(_BATCH) <= last)
        _last(rows, feed).drop(_BATCH).write.parquet(aside)
        if not move_new(spark, aside, f"{path}/merged/{_BATCH}={last}"):
            raise OSError(f"could not put the merged state into {path}")
    for folder, numbers in (("parts", parts), ("merged", merged)):
        for number in numbers:
            if number < last or folder == "parts":
                remove(spark, f"{path}/{folder}/{_BATCH}={number}")
    return len(fresh)
