"""Incremental change ingestion and change counts.

Changes are appended to a log, one folder per micro-batch. A repeated micro-batch replaces
its own folder, so restarts neither lose nor double changes. The current state is the base
table overlaid with the newest change per key.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.labels import col
from ..session import exists, file_names, publish, remove, scratch_path
from ..operators.changes import DELETE


@dataclass(frozen=True)
class ChangeFeed:
    """Columns of a feed. ``sequence`` orders changes of one key made at the same time."""

    key: str
    changed_at: str
    change_type: str
    sequence: str
    delay: str = "1 hour"


def newest_per_key(changes: DataFrame, feed: ChangeFeed) -> DataFrame:
    """The last change of every key, found by a combining aggregate."""
    others = [name for name in changes.columns if name != feed.key]
    position = F.struct(col(feed.changed_at), col(feed.sequence))
    newest = F.max_by(F.struct(*[col(name) for name in others]), position).alias("_newest")
    return changes.groupBy(col(feed.key)).agg(newest).select(col(feed.key), "_newest.*")


def _watermark(spark: SparkSession, log: str, batch_id: int, feed: ChangeFeed):
    """Latest time seen by earlier micro-batches, less the allowed delay."""
    if not exists(spark, f"{log}/seen"):
        return None
    seen = spark.read.schema("seen timestamp_ntz, batch_id bigint").parquet(f"{log}/seen")
    mark = seen.where(F.col("batch_id") < batch_id).agg(
        (F.max("seen") - F.expr(f"INTERVAL {feed.delay}")).alias("mark")
    )
    return mark.first()["mark"]


def _write_batch(changes: DataFrame, batch_id: int, log: str, feed: ChangeFeed) -> None:
    spark = changes.sparkSession
    mark = _watermark(spark, log, batch_id, feed)
    time = col(feed.changed_at).cast("timestamp_ntz")
    late = F.lit(False) if mark is None else time < F.lit(str(mark)).cast("timestamp_ntz")
    changes.persist()
    on_time = _not_superseded(newest_per_key(changes.where(~late), feed), log, feed)

    def write(df: DataFrame, part: str) -> None:
        df.write.mode("overwrite").parquet(f"{log}/{part}/batch_id={batch_id}")

    write(on_time, "changes")
    write(changes.where(late), "late")
    facts = changes.agg(
        F.max(time).alias("seen"),
        F.count(F.lit(1)).alias("lines"),
        F.count_if(late).alias("late_lines"),
    )
    write(facts.select("seen", "lines", "late_lines"), "seen")
    changes.unpersist()


def _position(feed: ChangeFeed):
    return F.struct(col(feed.changed_at).alias("at"), col(feed.sequence).alias("sequence"))


def _held(spark: SparkSession, log: str) -> DataFrame | None:
    """``key, at, sequence`` of the changes that compactions have applied and that older on-time changes may still meet."""
    names = sorted(file_names(spark, f"{log}/held"))
    return spark.read.parquet(f"{log}/held/{names[-1]}") if names else None


def _not_superseded(changes: DataFrame, log: str, feed: ChangeFeed) -> DataFrame:
    """Changes newer than what a compaction has already put into the base table."""
    held = _held(changes.sparkSession, log)
    if held is None:
        return changes
    newest = held.select(F.col("key").alias("_key"), F.struct("at", "sequence").alias("_held"))
    joined = changes.join(newest, col(feed.key) == F.col("_key"), "left")
    newer = F.col("_held").isNull() | (_position(feed) > F.col("_held"))
    return joined.where(newer).select(*[col(name) for name in changes.columns])


def _hold(changes: DataFrame, log: str, last: int, feed: ChangeFeed) -> None:
    """Remember the positions of applied changes, but for those so old that a change before them would be late."""
    spark = changes.sparkSession
    applied = newest_per_key(changes, feed).select(
        col(feed.key).alias("key"), col(feed.changed_at).alias("at"), col(feed.sequence).alias("sequence")
    )
    if (before := _held(spark, log)) is not None:
        applied = applied.unionByName(before)
    mark = _watermark(spark, log, last + 1, feed)
    if mark is not None:
        applied = applied.where(F.col("at").cast("timestamp_ntz") >= F.lit(str(mark)).cast("timestamp_ntz"))
    newest = applied.groupBy("key").agg(F.max(F.struct("at", "sequence")).alias("p")).select("key", "p.*")
    newest.write.mode("overwrite").parquet(f"{log}/held/{last:020d}")


def ingest(stream: DataFrame, log: str, checkpoint: str, feed: ChangeFeed) -> StreamingQuery:
    """Append all available changes of a stream to the log.

    Each micro-batch keeps only the newest change per key. Changes older than the delay behind
    what earlier micro-batches saw go to the log's ``late`` side instead.
    """
    return (
        stream.writeStream.foreachBatch(partial(_write_batch, log=log, feed=feed))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_log(spark: SparkSession, log: str, schema: T.StructType, part: str = "changes") -> DataFrame:
    """Logged changes with the micro-batch each came in."""
    typed = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(typed).parquet(f"{log}/{part}")


def batch_statuses(spark: SparkSession, log: str) -> DataFrame:
    """One row per committed micro-batch: lines and late lines."""
    schema = "seen timestamp_ntz, lines bigint, late_lines bigint, batch_id bigint"
    return (
        spark.read.schema(schema)
        .parquet(f"{log}/seen")
        .select("batch_id", "lines", "late_lines", F.lit("completed").alias("status"))
    )


def overlay(base: DataFrame, changes: DataFrame, feed: ChangeFeed) -> DataFrame:
    """The base table after the changes: replaced, added and, for deletes, removed records."""
    newest = newest_per_key(changes, feed)
    kept = base.join(newest.select(col(feed.key)), feed.key, "left_anti")
    written = newest.where(col(feed.change_type) != DELETE)
    return kept.unionByName(written.select(*[col(name) for name in base.columns]))


def compact(base: DataFrame, changes: DataFrame, feed: ChangeFeed, path: str) -> DataFrame:
    """Write the overlaid table aside and move it to ``path``."""
    spark = base.sparkSession
    staged = scratch_path(spark, "compacted")
    overlay(base, changes, feed).write.parquet(staged)
    publish(spark, staged, path)
    return spark.read.schema(base.schema).parquet(path)


def compact_log(
    base: DataFrame, log: str, schema: T.StructType, feed: ChangeFeed, path: str
) -> DataFrame:
    """Apply all logged changes to ``base``, write the result to ``path``, and trim the log.

    Only micro-batches that were there at the start are applied and removed; what a running
    ingestion adds meanwhile stays for the next time. The sightings behind the watermark stay, and so do the positions of
    applied changes that an older one, still on time, could come after: it is not logged any more.
    A restarted ingestion repeats its last micro-batch at most, which changes nothing any more.
    """
    spark = base.sparkSession
    changes = read_log(spark, log, schema)
    last = changes.agg(F.max("batch_id").alias("last")).first()["last"]
    if last is None:
        return compact(base, changes.drop("batch_id"), feed, path)
    applied = changes.where(F.col("batch_id") <= last).drop("batch_id")
    _hold(applied, log, last, feed)
    result = compact(base, applied, feed, path)
    for batch_id in [row["batch_id"] for row in batch_statuses(spark, log).where(F.col("batch_id") <= last).collect()]:
        remove(spark, f"{log}/changes/batch_id={batch_id}")
    return result


def change_counts(
    changes: DataFrame, changed_at: str, change_type: str, window: str = "1 day"
) -> DataFrame:
    """Changes per tumbling window and type; the same code counts a table or a stream."""
    return (
        changes.groupBy(F.window(col(changed_at), window).alias("_w"), col(change_type))
        .agg(F.count(F.lit(1)).alias("changes"))
        .select(
            F.col("_w.start").alias("window_start"), col(change_type), F.col("changes")
        )
    )


def _utc_instant(column):
    """Zone-free wall-clock time as the instant it names in UTC."""
    return F.from_utc_timestamp(column.cast("timestamp"), F.current_timezone())


def _utc_wall_clock(column):
    return F.to_utc_timestamp(column, F.current_timezone()).cast("timestamp_ntz")


def stream_change_counts(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    changed_at: str,
    change_type: str,
    window: str = "1 day",
    delay: str = "1 hour",
) -> StreamingQuery:
    """Keep the counts of a stream in ``path``: updated windows, one folder per micro-batch.

    The watermark bounds the state to open windows. Watermarks need instants, so zone-free
    times are taken as UTC.
    """
    zone_free = isinstance(stream.schema[changed_at].dataType, T.TimestampNTZType)
    if zone_free:
        stream = stream.withColumn(changed_at, _utc_instant(col(changed_at)))
    counts = change_counts(stream.withWatermark(changed_at, delay), changed_at, change_type, window)

    def write(df: DataFrame, batch_id: int) -> None:
        if zone_free:
            df = df.withColumn("window_start", _utc_wall_clock(F.col("window_start")))
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_change_counts(
    spark: SparkSession, path: str, change_type: str, time_type: str = "timestamp_ntz"
) -> DataFrame:
    """The last value written for every window and type."""
    counts = spark.read.schema(
        f"window_start {time_type}, `{change_type}` string, changes bigint, batch_id bigint"
    ).parquet(path)
    return counts.groupBy("window_start", col(change_type)).agg(
        F.max_by("changes", "batch_id").alias("changes")
    )
