"""Batches carried out one after the other, with a journal that a restart goes on from.

The plan is written before the first batch: which lines belong to which batch. Every batch is one commit of a keyed table
under an id of its own, so a batch that took effect is recognised by the table itself, whatever the journal got to hear of it.
Batches are small by the rule that made them and each is one Spark job; the driver only steps from one to the next.

A batch is ``completed``, ``failed`` if it was refused and changed nothing, or ``uncertain`` if something else went wrong while
it was written. The first that isn't completed ends the run; earlier ones stay. Starting again repeats it and goes on.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.labels import col
from ..session import exists, file_names, read_text, remove, write_text
from ..sources.keyed import CommitError, KeyedTable
from .batching import BatchRule, assign_batches, plan_batches
from .commits import commit_upsert_files
from .upsert import outcome

COMPLETED, FAILED, UNCERTAIN = "completed", "failed", "uncertain"
_COUNTS = ("total_processed", "created", "updated", "unchanged", "failed_lines")
_REPORT = (
    "batch_number bigint, start_line bigint, end_line bigint, records bigint, payload_bytes bigint, status string, "
    + ", ".join(f"{name} bigint" for name in _COUNTS)
    + ", outcome string, error string"
)
#: What the library and Spark raise for lines that can't be written, before anything is.
_REFUSALS = (CommitError, ValueError, AnalysisException)


class BatchError(RuntimeError):
    """A run that ended early; ``journal`` tells what became of each batch."""

    def __init__(self, message: str, journal: Journal) -> None:
        super().__init__(message)
        self.journal = journal


@dataclass(frozen=True)
class Journal:
    """The folder of one run: its plan, and a note for each batch that was begun."""

    table: KeyedTable
    path: str

    def report(self) -> DataFrame:
        """A row for each batch that was begun, in order."""
        spark = self.table.spark
        names = sorted(name for name in file_names(spark, f"{self.path}/batches") if name.endswith(".json"))
        notes = [json.loads(read_text(spark, f"{self.path}/batches/{name}")) for name in names]
        fields = [field.split()[0] for field in _REPORT.split(", ")]
        return spark.createDataFrame([tuple(note.get(name) for name in fields) for note in notes], _REPORT)

    def totals(self) -> DataFrame:
        """Counts over the completed batches, and the outcome of them together."""
        done = self.report().where(F.col("status") == COMPLETED)
        sums = done.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in _COUNTS])
        verdict = F.when(F.col("failed_lines") == 0, "success").when(F.col("failed_lines") == F.col("total_processed"), "failed")
        return sums.withColumn("outcome", verdict.otherwise("partial"))


def _plan(source: DataFrame, rule: BatchRule, path: str) -> tuple[DataFrame, list[dict]]:
    """The lines by batch and the batches in order; written once, then read."""
    spark = source.sparkSession
    if not exists(spark, f"{path}/planned.json"):
        if rule.shard:
            raise ValueError("batches of one table are carried out as one sequence")
        remove(spark, f"{path}/lines")
        numbers = assign_batches(source, rule).withColumnRenamed(rule.line, "_planned_line")
        placed = source.join(numbers, col(rule.line) == F.col("_planned_line")).drop("_planned_line")
        placed.repartition("batch_number").write.partitionBy("batch_number").parquet(f"{path}/lines")
        batches = [row.asDict() for row in plan_batches(source, rule).orderBy("batch_number").collect()]
        # last: a plan without this file is made anew, before any batch has begun
        write_text(spark, f"{path}/planned.json", json.dumps(batches))
    schema = T.StructType([*source.schema.fields, T.StructField("batch_number", T.LongType())])
    return spark.read.schema(schema).parquet(f"{path}/lines"), json.loads(read_text(spark, f"{path}/planned.json"))


def execute_batches(
    table: KeyedTable, source: DataFrame, rule: BatchRule, run: str, refuse: Column | None = None,
    commit: Callable[..., tuple[KeyedTable, DataFrame | None]] = commit_upsert_files, **options,
) -> tuple[KeyedTable, Journal]:
    """Upsert ``source`` in batches, in order, until one isn't completed; return the table after the last.

    ``run`` names the run: the same name goes on where the run ended, with the plan it had. A batch is refused as a whole
    if ``refuse`` is true on any of its lines, or if its lines can't be written. Line errors don't refuse a batch. If the first
    batch of a run already goes wrong, its error is raised as it is, otherwise a ``BatchError``.
    """
    spark, path = table.spark, f"{table.path}/journal/{run}"
    lines, batches = _plan(source, rule, path)
    done = 0
    for batch in batches:
        number, note = batch["batch_number"], f"{path}/batches/{batch['batch_number']:012d}.json"
        commit_id = f"{run}/{number}"
        mine = lines.where(F.col("batch_number") == number).drop("batch_number")
        try:
            if commit_id not in table.version.commits:
                # known to the journal before it can take effect
                write_text(spark, note, json.dumps({**batch, "status": UNCERTAIN, "error": "begun"}))
                if refuse is not None and not mine.where(refuse).isEmpty():
                    raise CommitError("the batch holds a refused line")
            elif exists(spark, note) and json.loads(read_text(spark, note))["status"] == COMPLETED:
                done += 1
                continue
            table, written = commit(table, mine, commit_id=commit_id, line=rule.line, **options)
        except Exception as error:
            status = FAILED if isinstance(error, _REFUSALS) else UNCERTAIN
            write_text(spark, note, json.dumps({**batch, "status": status, "error": str(error).split("\n")[0]}))
            if not done:
                raise
            raise BatchError(f"batch {number} is {status}", Journal(table, path)) from error
        # a batch whose commit was done before its note was written has lost its counts, not its effect
        counts = outcome(written).first().asDict() if written is not None else {}
        write_text(spark, note, json.dumps({**batch, "status": COMPLETED, **counts}))
        done += 1
    return table, Journal(table, path)
