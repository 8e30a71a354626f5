"""Pages of a table by a stored index of ranks: sorted once, then any page reads one or two files.

A sorted copy of the table is written together with one row per file: how many rows stand before it. A page is found in that
index and read from the files that hold it, by the place of its rows in them; nothing is sorted or shuffled again. Rows that
are equal in the sort columns keep the places they got, so pages never overlap.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import col
from ..session import exists, read_text, write_text

RANK = "_rank"
_FILES = "file string, first bigint, rows bigint"


@dataclass(frozen=True)
class PageIndex:
    """A sorted copy at ``path``; ``schema`` is that of the table."""

    spark: SparkSession
    path: str
    schema: T.StructType

    @classmethod
    def create(cls, df: DataFrame, order: Sequence[str | Column], path: str) -> PageIndex:
        spark, path = df.sparkSession, path.rstrip("/")
        keys = [col(key) if isinstance(key, str) else key for key in order]
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.option("maxRecordsPerFile", 0).parquet(f"{path}/rows")
        index = cls(spark, path, df.schema)
        counted = index._rows(f"{path}/rows").groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
        # task numbers follow the range order; one row per file is added up on the driver
        files, before = [], 0
        for row in counted.orderBy(F.regexp_extract("file", r"part-(\d+)", 1).cast("int")).collect():
            files.append((row["file"], before, row["rows"]))
            before += row["rows"]
        spark.createDataFrame(files, _FILES).coalesce(1).write.parquet(f"{path}/index")
        # last: without it there is no index
        write_text(spark, f"{path}/schema.json", df.schema.json())
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> PageIndex:
        path = path.rstrip("/")
        if not exists(spark, f"{path}/schema.json"):
            raise FileNotFoundError(f"no page index at {path}")
        return cls(spark, path, T.StructType.fromJson(json.loads(read_text(spark, f"{path}/schema.json"))))

    def _rows(self, *paths: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _files(self) -> DataFrame:
        return self.spark.read.schema(_FILES).parquet(f"{self.path}/index")

    def count(self) -> int:
        return self._files().agg(F.sum("rows")).first()[0] or 0

    def page(self, skip: int, top: int) -> DataFrame:
        """Rows ``skip + 1`` to ``skip + top`` with their 1-based rank in ``_rank``."""
        if skip < 0 or top < 1:
            raise ValueError("skip must not be negative and top must be at least 1")
        met = self._files().where((F.col("first") < skip + top) & (F.col("first") + F.col("rows") > skip)).collect()
        none = self.spark.createDataFrame([], self.schema).withColumn(RANK, F.lit(None).cast("bigint"))
        if not met:
            return none
        firsts = self.spark.createDataFrame([(row["file"], row["first"]) for row in met], "_file string, _first bigint")
        rows = self._rows(*[f"{self.path}/rows/{row['file']}" for row in met]).select(
            "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_place")
        )
        placed = rows.join(firsts, "_file").withColumn(RANK, F.col("_first") + F.col("_place") + 1)
        return placed.where((F.col(RANK) > skip) & (F.col(RANK) <= skip + top)).drop("_file", "_first", "_place")
