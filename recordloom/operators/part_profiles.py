"""Profiles of a table kept per part: a part that changes is read again, the others are merged from what is stored.

A part's profile is one stored row: its rows and, per column, filled rows, lowest and highest value in the column's own type, a
sketch of its distinct values and, for numbers, a sketch of its quantiles. Counts and bounds of the merged profile are exact,
distinct values and quantiles are estimates: with the sizes below about 0.8 percent of the value and 1 percent of the rank.

Null is a part like any other. A part named to ``update`` that has no rows any more is stored with none. NaN and null take no part
in quantiles. A store has one writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import col, resolve
from ..session import exists, read_text, write_text

#: Sizes of the sketches: 2^14 registers of distinct values, 400 items a level for quantiles.
DISTINCT_BITS, QUANTILE_ITEMS = 14, 400
QUANTILES = (0.25, 0.5, 0.75)

_PLAIN = (T.StringType, T.BinaryType)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
_RUN = "_run"


def _hashed(value: Column, kind: T.DataType) -> Column:
    """The value in a type that distinct sketches take; equal values stay equal."""
    if isinstance(kind, _PLAIN):
        return value
    if isinstance(kind, _WHOLE):
        return value.cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # one zero
        return F.when(value == 0, F.lit("0")).otherwise(value.cast("string"))
    return F.when(value.isNotNull(), F.to_json(F.struct(value))) if isinstance(kind, _NESTED) else value.cast("string")


def _facts(field: T.StructField) -> Column:
    value, kind = col(field.name), field.dataType
    ordered = not isinstance(kind, _NESTED)
    facts = [
        F.count(value).alias("filled"),
        F.hll_sketch_agg(_hashed(value, kind), DISTINCT_BITS).alias("values"),
    ]
    if ordered:
        facts += [F.min(value).alias("lowest"), F.max(value).alias("highest")]
    if isinstance(kind, T.NumericType):
        number = value.cast("double")
        facts.append(F.kll_sketch_agg_double(F.when(~F.isnan(number), number), QUANTILE_ITEMS).alias("ranks"))
    return F.struct(*facts)


@dataclass(frozen=True)
class PartProfiles:
    """The stored profiles at ``path`` of the parts of a table, told apart by its column ``part``."""

    spark: SparkSession
    path: str
    part: str
    schema: T.StructType

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType, part: str) -> PartProfiles:
        path = path.rstrip("/")
        if exists(spark, f"{path}/table.json"):
            raise FileExistsError(f"there are profiles at {path} already")
        part = resolve(schema.names, part)
        write_text(spark, f"{path}/table.json", json.dumps({"part": part, "schema": schema.jsonValue()}))
        return cls(spark, path, part, schema)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> PartProfiles:
        path = path.rstrip("/")
        if not exists(spark, f"{path}/table.json"):
            raise FileNotFoundError(f"no profiles at {path}")
        kept = json.loads(read_text(spark, f"{path}/table.json"))
        return cls(spark, path, kept["part"], T.StructType.fromJson(kept["schema"]))

    @property
    def fields(self) -> list[T.StructField]:
        return [field for field in self.schema.fields if field.name != self.part]

    def _profiled(self, df: DataFrame) -> DataFrame:
        facts = [_facts(field).alias(f"_c{i}") for i, field in enumerate(self.fields)]
        return df.groupBy(col(self.part).alias("_part")).agg(F.count(F.lit(1)).alias("_rows"), *facts)

    def update(self, df: DataFrame, parts: Sequence[object] | None = None) -> None:
        """Profile ``parts`` of ``df`` anew, all that it has by default; only their rows are read."""
        if [(f.name, f.dataType) for f in df.schema.fields] != [(f.name, f.dataType) for f in self.schema.fields]:
            raise ValueError("the table's columns are not those that are profiled")
        kind = self.schema[self.part].dataType
        if parts is None:
            found = self._profiled(df)
        else:
            given = [value for value in parts if value is not None]
            among = col(self.part).isin(given) if given else F.lit(False)
            rows = df.where(among | col(self.part).isNull() if None in parts else among)
            # a row for each named part, also for those without rows
            named = self.spark.createDataFrame([(value,) for value in dict.fromkeys(parts)], T.StructType([T.StructField("_named", kind)]))
            found = named.join(self._profiled(rows), F.col("_named").eqNullSafe(F.col("_part")), "left")
            found = found.withColumn("_part", F.col("_named")).drop("_named").fillna(0, ["_rows"])
        last = self._stored().agg(F.max(_RUN)).first()[0] if self._written() else 0
        found.withColumn(_RUN, F.lit(last + 1).cast("long")).write.mode("append").parquet(f"{self.path}/parts")

    def _written(self) -> bool:
        return exists(self.spark, f"{self.path}/parts")

    def _stored(self) -> DataFrame:
        if self._written():
            return self.spark.read.parquet(f"{self.path}/parts")
        return self._profiled(self.spark.createDataFrame([], self.schema)).withColumn(_RUN, F.lit(0).cast("long"))

    def _newest(self) -> DataFrame:
        """Per part its last profile."""
        stored = self._stored()
        facts = F.struct(*[F.col(name) for name in stored.columns if name != "_part"])
        return stored.groupBy("_part").agg(F.max_by(facts, _RUN).alias("_last")).select("_part", "_last.*")

    def report(self, per_part: bool = False, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
        """Per column, or part and column: rows, filled rows, estimated distinct values, bounds as text and quantiles.

        Reads the stored rows only. ``quantiles`` is null where the column holds no number. Without parts, or if all are
        empty, rows are 0.
        """
        if any(not 0 <= q <= 1 for q in quantiles):
            raise ValueError("quantiles must be between 0 and 1")
        newest, facts = self._newest(), [F.coalesce(F.sum("_rows"), F.lit(0).cast("long")).alias("rows")]
        for i, field in enumerate(self.fields):
            held = F.col(f"_c{i}")
            facts.append(F.coalesce(F.sum(held["filled"]), F.lit(0).cast("long")).alias(f"_f{i}"))
            facts.append(F.hll_sketch_estimate(F.hll_union_agg(held["values"])).alias(f"_d{i}"))
            if not isinstance(field.dataType, _NESTED):
                facts += [F.min(held["lowest"]).alias(f"_a{i}"), F.max(held["highest"]).alias(f"_z{i}")]
            if isinstance(field.dataType, T.NumericType):
                # sketches without an item have no quantiles
                filled = F.when(F.kll_sketch_get_n_double(held["ranks"]) > 0, held["ranks"])
                facts.append(F.kll_merge_agg_double(filled).alias(f"_r{i}"))
                facts.append(F.max(filled.isNotNull()).alias(f"_any{i}"))
        keys = [F.col("_part").alias(self.part)] if per_part else []
        merged = newest.groupBy(*keys).agg(*facts) if per_part else newest.agg(*facts)
        rows = [self._row(i, field, quantiles) for i, field in enumerate(self.fields)]
        return merged.select(*([col(self.part)] if per_part else []), F.inline(F.array(*rows)))

    def _row(self, i: int, field: T.StructField, quantiles: Sequence[float]) -> Column:
        nothing, ranks = F.lit(None).cast("string"), F.lit(None).cast("array<double>")
        ordered = not isinstance(field.dataType, _NESTED)
        if isinstance(field.dataType, T.NumericType):
            asked = F.array(*[F.lit(float(q)) for q in quantiles])
            ranks = F.when(F.col(f"_any{i}"), F.kll_sketch_get_quantile_double(F.col(f"_r{i}"), asked))
        return F.struct(
            F.lit(field.name).alias("column"),
            F.col("rows"),
            F.col(f"_f{i}").alias("filled"),
            F.coalesce(F.col(f"_d{i}"), F.lit(0).cast("long")).alias("distinct_values"),
            (F.col(f"_a{i}").cast("string") if ordered else nothing).alias("lowest"),
            (F.col(f"_z{i}").cast("string") if ordered else nothing).alias("highest"),
            ranks.alias("quantiles"),
        )
