"""The corpus pipeline: every stage reads what the one before it kept, as written Parquet.

Stages keep all columns of ``documents``, whatever further ones there are, and decide on whole texts:

1. language ID drops documents without a language, or of whose text the languages of its mixture explain less than a fifth;
   it learns from all documents with a language;
2. near duplicates, linked from 80 percent of their five-word shingles on, keep one document of each group, the smallest id;
3. decontamination cuts passages of ``benchmark`` out of texts and drops documents that are mostly such passages;
4. secret scans replace secrets by a mark;
5. mixing keeps what the target weights take: ``taken`` words of each document, none that takes nothing.

Where a text changes, ``n_chars`` follows, if there is such a column. Empty tables give empty results. Null and
empty texts have no language and go in the first stage. A document with a null id stands for itself. Of rows with equal id and
text the second stage keeps the one whose other columns, as JSON, come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.decontamination import decontaminate
from recordloom.llm.hash_bits import hash_bits, split_by_bits
from recordloom.llm.language_mixture import identify_languages, learn_languages
from recordloom.llm.mixing import mix_sources
from recordloom.llm.near_duplicates import near_duplicates
from recordloom.llm.secrets import find_secrets, fresh_name, redact
from recordloom.session import scratch_path
from recordloom.session import stage as written

LEAST_EXPLAINED = 0.2
NEAR_DUPLICATE_PERCENT = 80


def _same_row(docs: DataFrame, found: DataFrame) -> Column:
    """Rows of an operator's result belong to rows of the same id and text."""
    return docs["doc_id"].cast("long").eqNullSafe(found["_id"]) & F.xxhash64(docs["text"]).eqNullSafe(found["_text"])


def _keys(found: DataFrame, *columns: str) -> DataFrame:
    return found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text"), *columns)


def _with_length(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = identify_languages(docs, learn_languages(docs))
    refused = _keys(found.filter((F.col("lang_pred") == "und") | (F.col("explained") < LEAST_EXPLAINED))).distinct()
    # written first, so its size is known and texts are shuffled only where it is too large to send around
    refused = written(refused, "refused")
    return docs.join(refused, _same_row(docs, refused), "left_anti")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = written(near_duplicates(docs, NEAR_DUPLICATE_PERCENT), "near-duplicates")
    others = written(_keys(found.filter(~F.col("kept"))).distinct(), "near-duplicates")
    # documents that can't be among the others pass without a shuffle
    maybe, sure = split_by_bits(docs, F.xxhash64("text"), hash_bits(others, "_text"))
    kept = sure.union(maybe.join(others, _same_row(maybe, others), "left_anti"))
    # equal rows of a kept id are one document; where there are any, only they are shuffled
    equal = _keys(found.filter("kept")).groupBy("_id", "_text").agg(F.count("*").alias("rows")).filter("rows > 1")
    equal = written(equal.select("_id", "_text"), "near-duplicates")
    if equal.isEmpty():
        return kept
    repeated = kept.join(equal, _same_row(kept, equal), "left_semi")
    # of rows that differ elsewhere, the one whose other columns come first as text
    others = F.to_json(F.struct(*[F.col(f"`{name}`") for name in docs.columns]), {"ignoreNullFields": "false"})
    first = repeated.groupBy("doc_id", "text").agg(F.min_by(F.struct("*"), others).alias("_row")).select("_row.*")
    return kept.join(equal, _same_row(kept, equal), "left_anti").union(first)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_length(decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spans = fresh_name(docs, "_spans")
    found = find_secrets(docs, result=spans)
    return _with_length(found.withColumn("text", redact(F.col("text"), F.col(spans))).drop(spans))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = _keys(mix_sources(docs), "taken").groupBy("_id", "_text").agg(F.min("taken").alias("taken"))
    docs = docs.drop("taken")
    taken = docs.join(mixed.filter("taken > 0"), _same_row(docs, mixed))
    return taken.drop(mixed["_id"], mixed["_text"])


STAGES = [
    ("language ID", language_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secret scans", secret_stage),
    ("mixing to target weights", mixing_stage),
]

#: SQL can express neither the language models nor the sketches' documents that they keep.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES:
        path = scratch_path(spark, "pipeline")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
