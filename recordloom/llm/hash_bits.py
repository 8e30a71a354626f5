"""A bit table of fixed size that tells which rows can't be among given keys, before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.session import stage

#: Words of 64 bits. The table is broadcast: it never has more rows than this, a few MB, whatever the number of keys; with
#: very many keys it only rules out fewer rows.
WORDS = 1 << 18


def _word(value: Column) -> Column:
    return F.pmod(F.shiftrightunsigned(value, 6), F.lit(WORDS)).cast("int")


def _bit(value: Column) -> Column:
    # shifts of a long take the last six bits of the distance
    return F.call_function("shiftleft", F.lit(1).cast("long"), value.bitwiseAND(F.lit(63).cast("long")).cast("int"))


def hash_bits(keys: DataFrame, column: str) -> DataFrame:
    """``_word, _bits`` over the 64-bit hashes in ``column``; null counts as a hash of 0."""
    value = F.coalesce(F.col(column), F.lit(0).cast("long"))
    return stage(keys.groupBy(_word(value).alias("_word")).agg(F.bit_or(_bit(value)).alias("_bits")), "hash-bits")


def split_by_bits(rows: DataFrame, value: Column, bits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose hash ``value`` may be among the keys, and rows whose hash isn't. Columns stay as they are."""
    value = F.coalesce(value, F.lit(0).cast("long"))
    table = F.broadcast(bits.select(F.col("_word").alias("_bits_word"), "_bits"))
    joined = rows.join(table, _word(value) == table["_bits_word"], "left")
    held = F.coalesce(table["_bits"].bitwiseAND(_bit(value)) != 0, F.lit(False))
    drop = lambda df: df.drop(table["_bits_word"], table["_bits"])
    return drop(joined.filter(held)), drop(joined.filter(~held))
