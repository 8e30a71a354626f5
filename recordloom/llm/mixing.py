"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

Targets: every source gets its weight times a common level, but no more than ``max_epochs`` times its size; what
that cuts is shared out again by weight until no source is above. Only the level is held by the driver.

Repetitions: a source is taken whole as often as its target allows, and what is missing comes from its
documents in a seeded order, the last one in part, so each source's words meet its target to a word.
The order is found by hash buckets: only their sums and the one bucket that holds the cut are ever
sorted, about the square root of a source's rows.

Null texts have no words, the null source is a source (the last one). Repeated rows are documents of their own;
equal ones are interchangeable. A source without words has a target of 0. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.operators.ordering import global_rank
from recordloom.session import stage

WORD = r"[^\x20\x09-\x0D]+"
_TICKET_BITS = 48


def water_level(sources: DataFrame, total: float, max_epochs: float) -> float:
    """The level at which ``sum(least(weight * level, max_epochs * words))`` is ``total``.

    ``sources`` has ``weight, words``. Every round clamps what stands above its cap and spreads the rest.
    """
    cap = F.col("words") * F.lit(float(max_epochs))
    level, before = 0.0, None
    while level != before:
        above = F.col("weight") * F.lit(level) > cap
        row = sources.agg(
            F.sum(F.when(above, cap)).alias("capped"), F.sum(F.when(~above, F.col("weight"))).alias("open")
        ).first()
        before = level
        if not row["open"]:
            return math.inf if row["capped"] is not None else 0.0
        level = max(before, (total - (row["capped"] or 0.0)) / row["open"])
    return level


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), share: float = 1.5,
    max_epochs: int = 2, seed: int = 17,
) -> DataFrame:
    """``doc_id, text_hash, source, size, source_size, target, taken`` for each row of ``docs``.

    Sources in code-point order, null last, get ``weights`` in turn; all targets sum to ``share`` times all words,
    as far as ``max_epochs`` allows.
    """
    ticket = F.conv(
        F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit(""))))), 1, 12),
        16, 10,
    ).cast("long")
    sizes = stage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), ticket.alias("ticket"),
        ),
        "sizes",
    )
    counted = sizes.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    ranked = global_rank(counted, [F.col("source").asc_nulls_last()], "place")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    sources = stage(ranked.withColumn("weight", turn), "sources")
    whole = sources.agg(F.sum("words").alias("words"), F.max("rows").alias("rows")).first()
    total = share * (whole["words"] or 0)
    level = water_level(sources, total, max_epochs)
    cap = F.col("words") * F.lit(float(max_epochs))
    targets = sources.withColumn(
        "target", F.when(F.col("weight") * F.lit(level) > cap, cap).otherwise(F.col("weight") * F.lit(level))
    )
    targets = targets.withColumn(
        "whole", F.when(F.col("words") > 0, F.least(F.floor(F.col("target") / F.col("words")), F.lit(max_epochs))).otherwise(0)
    ).withColumn("part", F.greatest(F.lit(0), F.floor("target") - F.col("whole") * F.col("words")))

    # buckets of the seeded order, about as many as rows in one of them
    bits = max(1, math.ceil(math.log2(max(1, whole["rows"] or 1)) / 2))
    bucket = F.shiftright("ticket", _TICKET_BITS - bits).cast("int")
    known = F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))
    rows = sizes.withColumn("bucket", bucket).withColumn("known", known)
    sums = rows.groupBy("known", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("known").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    plan = targets.select(known.alias("known"), F.col("words").alias("source_size"), "target", "whole", "part")
    cuts = (
        placed.join(plan, "known")
        .filter("part > 0 AND before < part AND part <= before + words")
        .select("known", F.col("bucket").alias("cut"), "before")
    )
    plan = stage(plan.join(cuts, "known", "left"), "mix-plan")

    shared = ["doc_id", "text_hash", "source", "size", "source_size", "target"]
    on_cut = rows.join(
        plan.filter("cut IS NOT NULL").withColumnRenamed("cut", "bucket"), ["known", "bucket"]
    )
    inside = Window.partitionBy("known", "bucket").orderBy("ticket", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    on_cut = on_cut.withColumn("seen", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    extra = F.least(F.col("size"), F.greatest(F.lit(0), F.col("part") - F.col("seen")))
    on_cut = on_cut.select(*shared, (F.col("whole") * F.col("size") + extra).alias("taken"))

    below = F.when(F.col("bucket") < F.col("cut"), F.col("size")).otherwise(0)
    others = (
        rows.join(plan, "known")
        .filter("cut IS NULL OR bucket != cut")
        .select(*shared, (F.col("whole") * F.col("size") + F.coalesce(below, F.lit(0))).alias("taken"))
    )
    return others.union(on_cut)
