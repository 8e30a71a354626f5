"""Summaries kept up to date from changed children, without reading the others.

For each parent a row of mergeable partials is stored: counts, sums, squares around a mean, greatest and least values. A
change feed gives old and new versions of changed children; their contributions are added up per parent and joined with the
partials. Only where the greatest or least value went with an old version are the children of that parent read again. A
child that moves counts as old at one parent and new at another.

COUNT, SUM, AVG, STD-DEV, MAX and MIN can be kept so; the other kinds hold values and are computed anew. Sums of fractions may
differ from fresh ones in their last digits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import col, resolve
from ..session import stage
from .query import as_predicate
from .relations import Summary

SIGN = "_sign"
KEPT = ("COUNT", "SUM", "AVG", "STD-DEV", "MAX", "MIN")
_PARTS = {"COUNT": "n", "SUM": "ns", "AVG": "ns", "STD-DEV": "npsq", "MAX": "m", "MIN": "m"}


def _values(rows: DataFrame, fk: str, summaries: Sequence[Summary], *more: str) -> DataFrame:
    """``_fk`` and for each summary the value that counts, null where none does."""
    for summary in summaries:
        if summary.kind not in KEPT:
            raise ValueError(f"{summary.kind} summaries can't be kept up to date")
    values = []
    for i, summary in enumerate(summaries):
        value = col(resolve(rows.columns, summary.field)) if summary.field else F.lit(1)
        condition = as_predicate(rows, summary.where)
        values.append((value if condition is None else F.when(condition, value)).alias(f"_x{i}"))
    key = col(resolve(rows.columns, fk))
    return rows.where(key.isNotNull()).select(key.alias("_fk"), *values, *more)


def _extreme(summary: Summary, value: Column) -> Column:
    return F.max(value) if summary.kind == "MAX" else F.min(value)


def partials(child: DataFrame, fk: str, summaries: Sequence[Summary]) -> DataFrame:
    """The partials of every parent with children, in one combining aggregation; written."""
    rows, found = _values(child, fk, summaries), []
    for i, summary in enumerate(summaries):
        x = F.col(f"_x{i}")
        each = {
            "n": F.count(x), "s": F.lit(0.0) if summary.kind == "STD-DEV" else F.sum(x), "p": F.coalesce(F.avg(x), F.lit(0.0)),
            "q": F.coalesce(F.var_pop(x) * F.count(x), F.lit(0.0)), "m": _extreme(summary, x),
        }
        found += [each[part].alias(f"_{part}{i}") for part in _PARTS[summary.kind]]
    return stage(rows.groupBy("_fk").agg(*found), "partials")


def update_partials(
    state: DataFrame, old: DataFrame, new: DataFrame, fk: str, summaries: Sequence[Summary], child: DataFrame
) -> DataFrame:
    """The partials after a change feed: ``old`` and ``new`` versions of the changed children, ``child`` all of them afterwards.

    ``child`` is read only for parents whose greatest or least value went.
    """
    signed = old.withColumn(SIGN, F.lit(-1)).unionByName(new.withColumn(SIGN, F.lit(1)))
    changes = _values(signed, fk, summaries, SIGN)
    pivots = [f"_p{i}" for i, s in enumerate(summaries) if s.kind == "STD-DEV"]
    if pivots:
        changes = changes.join(state.select("_fk", *pivots), "_fk", "left")
    found, merged, lost = [], [F.coalesce(F.col("_fk"), F.col("_changed")).alias("_fk")], []
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    for i, summary in enumerate(summaries):
        x, sign = F.col(f"_x{i}"), F.col(SIGN)
        if summary.kind in ("MAX", "MIN"):
            found += [
                _extreme(summary, F.when(sign > 0, x)).alias(f"_in{i}"), _extreme(summary, F.when(sign < 0, x)).alias(f"_out{i}")
            ]
            best = (F.greatest if summary.kind == "MAX" else F.least)(F.col(f"_m{i}"), F.col(f"_in{i}"))
            merged.append(best.alias(f"_m{i}"))
            # the best value left, and nothing as good came in its place
            came = F.coalesce(F.col(f"_in{i}") == best, F.lit(False))
            went = F.coalesce(F.col(f"_out{i}") == F.col(f"_m{i}"), F.lit(False)) & F.coalesce(best == F.col(f"_m{i}"), F.lit(False))
            lost.append((went & ~came).alias(f"_lost{i}"))
            continue
        shifted = x - zero(f"_p{i}") if summary.kind == "STD-DEV" else x
        deltas = {"n": F.sum(F.when(x.isNotNull(), sign)), "s": F.sum(sign * shifted), "q": F.sum(sign * shifted * shifted)}
        for part in _PARTS[summary.kind]:
            if part == "p":
                merged.append(zero(f"_p{i}").alias(f"_p{i}"))
            else:
                found.append(deltas[part].alias(f"_d{part}{i}"))
                merged.append((zero(f"_{part}{i}") + zero(f"_d{part}{i}")).alias(f"_{part}{i}"))
    delta = changes.groupBy(F.col("_fk").alias("_changed")).agg(*found)
    joined = state.join(delta, F.col("_fk") == F.col("_changed"), "full").select(*merged, *lost)
    names = [name for name in joined.columns if not name.startswith("_lost")]
    joined = stage(joined, "partials")
    marks = [F.col(name) for name in joined.columns if name.startswith("_lost")]
    if not marks:
        return joined
    broken = joined.where(reduce(or_, marks))
    if broken.isEmpty():
        return joined.select(*names)
    again = _values(child, fk, summaries).join(broken.select("_fk"), "_fk", "left_semi").groupBy("_fk").agg(
        *[_extreme(s, F.col(f"_x{i}")).alias(f"_again{i}") for i, s in enumerate(summaries) if s.kind in ("MAX", "MIN")]
    )
    fresh = {f"_m{i}": F.when(F.col(f"_lost{i}"), F.col(f"_again{i}")).otherwise(F.col(f"_m{i}")) for i, s in enumerate(summaries) if s.kind in ("MAX", "MIN")}
    return stage(joined.join(again, "_fk", "left").select(*[fresh.get(name, F.col(name)).alias(name) for name in names]), "partials")


def summaries_from(parent: DataFrame, key: str, state: DataFrame, summaries: Sequence[Summary]) -> DataFrame:
    """The parent with its summary fields, as ``add_summaries`` gives them."""
    outputs = []
    for i, summary in enumerate(summaries):
        n, s, q = F.col(f"_n{i}"), F.col(f"_s{i}"), F.col(f"_q{i}")
        value = {
            "COUNT": F.coalesce(n, F.lit(0).cast("bigint")),
            "SUM": F.when(n > 0, s),
            "AVG": F.when(n > 0, s / n),
            "STD-DEV": F.when(n > 1, F.sqrt(F.greatest(q - s * s / n, F.lit(0.0)) / (n - 1))),
            "MAX": F.col(f"_m{i}"),
            "MIN": F.col(f"_m{i}"),
        }[summary.kind]
        outputs.append(value.alias(summary.name))
    joined = parent.join(state, col(resolve(parent.columns, key)) == F.col("_fk"), "left")
    return joined.select(*[col(name) for name in parent.columns], *outputs)
