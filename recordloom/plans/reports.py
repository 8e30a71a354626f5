"""Saved reports: named queries kept as data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from ..functions.labels import resolve_table
from ..functions.predicates import RecordFilter
from ..operators.query import run_query


@dataclass(frozen=True)
class Report:
    """A stored query; ``conditions`` are (label, operator code, value) triples."""

    name: str
    table: str
    columns: Sequence[str]
    conditions: Sequence[tuple] = ()
    match: str = "all"
    sort_by: Sequence[tuple[str, str]] = ()
    group_by: Sequence[str] = ()
    key: str | None = None
    labels: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.match not in ("all", "any"):
            raise ValueError("match must be 'all' or 'any'")

    def predicate(self, df: DataFrame) -> Column | None:
        if not self.conditions:
            return None
        where = RecordFilter(df)
        parts = [where.expr(*condition) for condition in self.conditions]
        return where.and_(*parts) if self.match == "all" else where.or_(*parts)


def run_report(
    tables: Mapping[str, DataFrame], report: Report, skip: int = 0, top: int | None = None
) -> DataFrame:
    """Run a saved report over a dataset; columns may be shown under other labels."""
    df = resolve_table(tables, report.table)
    result = run_query(
        df,
        report.columns,
        report.predicate(df),
        report.sort_by or None,
        report.group_by or None,
        skip,
        top,
        report.key,
    )
    return result.withColumnsRenamed(dict(report.labels))


def register_report(tables: Mapping[str, DataFrame], report: Report) -> None:
    """Make a report available to Spark SQL under its name."""
    run_report(tables, report).createOrReplaceTempView(report.name)
