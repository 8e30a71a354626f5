"""Derived fields of a dataset, added in dependency order.

Fields are named ``table.label``, relationships ``@name``. Formulas, lookups and summaries
may feed each other across tables; each level of independent fields becomes one projection,
one join per lookup relationship and one aggregation per summary relationship.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame

from ..functions.labels import col, resolve
from ..operators.formulas import Formula, add_formulas
from ..operators.relations import Summary, add_lookups, add_summaries, lookup_label
from ..session import stage

# Among fields that are ready, these come first.
_PRIORITY = {"field": 0, "relationship": 1, "formula": 2, "lookup": 3, "summary": 3}


@dataclass(frozen=True)
class Relationship:
    name: str
    parent: str
    child: str
    key: str
    fk: str
    lookups: Sequence[str] = ()
    summaries: Sequence[Summary] = ()
    fk_label: str | None = None


@dataclass(frozen=True)
class Derivation:
    """Formulas per ``table.label`` and the relationships between tables."""

    formulas: Mapping[str, Formula] = field(default_factory=dict)
    relationships: Sequence[Relationship] = ()


@dataclass(frozen=True)
class Ordering:
    ordered: tuple[str, ...]
    blocked: tuple[str, ...] = ()
    cycle: tuple[str, ...] = ()


def _dependencies(tables: Mapping[str, DataFrame], plan: Derivation):
    needs: dict[str, set[str]] = {}
    kinds: dict[str, str] = {}

    def add(address: str, kind: str, required=()) -> None:
        if address in needs:
            raise ValueError(f"{address} is defined twice")
        needs[address], kinds[address] = set(required), kind

    for table, df in tables.items():
        for name in df.columns:
            add(f"{table}.{name}", "field")
    for relation in plan.relationships:
        link = f"@{relation.name}"
        ends = [f"{relation.child}.{relation.fk}", f"{relation.parent}.{relation.key}"]
        add(link, "relationship", ends)
        for name in relation.lookups:
            label = lookup_label(relation.fk_label or relation.fk, name)
            add(f"{relation.child}.{label}", "lookup", [link, f"{relation.parent}.{name}"])
        for summary in relation.summaries:
            read = [summary.field] if summary.field else []
            source = [f"{relation.child}.{name}" for name in (*read, *summary.where_fields)]
            add(f"{relation.parent}.{summary.name}", "summary", [link, *source])
    for address, formula in plan.formulas.items():
        add(address, "formula", formula.depends_on)
    unknown = sorted({name for required in needs.values() for name in required} - needs.keys())
    if unknown:
        raise ValueError(f"unknown dependencies: {unknown}")
    return needs, kinds


def order(tables: Mapping[str, DataFrame], plan: Derivation) -> Ordering:
    """Deterministic derivation order, and what a dependency cycle blocks."""
    needs, kinds = _dependencies(tables, plan)
    sorter = TopologicalSorter(needs)
    cycle: tuple[str, ...] = ()
    try:
        sorter.prepare()
    except CycleError as error:
        cycle = tuple(error.args[1])
    done: list[str] = []
    ready = set(sorter.get_ready())
    while ready:
        address = min(ready, key=lambda name: (_PRIORITY[kinds[name]], name))
        ready.remove(address)
        done.append(address)
        sorter.done(address)
        ready.update(sorter.get_ready())
    return Ordering(tuple(done), tuple(sorted(needs.keys() - set(done))), cycle)


def _wanted(needs: Mapping[str, set[str]], addresses: Iterable[str]) -> set[str]:
    """The addresses and everything that they depend on."""
    found: set[str] = set()
    left = list(addresses)
    if unknown := sorted(set(left) - needs.keys()):
        raise ValueError(f"unknown fields: {unknown}")
    while left:
        address = left.pop()
        if address not in found:
            found.add(address)
            left.extend(needs[address])
    return found


def derive(
    tables: Mapping[str, DataFrame], plan: Derivation, wanted: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """Every table with its derived fields, or the tables of the ``wanted`` fields with what these depend on.

    What several consumers read of a table that has derived fields already is written first, only the columns they need:
    each plan then grows by one join per relationship and level. A table with one consumer is part of its plan.
    """
    needs, kinds = _dependencies(tables, plan)
    outputs = set(tables)
    if wanted is not None:
        wanted = list(wanted)
        outputs = {address.split(".", 1)[0] for address in wanted}
        kept = _wanted(needs, wanted)
        needs = {address: required for address, required in needs.items() if address in kept}
    sorter = TopologicalSorter(needs)
    sorter.prepare()
    levels: list[set[str]] = []
    while sorter.is_active():
        levels.append(set(sorter.get_ready()))
        sorter.done(*levels[-1])
    reads = [
        side for level in levels for relation in plan.relationships
        for side, fields in (
            (relation.parent, _lookups(relation, level)), (relation.child, _summaries(relation, level))
        ) if fields
    ]
    shared = {name for name in tables if reads.count(name) + (name in outputs) > 1}
    result = dict(tables)
    for level in levels:
        formulas: dict[str, dict[str, Formula]] = defaultdict(dict)
        for address in sorted(level):
            if kinds[address] == "formula":
                table, label = address.split(".", 1)
                formulas[table][label] = plan.formulas[address]
        before = dict(result)
        for table, group in formulas.items():
            result[table] = add_formulas(result[table], group)
        for relation in plan.relationships:
            _add_relationship(tables, result, before, relation, level, shared)
    return {name: result[name] for name in tables if name in outputs}


def _lookups(relation: Relationship, level: set[str]) -> list[str]:
    label = relation.fk_label or relation.fk
    return [n for n in relation.lookups if f"{relation.child}.{lookup_label(label, n)}" in level]


def _summaries(relation: Relationship, level: set[str]) -> list[Summary]:
    return [s for s in relation.summaries if f"{relation.parent}.{s.name}" in level]


def _side(tables, before, table: str, columns: list[str] | None, shared: set[str]) -> DataFrame:
    """A table as a relationship reads it: only these columns, and written if others read its derived fields too."""
    df = before[table]
    if df is tables[table]:
        return df
    if columns is not None:
        df = df.select(*[col(name) for name in dict.fromkeys(resolve(df.columns, n) for n in columns)])
    return stage(df, "derived") if table in shared else df


def _add_relationship(tables, result, before, relation: Relationship, level: set[str], shared: set[str]) -> None:
    label = relation.fk_label or relation.fk
    lookups, summaries = _lookups(relation, level), _summaries(relation, level)
    if lookups:
        result[relation.child] = add_lookups(
            result[relation.child],
            _side(tables, before, relation.parent, [relation.key, *lookups], shared),
            relation.fk,
            relation.key,
            lookups,
            label,
        )
    if summaries:
        # a filter that doesn't name what it reads may read any column
        known = all(s.where is None or s.where_fields for s in summaries)
        read = [relation.fk, *[n for s in summaries for n in (s.field, *s.where_fields) if n]]
        child = _side(tables, before, relation.child, read if known else None, shared)
        result[relation.parent] = add_summaries(
            result[relation.parent], child, relation.key, relation.fk, summaries
        )
