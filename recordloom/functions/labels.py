"""Resolve human labels to columns and tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


class LabelError(ValueError):
    """A label names no column, or more than one."""


def col(name: str) -> Column:
    """Column by its exact name, whatever characters it holds."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def resolve(columns: Iterable[str], label: str) -> str:
    """Exact spelling wins; otherwise the only match ignoring case.

    ``casefold`` rather than Spark's ``lower``: "Straße" must find "STRASSE".
    """
    names = list(columns)
    if label in names:
        return label
    matches = sorted(name for name in names if name.casefold() == label.casefold())
    if not matches:
        raise LabelError(f"Label {label!r} not found. Available: {sorted(names)}")
    if len(matches) > 1:
        raise LabelError(f"Label {label!r} is ambiguous. Matches: {matches}")
    return matches[0]


def resolve_all(columns: Iterable[str], labels: Iterable[str]) -> list[str]:
    """Resolve a projection list; one column may be asked for only once."""
    names = list(columns)
    found = [resolve(names, label) for label in labels]
    repeated = sorted({name for name in found if found.count(name) > 1})
    if repeated:
        raise LabelError(f"Labels selected more than once: {repeated}")
    return found


def resolve_table(tables: Mapping[str, Any], name: str) -> Any:
    """Look a table up in a dataset by id, else by name ignoring case."""
    return tables[name] if name in tables else tables[resolve(tables, name)]


def unique_labels(labels: Iterable[str]) -> list[str]:
    """Check that labels differ even when case is ignored."""
    names = list(labels)
    seen: dict[str, str] = {}
    for name in names:
        twin = seen.setdefault(name.casefold(), name)
        if twin is not name:
            raise LabelError(f"Labels {twin!r} and {name!r} collide")
    return names
