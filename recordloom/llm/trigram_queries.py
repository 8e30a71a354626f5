"""Boolean trigram queries that every match of a regular expression must satisfy.

A query is True (no trigram is mandatory), a trigram, ``("and", ...)`` or ``("or", ...)``. Trigrams are in lower
case. The regex is read by Python's own parser; what the derivation doesn't know only loosens the query.
"""

from __future__ import annotations

from re import _constants as code
from re import _parser

Query = bool | str | tuple

#: A set of more alternative strings is given up, which loosens the query.
MOST_STRINGS = 64


def _all(queries: list[Query]) -> Query:
    kept = sorted({q for q in queries if q is not True}, key=repr)
    return True if not kept else kept[0] if len(kept) == 1 else ("and", *kept)


def _any(queries: list[Query]) -> Query:
    if True in queries or not queries:
        return True
    kept = sorted(set(queries), key=repr)
    return kept[0] if len(kept) == 1 else ("or", *kept)


def _of_strings(strings: set[str]) -> Query:
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    # a conjunction that asks for more than another one adds nothing to the alternatives
    return _any([_all(list(one)) for one in sets if not any(other < one for other in sets)])


def _characters(items) -> set[str] | None:
    """The lower-case characters of a class; None if they are too many or not listed."""
    found: set[str] = set()
    for kind, value in items:
        if kind is code.LITERAL:
            found.add(chr(value).lower())
        elif kind is code.RANGE and value[1] - value[0] < MOST_STRINGS:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


def _walk(items) -> tuple[set[str] | None, Query]:
    """The exact strings that the items match, if few, else None; and the query."""
    strings: set[str] = {""}
    queries: list[Query] = []
    exact = True

    def part(found: set[str] | None, query: Query) -> None:
        nonlocal strings, exact
        if found is not None and len(strings) * len(found) <= MOST_STRINGS:
            strings = {a + b for a in strings for b in found}
            return
        queries.append(_of_strings(strings))
        queries.append(query if found is None else True)
        # what follows begins anew; a set that was too large still counts from here
        strings, exact = (found if found is not None else {""}), False

    for kind, value in items:
        if kind is code.LITERAL:
            part({chr(value).lower()}, True)
        elif kind is code.IN:
            part(_characters(value), True)
        elif kind is code.SUBPATTERN:
            part(*_walk(value[3]))
        elif kind is code.BRANCH:
            inner = [_walk(branch) for branch in value[1]]
            if all(found is not None for found, _ in inner):
                part(set().union(*(found for found, _ in inner)), True)
            else:
                part(None, _any([_of_strings(found) if found is not None else query for found, query in inner]))
        elif kind in (code.MAX_REPEAT, code.MIN_REPEAT):
            low, high, inside = value
            found, query = _walk(inside)
            if (low, high) == (0, 1) and found is not None:
                part(found | {""}, True)
            elif low:
                if found is not None:
                    part(found, True)
                part(None, True if found is not None else query)
            else:
                part(None, True)
        elif kind not in (code.AT, code.ASSERT, code.ASSERT_NOT):
            part(None, True)
    if exact:
        return strings, True
    return None, _all([*queries, _of_strings(strings)])


def trigram_query(pattern: str) -> Query:
    strings, query = _walk(_parser.parse(pattern))
    return _of_strings(strings) if strings is not None else query


def trigrams(query: Query) -> set[str]:
    if isinstance(query, str):
        return {query}
    return set().union(*map(trigrams, query[1:])) if isinstance(query, tuple) else set()
