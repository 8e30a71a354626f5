"""Label-based queries, paging and grouping."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import col, resolve, resolve_all
from ..functions.predicates import RecordFilter
from .ordering import first_rows, global_rank

# Fixed value: records in one page unless asked otherwise.
PAGE_SIZE = 1000

# Up to this many rows a sorted prefix is kept by a top-k heap; deeper pages are ranked.
TOP_K_LIMIT = 100_000

Where = Column | Callable[[RecordFilter], Column] | str | None


def as_predicate(df: DataFrame, where: Where) -> Column | None:
    if callable(where) and not isinstance(where, Column):
        return where(RecordFilter(df))
    return F.expr(where) if isinstance(where, str) else where


def select_where(df: DataFrame, where: Where) -> DataFrame:
    predicate = as_predicate(df, where)
    return df if predicate is None else df.where(predicate)


def _count(value: int | None, name: str, optional: bool = False) -> None:
    if value is None and optional:
        return
    if not isinstance(value, int) or isinstance(value, bool) or value < 0:
        raise ValueError(f"{name} must be a non-negative integer{' or None' if optional else ''}")


def sort_columns(columns: Sequence[str], sort_by: Sequence[tuple[str, str]]) -> list[Column]:
    """Sort columns from (label, direction) pairs; blanks come first ascending."""
    directions = {"ASC": Column.asc_nulls_first, "DESC": Column.desc_nulls_last}
    result = []
    for label, direction in sort_by:
        if direction.upper() not in directions:
            raise ValueError(f"sort direction must be ASC or DESC, not {direction!r}")
        result.append(directions[direction.upper()](col(resolve(columns, label))))
    return result


def window_of_rows(df: DataFrame, order: Sequence[Column], skip: int, top: int | None) -> DataFrame:
    """Rows ``skip + 1 .. skip + top`` of an order; ``top`` of None or 0 means all the rest."""
    limit = top or None
    if limit and skip + limit <= TOP_K_LIMIT:
        return df.orderBy(*order).offset(skip).limit(limit)
    if not limit and not skip:
        return df.orderBy(*order)
    # A deep offset would send every skipped row through one task; rank in parallel instead.
    ranked = global_rank(df, order, "_rank").where(F.col("_rank") > skip)
    if limit:
        ranked = ranked.where(F.col("_rank") <= skip + limit)
    return ranked.orderBy("_rank").drop("_rank")


def run_query(
    df: DataFrame,
    select: Sequence[str],
    where: Where = None,
    sort_by: Sequence[tuple[str, str]] | None = None,
    group_by: Sequence[str] | None = None,
    skip: int = 0,
    top: int | None = None,
    key: str | None = None,
) -> DataFrame:
    """Select labels in order from the matching rows.

    With ``key`` the row order is total: ties break on the key, and a limit without a sort
    takes the lowest keys. Without ``sort_by`` and limits no order is imposed.
    """
    _count(skip, "skip")
    _count(top, "top", optional=True)
    wanted = resolve_all(df.columns, select)
    matching = select_where(df, where)
    if group_by:
        groups = resolve_all(df.columns, group_by)
        if not set(wanted) <= set(groups):
            raise ValueError("only grouped labels can be selected; use group_equal to aggregate")
        matching = matching.select(*[col(name) for name in groups]).distinct()
        order = sort_columns(groups, sort_by or [])
        tie_breakers = groups
    else:
        order = sort_columns(df.columns, sort_by or [])
        tie_breakers = [resolve(df.columns, key)] if key else []
    if sort_by or skip or top:
        order += [col(name).asc_nulls_first() for name in tie_breakers]
        if order:
            needed = wanted if group_by else _needed(df, wanted, sort_by, tie_breakers)
            matching = matching.select(*[col(name) for name in dict.fromkeys(needed)])
            matching = window_of_rows(matching, order, skip, top)
        else:
            if skip:
                raise ValueError("skip needs sort_by or key: rows have no order of their own")
            # a limit without an order sends all its rows through one task
            matching = matching.limit(top) if top <= TOP_K_LIMIT else first_rows(matching, top)
    return matching.select(*[col(name) for name in wanted])


def _needed(df, wanted, sort_by, tie_breakers) -> list[str]:
    return [*wanted, *[resolve(df.columns, label) for label, _ in sort_by or []], *tie_breakers]


def group_equal(
    df: DataFrame, group_by: Sequence[str], aggregates: Sequence[Column] = (), where: Where = None
) -> DataFrame:
    """One row per distinct combination of values, with optional aggregates."""
    groups = [col(name) for name in resolve_all(df.columns, group_by)]
    matching = select_where(df, where)
    if not aggregates:
        return matching.select(*groups).distinct()
    return matching.groupBy(*groups).agg(*aggregates)


def keyset_page(
    df: DataFrame,
    key: str,
    select: Sequence[str] | None = None,
    where: Where = None,
    cursor: int | None = None,
    page_size: int = PAGE_SIZE,
) -> DataFrame:
    """The next ``page_size`` matching rows with a key above ``cursor``, in key order."""
    if not isinstance(page_size, int) or isinstance(page_size, bool) or page_size < 1:
        raise ValueError("page_size must be a positive integer")
    key = resolve(df.columns, key)
    columns = resolve_all(df.columns, select) if select else df.columns
    page = select_where(df, where)
    if cursor is not None:
        page = page.where(col(key) > cursor)
    scanned = [col(name) for name in dict.fromkeys([*columns, key])]
    return page.select(*scanned).orderBy(col(key).asc()).limit(page_size)


def iter_keyset_pages(
    df: DataFrame,
    key: str,
    select: Sequence[str] | None = None,
    where: Where = None,
    cursor: int | None = None,
    page_size: int = PAGE_SIZE,
    record_limit: int | None = None,
) -> Iterator[DataFrame]:
    """Pages for resumable scans; only each page's count and last key reach the driver.

    Meant for stepping through a table; to process all of it use ``run_query``.
    """
    _count(record_limit, "record_limit", optional=True)
    key = resolve(df.columns, key)
    remaining = record_limit
    while remaining is None or remaining > 0:
        size = page_size if remaining is None else min(page_size, remaining)
        page = keyset_page(df, key, select, where, cursor, size)
        facts = page.agg(F.count(F.lit(1)).alias("n"), F.max(col(key)).alias("last")).first()
        if not facts["n"]:
            return
        yield page.select(*[col(name) for name in (select or df.columns)])
        if facts["n"] < size:
            return
        cursor = facts["last"]
        remaining = None if remaining is None else remaining - facts["n"]


def page_facts(
    df: DataFrame,
    select: Sequence[str],
    where: Where = None,
    skip: int = 0,
    top: int | None = PAGE_SIZE,
    group_by: Sequence[str] | None = None,
) -> DataFrame:
    """One row describing a page: fields, records in it, records in all, rows skipped.

    With ``group_by`` the records are the distinct combinations of these labels.
    """
    _count(skip, "skip")
    _count(top, "top", optional=True)
    matching = select_where(df, where)
    if group_by:
        matching = matching.select(*[col(n) for n in resolve_all(df.columns, group_by)]).distinct()
    fields = len(resolve_all(df.columns, select))
    total = F.col("total_records")
    rest = F.greatest(total - F.lit(skip), F.lit(0))
    return (
        matching
        .agg(F.count(F.lit(1)).alias("total_records"))
        .select(
            F.lit(fields).alias("num_fields"),
            (F.least(rest, F.lit(top)) if top else rest).cast("bigint").alias("num_records"),
            total,
            F.lit(skip).cast("bigint").alias("skip"),
        )
    )


def query_page(
    df: DataFrame,
    select: Sequence[str],
    where: Where = None,
    sort_by: Sequence[tuple[str, str]] | None = None,
    skip: int = 0,
    top: int = PAGE_SIZE,
    key: str | None = None,
    group_by: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One bounded page, of records or of distinct combinations, together with its facts."""
    page = run_query(df, select, where, sort_by, group_by, skip, top, key)
    return page, page_facts(df, select, where, skip, top, group_by)


def assign_pages(
    df: DataFrame, key: str, page_size: int = PAGE_SIZE, where: Where = None
) -> DataFrame:
    """All pages of a table in key order: first and last key, records, records still left.

    ``total_records`` counts the page itself and all later pages, as a scan that moves a
    cursor forward would see it.
    """
    if page_size < 1:
        raise ValueError("page_size must be a positive integer")
    key = resolve(df.columns, key)
    keys = select_where(df, where).select(col(key).alias("_key"))
    pages = (
        global_rank(keys, ["_key"], "_rank")
        .groupBy(F.ceil(F.col("_rank") / page_size).cast("bigint").alias("page"))
        .agg(
            F.min("_key").alias("first_key"),
            F.max("_key").alias("last_key"),
            F.count(F.lit(1)).alias("num_records"),
            F.min("_rank").alias("_first_rank"),
        )
    )
    total = keys.count()
    return pages.select(
        "page",
        "first_key",
        "last_key",
        "num_records",
        (F.lit(total) - F.col("_first_rank") + 1).alias("total_records"),
    )
