"""Queries, pages and reports."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.operators.ordering import global_rank
from recordloom.operators.page_index import PageIndex
from recordloom.operators.query import (
    assign_pages,
    group_equal,
    keyset_page,
    page_facts,
    query_page,
    run_query,
)
from recordloom.plans.reports import Report, run_report
from recordloom.session import scratch_path

from . import query, table


@query(
    "scan_all",
    "SELECT c_name, c_acctbal FROM customer WHERE lower(c_mktsegment) = 'building' AND c_acctbal > 1000",
)
def scan_all(spark, sf_dir):
    return run_query(
        table(spark, sf_dir, "customer"),
        ["c_name", "c_acctbal"],
        lambda w: w.and_(w.eq("c_mktsegment", "BUILDING"), w.greater_than("c_acctbal", 1000)),
    )


@query(
    "scan_sorted_top",
    """
    SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_totalprice > 1000
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 50
    """,
)
def scan_sorted_top(spark, sf_dir):
    return run_query(
        table(spark, sf_dir, "orders"),
        ["o_orderkey", "o_totalprice", "o_orderdate"],
        lambda w: w.greater_than("o_totalprice", 1000),
        sort_by=[("o_totalprice", "desc")],
        top=50,
        key="o_orderkey",
    )


@query(
    "scan_offset",
    """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 892
    """,
)
def scan_offset(spark, sf_dir):
    return run_query(
        table(spark, sf_dir, "orders"),
        ["o_orderkey", "o_orderstatus", "o_totalprice"],
        sort_by=[("o_orderstatus", "ASC"), ("o_totalprice", "DESC")],
        skip=892,
        top=100,
        key="o_orderkey",
    )


@query(
    "scan_deep_offset",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT ALL OFFSET 1201
    """,
)
def scan_deep_offset(spark, sf_dir):
    """Skip without a limit: every later row, without one task holding the skipped ones."""
    return run_query(
        table(spark, sf_dir, "orders"),
        ["o_orderkey", "o_totalprice"],
        sort_by=[("o_totalprice", "DESC")],
        skip=1201,
        top=0,
        key="o_orderkey",
    )


@query(
    "keyset_page",
    """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderkey > 500
    ORDER BY o_orderkey LIMIT 1000
    """,
)
def keyset(spark, sf_dir):
    return keyset_page(
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        ["o_orderkey", "o_totalprice"],
        lambda w: w.is_value("o_orderstatus", "F"),
        cursor=500,
    )


@query(
    "query_page",
    """
    SELECT event_id, user_id, value FROM events WHERE event_type = 'click'
    ORDER BY value DESC, event_id LIMIT 1000 OFFSET 10
    """,
)
def one_page(spark, sf_dir):
    page, _ = query_page(
        table(spark, sf_dir, "events"),
        ["event_id", "user_id", "value"],
        lambda w: w.is_value("event_type", "click"),
        sort_by=[("value", "DESC")],
        skip=10,
        key="event_id",
    )
    return page


@query(
    "query_page_grouped",
    """
    WITH g AS (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer)
    SELECT c_mktsegment, c_nationkey, 2 AS num_fields, least(greatest(n - 10, 0), 20) AS num_records, n AS total_records, 10 AS skip
    FROM (SELECT * FROM g ORDER BY c_mktsegment, c_nationkey LIMIT 20 OFFSET 10), (SELECT count(*) AS n FROM g)
    """,
)
def query_page_grouped(spark, sf_dir):
    """A page of distinct combinations with its facts."""
    page, facts = query_page(
        table(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"], sort_by=[("c_mktsegment", "ASC"), ("c_nationkey", "ASC")],
        skip=10, top=20, group_by=["c_mktsegment", "c_nationkey"],
    )
    return page.crossJoin(facts)  # facts are one row


@query(
    "page_facts",
    """
    SELECT 3::INTEGER AS num_fields,
           least(greatest(count(*) - 10, 0), 1000)::BIGINT AS num_records,
           count(*) AS total_records, 10::BIGINT AS skip
    FROM events WHERE event_type = 'click'
    """,
)
def facts(spark, sf_dir):
    return page_facts(
        table(spark, sf_dir, "events"),
        ["event_id", "user_id", "value"],
        lambda w: w.is_value("event_type", "click"),
        skip=10,
    )


@query(
    "page_assign",
    """
    WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rank,
                      count(*) OVER () AS total FROM orders WHERE o_orderstatus <> 'P')
    SELECT ((rank - 1) // 1000 + 1)::BIGINT AS page, min(o_orderkey) AS first_key,
           max(o_orderkey) AS last_key, count(*) AS num_records,
           (any_value(total) - min(rank) + 1)::BIGINT AS total_records
    FROM r GROUP BY 1
    """,
)
def page_assign(spark, sf_dir):
    return assign_pages(
        table(spark, sf_dir, "orders"), "o_orderkey", where=lambda w: w.is_not_value("o_orderstatus", "P")
    )


@query(
    "record_rank",
    """
    SELECT event_id, row_number() OVER (ORDER BY value DESC, event_id) AS rank FROM events
    """,
)
def record_rank(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return global_rank(events, [F.col("value").desc(), "event_id"], "rank").select("event_id", "rank")


_REPORT = Report(
    name="large_open_orders",
    table="Orders",
    columns=["o_orderkey", "o_orderdate", "o_totalprice"],
    conditions=[("o_orderstatus", "EX", "o"), ("o_totalprice", "GTE", 200000)],
    sort_by=[("o_orderdate", "DESC")],
    key="o_orderkey",
    labels={"o_totalprice": "Total", "o_orderkey": "Order", "o_orderdate": "Ordered"},
)


@query(
    "saved_report",
    """
    SELECT o_orderkey AS "Order", o_orderdate AS "Ordered", o_totalprice AS "Total" FROM orders
    WHERE o_orderstatus = 'O' AND o_totalprice >= 200000
    ORDER BY o_orderdate DESC, o_orderkey LIMIT 500 OFFSET 20
    """,
)
def saved_report(spark, sf_dir):
    return run_report({"orders": table(spark, sf_dir, "orders")}, _REPORT, skip=20, top=500)


@query("group_equal_values", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def group_values(spark, sf_dir):
    return run_query(
        table(spark, sf_dir, "orders"),
        ["o_orderstatus", "o_orderpriority"],
        group_by=["O_ORDERSTATUS", "o_orderpriority"],
    )


@query(
    "group_aggregates",
    """
    SELECT event_type, user_id, count(*) AS n, min(ts) AS first_ts, max(value) AS top_value
    FROM events GROUP BY event_type, user_id
    """,
)
def group_aggregates(spark, sf_dir):
    return group_equal(
        table(spark, sf_dir, "events"),
        ["event_type", "user_id"],
        [
            F.count(F.lit(1)).alias("n"),
            F.min("ts").alias("first_ts"),
            F.max("value").alias("top_value"),
        ],
    )


_PAGES = ((0, 7), (3, 1), (120, 25), (1499, 3), (5000, 40), (14990, 50))


@query(
    "page_by_index",
    f"""
    WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
    SELECT skip::BIGINT AS skip, rank, o_orderkey, o_totalprice
    FROM r JOIN (VALUES {", ".join(map(str, _PAGES))}) p(skip, top) ON rank > skip AND rank <= skip + top
    """,
)
def page_by_index(spark, sf_dir):
    """Pages anywhere in the orders by price; the orders are sorted once."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    path = scratch_path(spark, "pages")
    PageIndex.create(orders, [F.col("o_totalprice").desc(), "o_orderkey"], path)
    index = PageIndex.open(spark, path)
    pages = [index.page(skip, top).withColumn("skip", F.lit(skip).cast("bigint")) for skip, top in _PAGES]
    return reduce(DataFrame.union, pages).select("skip", F.col("_rank").alias("rank"), "o_orderkey", "o_totalprice")
