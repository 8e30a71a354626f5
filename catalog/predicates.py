"""Label-based predicates, one query per operator code."""

from datetime import date

from pyspark.sql import functions as F

from recordloom.functions.predicates import RecordFilter, starts_with_or_false, truth
from recordloom.operators.changes import filter_ids
from recordloom.operators.query import run_query, select_where

from . import query, table

_SELECT = {
    "customer": ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"],
    "part": ["p_partkey", "p_name", "p_type"],
    "orders": ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "events": ["event_id", "ts", "user_id", "event_type"],
}


def _predicate(name, source, label, code, value, condition, as_of=None):
    columns = _SELECT[source]

    @query(name, f"SELECT {', '.join(columns)} FROM {source} WHERE {condition}")
    def run(spark, sf_dir):
        df = table(spark, sf_dir, source)
        return run_query(df, columns, RecordFilter(df, as_of).expr(label, code, value))


def _pair(name, source, label, code, value, condition, as_of=None):
    """An operator and its complement."""
    _predicate(f"pred_{name}", source, label, code, value, condition, as_of)
    _predicate(
        f"pred_x{name}", source, label, f"X{code}", value, f"NOT coalesce({condition}, false)", as_of
    )


_pair("ex", "customer", "C_MktSegment", "EX", "building", "lower(c_mktsegment) = 'building'")
_pair("ct", "part", "p_name", "CT", "RING", "contains(lower(p_name), 'ring')")
_pair("sw", "part", "P_TYPE", "SW", "eco", "starts_with(lower(p_type), 'eco')")
_pair("tv", "orders", "o_orderpriority", "TV", "5-LOW", "o_orderpriority = '5-LOW'")
_pair(
    "ir", "events", "ts", "IR", "last 2 weeks",
    "(ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-15')", date(2024, 1, 20),
)
for _name, _code, _sign in (
    ("lt", "LT", "<"), ("lte", "LTE", "<="), ("gt", "GT", ">"), ("gte", "GTE", ">="),
):
    _predicate(
        f"pred_{_name}", "orders", "o_totalprice", _code, 112946.26, f"o_totalprice {_sign} 112946.26"
    )
_DAY = date(1998, 10, 3)
for _name, _code, _condition in (
    ("bf", "BF", "o_orderdate < TIMESTAMP '1998-10-03'"),
    ("obf", "OBF", "o_orderdate < TIMESTAMP '1998-10-04'"),
    ("af", "AF", "o_orderdate >= TIMESTAMP '1998-10-04'"),
    ("oaf", "OAF", "o_orderdate >= TIMESTAMP '1998-10-03'"),
):
    _predicate(f"pred_{_name}", "orders", "o_orderdate", _code, _DAY, _condition)


def _words(spark, sf_dir):
    return table(spark, sf_dir, "part").withColumn("words", F.split("p_name", " "))


_HAS = "list_has_any(string_split(p_name, ' '), ['red', 'blue'])"


@query("pred_has", f"SELECT p_partkey, p_name FROM part WHERE {_HAS}")
def pred_has(spark, sf_dir):
    df = _words(spark, sf_dir)
    return run_query(df, ["p_partkey", "p_name"], RecordFilter(df).has("words", ["red", "blue"]))


@query("pred_xhas", f"SELECT p_partkey, p_name FROM part WHERE NOT {_HAS}")
def pred_xhas(spark, sf_dir):
    df = _words(spark, sf_dir)
    return run_query(df, ["p_partkey", "p_name"], RecordFilter(df).not_has("words", ["red", "blue"]))


@query(
    "pred_nulls",
    """
    WITH o AS (SELECT *, nullif(o_orderpriority, '5-LOW') AS p FROM orders)
    SELECT count(*) AS n,
           count(*) FILTER (WHERE coalesce(lower(p) = '2-high', false)) AS ex,
           count(*) FILTER (WHERE NOT coalesce(lower(p) = '2-high', false)) AS xex,
           count(*) FILTER (WHERE coalesce(contains(lower(p), 'u'), false)) AS ct,
           count(*) FILTER (WHERE NOT coalesce(contains(lower(p), 'u'), false)) AS xct,
           count(*) FILTER (WHERE coalesce(starts_with(lower(p), '1'), false)) AS sw,
           count(*) FILTER (WHERE NOT coalesce(starts_with(lower(p), '1'), false)) AS xsw,
           count(*) FILTER (WHERE p IS NULL OR p = '') AS blank,
           count(*) FILTER (WHERE NOT (p IS NULL OR p = '')) AS not_blank
    FROM o
    """,
)
def pred_nulls(spark, sf_dir):
    """Every operator and its complement together cover all rows, nulls included."""
    df = table(spark, sf_dir, "orders").withColumn("p", F.expr("nullif(o_orderpriority, '5-LOW')"))
    where = RecordFilter(df)
    cases = {
        "ex": where.eq("p", "2-HIGH"), "xex": where.neq("p", "2-HIGH"),
        "ct": where.contains("p", "U"), "xct": where.not_contains("p", "U"),
        "sw": where.starts_with("p", "1"), "xsw": where.not_starts_with("p", "1"),
        "blank": where.eq("p", ""), "not_blank": where.neq("p", None),
    }
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(truth(predicate)).alias(name) for name, predicate in cases.items()],
    )


@query(
    "bool_nested",
    """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE (o_orderstatus = 'F' OR o_orderstatus = 'O')
      AND NOT (contains(lower(o_orderpriority), 'low') OR o_totalprice < 100000)
    """,
)
def bool_nested(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    return run_query(
        df,
        ["o_orderkey", "o_orderstatus", "o_totalprice"],
        lambda w: w.and_(
            w.or_(w.is_value("o_orderstatus", "F"), w.is_value("o_orderstatus", "O")),
            w.not_(w.or_(w.contains("o_orderpriority", "low"), w.less_than("o_totalprice", 100000))),
        ),
    )


@query(
    "id_filter",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE lower(c_mktsegment) = 'building')
    """,
)
def id_filter(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    ids = select_where(customers, lambda w: w.eq("c_mktsegment", "BUILDING")).select("c_custkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return filter_ids(orders, "o_custkey", ids)


@query(
    "prefix_rows",
    """
    SELECT page_id, url FROM pages
    WHERE coalesce(starts_with(nullif(url, ''), 'https://'), false)
    """,
)
def prefix_rows(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.where(starts_with_or_false(F.expr("nullif(url, '')"), "https://"))
