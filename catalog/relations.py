"""Lookup, summary and formula fields."""

from pyspark.sql import functions as F

from recordloom.operators.formulas import Formula, add_formulas, run_formula
from recordloom.operators.maintained import partials, summaries_from, update_partials
from recordloom.operators.relations import (
    Summary,
    add_lookups,
    add_summaries,
    check_relationship,
    integrity,
)
from recordloom.plans.derivation import Derivation, Relationship, derive, order

from . import query, table


@query(
    "lookup_fields",
    """
    WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS customer
               FROM orders)
    SELECT o_orderkey, customer, c_name AS "customer - c_name", c_acctbal AS "customer - c_acctbal"
    FROM o LEFT JOIN customer ON customer = c_custkey
    """,
)
def lookup_fields(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("customer")
    )
    customers = table(spark, sf_dir, "customer")
    return add_lookups(orders, customers, "customer", "c_custkey", ["c_name", "c_acctbal"])


@query(
    "summary_all",
    """
    SELECT o_orderkey, count(l_orderkey) AS n_lines,
           round(sum(l_extendedprice), 2) AS total, round(avg(l_quantity), 6) AS mean_quantity,
           max(l_quantity) AS most, min(l_quantity) AS least,
           round(stddev_samp(l_quantity), 6) AS spread,
           string_agg(DISTINCT l_returnflag, '; ' ORDER BY l_returnflag) AS flags,
           string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS statuses,
           count(DISTINCT l_suppkey) AS suppliers
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey
    """,
)
def summary_all(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    found = add_summaries(
        orders,
        table(spark, sf_dir, "lineitem"),
        "o_orderkey",
        "l_orderkey",
        [
            Summary("COUNT", label="n_lines"),
            Summary("SUM", "l_extendedprice", "total"),
            Summary("AVG", "l_quantity", "mean_quantity"),
            Summary("MAX", "l_quantity", "most"),
            Summary("MIN", "l_quantity", "least"),
            Summary("STD-DEV", "l_quantity", "spread"),
            Summary("COMBINED-TEXT", "l_returnflag", "flags"),
            Summary("COMBINED-USER", "l_linestatus", "statuses"),
            Summary("DISTINCT-COUNT", "l_suppkey", "suppliers"),
        ],
    )
    return (
        found.withColumn("total", F.round("total", 2))
        .withColumn("mean_quantity", F.round("mean_quantity", 6))
        .withColumn("spread", F.round("spread", 6))
        .withColumn("statuses", F.array_join("statuses", ","))
    )


@query(
    "summary_filtered",
    """
    SELECT o_orderkey,
           count(l_orderkey) FILTER (WHERE l_returnflag = 'R') AS returned,
           sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS returned_quantity,
           count(DISTINCT l_partkey) FILTER (WHERE l_discount > 0.05) AS discounted_parts
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey
    """,
)
def summary_filtered(spark, sf_dir):
    returned = lambda w: w.is_value("l_returnflag", "R")
    return add_summaries(
        table(spark, sf_dir, "orders").select("o_orderkey"),
        table(spark, sf_dir, "lineitem"),
        "o_orderkey",
        "l_orderkey",
        [
            Summary("COUNT", label="returned", where=returned),
            Summary("SUM", "l_quantity", "returned_quantity", returned),
            Summary(
                "DISTINCT-COUNT", "l_partkey", "discounted_parts",
                lambda w: w.greater_than("l_discount", 0.05),
            ),
        ],
    )


def _customer_summary(name, kind, field, sql, finish=None):
    @query(
        f"summary_{name}",
        f"""
        SELECT c_custkey, {sql} AS result
        FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey
        """,
    )
    def run(spark, sf_dir):
        customers = table(spark, sf_dir, "customer").select("c_custkey")
        orders = table(spark, sf_dir, "orders")
        summary = Summary(kind, field, "result")
        found = add_summaries(customers, orders, "c_custkey", "o_custkey", [summary])
        return found.withColumn("result", finish(F.col("result"))) if finish else found


_customer_summary("sum", "SUM", "o_totalprice", "round(sum(o_totalprice), 2)", lambda c: F.round(c, 2))
_customer_summary("max", "MAX", "o_orderdate", "max(o_orderdate)")
_customer_summary("min", "MIN", "o_orderdate", "min(o_orderdate)")
_customer_summary(
    "std_dev", "STD-DEV", "o_totalprice", "round(stddev_samp(o_totalprice), 4)", lambda c: F.round(c, 4)
)
_customer_summary("count", "COUNT", None, "count(o_orderkey)")
_customer_summary(
    "combined_text", "COMBINED-TEXT", "o_orderpriority",
    "string_agg(DISTINCT o_orderpriority, '; ' ORDER BY o_orderpriority)",
)
_customer_summary(
    "combined_user", "COMBINED-USER", "o_orderstatus",
    "string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus)",
    lambda c: F.array_join(c, ","),
)
_customer_summary(
    "distinct_count", "DISTINCT-COUNT", "o_orderpriority", "count(DISTINCT o_orderpriority)"
)


@query(
    "summary_avg",
    """
    SELECT p_partkey, avg(l_quantity) AS result
    FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey
    """,
)
def summary_avg(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey")
    lines = table(spark, sf_dir, "lineitem")
    summary = Summary("AVG", "l_quantity", "result")
    return add_summaries(parts, lines, "p_partkey", "l_partkey", [summary])


@query(
    "summary_list_user",
    """
    WITH w AS (SELECT p_brand, unnest(string_split(p_name, ' ')) AS word FROM part)
    SELECT p_brand, string_agg(DISTINCT word, ',' ORDER BY word) AS words, any_value(n) AS parts
    FROM w JOIN (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand) USING (p_brand)
    GROUP BY p_brand
    """,
)
def summary_list_user(spark, sf_dir):
    """COMBINED-USER over a list field."""
    parts = table(spark, sf_dir, "part").withColumn("words", F.split("p_name", " "))
    brands = parts.select(F.col("p_brand").alias("brand")).distinct()
    found = add_summaries(
        brands,
        parts,
        "brand",
        "p_brand",
        [Summary("COMBINED-USER", "words", "all_words"), Summary("COUNT", label="parts")],
    )
    return found.select(
        F.col("brand").alias("p_brand"), F.array_join("all_words", ",").alias("words"), "parts"
    )


@query(
    "integrity_report",
    """
    SELECT 'orphan' AS problem, d.doc_id AS key, count(*) AS records FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY d.doc_id
    UNION ALL
    SELECT 'childless', l.doc_id, 0 FROM labels l
    WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE l.doc_id = d.doc_id)
    """,
)
def integrity_report(spark, sf_dir):
    labels, documents = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    return integrity(labels, documents, "doc_id", "doc_id")


@query(
    "childless_parents",
    """
    SELECT 'childless' AS problem, o_orderkey AS key, 0::BIGINT AS records FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    UNION ALL
    SELECT 'orphan', l_orderkey, count(*) FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE l_orderkey = o_orderkey) GROUP BY l_orderkey
    """,
)
def childless_parents(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return integrity(orders, lines, "o_orderkey", "l_orderkey")


@query(
    "relationship_check",
    """
    WITH k AS (SELECT nullif(o_custkey, 0) AS k, count(*) AS n FROM orders GROUP BY 1)
    SELECT 'parent key is null' AS rule, coalesce(sum(n) FILTER (WHERE k IS NULL), 0)::BIGINT AS records
    FROM k
    UNION ALL
    SELECT 'parent key repeats', coalesce(sum(n) FILTER (WHERE k IS NOT NULL AND n > 1), 0)::BIGINT
    FROM k
    """,
)
def relationship_check(spark, sf_dir):
    """Orders make a bad parent by customer key: it repeats, and one is blanked."""
    parent = table(spark, sf_dir, "orders").select(
        F.expr("nullif(o_custkey, 0)").alias("account"), "o_orderstatus"
    )
    return check_relationship(
        parent, table(spark, sf_dir, "events"), "account", "user_id", ["o_orderstatus"]
    )


@query(
    "formula_column",
    """
    SELECT l_orderkey, l_partkey, l_linenumber,
           (l_quantity * 2)::BIGINT AS doubled,
           CASE WHEN l_discount > 0.05 THEN 'high' ELSE 'low' END AS band
    FROM lineitem
    """,
)
def formula_column(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount"
    )
    formulas = {
        "doubled": Formula("l_quantity * 2", "bigint"),
        "band": Formula("CASE WHEN l_discount > 0.05 THEN 'high' ELSE 'low' END  "),
    }
    return add_formulas(lines, formulas).drop("l_quantity", "l_discount")


@query("run_formula", "SELECT c_custkey, upper(c_mktsegment) || '/' || c_name AS result FROM customer")
def formula_over_table(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return run_formula(customers, "concat(upper(c_mktsegment), '/', c_name)", "c_custkey")


def _chain(spark, sf_dir):
    tables = {
        "orders": table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"),
        "lines": table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_discount"
        ),
    }
    plan = Derivation(
        formulas={
            "orders.taxed": Formula("o_totalprice * 2", depends_on=("orders.o_totalprice",)),
            "orders.final": Formula(
                "taxed + coalesce(net_total, 0)", depends_on=("orders.taxed", "orders.net_total")
            ),
            "lines.net": Formula(
                "l_extendedprice * (1 - l_discount)",
                depends_on=("lines.l_extendedprice", "lines.l_discount"),
            ),
            "lines.plus_one": Formula("`order - taxed` + 1", depends_on=("lines.order - taxed",)),
        },
        relationships=[
            Relationship(
                "order_lines", "orders", "lines", "o_orderkey", "l_orderkey",
                lookups=["taxed"], summaries=[Summary("SUM", "net", "net_total")], fk_label="order",
            )
        ],
    )
    return tables, plan


_NET = "l_extendedprice * (1 - l_discount)"


@query(
    "formula_chain_parent",
    f"""
    WITH s AS (SELECT l_orderkey, sum({_NET}) AS net FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey, round(o_totalprice * 2, 2) AS taxed, round(net, 4) AS net_total,
           round(o_totalprice * 2 + coalesce(net, 0), 4) AS final
    FROM orders LEFT JOIN s ON o_orderkey = l_orderkey
    """,
)
def formula_chain_parent(spark, sf_dir):
    """Formula over a summary over a formula of the children."""
    wanted = ["orders.taxed", "orders.net_total", "orders.final"]
    orders = derive(*_chain(spark, sf_dir), wanted)["orders"]
    return orders.select(
        "o_orderkey",
        F.round("taxed", 2).alias("taxed"),
        F.round("net_total", 4).alias("net_total"),
        F.round("final", 4).alias("final"),
    )


@query(
    "formula_chain_child",
    f"""
    SELECT l_orderkey, l_partkey, l_linenumber, round({_NET}, 4) AS net,
           round(o_totalprice * 2 + 1, 2) AS plus_one
    FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
    """,
)
def formula_chain_child(spark, sf_dir):
    """Formula over a lookup of a formula of the parent."""
    lines = derive(*_chain(spark, sf_dir), ["lines.net", "lines.plus_one"])["lines"]
    return lines.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.round("net", 4).alias("net"),
        F.round("plus_one", 2).alias("plus_one"),
    )


@query(
    "formula_chain_deep",
    f"""
    WITH t AS (SELECT l_orderkey, sum({_NET}) FILTER (WHERE {_NET} > 1000) AS big FROM lineitem GROUP BY l_orderkey),
    o AS (SELECT o_orderkey, o_custkey, big / o_totalprice AS score FROM orders LEFT JOIN t ON l_orderkey = o_orderkey),
    c AS (SELECT o_custkey, max(score) AS best FROM o GROUP BY o_custkey)
    SELECT o_orderkey, round(score, 6) AS score, round(score / best, 6) AS share
    FROM o LEFT JOIN c ON o.o_custkey = c.o_custkey AND EXISTS (SELECT 1 FROM customer WHERE c_custkey = c.o_custkey)
    """,
)
def formula_chain_deep(spark, sf_dir):
    """Formula, filtered summary, formula, summary, lookup and formula over three tables."""
    tables, _ = _chain(spark, sf_dir)
    tables["orders"] = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    tables["customers"] = table(spark, sf_dir, "customer").select("c_custkey")
    big = Summary("SUM", "net", "big", lambda w: w.greater_than("net", 1000), where_fields=["net"])
    plan = Derivation(
        {
            "lines.net": Formula(_NET, depends_on=("lines.l_extendedprice", "lines.l_discount")),
            "orders.score": Formula("big / o_totalprice", depends_on=("orders.big", "orders.o_totalprice")),
            "orders.share": Formula("score / `customer - best`", depends_on=("orders.score", "orders.customer - best")),
        },
        [
            Relationship("items", "orders", "lines", "o_orderkey", "l_orderkey", summaries=[big]),
            Relationship(
                "buyers", "customers", "orders", "c_custkey", "o_custkey", lookups=["best"],
                summaries=[Summary("MAX", "score", "best")], fk_label="customer",
            ),
        ],
    )
    orders = derive(tables, plan, ["orders.score", "orders.share"])["orders"]
    return orders.select("o_orderkey", F.round("score", 6).alias("score"), F.round("share", 6).alias("share"))


@query(
    "derivation_counts",
    """
    SELECT 'orders.final' AS field, count(*) AS filled FROM orders
    UNION ALL SELECT 'lines.plus_one', count(o_totalprice)
    FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
    """,
)
def derivation_counts(spark, sf_dir):
    """Filled values of the last field each table derives, in the order found for them."""
    tables, plan = _chain(spark, sf_dir)
    done = derive(tables, plan)
    last = {address.split(".")[0]: address for address in order(tables, plan).ordered if "." in address}
    ends = [a for a in ("orders.final", "lines.plus_one") if a in last.values() or a in plan.formulas]
    parts = [
        done[a.split(".")[0]]
        .agg(F.count(a.split(".")[1]).alias("filled"))
        .select(F.lit(a).alias("field"), "filled")
        for a in ends
    ]
    return parts[0].unionByName(parts[1])


@query(
    "derivation_order",
    """
    SELECT o.place::BIGINT AS place, o.field, (SELECT count(*) FROM orders) AS parents
    FROM (VALUES (1, '@order_lines'), (2, 'lines.net'), (3, 'orders.taxed'), (4, 'lines.order - taxed'),
                 (5, 'lines.plus_one'), (6, 'orders.net_total'), (7, 'orders.final')) o(place, field)
    """,
)
def derivation_order(spark, sf_dir):
    """The derived fields and relationships in the order in which they are added, beside the number of parents."""
    tables, plan = _chain(spark, sf_dir)
    own = {f"{name}.{column}" for name, df in tables.items() for column in df.columns}
    derived = [address for address in order(tables, plan).ordered if address not in own]
    places = spark.createDataFrame([(i, a) for i, a in enumerate(derived, 1)], "place bigint, field string")
    return places.crossJoin(tables["orders"].agg(F.count(F.lit(1)).alias("parents")))


_KEPT = [
    Summary("COUNT", label="orders"), Summary("SUM", "o_totalprice", "total"), Summary("AVG", "o_totalprice", "mean"),
    Summary("STD-DEV", "o_totalprice", "spread"), Summary("MAX", "o_totalprice", "largest"),
    Summary("MIN", "o_totalprice", "smallest_f", "o_orderstatus = 'F'"),
]


@query(
    "summary_incremental",
    """
    WITH after AS (
        SELECT CASE WHEN o_orderkey % 10 = 5 THEN o_custkey + 1 ELSE o_custkey END AS cust,
               CASE WHEN o_orderkey % 10 = 3 THEN o_totalprice - 500 ELSE o_totalprice END AS price, o_orderstatus
        FROM orders WHERE o_orderkey % 10 <> 7),
    s AS (SELECT cust, count(*) AS orders, sum(price) AS total, avg(price) AS mean, stddev_samp(price) AS spread, max(price) AS largest,
                 min(price) FILTER (WHERE o_orderstatus = 'F') AS smallest_f FROM after GROUP BY cust)
    SELECT c_custkey, coalesce(orders, 0) AS orders, round(total, 2) AS total, round(mean, 6) AS mean, round(spread, 4) AS spread,
           round(largest, 2) AS largest, round(smallest_f, 2) AS smallest_f
    FROM customer LEFT JOIN s ON cust = c_custkey
    """,
)
def summary_incremental(spark, sf_dir):
    """Orders that change their price, move to another customer or go; the summaries follow from these alone."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    turn = F.col("o_orderkey") % 10
    moved = F.when(turn == 5, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    lowered = F.when(turn == 3, F.col("o_totalprice") - 500).otherwise(F.col("o_totalprice"))
    after = orders.where(turn != 7).withColumns({"o_custkey": moved, "o_totalprice": lowered})
    old, new = orders.where(turn.isin(3, 5, 7)), after.where(turn.isin(3, 5))
    state = partials(orders, "o_custkey", _KEPT)
    state = update_partials(state, old, new, "o_custkey", _KEPT, after)
    found = summaries_from(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", state, _KEPT)
    return found.withColumns({"total": F.round("total", 2), "mean": F.round("mean", 6), "spread": F.round("spread", 4), "largest": F.round("largest", 2), "smallest_f": F.round("smallest_f", 2)})
