"""Contracts, constraints, profiles and measurement tables."""

from pyspark.sql import functions as F

from recordloom.operators.constraints import FieldRule, check_constraints, check_parts, violating_rows
from recordloom.operators.contract import (
    conform,
    conformance,
    drop_fields,
    publish_conformed,
    with_field_ids,
)
from recordloom.operators.ordering import exact_median
from recordloom.operators.part_profiles import PartProfiles
from recordloom.operators.relations import Summary, add_lookups, add_summaries
from recordloom.operators.stats import (
    profile,
    regression_signals,
    sample_summary,
    update_pass,
    workload_records,
)
from recordloom.session import scratch_path

from . import query, table


@query(
    "constraint_rows",
    """
    WITH e AS (SELECT event_id, nullif(event_type, 'view') AS event_type, user_id FROM events)
    SELECT *, 'event_type' AS _field, 'required' AS _rule FROM e WHERE event_type IS NULL
    UNION ALL SELECT *, 'event_type', 'choice' FROM e WHERE event_type <> 'click'
    UNION ALL SELECT *, 'event_id', 'positive key' FROM e WHERE event_id < 1
    UNION ALL SELECT *, 'user_id', 'unique' FROM e WHERE user_id IN (SELECT user_id FROM e GROUP BY user_id HAVING count(*) > 1)
    """,
)
def constraint_rows(spark, sf_dir):
    """The rows behind the counts."""
    events = table(spark, sf_dir, "events").select(
        "event_id", F.nullif(F.col("event_type"), F.lit("view")).alias("event_type"), "user_id"
    )
    rules = [FieldRule("event_type", required=True, choices=["click"]), FieldRule("user_id", unique=True)]
    return violating_rows(events, "event_id", rules)


@query(
    "constraint_violations",
    """
    WITH o AS (SELECT l_orderkey, nullif(l_returnflag, 'N') AS flag, l_linestatus,
                      l_shipdate::VARCHAR AS shipped FROM lineitem),
    k AS (SELECT count(*) AS n FROM o GROUP BY l_orderkey),
    s AS (SELECT count(*) AS n FROM o WHERE flag IS NOT NULL GROUP BY flag)
    SELECT 'l_orderkey' AS field, 'null key' AS rule, count(*) FILTER (WHERE l_orderkey IS NULL) AS violations FROM o
    UNION ALL SELECT 'l_orderkey', 'positive key', count(*) FILTER (WHERE l_orderkey < 1) FROM o
    UNION ALL SELECT 'flag', 'required', count(*) FILTER (WHERE flag IS NULL) FROM o
    UNION ALL SELECT 'l_linestatus', 'choice', count(*) FILTER (WHERE l_linestatus <> 'O') FROM o
    UNION ALL SELECT 'shipped', 'type', count(*) FILTER (WHERE TRY_CAST(shipped AS BIGINT) IS NULL) FROM o
    UNION ALL SELECT 'l_orderkey', 'unique key', coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT FROM k
    UNION ALL SELECT 'flag', 'unique', coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT FROM s
    UNION ALL SELECT 'extra', 'unexpected field', 1
    """,
)
def constraint_violations(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.expr("nullif(l_returnflag, 'N')").alias("flag"),
        "l_linestatus",
        F.col("l_shipdate").cast("string").alias("shipped"),
        F.col("l_tax").alias("extra"),
    )
    rules = [
        FieldRule("flag", required=True, unique=True),
        FieldRule("l_linestatus", choices=["O"]),
        FieldRule("shipped", type="bigint"),
    ]
    return check_constraints(lines, "l_orderkey", rules, exact_fields=True)


_RULES = [
    FieldRule("Order", type="bigint", required=True, unique=True, field_id=3),
    FieldRule("O_OrderStatus", required=True, choices=["F", "O"]),
    FieldRule("o_totalprice", type="double"),
    FieldRule("o_orderpriority", type="int"),
    FieldRule("o_orderdate", type="timestamp_ntz"),
    FieldRule("o_custkey", unique=True),
    FieldRule("doubled", type="double", formula="o_totalprice * 2", depends_on=["o_totalprice"]),
    FieldRule("risky", formula="o_orderpriority + 1", depends_on=["o_orderpriority"]),
    FieldRule("egg", formula="hen", depends_on=["hen"]),
    FieldRule("hen", formula="egg", depends_on=["egg"]),
    FieldRule("lost", field_id=99),
]


@query(
    "conformance_report",
    """
    WITH o AS (SELECT count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS choice,
                      count(*) FILTER (WHERE TRY_CAST(o_orderpriority AS INTEGER) IS NULL) AS types FROM orders),
    c AS (SELECT sum(n)::BIGINT AS repeats FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey) WHERE n > 1)
    SELECT 'Order' AS field, 'update' AS action, NULL AS reason, 0::BIGINT AS offending_rows
    UNION ALL SELECT 'O_OrderStatus', 'conflict', 'values are no allowed choice', choice FROM o
    UNION ALL SELECT 'o_totalprice', 'unchanged', NULL, 0
    UNION ALL SELECT 'o_orderpriority', 'conflict', 'values do not cast', types FROM o
    UNION ALL SELECT 'o_orderdate', 'unchanged', NULL, 0
    UNION ALL SELECT 'o_custkey', 'conflict', 'values repeat', repeats FROM c
    UNION ALL SELECT 'doubled', 'create', NULL, 0
    UNION ALL SELECT 'risky', 'conflict', 'a field it depends on has a conflict', 0
    UNION ALL SELECT 'egg', 'conflict', 'its dependencies form a cycle', 0
    UNION ALL SELECT 'hen', 'conflict', 'its dependencies form a cycle', 0
    UNION ALL SELECT 'lost', 'conflict', 'no column carries field id 99', 0
    """,
)
def conformance_report(spark, sf_dir):
    orders = with_field_ids(table(spark, sf_dir, "orders"), {"o_orderkey": 3})
    return conformance(orders, _RULES).select("field", "action", "reason", "offending_rows")


@query(
    "conform_table",
    """
    WITH s AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey AS "Order", o_custkey::VARCHAR AS o_custkey, o_orderstatus, o_totalprice,
           o_orderdate, o_orderpriority, NULL::VARCHAR AS note, o_totalprice * 2 AS doubled,
           o_totalprice * 2 + 1 AS plus_one, c_mktsegment AS "Customer - c_mktsegment",
           coalesce(n, 0) AS "Line count"
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN s ON o_orderkey = l_orderkey
    """,
)
def conform_table(spark, sf_dir):
    """Rename by bound id, cast, and add a blank, formulas, a lookup and a summary; then publish."""
    orders = with_field_ids(table(spark, sf_dir, "orders"), {"o_orderkey": 3})
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_mktsegment"
    )
    lines = table(spark, sf_dir, "lineitem")
    rules = [
        FieldRule("Order", type="bigint", field_id=3),
        FieldRule("o_custkey", type="string"),
        FieldRule("note", type="string"),
        FieldRule("plus_one", type="double", formula="doubled + 1", depends_on=["doubled"]),
        FieldRule("doubled", type="double", formula="o_totalprice * 2", depends_on=["o_totalprice"]),
        FieldRule("Customer - c_mktsegment", mode="lookup", source="o_custkey.c_mktsegment"),
        FieldRule("Line count", type="bigint", mode="summary", source="lineitem COUNT"),
    ]
    rules = [FieldRule("o_totalprice", type="double"), *rules]
    derived = {
        "Customer - c_mktsegment": lambda df: add_lookups(
            df, customers, "o_custkey", "c_custkey", ["c_mktsegment"], "Customer"
        ),
        "Line count": lambda df: add_summaries(
            df, lines, "Order", "l_orderkey", [Summary("COUNT", label="Line count")]
        ),
    }
    return publish_conformed(orders, rules, scratch_path(spark, "conform"), derived)


@query("drop_fields", "SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders")
def dropped(spark, sf_dir):
    return drop_fields(table(spark, sf_dir, "orders"), ["o_custkey", "o_totalprice"])


@query(
    "part_stability",
    """
    SELECT 'F' AS part, true AS same_fields, count(*) AS records, true AS same_count FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'O', true, count(*), false FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'P', false, count(*), true FROM orders WHERE o_orderstatus = 'P'
    """,
)
def part_stability(spark, sf_dir):
    """Orders in three parts: one with a wrong count, one with a field of another type."""
    orders = table(spark, sf_dir, "orders")
    parts = {status: orders.where(F.col("o_orderstatus") == status) for status in ("F", "O", "P")}
    counts = {"F": parts["F"].count(), "O": -1}
    parts["P"] = parts["P"].withColumn("o_custkey", F.col("o_custkey").cast("string"))
    return check_parts(parts, counts)


@query(
    "dataset_profile",
    """
    WITH c AS (SELECT 'customer' AS t, count(*) AS n, * FROM (SELECT
        count(c_custkey) a1, count(DISTINCT c_custkey) a2, min(c_custkey)::VARCHAR a3, max(c_custkey)::VARCHAR a4,
        count(c_name) b1, count(DISTINCT c_name) b2, min(c_name) b3, max(c_name) b4,
        count(c_mktsegment) c1, count(DISTINCT c_mktsegment) c2, min(c_mktsegment) c3, max(c_mktsegment) c4,
        count(*) AS total FROM customer) GROUP BY ALL),
    p AS (SELECT count(*) AS total, count(p) AS filled, count(DISTINCT p) AS d, min(p) AS lo, max(p) AS hi
          FROM (SELECT nullif(o_orderpriority, '5-LOW') AS p FROM orders))
    SELECT t AS "table", 'c_custkey' AS "column", total AS rows, a1 AS filled, a2 AS distinct_values, a3 AS lowest, a4 AS highest FROM c
    UNION ALL SELECT t, 'c_name', total, b1, b2, b3, b4 FROM c
    UNION ALL SELECT t, 'c_mktsegment', total, c1, c2, c3, c4 FROM c
    UNION ALL SELECT 'orders', 'o_orderpriority', total, filled, d, lo, hi FROM p
    """,
)
def dataset_profile(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select(
        F.expr("nullif(o_orderpriority, '5-LOW')").alias("o_orderpriority")
    )
    return profile({"customer": customers, "orders": orders}, exact=True)


@query("dataset_profile_approx")
def dataset_profile_approx(spark, sf_dir):
    """All columns of all tables; distinct counts are estimates."""
    names = ("customer", "orders", "lineitem", "events", "documents", "pages", "embeddings")
    return profile({name: table(spark, sf_dir, name) for name in names})


_PROFILED = {"o_orderkey": "o_orderkey", "o_custkey": "o_custkey", "price": "o_totalprice::DECIMAL(14,2)", "o_orderpriority": "o_orderpriority"}


@query(
    "profile_by_parts",
    "WITH o AS (SELECT *, coalesce(o_orderstatus, '?') AS part FROM orders) "
    + " UNION ALL ".join(
        f"""
        SELECT {part} AS part, '{name}' AS "column", count(*) AS rows, count({value}) AS filled, min({value})::VARCHAR AS lowest,
               max({value})::VARCHAR AS highest, true AS distinct_near, true AS median_near FROM o {group}"""
        for name, value in _PROFILED.items()
        for part, group in (("part", "GROUP BY part"), ("'all'", ""))
    ),
)
def profile_by_parts(spark, sf_dir):
    """Orders by status. One part is profiled again after its prices are put right; estimates are held against exact figures."""
    price = F.col("o_totalprice").cast("decimal(14,2)")
    right = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey", "o_custkey", price.alias("price"), "o_orderpriority")
    wrong = F.when(F.col("o_orderstatus") == "F", F.col("price") * 10).otherwise(F.col("price")).cast("decimal(14,2)")
    path = scratch_path(spark, "profiles")
    PartProfiles.create(spark, path, right.schema, "o_orderstatus").update(right.withColumn("price", wrong))
    kept = PartProfiles.open(spark, path)
    kept.update(right, ["F"])
    part = F.coalesce("o_orderstatus", F.lit("?")).alias("part")
    found = kept.report(per_part=True).select(part, "*").drop("o_orderstatus")
    found = found.unionByName(kept.report().withColumn("part", F.lit("all")))
    texts = {name: F.col(name).cast("string") for name in _PROFILED}
    cells = F.array(*[F.struct(F.lit(n).alias("column"), t.alias("value"), t.try_cast("double").alias("number")) for n, t in texts.items()])
    values = right.select(F.explode(F.array(F.coalesce("o_orderstatus", F.lit("?")), F.lit("all"))).alias("part"), F.inline(cells))
    exact = values.join(found.select("part", "column", F.col("quantiles")[1].alias("median")), ["part", "column"])
    exact = exact.groupBy("part", "column").agg(
        F.count_distinct("value").alias("exact"),
        F.max("median").alias("median"),
        F.avg(F.when(F.col("number") < F.col("median"), 1).otherwise(0)).alias("below"),
        F.avg(F.when(F.col("number") <= F.col("median"), 1).otherwise(0)).alias("up_to"),
    )
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.greatest(F.lit(1), F.col("exact") * 0.05)
    middle = F.col("median").isNull() | ((F.col("below") <= 0.53) & (F.col("up_to") >= 0.47))
    return found.join(exact, ["part", "column"]).select(
        "part", "column", "rows", "filled", "lowest", "highest", near.alias("distinct_near"), middle.alias("median_near")
    )


_SUMMARY = """
    SELECT event_type, user_id, count(value) AS samples, median(value) AS median, min(value) AS min,
           max(value) AS max, coalesce(stddev_samp(value), 0) AS stdev, avg(value) AS mean
    FROM events GROUP BY event_type, user_id
"""


@query(
    "sample_summary",
    f"""
    SELECT event_type, user_id, samples, round(median, 6) AS median, min, max, round(stdev, 6) AS stdev,
           CASE WHEN mean = 0 THEN 0.0 ELSE round(stdev / mean, 6) END AS coefficient_of_variation
    FROM ({_SUMMARY})
    """,
)
def summary(spark, sf_dir):
    found = sample_summary(table(spark, sf_dir, "events"), ["event_type", "user_id"], "value")
    for name in ("median", "stdev", "coefficient_of_variation"):
        found = found.withColumn(name, F.round(name, 6))
    return found


@query(
    "median_by_rank",
    "SELECT event_type, round(median(value), 6) AS median FROM events GROUP BY event_type",
)
def median_by_rank(spark, sf_dir):
    """The path for groups too large for one task, forced by a limit of one row."""
    events = table(spark, sf_dir, "events")
    found = exact_median(events, ["event_type"], "value", "median", small_group=1)
    return found.withColumn("median", F.round("median", 6))


@query(
    "median_hot_value",
    """
    SELECT l_returnflag, median(CASE WHEN l_orderkey % 10 < 9 THEN 7.5 ELSE l_extendedprice END) AS median
    FROM lineitem GROUP BY l_returnflag
    """,
)
def median_hot_value(spark, sf_dir):
    """One value on nine rows of ten, on the path for large groups."""
    hot = F.when(F.col("l_orderkey") % 10 < 9, F.lit(7.5)).otherwise(F.col("l_extendedprice"))
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", hot.alias("v"))
    return exact_median(lines, ["l_returnflag"], "v", "median", small_group=1)


@query(
    "summary_null_group",
    """
    WITH e AS (SELECT nullif(event_type, 'click') AS g, value, unnest([1, 1000000]) AS small_group FROM events)
    SELECT g, small_group, count(value) AS samples, round(median(value), 6) AS median, round(max(value), 6) AS max FROM e GROUP BY ALL
    """,
)
def summary_null_group(spark, sf_dir):
    """A null group, on both sides of the size from which groups are ranked instead of gathered."""
    events = table(spark, sf_dir, "events").withColumn("g", F.when(F.col("event_type") != "click", F.col("event_type")))
    found = [
        sample_summary(events, ["g"], "value", small).withColumn("small_group", F.lit(small)) for small in (1, 1_000_000)
    ]
    return found[0].unionByName(found[1]).select(
        "g", "small_group", "samples", F.round("median", 6).alias("median"), F.round("max", 6).alias("max")
    )


_SIGNALS = """
    WITH a AS (SELECT event_type, user_id, median(value) AS m, min(value) AS lo, max(value) AS hi
               FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY ALL),
    b AS (SELECT event_type, user_id, median(value) AS m, min(value) AS lo, max(value) AS hi
          FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY ALL),
    j AS (SELECT a.*, b.m AS bm, b.lo AS blo, b.hi AS bhi, (a.m - b.m) / nullif(b.m, 0) * 100 AS delta,
                 a.event_type IN ('click', 'purchase') AS better
          FROM a LEFT JOIN b USING (event_type, user_id)),
    q AS (SELECT *, CASE WHEN better THEN delta ELSE -delta END AS gain, lo > bhi AS above, hi < blo AS below FROM j)
    SELECT event_type, user_id, round(m, 6) AS current_median, round(bm, 6) AS baseline_median,
           round(delta, 4) AS delta_percent,
           CASE WHEN delta IS NOT NULL THEN NOT (above OR below) END AS ranges_overlap,
           CASE WHEN delta IS NULL THEN 'unavailable'
                WHEN gain <= -15 AND (CASE WHEN better THEN below ELSE above END) THEN 'regression_signal'
                WHEN gain >= 15 AND (CASE WHEN better THEN above ELSE below END) THEN 'improvement_signal'
                ELSE 'stable' END AS classification
    FROM q
"""


@query("regression_signal", _SIGNALS)
def signals(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    found = regression_signals(
        events.where(F.col("ts") >= middle),
        events.where(F.col("ts") < middle),
        ["event_type", "user_id"],
        "value",
        higher_is_better=F.col("event_type").isin("click", "purchase"),
    )
    return found.select(
        "event_type",
        "user_id",
        F.round("current_median", 6).alias("current_median"),
        F.round("baseline_median", 6).alias("baseline_median"),
        F.round("delta_percent", 4).alias("delta_percent"),
        "ranges_overlap",
        "classification",
    )


_WORKLOAD = """
    SELECT event_id AS index, 'run-' || CASE WHEN event_id < 100000 THEN lpad(event_id::VARCHAR, 5, '0') ELSE event_id::VARCHAR END AS "Fixture Key",
           'Workload record ' || CASE WHEN event_id < 100000 THEN lpad(event_id::VARCHAR, 5, '0') ELSE event_id::VARCHAR END AS "Name",
           {amount} AS "Amount",
           ['Ready', 'Running', 'Complete'][event_id % 3 + 1] AS "Status", event_id % 2 = 0 AS "Active",
           (TIMESTAMP '2026-01-01' + to_days((event_id % 365)::INTEGER)) AS "Event Date"
    FROM events
"""


def _workload(spark, sf_dir):
    records = workload_records(table(spark, sf_dir, "events"), "event_id", "run")
    return records


def _as_timestamp(df):
    return df.withColumn("Event Date", F.col("Event Date").cast("timestamp_ntz"))


@query("workload_gen", _WORKLOAD.format(amount="round((event_id + 1) * 1.25::DOUBLE, 2)"))
def workload_gen(spark, sf_dir):
    """One generated record per event id."""
    return _as_timestamp(_workload(spark, sf_dir))


@query(
    "workload_update",
    _WORKLOAD.format(
        amount="round((event_id + 1) * 1.25::DOUBLE, 2) + CASE WHEN event_id % 5 = 0 THEN 1000 ELSE 0 END"
    ),
)
def workload_update(spark, sf_dir):
    return _as_timestamp(update_pass(_workload(spark, sf_dir), 5))


@query(
    "conform_in_place",
    "SELECT c_custkey AS \"Account\", c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def conform_in_place(spark, sf_dir):
    """A rename through the bound id, without writing."""
    customers = with_field_ids(table(spark, sf_dir, "customer"), {"c_custkey": 3})
    return conform(customers, [FieldRule("Account", field_id=3, unique=True)])
