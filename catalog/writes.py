"""Upserts, batches, differences, deletes and change feeds."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from recordloom.functions.literals import utc_second_column
from recordloom.operators.batching import BatchRule, assign_batches, plan_batches, to_global_lines
from recordloom.operators.changes import (
    change_count,
    changed_tables,
    delete_records,
    modified_since,
    table_diff,
)
from recordloom.operators.commits import commit_delete, commit_delete_files, commit_upsert, commit_upsert_files
from recordloom.operators.constraints import FieldRule
from recordloom.operators.digests import diff_by_digest, digest_tree
from recordloom.operators.journal import BatchError, execute_batches
from recordloom.operators.query import select_where
from recordloom.operators.upsert import batch_report, check_result, line_errors, upsert
from recordloom.session import scratch_path, stage
from recordloom.sources.keyed import KeyedTable
from recordloom.streaming.ingest import (
    ChangeFeed,
    batch_statuses,
    change_counts,
    compact_log,
    ingest,
    overlay,
    read_change_counts,
    read_log,
    stream_change_counts,
)
from recordloom.streaming.state import compact_state, keep_state, read_state

from . import query, table

_LINES = """
    WITH src AS (
        SELECT o_orderkey + 1 AS line, o_orderstatus AS s,
               CASE WHEN o_orderpriority <> '5-LOW' THEN (o_orderkey // 2) * 3 END AS k
        FROM orders),
    firsts AS (SELECT k, min(line) AS first FROM src WHERE k IS NOT NULL GROUP BY k),
    checked AS (
        SELECT line, s, src.k,
               concat_ws(' | ',
                   CASE WHEN s NOT IN ('F', 'O') THEN 'o_orderstatus: not an allowed choice' END,
                   CASE WHEN src.k IS NULL THEN 'o_orderkey: the merge key is missing' END,
                   CASE WHEN line <> first THEN 'o_orderkey: already used on line ' || first END
               ) AS errors
        FROM src LEFT JOIN firsts ON src.k = firsts.k),
    lines AS (
        SELECT line, k, s, errors,
               CASE WHEN errors <> '' THEN 'error' WHEN o_orderkey IS NULL THEN 'created'
                    WHEN s IS DISTINCT FROM o_orderstatus THEN 'updated' ELSE 'unchanged' END AS action
        FROM checked LEFT JOIN orders ON k = o_orderkey)
"""


def _status_upsert(spark, sf_dir):
    """Order statuses with missing, repeated, known and new keys and a choice not allowed."""
    orders = table(spark, sf_dir, "orders")
    source, rules = _status_lines(orders)
    return upsert(orders, source, "o_orderkey", "o_orderkey", rules=rules)


def _status_lines(orders):
    source = orders.select(
        (F.col("o_orderkey") + 1).alias("line"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.floor(F.col("o_orderkey") / 2) * 3).alias(
            "o_orderkey"
        ),
        "o_orderstatus",
    )
    return source, [FieldRule("o_orderstatus", required=True, choices=["F", "O"])]


@query(
    "upsert_lines",
    _LINES
    + "SELECT line, CASE WHEN errors = '' THEN k END AS record_id, action, errors FROM lines",
)
def upsert_lines(spark, sf_dir):
    lines = _status_upsert(spark, sf_dir).lines
    return lines.withColumn("errors", F.array_join("errors", " | "))


@query(
    "upsert_commit",
    _LINES
    + """
    SELECT o_orderkey + 1 AS o_orderkey, coalesce(s, o_orderstatus) AS o_orderstatus
    FROM orders LEFT JOIN (SELECT * FROM lines WHERE action = 'updated') ON k = o_orderkey
    UNION ALL SELECT k + 1, s FROM lines WHERE action = 'created'
    """,
)
def upsert_commit(spark, sf_dir):
    """The table as it is read after two equal commits, of which the second does nothing.

    Record ids start at 1, so all keys are one higher here.
    """
    path, orders = scratch_path(spark, "orders"), table(spark, sf_dir, "orders")
    orders.withColumn("o_orderkey", F.col("o_orderkey") + 1).write.parquet(path)
    source, rules = _status_lines(orders)
    source = source.withColumn("o_orderkey", F.col("o_orderkey") + 1)
    for _ in range(2):
        commit_upsert(spark, path, source, "o_orderkey", "statuses", merge_on="o_orderkey", rules=rules)
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus")


_FILE_ROWS = 1000


@query(
    "upsert_commit_files",
    f"""
    WITH t0 AS (SELECT o_orderkey + 1 AS k, o_orderpriority AS p, (row_number() OVER (ORDER BY o_orderkey) - 1) // {_FILE_ROWS} AS file FROM orders),
    s1 AS (SELECT k FROM t0 WHERE k % 100 < 4 AND k < 4000), created AS (SELECT k + 1000000000 AS k, p FROM t0 WHERE k % 50 = 7),
    u1 AS (SELECT * FROM t0 WHERE k % 100 < 4 AND k < 4000 AND p <> '1-URGENT'),
    gone AS (SELECT * FROM t0 WHERE k % 1000 = 999 AND k > 6000),
    final AS (
        SELECT k, CASE WHEN k % 100 < 4 AND k < 4000 THEN '1-URGENT' ELSE p END AS p FROM t0 WHERE NOT (k % 1000 = 999 AND k > 6000)
        UNION ALL SELECT k, p FROM created),
    n AS (SELECT (SELECT count(DISTINCT file) FROM t0) AS files, (SELECT count(DISTINCT file) FROM u1) AS touched,
                 ((SELECT count(*) FROM created) + {_FILE_ROWS} - 1) // {_FILE_ROWS} AS added, (SELECT count(DISTINCT file) FROM gone) AS cut,
                 (SELECT count(*) FROM t0) AS rows, (SELECT count(*) FROM created) AS more, (SELECT count(*) FROM gone) AS less)
    SELECT 'record' AS kind, k AS id, p AS priority, NULL::BIGINT AS kept, NULL::BIGINT AS rewritten, NULL::BIGINT AS added, NULL::BIGINT AS rows FROM final
    UNION ALL SELECT 'commit', 0, NULL, 0, 0, files, rows FROM n
    UNION ALL SELECT 'commit', 1, NULL, files - touched, touched, 0, rows FROM n
    UNION ALL SELECT 'commit', 2, NULL, files, 0, added, rows + more FROM n
    UNION ALL SELECT 'commit', 3, NULL, files + added - cut, cut, 0, rows + more - less FROM n
    """,
)
def upsert_commit_files(spark, sf_dir):
    """Updates, new records and deletes committed one after the other, and what each commit did to the files."""
    orders = table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("k"), F.col("o_orderpriority").alias("p"))
    line = F.col("k")
    stored = KeyedTable.create(orders, scratch_path(spark, "keyed"), "k", _FILE_ROWS)
    urgent = orders.where("k % 100 < 4 AND k < 4000").select(line.alias("line"), "k", F.lit("1-URGENT").alias("p"))
    new = orders.where("k % 50 = 7").select(line.alias("line"), (F.col("k") + 1_000_000_000).alias("k"), "p")
    stored, _ = commit_upsert_files(stored, urgent, "urgent", merge_on="k", file_rows=_FILE_ROWS)
    stored, _ = commit_upsert_files(stored, new, "new", merge_on="k", file_rows=_FILE_ROWS)
    stored, _ = commit_delete_files(stored, (F.col("k") % 1000 == 999) & (F.col("k") > 6000), "gone")
    none = F.lit(None).cast("bigint")
    records = stored.read().select(
        F.lit("record").alias("kind"), F.col("k").alias("id"), F.col("p").alias("priority"),
        none.alias("kept"), none.alias("rewritten"), none.alias("added"), none.alias("rows"),
    )
    commits = stored.history().select(
        F.lit("commit").alias("kind"), F.col("number").alias("id"), F.lit(None).cast("string").alias("priority"),
        "kept", "rewritten", "added", "rows",
    )
    return records.union(commits)


_EXECUTED = 800_000


@query(
    "batch_execute",
    f"""
    WITH RECURSIVE d AS (SELECT doc_id + 1 AS line, strlen(text) AS size, row_number() OVER (ORDER BY doc_id) AS i FROM documents),
    walk AS (
        SELECT i, line, 1 AS batch, 30 + size AS used FROM d WHERE i = 1
        UNION ALL
        SELECT d.i, d.line, CASE WHEN used + 2 + d.size > {_EXECUTED} THEN batch + 1 ELSE batch END,
               CASE WHEN used + 2 + d.size > {_EXECUTED} THEN 30 + d.size ELSE used + 2 + d.size END
        FROM walk JOIN d ON d.i = walk.i + 1),
    bad AS (SELECT coalesce(min(batch), 1000000000) AS batch FROM walk WHERE line = 501),
    act AS (
        SELECT line, batch, CASE WHEN n_chars < 0 THEN 'error' WHEN (line - 1) % 3 = 2 THEN 'created'
               WHEN (line - 1) % 2 = 0 THEN 'updated' ELSE 'unchanged' END AS action
        FROM walk JOIN documents ON doc_id = line - 1)
    SELECT batch::BIGINT AS batch_number, min(walk.line) AS start_line, max(walk.line) AS end_line, count(*) AS records,
           max(used)::BIGINT AS payload_bytes, CASE WHEN batch < (SELECT batch FROM bad) THEN 'completed' ELSE 'failed' END AS status,
           CASE WHEN batch < (SELECT batch FROM bad) THEN count(*) FILTER (WHERE action = 'created') END AS created,
           CASE WHEN batch < (SELECT batch FROM bad) THEN count(*) FILTER (WHERE action = 'updated') END AS updated,
           CASE WHEN batch < (SELECT batch FROM bad) THEN count(*) FILTER (WHERE action = 'unchanged') END AS unchanged
    FROM walk JOIN act USING (line, batch) WHERE batch <= (SELECT batch FROM bad) GROUP BY batch
    """,
)
def batch_execute(spark, sf_dir):
    """The lengths of documents written in batches, of which the one with line 501 is refused."""
    docs = table(spark, sf_dir, "documents")
    third, even, line = F.col("doc_id") % 3, F.col("doc_id") % 2, F.col("doc_id") + 1
    stored = KeyedTable.create(docs.where(third != 2).select(line.alias("id"), "n_chars"), scratch_path(spark, "batches"), "id")
    source = docs.select(
        line.alias("line"), line.alias("id"), F.when(even == 0, -1 - F.col("n_chars")).otherwise(F.col("n_chars")).alias("n_chars"),
        F.octet_length("text").cast("bigint").alias("size"),
    )
    rule = BatchRule("line", F.col("size"), envelope_bytes=30, max_bytes=_EXECUTED)
    commit = lambda table, lines, **options: commit_upsert_files(table, lines.drop("size"), **options)
    try:
        _, journal = execute_batches(stored, source, rule, "lengths", F.col("line") == 501, commit, merge_on="id")
    except BatchError as error:
        journal = error.journal
    return journal.report().select(
        "batch_number", "start_line", "end_line", "records", "payload_bytes", "status", "created", "updated", "unchanged"
    )


@query("delete_commit", "SELECT * FROM customer WHERE c_acctbal >= 0 OR c_acctbal IS NULL")
def delete_commit(spark, sf_dir):
    path = scratch_path(spark, "customer")
    table(spark, sf_dir, "customer").write.parquet(path)
    commit_delete(spark, path, lambda w: w.less_than("c_acctbal", 0))
    return spark.read.parquet(path)


@query(
    "upsert_hot_key",
    """
    WITH src AS (
        SELECT o_orderkey + 1 AS line, o_totalprice AS v,
               CASE WHEN o_orderkey % 10 < 6 THEN 5 WHEN o_orderkey % 10 < 9 THEN NULL ELSE o_custkey END AS k
        FROM orders),
    firsts AS (SELECT k, min(line) AS first FROM src WHERE k IS NOT NULL GROUP BY k)
    SELECT line, CASE WHEN line = first THEN src.k END AS record_id,
           CASE WHEN line IS DISTINCT FROM first THEN 'error' WHEN c_custkey IS NULL THEN 'created'
                WHEN v IS DISTINCT FROM c_acctbal THEN 'updated' ELSE 'unchanged' END AS action,
           CASE WHEN src.k IS NULL THEN 'c_custkey: the merge key is missing'
                WHEN line <> first THEN 'c_custkey: already used on line ' || first ELSE '' END AS errors
    FROM src LEFT JOIN firsts ON src.k = firsts.k LEFT JOIN customer ON c_custkey = src.k
    """,
)
def upsert_hot_key(spark, sf_dir):
    """Most lines hold one merge key, many hold none."""
    key = F.col("o_orderkey") % 10
    source = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + 1).alias("line"),
        F.when(key < 6, F.lit(5)).when(key < 9, F.lit(None)).otherwise(F.col("o_custkey")).alias("c_custkey"),
        F.col("o_totalprice").alias("c_acctbal"),
    )
    lines = upsert(table(spark, sf_dir, "customer"), source, "c_custkey", "c_custkey").lines
    return lines.withColumn("errors", F.array_join("errors", " | "))


@query(
    "upsert_merged",
    _LINES
    + """
    SELECT o_orderkey, o_custkey, coalesce(s, o_orderstatus) AS o_orderstatus, o_totalprice,
           o_orderdate, o_orderpriority
    FROM orders LEFT JOIN (SELECT * FROM lines WHERE action = 'updated') ON k = o_orderkey
    UNION ALL SELECT k, NULL, s, NULL, NULL, NULL FROM lines WHERE action = 'created'
    """,
)
def upsert_merged(spark, sf_dir):
    return _status_upsert(spark, sf_dir).merged


@query(
    "upsert_summary",
    _LINES
    + """
    SELECT count(*) AS total_processed, count(*) FILTER (WHERE action = 'created') AS created,
           count(*) FILTER (WHERE action = 'updated') AS updated,
           count(*) FILTER (WHERE action = 'unchanged') AS unchanged,
           count(*) FILTER (WHERE action = 'error') AS failed_lines,
           CASE WHEN failed_lines = 0 THEN 'success' WHEN failed_lines = total_processed THEN 'failed'
                ELSE 'partial' END AS outcome
    FROM lines
    """,
)
def upsert_summary(spark, sf_dir):
    return _status_upsert(spark, sf_dir).summary()


@query(
    "upsert_line_errors",
    _LINES
    + "SELECT line, unnest(string_split(errors, ' | ')) AS message FROM lines WHERE errors <> ''",
)
def upsert_line_errors(spark, sf_dir):
    return line_errors(_status_upsert(spark, sf_dir).lines)


@query(
    "upsert_returned",
    _LINES
    + "SELECT k AS o_orderkey, s AS o_orderstatus FROM lines WHERE errors = ''",
)
def upsert_returned(spark, sf_dir):
    return _status_upsert(spark, sf_dir).returned(["o_orderstatus"])


_NEW_IDS = """
    WITH src AS (
        SELECT s_suppkey + 1 AS line, s_acctbal AS bal,
               CASE WHEN s_acctbal > 0 THEN replace(s_name, 'Supplier', 'Customer') ELSE s_name END AS n
        FROM supplier),
    m AS (SELECT src.*, c_custkey, c_acctbal FROM src LEFT JOIN customer ON n = c_name),
    fresh AS (SELECT line, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY line) AS id
              FROM m WHERE c_custkey IS NULL)
"""


def _name_upsert(spark, sf_dir):
    """Customers merged on their name: unknown names get the next ids in line order."""
    name = F.when(
        F.col("s_acctbal") > 0, F.regexp_replace("s_name", "Supplier", "Customer")
    ).otherwise(F.col("s_name"))
    source = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1).alias("line"),
        name.alias("C_NAME"),
        F.col("s_acctbal").alias("c_acctbal"),
    )
    return upsert(table(spark, sf_dir, "customer"), source, "c_custkey", "c_name")


@query(
    "upsert_new_ids",
    _NEW_IDS
    + """
    SELECT m.line, coalesce(c_custkey, id) AS record_id,
           CASE WHEN c_custkey IS NULL THEN 'created'
                WHEN bal IS DISTINCT FROM c_acctbal THEN 'updated' ELSE 'unchanged' END AS action
    FROM m LEFT JOIN fresh USING (line)
    """,
)
def upsert_new_ids(spark, sf_dir):
    return _name_upsert(spark, sf_dir).lines.drop("errors")


@query(
    "upsert_new_ids_merged",
    _NEW_IDS
    + """
    SELECT c.c_custkey, c.c_name, c.c_nationkey, coalesce(bal, c.c_acctbal) AS c_acctbal, c_mktsegment
    FROM customer c LEFT JOIN m ON c.c_custkey = m.c_custkey
    UNION ALL SELECT id, n, NULL, bal, NULL FROM m JOIN fresh USING (line)
    """,
)
def upsert_new_ids_merged(spark, sf_dir):
    return _name_upsert(spark, sf_dir).merged


@query(
    "upsert_ragged",
    """
    SELECT s_suppkey, CASE WHEN s_acctbal < 5000 THEN upper(s_name) ELSE s_name END AS s_name,
           s_nationkey, CASE WHEN s_acctbal < 5000 THEN s_acctbal END AS s_acctbal
    FROM supplier
    """,
)
def upsert_ragged(spark, sf_dir):
    """Each line carries only some fields; a field not carried keeps its value."""
    suppliers = table(spark, sf_dir, "supplier")
    source = suppliers.select(
        (F.col("s_suppkey") + 1).alias("line"),
        "s_suppkey",
        F.upper("s_name").alias("s_name"),
        F.lit(None).cast("double").alias("s_acctbal"),
        F.when(F.col("s_acctbal") < 5000, F.array(F.lit("s_suppkey"), F.lit("s_name")))
        .otherwise(F.array(F.lit("s_suppkey"), F.lit("s_acctbal")))
        .alias("carried"),
    )
    return upsert(suppliers, source, "s_suppkey", "s_suppkey", present="carried").merged


@query("upsert_twice", "SELECT count(*) AS unchanged, 0::BIGINT AS others FROM customer")
def upsert_twice(spark, sf_dir):
    """Writing a table into itself leaves every record unchanged."""
    customers = table(spark, sf_dir, "customer")
    source = customers.withColumn("line", F.col("c_custkey") + 1)
    lines = upsert(customers, source, "c_custkey", "c_custkey").lines
    return lines.agg(
        F.count_if(F.col("action") == "unchanged").alias("unchanged"),
        F.count_if(F.col("action") != "unchanged").alias("others"),
    )


@query(
    "upsert_check",
    _LINES
    + """
    SELECT 'position out of range' AS rule
    UNION ALL SELECT 'processed differs from submitted'
    UNION ALL SELECT DISTINCT 'record id not positive' FROM lines WHERE errors = '' AND k < 1
    """,
)
def upsert_check(spark, sf_dir):
    """Write-result rules, held against half as many submitted lines as there were."""
    lines = stage(_status_upsert(spark, sf_dir).lines, "lines")
    return check_result(lines, table(spark, sf_dir, "orders").count() // 2)


_BATCH_BYTES = 262_144
_BATCH_SQL = f"""
    WITH RECURSIVE d AS (
        SELECT source, doc_id, strlen(text) AS size,
               row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
    walk AS (
        SELECT source, i, doc_id, size, 1 AS batch, 30 + size AS used FROM d WHERE i = 1
        UNION ALL
        SELECT d.source, d.i, d.doc_id, d.size,
               CASE WHEN used + 2 + d.size > {_BATCH_BYTES} THEN batch + 1 ELSE batch END,
               CASE WHEN used + 2 + d.size > {_BATCH_BYTES} THEN 30 + d.size ELSE used + 2 + d.size END
        FROM walk JOIN d ON d.source = walk.source AND d.i = walk.i + 1)
"""


def _batch_rule():
    size = F.octet_length("text").cast("bigint")
    return BatchRule("doc_id", size, ["source"], envelope_bytes=30, max_bytes=_BATCH_BYTES)


@query(
    "batch_plan",
    _BATCH_SQL
    + """
    SELECT source, batch::BIGINT AS batch_number, min(doc_id) AS start_line, max(doc_id) AS end_line,
           count(*) AS records, max(used)::BIGINT AS payload_bytes
    FROM walk GROUP BY source, batch
    """,
)
def batch_plan(spark, sf_dir):
    return plan_batches(table(spark, sf_dir, "documents"), _batch_rule())


@query(
    "batch_null_shard",
    _BATCH_SQL.replace("FROM documents)", "FROM (SELECT nullif(source, (SELECT min(source) FROM documents)) AS source, doc_id, text FROM documents))")
    .replace("d.source = walk.source", "d.source IS NOT DISTINCT FROM walk.source")
    + """
    SELECT source, batch::BIGINT AS batch_number, min(doc_id) AS start_line, max(doc_id) AS end_line,
           count(*) AS records, max(used)::BIGINT AS payload_bytes
    FROM walk GROUP BY source, batch
    """,
)
def batch_null_shard(spark, sf_dir):
    """One source is unknown; its lines are a shard like any other."""
    docs = table(spark, sf_dir, "documents")
    first = docs.agg(F.min("source")).first()[0]
    return plan_batches(docs.withColumn("source", F.when(F.col("source") != first, F.col("source"))), _batch_rule())


@query(
    "batch_lines",
    _BATCH_SQL + "SELECT source, doc_id, batch::BIGINT AS batch_number FROM walk",
)
def batch_lines(spark, sf_dir):
    return assign_batches(table(spark, sf_dir, "documents"), _batch_rule())


@query(
    "batch_rebase",
    """
    WITH RECURSIVE d AS (SELECT doc_id + 1 AS line, strlen(text) AS size FROM documents),
    walk AS (
        SELECT line, 1 AS batch, size AS used, 1 AS position FROM d WHERE line = 1
        UNION ALL
        SELECT d.line, CASE WHEN used + 2 + d.size > 262144 THEN batch + 1 ELSE batch END,
               CASE WHEN used + 2 + d.size > 262144 THEN d.size ELSE used + 2 + d.size END,
               CASE WHEN used + 2 + d.size > 262144 THEN 1 ELSE position + 1 END
        FROM walk JOIN d ON d.line = walk.line + 1)
    SELECT batch::BIGINT AS batch_number, position, line AS global_line FROM walk
    """,
)
def batch_rebase(spark, sf_dir):
    """All documents as one sequence; positions within a batch and the lines they stand for."""
    lines = table(spark, sf_dir, "documents").select(
        (F.col("doc_id") + 1).alias("line"), F.octet_length("text").cast("bigint").alias("size")
    )
    rule = BatchRule("line", F.col("size"), max_bytes=_BATCH_BYTES)
    inside = Window.partitionBy("batch_number").orderBy("line")
    local = assign_batches(lines, rule).select(
        "batch_number", F.row_number().over(inside).alias("position")
    )
    return to_global_lines(local, plan_batches(lines, rule), "position")


@query("batch_outcomes")
def batch_outcomes(spark, sf_dir):
    """Outcome per batch of the order upsert. The tests check it on a small fixture."""
    lines = stage(_status_upsert(spark, sf_dir).lines, "lines")
    sizes = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + 1).alias("line"),
        (F.octet_length("o_orderpriority") + 40).cast("bigint").alias("size"),
    )
    rule = BatchRule("line", F.col("size"), envelope_bytes=60, max_bytes=40_000)
    return batch_report(lines, plan_batches(sizes, rule), assign_batches(sizes, rule))


_AFTER = """
    WITH before AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders),
    after AS (
        SELECT o_orderkey, o_orderstatus,
               CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
               nullif(o_orderpriority, '1-URGENT') AS o_orderpriority
        FROM orders WHERE NOT (o_orderstatus = 'P' AND o_totalprice < 100000)
        UNION ALL
        SELECT 1000000000 + c_custkey, 'O', c_acctbal, '5-LOW' FROM customer)
"""


def _before_after(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    urgent = F.col("o_orderpriority") == "1-URGENT"
    kept = orders.where(~((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 100000)))
    changed = kept.select(
        "o_orderkey",
        "o_orderstatus",
        F.when(urgent, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(~urgent, F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    new = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1_000_000_000).alias("o_orderkey"),
        F.lit("O").alias("o_orderstatus"),
        F.col("c_acctbal").alias("o_totalprice"),
        F.lit("5-LOW").alias("o_orderpriority"),
    )
    return orders, changed.unionByName(new)


_DIFF = (
    _AFTER
    + """
    , rows AS (
        SELECT coalesce(b.o_orderkey, a.o_orderkey) AS record_id,
               CASE WHEN b.o_orderkey IS NULL THEN 'CREATE' WHEN a.o_orderkey IS NULL THEN 'DELETE'
                    ELSE 'MODIFY' END AS change_type,
               concat_ws(',',
                   CASE WHEN a.o_orderstatus IS DISTINCT FROM b.o_orderstatus THEN 'o_orderstatus' END,
                   CASE WHEN a.o_totalprice IS DISTINCT FROM b.o_totalprice THEN 'o_totalprice' END,
                   CASE WHEN a.o_orderpriority IS DISTINCT FROM b.o_orderpriority THEN 'o_orderpriority' END
               ) AS fields,
               b.o_totalprice AS price_before, a.o_totalprice AS price_after
        FROM before b FULL JOIN after a ON a.o_orderkey = b.o_orderkey)
    SELECT record_id, change_type, CASE WHEN change_type = 'MODIFY' THEN fields ELSE '' END AS changed_fields,
           price_before, price_after
    FROM rows WHERE change_type <> 'MODIFY' OR fields <> ''
    """
)


@query(
    "table_diff",
    _DIFF,
)
def diff(spark, sf_dir):
    return _shown_diff(table_diff(*_before_after(spark, sf_dir), "o_orderkey", include_details=True))


def _shown_diff(entries):
    return entries.select(
        "record_id",
        "change_type",
        F.array_join("changed_fields", ",").alias("changed_fields"),
        F.col("before.o_totalprice").alias("price_before"),
        F.col("after.o_totalprice").alias("price_after"),
    )


@query("diff_by_digest", _DIFF)
def by_digest(spark, sf_dir):
    """The same difference by digest trees of both states."""
    before, after = _before_after(spark, sf_dir)
    trees = [digest_tree(df, "o_orderkey") for df in (before, after)]
    return _shown_diff(diff_by_digest(before, after, "o_orderkey", *trees, include_details=True))


@query(
    "table_diff_counts",
    _AFTER
    + """
    SELECT CASE WHEN b.o_orderkey IS NULL THEN 'CREATE' WHEN a.o_orderkey IS NULL THEN 'DELETE'
                ELSE 'MODIFY' END AS change_type, count(*) AS changes
    FROM before b FULL JOIN after a ON a.o_orderkey = b.o_orderkey
    WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_totalprice IS DISTINCT FROM b.o_totalprice
    GROUP BY 1
    """,
)
def diff_counts(spark, sf_dir):
    """Restricted to one field."""
    before, after = _before_after(spark, sf_dir)
    return change_count(table_diff(before, after, "o_orderkey", ["o_totalprice"]))


@query(
    "modified_since",
    """
    SELECT event_id AS record_id, 'MODIFY' AS change_type, ts AS changed_at, user_id, value
    FROM events WHERE ts >= TIMESTAMP '2024-01-20 17:30:00'
    """,
)
def since(spark, sf_dir):
    return modified_since(
        table(spark, sf_dir, "events"),
        "ts",
        "2024-01-20T12:30:00.987654-05:00",
        "event_id",
        ["user_id", "value"],
    )


@query(
    "utc_seconds",
    "SELECT event_id, date_trunc('second', ts + INTERVAL 5 HOUR)::TIMESTAMP AS at FROM events",
)
def utc_seconds(spark, sf_dir):
    """Wall-clock times five hours behind UTC as whole UTC seconds."""
    at = utc_second_column(F.col("ts"), "-05:00").cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select("event_id", at.alias("at"))


@query(
    "changed_tables",
    """
    SELECT 'events' AS "table", count(*) AS changes, count(*) > 0 AS changed FROM events
    WHERE ts >= TIMESTAMP '2024-01-15'
    UNION ALL SELECT 'orders', count(*), count(*) > 0 FROM orders
    WHERE o_orderdate >= TIMESTAMP '2024-01-15'
    """,
)
def tables_changed(spark, sf_dir):
    tables = {name: table(spark, sf_dir, name) for name in ("events", "orders")}
    return changed_tables(tables, {"events": "ts", "orders": "o_orderdate"}, "2024-01-15T00:00:00Z")


@query(
    "delete_where",
    """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE NOT coalesce(o_orderstatus = 'F' AND o_totalprice < 200000, false)
    """,
)
def delete_where(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return delete_records(
        orders, lambda w: w.and_(w.is_value("o_orderstatus", "F"), w.less_than("o_totalprice", 200000))
    ).kept


_BUILDING = "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'"


def _delete_by_id(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    ids = select_where(customers, lambda w: w.is_value("c_mktsegment", "BUILDING")).select("c_custkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return delete_records(orders, ids, "o_custkey")


@query(
    "delete_ids",
    f"SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_custkey NOT IN ({_BUILDING})",
)
def delete_ids(spark, sf_dir):
    return _delete_by_id(spark, sf_dir).kept


@query(
    "delete_count", f"SELECT count(*) AS number_deleted FROM orders WHERE o_custkey IN ({_BUILDING})"
)
def delete_count(spark, sf_dir):
    return _delete_by_id(spark, sf_dir).number_deleted()


_FEED = ChangeFeed("user_id", "ts", "change_type", "event_id")


def _feed_stream(spark, sf_dir):
    """The events as a stream of changes; errors stand for deletes."""
    schema = table(spark, sf_dir, "events").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    kind = F.when(F.col("event_type") == "error", "DELETE").otherwise("MODIFY")
    return files.parquet(sf_dir).select(
        "event_id", "ts", "user_id", "value", kind.alias("change_type")
    )


def _ingested(spark, sf_dir):
    root = scratch_path(spark, "ingest")
    stream = _feed_stream(spark, sf_dir)
    ingest(stream, f"{root}/log", f"{root}/checkpoint", _FEED).awaitTermination()
    return stream.schema, f"{root}/log"


_NEWEST = """
    SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts,
           arg_max(value, (ts, event_id)) AS value,
           arg_max(CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'MODIFY' END, (ts, event_id)) AS change_type
    FROM events GROUP BY user_id
"""


@query("stream_ingest", f"SELECT * FROM ({_NEWEST})")
def stream_ingest(spark, sf_dir):
    schema, log = _ingested(spark, sf_dir)
    return read_log(spark, log, schema).drop("batch_id")


@query(
    "stream_overlay",
    f"""
    WITH newest AS ({_NEWEST})
    SELECT c_custkey AS user_id, c_acctbal AS value FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM newest)
    UNION ALL SELECT user_id, value FROM newest WHERE change_type <> 'DELETE'
    """,
)
def stream_overlay(spark, sf_dir):
    """A table with the ingested changes applied."""
    schema, log = _ingested(spark, sf_dir)
    base = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("value")
    )
    return overlay(base, read_log(spark, log, schema), _FEED)


@query(
    "stream_statuses",
    """
    SELECT 0::BIGINT AS batch_id, count(*) AS lines, 0::BIGINT AS late_lines, 'completed' AS status
    FROM events
    """,
)
def stream_statuses(spark, sf_dir):
    _, log = _ingested(spark, sf_dir)
    return batch_statuses(spark, log)


@query(
    "stream_late_rows",
    """
    WITH p AS (SELECT *, event_id % 3 AS part FROM events),
    m AS (SELECT b.part, (SELECT max(ts) - INTERVAL 10 DAY FROM p WHERE p.part < b.part) AS mark FROM (SELECT DISTINCT part FROM p) b)
    SELECT part AS batch_id, count(*) AS lines, count(*) FILTER (WHERE ts < mark) AS late_lines,
           count(DISTINCT user_id) FILTER (WHERE mark IS NULL OR ts >= mark) AS changed_keys
    FROM p JOIN m USING (part) GROUP BY part
    """,
)
def stream_late_rows(spark, sf_dir):
    """Three micro-batches over files of events, the later ones with rows behind the watermark."""
    root = scratch_path(spark, "late-rows")
    kind = F.when(F.col("event_type") == "error", "DELETE").otherwise("MODIFY")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", kind.alias("change_type"), "value")
    feed = ChangeFeed("user_id", "ts", "change_type", "event_id", "10 days")
    for part in range(3):
        events.where(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
        ingest(stream, f"{root}/log", f"{root}/checkpoint", feed).awaitTermination()
    keys = read_log(spark, f"{root}/log", events.schema).groupBy("batch_id").agg(F.count(F.lit(1)).alias("changed_keys"))
    return batch_statuses(spark, f"{root}/log").join(keys, "batch_id").select("batch_id", "lines", "late_lines", "changed_keys")


def _arrivals(spark, sf_dir):
    """Three lots of events, each with times from the whole range: most of the later ones come late."""
    kind = F.when(F.col("event_type") == "error", "DELETE").otherwise("MODIFY")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", kind.alias("change_type"))
    return events.schema, [events.where(F.col("event_id") % 3 == part) for part in (2, 0, 1)]


@query("stream_state", f"SELECT user_id, event_id, value FROM ({_NEWEST}) WHERE change_type <> 'DELETE'")
def stream_state(spark, sf_dir):
    """Three micro-batches in any order of time, with a compaction of the output between them."""
    root = scratch_path(spark, "state")
    schema, lots = _arrivals(spark, sf_dir)
    for number, lot in enumerate(lots):
        lot.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        keep_state(stream, f"{root}/state", f"{root}/checkpoint", _FEED).awaitTermination()
        if number == 1:
            compact_state(spark, f"{root}/state", schema, _FEED)
    return read_state(spark, f"{root}/state", schema, _FEED).select("user_id", "event_id", "value")


@query(
    "stream_compact_then_older",
    f"""
    WITH newest AS ({_NEWEST})
    SELECT c_custkey AS user_id, c_acctbal AS value FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM newest)
    UNION ALL SELECT user_id, value FROM newest WHERE change_type <> 'DELETE'
    """,
)
def stream_compact_then_older(spark, sf_dir):
    """The log is compacted into the table after each micro-batch; older changes that come later, but on time, change nothing."""
    root = scratch_path(spark, "compacted")
    feed = ChangeFeed("user_id", "ts", "change_type", "event_id", "400 days")
    schema, lots = _arrivals(spark, sf_dir)
    base = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("value"))
    for number, lot in enumerate(lots):
        lot.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        ingest(stream, f"{root}/log", f"{root}/checkpoint", feed).awaitTermination()
        base = compact_log(base, f"{root}/log", schema, feed, f"{root}/table{number}")
    return base


_COUNTS = """
    SELECT date_trunc('day', ts) AS window_start,
           CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'MODIFY' END AS change_type,
           count(*) AS changes
    FROM events GROUP BY 1, 2
"""


@query("change_counts", _COUNTS)
def counts(spark, sf_dir):
    kind = F.when(F.col("event_type") == "error", "DELETE").otherwise("MODIFY")
    events = table(spark, sf_dir, "events").withColumn("change_type", kind)
    return change_counts(events, "ts", "change_type")


@query("stream_change_counts", _COUNTS)
def stream_counts(spark, sf_dir):
    root = scratch_path(spark, "counts")
    stream = _feed_stream(spark, sf_dir)
    stream_change_counts(
        stream, f"{root}/counts", f"{root}/checkpoint", "ts", "change_type"
    ).awaitTermination()
    return read_change_counts(spark, f"{root}/counts", "change_type")
