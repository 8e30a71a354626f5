"""Wire records, JSON lines, digests, exports and snapshots."""

from pyspark.sql import functions as F

from recordloom.session import scratch_path
from recordloom.sources.cells import check_json_lines, from_wire, to_wire, wire_fields
from recordloom.sources.export import copy_tables, export_csv, read_csv, read_json_lines, write_json_lines
from recordloom.sources.files import decode_body, hash_files, list_files, total_bytes
from recordloom.sources.snapshot import (
    Capture,
    compare_files,
    compare_index,
    compare_items,
    compare_tables,
    inventory_problems,
    inventory_summary,
    line_issues,
    open_snapshot,
    take_snapshot,
    unsafe_paths,
)

from recordloom.operators.relations import Summary
from recordloom.plans.derivation import Derivation, Relationship, derive
from recordloom.plans.reports import Report, run_report

from . import query, table


@query("cells_flatten", "SELECT * FROM customer")
def cells_flatten(spark, sf_dir):
    """Customers as wire records and back."""
    customers = table(spark, sf_dir, "customer")
    fields = wire_fields(customers, "c_custkey")
    return from_wire(customers.select(to_wire(customers, fields)), fields)


@query(
    "jsonl_validate",
    """
    WITH lines AS (
        SELECT 'props' AS part, props AS line FROM events
        UNION ALL SELECT 'array', '[' || props || ']' FROM events
        UNION ALL SELECT 'cut', rtrim(props, '}') FROM events
        UNION ALL SELECT 'text', text FROM documents)
    SELECT part, count(*) FILTER (WHERE json_valid(line)) AS items,
           count(*) FILTER (WHERE NOT json_valid(line)) AS invalid,
           count(*) FILTER (WHERE json_valid(line) AND json_type(CASE WHEN json_valid(line) THEN line END) <> 'OBJECT') AS non_objects
    FROM lines GROUP BY part
    """,
)
def jsonl_validate(spark, sf_dir):
    props, text = F.col("props"), table(spark, sf_dir, "documents").select("text")
    events = table(spark, sf_dir, "events").select("props")
    parts = {
        "props": props,
        "array": F.concat(F.lit("["), props, F.lit("]")),
        "cut": F.rtrim(props, F.lit("}")),
    }
    each = F.array(*[F.struct(F.lit(n).alias("part"), c.alias("line")) for n, c in parts.items()])
    lines = events.select(F.inline(each)).unionByName(
        text.select(F.lit("text").alias("part"), F.col("text").alias("line"))
    )
    return check_json_lines(lines, "line", ["part"])


@query("file_digests")
def file_digests(spark, sf_dir):
    """The table files themselves as binary files."""
    return hash_files(spark, sf_dir).drop("uri")


@query("file_sizes")
def file_sizes(spark, sf_dir):
    return total_bytes(list_files(spark, sf_dir))


@query(
    "stored_bodies",
    """
    SELECT doc_id, 'encoded' AS form, sha256(text) AS sha256 FROM documents
    UNION ALL SELECT doc_id, 'raw', sha256('!' || text) FROM documents
    """,
)
def stored_bodies(spark, sf_dir):
    """Bodies kept as base64 are decoded; those that are not base64 stay as they are."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    forms = F.array(
        F.struct(
            F.lit("encoded").alias("form"),
            F.base64(F.encode("text", "utf-8")).alias("body"),
        ),
        F.struct(F.lit("raw").alias("form"), F.concat(F.lit("!"), F.col("text")).alias("body")),
    )
    bodies = documents.select("doc_id", F.inline(forms))
    body = F.regexp_replace("body", "\r\n", "")
    stored = F.when(F.col("form") == "encoded", body).otherwise(F.col("body"))
    return bodies.select("doc_id", "form", F.sha2(decode_body(stored), 256).alias("sha256"))


@query("csv_export", "SELECT * FROM customer WHERE lower(c_mktsegment) <> 'building'")
def csv_export(spark, sf_dir):
    """Export and read back."""
    customers = table(spark, sf_dir, "customer")
    path = export_csv(
        customers, "customer", scratch_path(spark, "csv"), "c_custkey",
        lambda w: w.neq("c_mktsegment", "building"),
    )
    return spark.read.schema(customers.schema).option("header", True).csv(path)


@query("csv_export_limit", "SELECT * FROM customer ORDER BY c_custkey LIMIT 300")
def csv_export_limit(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    path = export_csv(
        customers, "customer", scratch_path(spark, "csv"), "c_custkey", record_limit=300,
        single_file=True,
    )
    return spark.read.schema(customers.schema).option("header", True).csv(path)


@query("csv_export_text", "SELECT * FROM documents")
def csv_export_text(spark, sf_dir):
    """Whole texts with line ends, quotes and blanks, exported and read back."""
    documents = table(spark, sf_dir, "documents")
    path = export_csv(documents, "documents", scratch_path(spark, "csv"), "doc_id")
    return read_csv(spark, path, documents.schema)


@query("jsonl_export", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def jsonl_export(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "jsonl")
    write_json_lines(events, path, "event_id")
    return read_json_lines(spark, path, events.schema)


@query(
    "copy_tables",
    """
    SELECT 'customer' AS name, c_name AS value FROM customer
    UNION ALL SELECT 'orders', o_orderpriority FROM orders
    """,
)
def copied(spark, sf_dir):
    tables = {name: table(spark, sf_dir, name) for name in ("customer", "orders")}
    copies = copy_tables(tables, scratch_path(spark, "copy"))
    customers = copies["customer"].select(F.lit("customer").alias("name"), F.col("c_name").alias("value"))
    return customers.unionByName(
        copies["orders"].select(F.lit("orders").alias("name"), F.col("o_orderpriority").alias("value"))
    )


def _snapshot(spark, sf_dir, names):
    keys = {"customer": "c_custkey", "orders": "o_orderkey"}
    tables = {name: Capture(table(spark, sf_dir, name), keys[name]) for name in names}
    root = scratch_path(spark, "snapshot")
    return take_snapshot(tables, root, {"dataset": "tables"})


@query("snapshot_table", "SELECT * FROM orders")
def snapshot_table(spark, sf_dir):
    """Capture orders and read them back from the snapshot."""
    return _snapshot(spark, sf_dir, ["orders"]).table("ORDERS")


@query(
    "snapshot_tables",
    """
    SELECT 'customer' AS table_id, 'customer' AS name, count(*) AS record_count,
           0::BIGINT AS attachment_count FROM customer
    UNION ALL SELECT 'orders', 'orders', count(*), 0 FROM orders
    """,
)
def snapshot_tables(spark, sf_dir):
    snapshot = _snapshot(spark, sf_dir, ["customer", "orders"])
    return open_snapshot(spark, snapshot.root).tables()


@query(
    "snapshot_schema",
    """
    WITH s AS (SELECT o_custkey, sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS total, count(*) AS n FROM orders GROUP BY o_custkey)
    SELECT c_custkey, round(total, 2) AS total, coalesce(n, 0) AS n, (SELECT count(*) FROM orders WHERE o_totalprice > 150000) AS large,
           CAST(CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END AS BIGINT) AS documents
    FROM customer LEFT JOIN s ON o_custkey = c_custkey
    """,
)
def snapshot_schema(spark, sf_dir):
    """A relationship and a report, captured, read back from the snapshot and carried out on its tables."""
    tables = {n: Capture(table(spark, sf_dir, n), k) for n, k in (("customer", "c_custkey"), ("orders", "o_orderkey"))}
    paid = [Summary("SUM", "o_totalprice", "total", "o_orderstatus = 'F'", ("o_orderstatus",)), Summary("COUNT", label="n")]
    snapshot = take_snapshot(
        tables, scratch_path(spark, "snapshot"), {"dataset": "tables"},
        relationships=[Relationship("buyers", "customer", "orders", "c_custkey", "o_custkey", summaries=paid)],
        reports=[Report("large", "orders", ["o_orderkey"], [("o_totalprice", "GT", 150000)])],
    )
    captured = {name: snapshot.table(name) for name in tables}
    plan = Derivation(relationships=snapshot.relationships())
    found = derive(captured, plan, ["customer.total", "customer.n"])["customer"]
    large = run_report(captured, snapshot.reports()[0]).agg(F.count(F.lit(1)).alias("large"))
    kinds = F.when(F.col("kind") == "reports", 1).otherwise(2)
    documents = snapshot.inventory().where("kind IN ('relationships', 'reports')").groupBy(kinds.alias("k"))
    documents = documents.agg(F.sum("item_count").alias("n")).where("n > 0").select("k")
    counted = F.when(F.col("c_custkey") % 2 == 0, 1).otherwise(2)
    return found.join(large, how="cross").join(documents, counted == F.col("k")).select(
        "c_custkey", F.round("total", 2).alias("total"), "n", "large", F.col("k").cast("bigint").alias("documents")
    )


@query("snapshot_verify")
def snapshot_verify(spark, sf_dir):
    """Artifacts and bytes of a snapshot that verifies; they depend on how Spark splits files."""
    return _snapshot(spark, sf_dir, ["customer", "orders"]).verify()


# Inventories derived from documents and labels: texts labelled low quality are missing from
# the files, toxic ones were altered, and unlabelled ones are on disk only.
_FILES = """
    WITH d AS (
        SELECT 'tables/' || source || '/attachments/' || d.doc_id AS path, source, text, quality, toxic,
               l.doc_id IS NOT NULL AS listed
        FROM documents d LEFT JOIN labels l USING (doc_id)),
    expected AS (SELECT path, source, sha256(text) AS sha256, strlen(text) AS bytes,
                        length(text) - length(replace(text, chr(10), '')) + 1 AS item_count
                 FROM d WHERE listed),
    actual AS (SELECT path, source,
                      sha256(CASE WHEN toxic = 1 THEN text || '!' ELSE text END) AS sha256,
                      strlen(CASE WHEN toxic = 1 THEN text || '!' ELSE text END) AS bytes
               FROM d WHERE NOT listed OR quality = 1 OR toxic = 1)
"""


def _files(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    labels = table(spark, sf_dir, "labels").withColumn("listed", F.lit(True))
    joined = documents.join(labels, "doc_id", "left").withColumn(
        "path",
        F.concat(F.lit("tables/"), "source", F.lit("/attachments/"), F.col("doc_id").cast("string")),
    )
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    expected = joined.where("listed").select(
        "path",
        F.lit("attachment").alias("kind"),
        F.col("source").alias("table_id"),
        F.sha2("text", 256).alias("sha256"),
        F.octet_length("text").cast("bigint").alias("bytes"),
        lines.cast("bigint").alias("item_count"),
    )
    found = F.when(F.col("toxic") == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    actual = joined.where("listed IS NULL OR quality = 1 OR toxic = 1").select(
        "path",
        F.sha2(found, 256).alias("sha256"),
        F.octet_length(found).cast("bigint").alias("bytes"),
        F.col("text"),
        "quality",
        "toxic",
        F.col("source").alias("table_id"),
    )
    return expected, actual


@query(
    "verify_files",
    _FILES
    + """
    , j AS (SELECT coalesce(e.path, a.path) AS path, e.path IS NULL AS extra, a.path IS NULL AS gone,
                   e.sha256 AS es, a.sha256 AS s, a.bytes - e.bytes AS delta
            FROM expected e FULL JOIN actual a ON e.path = a.path)
    SELECT 'missing' AS "check", path, NULL::VARCHAR AS detail FROM j WHERE gone
    UNION ALL SELECT 'untracked', path, NULL FROM j WHERE extra
    UNION ALL SELECT 'hash differs', path, NULL FROM j WHERE es <> s
    UNION ALL SELECT 'byte count differs', path, delta::VARCHAR FROM j WHERE delta <> 0
    """,
)
def verify_files(spark, sf_dir):
    return compare_files(*_files(spark, sf_dir))


@query(
    "verify_items",
    _FILES
    + """
    , counted AS (SELECT path, CASE WHEN toxic = 1 THEN 1 ELSE
                         length(text) - length(replace(text, chr(10), '')) + 1 END AS n FROM d)
    SELECT 'item count differs' AS "check", path, n::VARCHAR AS detail
    FROM expected JOIN counted USING (path) WHERE n <> item_count
    """,
)
def verify_items(spark, sf_dir):
    """Line counts, with altered texts read as a single line."""
    expected, actual = _files(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    counted = expected.join(
        labels.select(F.col("doc_id").cast("string").alias("doc"), "toxic"),
        F.substring_index("path", "/", -1) == F.col("doc"),
    ).select("path", F.when(F.col("toxic") == 1, F.lit(1)).otherwise(F.col("item_count")).alias("items"))
    return compare_items(expected, counted.withColumn("items", F.col("items").cast("bigint")))


@query(
    "verify_lines",
    """
    WITH lines AS (SELECT event_type || '/' || user_id AS path,
                          CASE event_type WHEN 'error' THEN rtrim(props, '}')
                               WHEN 'view' THEN '[' || props || ']' ELSE props END AS line FROM events),
    c AS (SELECT path, count(*) FILTER (WHERE NOT json_valid(line)) AS invalid,
                 count(*) FILTER (WHERE json_valid(line) AND line LIKE '[%') AS other
          FROM lines GROUP BY path)
    SELECT 'invalid JSON' AS "check", path, invalid::VARCHAR AS detail FROM c WHERE invalid > 0
    UNION ALL SELECT 'non-object line', path, other::VARCHAR FROM c WHERE other > 0
    """,
)
def verify_lines(spark, sf_dir):
    props = F.col("props")
    line = (
        F.when(F.col("event_type") == "error", F.rtrim(props, F.lit("}")))
        .when(F.col("event_type") == "view", F.concat(F.lit("["), props, F.lit("]")))
        .otherwise(props)
    )
    lines = table(spark, sf_dir, "events").select(
        F.concat_ws("/", "event_type", F.col("user_id").cast("string")).alias("path"),
        line.alias("line"),
    )
    return line_issues(check_json_lines(lines, "line", ["path"]))


@query(
    "verify_tables",
    _FILES
    + """
    , t AS (SELECT source AS table_id, count(*) AS record_count FROM documents GROUP BY source),
    c AS (SELECT source AS table_id, sum(item_count)::BIGINT AS n FROM expected GROUP BY source)
    SELECT 'table record count differs' AS "check", table_id AS path, coalesce(n, 0)::VARCHAR AS detail
    FROM t LEFT JOIN c USING (table_id) WHERE coalesce(n, 0) <> record_count
    """,
)
def verify_tables(spark, sf_dir):
    """Records per table against the items of the table's files."""
    expected, _ = _files(spark, sf_dir)
    tables = (
        table(spark, sf_dir, "documents")
        .groupBy(F.col("source").alias("table_id"))
        .agg(F.count(F.lit(1)).alias("record_count"))
        .withColumn("attachment_count", F.lit(0).cast("bigint"))
    )
    return compare_tables(tables, expected.withColumn("kind", F.lit("records")))


@query(
    "verify_index",
    _FILES
    + """
    , idx AS (
        SELECT CASE WHEN toxic = 1 AND quality = 0 THEN 'elsewhere' ELSE source END AS table_id,
               path, sha256(CASE WHEN toxic = 1 THEN text || '!' ELSE text END) AS sha256,
               strlen(CASE WHEN toxic = 1 THEN text || '!' ELSE text END) AS bytes
        FROM d WHERE NOT listed OR quality = 1 OR toxic = 1
        UNION ALL SELECT source, path, sha256(text), strlen(text) FROM d WHERE toxic = 1 AND quality = 1
        UNION ALL SELECT source, NULL, sha256(text), strlen(text) FROM d WHERE NOT listed),
    j AS (SELECT i.*, e.path AS stored, e.sha256 AS es, e.bytes AS eb,
                 starts_with(i.path, 'tables/' || table_id || '/attachments/') AS own
          FROM idx i LEFT JOIN expected e ON i.path = e.path),
    known AS (SELECT * FROM j WHERE own AND stored IS NOT NULL)
    SELECT 'invalid attachment path' AS "check", path, NULL::VARCHAR AS detail FROM j WHERE path IS NULL
    UNION ALL SELECT 'attachment of another table', path, table_id FROM j WHERE path IS NOT NULL AND NOT own
    UNION ALL SELECT 'attachment missing', path, NULL FROM j WHERE own AND stored IS NULL
    UNION ALL SELECT 'attachment integrity differs', path, NULL FROM known WHERE sha256 <> es OR bytes <> eb
    UNION ALL SELECT 'indexed more than once', path, count(*)::VARCHAR FROM known GROUP BY path HAVING count(*) > 1
    UNION ALL SELECT 'never indexed', path, NULL FROM expected WHERE path NOT IN (SELECT path FROM known)
    """,
)
def verify_index(spark, sf_dir):
    expected, actual = _files(spark, sf_dir)
    moved = F.when((F.col("toxic") == 1) & (F.col("quality") == 0), F.lit("elsewhere"))
    entries = actual.select(
        F.coalesce(moved, F.col("table_id")).alias("table_id"), "path", "sha256", "bytes"
    )
    plain = (F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("bigint").alias("bytes"))
    again = actual.where("toxic = 1 AND quality = 1").select("table_id", "path", *plain)
    lost = actual.where("quality IS NULL").select(
        "table_id", F.lit(None).cast("string").alias("path"), *plain
    )
    return compare_index(entries.unionByName(again).unionByName(lost), expected)


@query(
    "verify_summary",
    _FILES
    + "SELECT count(*) AS artifact_count, sum(bytes)::BIGINT AS total_bytes FROM expected",
)
def verify_summary(spark, sf_dir):
    return inventory_summary(_files(spark, sf_dir)[0])


@query(
    "verify_inventory",
    """
    WITH i AS (
        SELECT CASE WHEN toxic = 1 THEN '../' || source ELSE 'docs/' || doc_id END AS path,
               CASE WHEN lang = 'de' THEN 'note' ELSE 'records' END AS kind,
               CASE WHEN quality = 0 THEN upper(sha256(text)) ELSE sha256(text) END AS sha256,
               n_chars - 100 AS bytes, n_chars - 50 AS items
        FROM documents LEFT JOIN labels USING (doc_id))
    SELECT 'unsafe path' AS "check", path, NULL::VARCHAR AS detail FROM i WHERE starts_with(path, '../')
    UNION ALL SELECT 'unknown kind', path, kind FROM i WHERE kind = 'note'
    UNION ALL SELECT 'malformed digest', path, NULL FROM i WHERE sha256 <> lower(sha256)
    UNION ALL SELECT 'negative byte count', path, bytes::VARCHAR FROM i WHERE bytes < 0
    UNION ALL SELECT 'negative item count', path, items::VARCHAR FROM i WHERE items < 0
    UNION ALL SELECT 'repeated path', path, count(*)::VARCHAR FROM i GROUP BY path HAVING count(*) > 1
    """,
)
def verify_inventory(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    digest = F.sha2("text", 256)
    plain = F.concat(F.lit("docs/"), F.col("doc_id").cast("string"))
    inventory = documents.select(
        F.when(F.col("toxic") == 1, F.concat(F.lit("../"), "source")).otherwise(plain).alias("path"),
        F.when(F.col("lang") == "de", "note").otherwise("records").alias("kind"),
        F.when(F.col("quality") == 0, F.upper(digest)).otherwise(digest).alias("sha256"),
        (F.col("n_chars") - 100).alias("bytes"),
        (F.col("n_chars") - 50).alias("item_count"),
    )
    return inventory_problems(inventory)


@query(
    "unsafe_paths",
    r"""
    WITH p AS (
        SELECT url AS path FROM pages
        UNION ALL SELECT regexp_replace(url, '^https?://', '') FROM pages
        UNION ALL SELECT regexp_replace(url, '^https?://[^/]+/', '../') FROM pages
        UNION ALL SELECT replace(regexp_replace(url, '^https?://', ''), '/', chr(92)) FROM pages)
    SELECT 'unsafe path' AS "check", path, NULL::VARCHAR AS detail FROM p
    WHERE path IS NULL OR path = '' OR contains(path, chr(92)) OR starts_with(path, '/')
       OR list_contains(string_split(path, '/'), '..') OR list_contains(string_split(path, '/'), '.')
       OR list_contains(string_split(path, '/'), '')
    """,
)
def unsafe(spark, sf_dir):
    """Page addresses as relative paths, plain and spoiled in three ways."""
    url = F.col("url")
    bare = F.regexp_replace(url, "^https?://", "")
    forms = F.array(
        url,
        bare,
        F.regexp_replace(url, "^https?://[^/]+/", "../"),
        F.replace(bare, F.lit("/"), F.lit("\\")),
    )
    paths = table(spark, sf_dir, "pages").select(F.explode(forms).alias("path"))
    return unsafe_paths(paths)
