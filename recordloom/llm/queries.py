"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.chat_format import Template, format_turns, read_back
from recordloom.llm.decontamination import scan_documents
from recordloom.llm.hard_negatives import mine_hard_negatives
from recordloom.llm.language_mixture import held_out, identify_languages, learn_languages
from recordloom.llm.mixing import mix_sources
from recordloom.llm.near_duplicates import near_duplicates
from recordloom.llm.neighbours import nearest
from recordloom.llm.quality_rules import judge_quality, learn_quality
from recordloom.llm.secrets import BASE_KINDS, RULES, find_secrets, span_text
from recordloom.llm.token_alignment import align_tokens
from recordloom.llm.toxicity import learn_letters, learn_toxicity, score_toxicity
from recordloom.llm.url_rules import judge_urls
from recordloom.llm.warc import read_archive, write_archive

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op9_near_duplicates")
def op9_near_duplicates(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


@_query(
    "op2_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p),
    w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS largest FROM d)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM largest THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM largest THEN largest END AS refers_to
    FROM w
    """,
)
def op2_warc(spark, sf_dir):
    archive = write_archive(_table(spark, sf_dir, "pages"))
    return read_archive(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_SECRET_SQL = "\n".join(
    f"""{rule.kind}_m AS (
        SELECT doc_id, rid, {place} AS place, unnest(generate_series(1, len(m))) AS k, m, g, v
        FROM (SELECT doc_id, rid, regexp_extract_all(t, {pattern}) AS m, string_split_regex(t, {pattern}) AS g,
                     regexp_extract_all(t, {pattern}, {rule.group}) AS v FROM d)
    ),
    {rule.kind} AS (
        SELECT rid, place, CAST(list_sum(list_transform(g[1:k], lambda x: length(x)))
                 + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0) AS BIGINT) AS s, length(m[k]) AS n
        FROM {rule.kind}_m WHERE length(v[k]) >= {rule.least}
    ),"""
    for place, rule in enumerate(RULES)
    for pattern in ["'" + rule.pattern.replace("'", "''") + "'"]
)


def _secret_list(places: str) -> str:
    kinds = "[" + ", ".join(f"'{rule.kind}'" for rule in RULES) + "]"
    text = f"{kinds}[place + 1] || ':' || s || ':' || (s + n)"
    return f"coalesce(string_agg({text}, ',' ORDER BY s, place) FILTER (WHERE place IN ({places})), '')"


@_query(
    "op4_secrets",
    f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
    {_SECRET_SQL}
    found AS ({" UNION ALL ".join(f"SELECT * FROM {rule.kind}" for rule in RULES)})
    SELECT any_value(doc_id) AS doc_id, count(*) FILTER (WHERE place = 0) AS n_assign, count(*) FILTER (WHERE place = 1) AS n_access,
           count(*) FILTER (WHERE place = 2) AS n_hex, sha256({_secret_list("0, 1, 2")}) AS base_sha256,
           {_secret_list("0, 1, 2, 3, 4, 5")} AS spans
    FROM d LEFT JOIN found USING (rid) GROUP BY rid
    """,
)
def op4_secrets(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    of = lambda *places: F.filter("secret_spans", lambda s: s["place"].isin(list(places)))
    return find_secrets(docs).select(
        "doc_id",
        *[F.size(of(i)).cast("long").alias(f"n_{kind}") for i, kind in enumerate(BASE_KINDS)],
        F.sha2(span_text(of(0, 1, 2)), 256).alias("base_sha256"),
        span_text(F.col("secret_spans")).alias("spans"),
    )


@_query(
    "op5_mixing",
    r"""
    WITH d AS (
        SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
               CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 12) AS BIGINT) AS ticket
        FROM documents
    ),
    s AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS words,
               [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS weight
        FROM d GROUP BY source
    ),
    r AS (
        SELECT *, words * 2.0::DOUBLE AS cap, row_number() OVER (ORDER BY words / weight, source NULLS LAST) AS k FROM s
    ),
    l AS (
        SELECT k, cap / weight AS own,
               ((SELECT 1.5::DOUBLE * sum(words) FROM s) - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
               / sum(weight) OVER (ORDER BY k DESC) AS level
        FROM r
    ),
    level AS (SELECT level FROM l WHERE level <= own ORDER BY k LIMIT 1),
    t AS (
        SELECT source, words, CASE WHEN weight * level > cap THEN cap ELSE weight * level END AS target
        FROM r, level
    ),
    p AS (
        SELECT *, CASE WHEN words > 0 THEN least(CAST(floor(target / words) AS BIGINT), 2) ELSE 0 END AS whole FROM t
    ),
    c AS (
        SELECT d.*, words, target, whole, greatest(0, CAST(floor(target) AS BIGINT) - whole * words) AS part,
               coalesce(CAST(sum(size) OVER (PARTITION BY d.source ORDER BY ticket, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS seen
        FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
    )
    SELECT doc_id, size, words AS source_size, target, CAST(whole * size + least(size, greatest(0, part - seen)) AS BIGINT) AS taken
    FROM c
    """,
)
def op5_mixing(spark, sf_dir):
    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


_URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


@_query(
    "op7_url_rules",
    f"""
    WITH u AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
    r AS (SELECT page_id, CASE WHEN strpos(u, '://') > 0 THEN substr(u, strpos(u, '://') + 3) ELSE '' END AS rest FROM u),
    h AS (
        SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path, row_number() OVER () AS rid
        FROM r
    ),
    rules(rule_host, rule_path, verdict) AS (VALUES {", ".join(map(str, _URL_RULES))}),
    fit AS (
        SELECT rid, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
               arg_max(verdict, length(rule_host || rule_path)) AS verdict
        FROM h JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY rid
    )
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM h LEFT JOIN fit USING (rid)
    """,
)
def op7_url_rules(spark, sf_dir):
    rules = spark.createDataFrame(_URL_RULES, "host string, path string, verdict string")
    return judge_urls(_table(spark, sf_dir, "pages"), rules)


_CONTROLS = ", ".join(f"'{c}'" for c in Template().controls())


@_query(
    "op8_chat_format",
    rf"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ),
    e AS (
        SELECT *, lag(role) OVER w AS before, row_number() OVER w AS k, lead(role) OVER w IS NULL AS last,
               length(text) + length(text) - length(replace(text, '\', ''))
               + CAST(list_sum(list_transform([{_CONTROLS}], lambda c: (length(text) - length(replace(text, c, ''))) // length(c))) AS BIGINT)
               + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 END AS chars
        FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(chars) AS BIGINT) AS formatted_chars,
           bool_and((coalesce(before, ''), role) IN (('', 'system'), ('', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user')))
           AND bool_or(last AND role = 'assistant') AS valid
    FROM e GROUP BY conv_id
    """,
)
def op8_chat_format(spark, sf_dir):
    probe = "</s>[INST] ok [/INST]"
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(
        spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    )
    return read_back(format_turns(turns))


@_query("op1_languages")
def op1_languages(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    model = learn_languages(docs.filter(learn))
    return identify_languages(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score", "mixture"
    )


@_query(
    "op6_neighbours",
    """
    WITH v AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ),
    q AS (SELECT vec_id AS query_id, min(e) AS qe FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id),
    d AS (
        SELECT query_id, vec_id, sqrt(list_reduce(list_transform(range(1, len(e) + 1), lambda i: (e[i] - qe[i]) * (e[i] - qe[i])), lambda a, b: a + b)) AS score
        FROM q JOIN v ON vec_id <> query_id AND len(e) = len(qe)
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM d QUALIFY rank <= 10
    """,
)
def op6_neighbours(spark, sf_dir):
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@_query(
    "op3_decontamination",
    r"""
    WITH d AS (
        SELECT doc_id, row_number() OVER () AS rid,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ),
    b AS (
        SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ),
    s AS (SELECT item, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
    i AS (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM s),
    windows AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS words FROM i),
    p AS (
        SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM s) WHERE len(w) >= k
    ),
    hits AS (SELECT rid, i, x.k, item FROM (SELECT rid, i, k, array_to_string(w[i:i + k - 1], ' ') AS words FROM p) x JOIN windows USING (k, words)),
    hit_words AS (SELECT rid, count(DISTINCT word) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS word FROM hits) GROUP BY rid),
    hit_items AS (SELECT rid, list_sort(list(DISTINCT item)) AS items FROM hits GROUP BY rid)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
           sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)
    """,
)
def op3_decontamination(spark, sf_dir):
    found = scan_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@_query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    model = learn_toxicity(docs, labels.filter(learn), learn_letters(docs))
    return score_toxicity(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


TOKENIZERS = "/opt/tokenizers"


@_query("op12_token_alignment")
def op12_token_alignment(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return align_tokens(docs, f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


@_query("op11_quality_rules")
def op11_quality_rules(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_quality(docs, learn_quality(docs, _table(spark, sf_dir, "labels"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability"
    )


@_query(
    "op13_hard_negatives",
    """
    WITH r AS (
        SELECT vec_id, row_number() OVER () AS rid, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    s AS (
        SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label, r.rid,
               CAST(coalesce(list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * r.e[i])), 0) AS BIGINT) AS score
        FROM (SELECT vec_id, min(ROW(label, e)) AS m, m[1] AS label, m[2] AS e FROM r WHERE vec_id % 50 = 0 GROUP BY vec_id) a
        JOIN r ON r.vec_id IS DISTINCT FROM a.vec_id AND len(r.e) = len(a.e)
    ),
    p AS (
        SELECT anchor_id, vec_id AS positive_id, rid AS positive, score AS positive_score FROM s WHERE label = anchor_label
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    ),
    n AS (
        SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, positive ORDER BY score DESC, vec_id) AS INTEGER) AS rank
        FROM p JOIN s ON p.anchor_id = s.anchor_id AND label <> anchor_label
             AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    )
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
    """,
)
def op13_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 50 == 0)
